"""Benchmark decontamination with suffix arrays over the training text.

Every slice of the training documents (a shard of a few MB) gets a suffix
array of word positions. All benchmark suffixes are located in it by binary
search, one word after the other, which narrows each suffix's range in the
array. A suffix that is located with all words of a window has a match there;
located suffixes that follow each other in one item and in the text, word by
word, are one match, and the longest such stretch is the longest verbatim match.
Suffixes of the training text whose first words begin no benchmark window could
never be in a range; they are left out of the array before it is sorted.

The benchmark is read in blocks of bounded size. Some blocks at a time are
shared with the tasks and searched for in one pass over the documents, each in
turn; a larger benchmark takes several passes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, fresh, share, slices, stage, text_bytes, with_columns
from .words import ALNUM, lower_ascii, mix, run_hashes, runs

#: Words of a window.
WINDOW = 10
#: Bytes of benchmark text that are searched for at once.
BLOCK_BYTES = 4 << 20
#: Blocks that are shared with the tasks in one pass; bytes of documents for which a task prepares each of them once.
BLOCKS, HELD_BYTES = 8, 32 << 20
_TABLE_BITS = 22


def _words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and text numbers of all words, and where each text's words begin."""
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, text = runs(data, at, ALNUM)
    return run_hashes(data, starts, ends), text, np.searchsorted(text, np.arange(len(texts) + 1))


def _head(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the first n (1 or 2) words of the suffix at each place."""
    h = mix(words)
    if n == 2:
        h = mix(h + np.append(words[1:], np.uint64(0)) * np.uint64(0x9E3779B97F4A7C15))
    return h


class Block:
    """Windows of some benchmark items: the distinct ones, and where each occurs (item, first word)."""

    def __init__(self, ids: list[str], words: np.ndarray, first: np.ndarray, window: int) -> None:
        count = np.diff(first)
        size = np.minimum(window, count)
        some = np.where(count > 0, count - size + 1, 0)  # windows of each item
        item = np.repeat(np.arange(len(ids)), some)
        offset = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
        at, size = first[item] + offset, size[item]
        h = mix(size.astype(np.uint64))
        for k in range(window):
            h = np.where(size > k, mix(h * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(at + k, max(len(words) - 1, 0))] if len(words) else h), h)
        order = np.argsort(h, kind="stable")
        new = np.flatnonzero(np.diff(h[order], prepend=np.uint64(0)) != 0) if len(h) else np.zeros(0, np.int64)
        if len(h) and (not len(new) or new[0] != 0):
            new = np.concatenate([[0], new])
        self.ids, self.item, self.offset = ids, item[order], offset[order]
        self.first = np.append(new, len(h))  # occurrences of each distinct window
        one = order[new]
        self.size = size[one]
        column = np.arange(window)
        inside = column < self.size[:, None]
        self.words = np.where(inside, words[np.minimum(at[one, None] + column, max(len(words) - 1, 0))], 0).astype(np.uint64) if len(one) else np.zeros((0, window), np.uint64)
        self.heads = {}
        for n in {min(2, int(x)) for x in np.unique(self.size)}:
            own = self.words[np.minimum(self.size, 2) == n]
            heads = mix(own[:, 0])
            if n == 2:
                heads = mix(heads + own[:, 1] * np.uint64(0x9E3779B97F4A7C15))
            heads = np.unique(heads)
            near = np.zeros(1 << _TABLE_BITS, bool)
            near[heads >> np.uint64(64 - _TABLE_BITS)] = True
            self.heads[n] = (heads, near)

    def occurrences(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For located windows: the number of the location, the item and the first word there, of every occurrence."""
        n = np.diff(self.first)[which]
        row = np.repeat(np.arange(len(which)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(self.first[which], n)
        return row, self.item[at], self.offset[at]

    def starts(self, words: np.ndarray) -> np.ndarray:
        """Places whose first words begin some window."""
        found = [np.zeros(0, np.int64)]
        for n, (h, near) in self.heads.items():
            own = _head(words, n)
            at = np.flatnonzero(near[own >> np.uint64(64 - _TABLE_BITS)])
            found.append(at[h[np.minimum(np.searchsorted(h, own[at]), len(h) - 1)] == own[at]])
        return np.unique(np.concatenate(found))


def _locate(words: np.ndarray, stop: np.ndarray, at: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
    """(place, window) of every occurrence: a suffix array of the places ``at``, searched for all windows."""
    if not len(at) or not len(block.size):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    width = block.words.shape[1]
    # Word k of each suffix; past its text's end a value below all words (their hashes are moved up by one).
    columns = [np.where(at + k < stop, np.maximum(words[np.minimum(at + k, len(words) - 1)], 1), 0).astype(np.uint64) for k in range(width)]
    order = np.lexsort(columns[::-1])
    columns, at = [c[order] for c in columns], at[order]
    lo, hi = np.zeros(len(block.size), np.int64), np.full(len(block.size), len(at))
    for k in range(width):
        live = np.flatnonzero((block.size > k) & (lo < hi))
        if not len(live):
            break
        wanted, column = np.maximum(block.words[live, k], 1), columns[k]
        for left in (True, False):
            a, b = lo[live].copy(), hi[live].copy()
            while (open_ := a < b).any():
                middle = (a + b) >> 1
                value = column[np.minimum(middle, len(at) - 1)]
                right = open_ & ((value < wanted) if left else (value <= wanted))
                a = np.where(right, middle + 1, a)
                b = np.where(open_ & ~right, middle, b)
            if left:
                low = a
            else:
                lo[live], hi[live] = low, a
    n = np.maximum(hi - lo, 0)
    which = np.repeat(np.arange(len(n)), n)
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return at[place], which


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))
_MATCHES = pa.list_(pa.struct([("item", pa.string()), ("words", pa.int64()), ("first", pa.int64()), ("item_first", pa.int64())]))
_FOUND = pa.struct([("n_words", pa.int64()), ("spans", _SPANS), ("matches", _MATCHES)])
_FOUND_SQL = "struct<n_words:bigint,spans:array<struct<first:bigint,end:bigint>>,matches:array<struct<item:string,words:bigint,first:bigint,item_first:bigint>>>"


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of intervals, sorted; touching ones are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def _longest(text: np.ndarray, place: np.ndarray, item: np.ndarray, offset: np.ndarray, size: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each text and item: words, place in the text and in the item of the longest match (of equal ones the first).

    Located windows of one item that lie word by word behind each other, there and in the text, are one match."""
    order = np.lexsort((place, place - offset, item, text))
    text, place, item, offset, size = (x[order] for x in (text, place, item, offset, size))
    new = np.ones(len(place), bool)
    new[1:] = (text[1:] != text[:-1]) | (item[1:] != item[:-1]) | (place[1:] - offset[1:] != place[:-1] - offset[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    words = np.diff(np.append(begin, len(place))) - 1 + size[begin]
    text, place, item, offset = (x[begin] for x in (text, place, item, offset))
    order = np.lexsort((offset, place, -words, item, text))
    best = np.ones(len(order), bool)
    best[1:] = (text[order][1:] != text[order][:-1]) | (item[order][1:] != item[order][:-1])
    return [x[order][best] for x in (text, item, words, place, offset)]


def _search(batches: Iterator[pa.RecordBatch], column: str, name: str, shared: list, window: int) -> Iterator[pa.RecordBatch]:
    """Adds or extends the column ``name`` by what the shared blocks have in common with each text."""
    held = []
    for batch in batches:  # some batches at once, so that a block is prepared for a good part of the partition
        held.append(batch)
        if sum(b.nbytes for b in held) >= HELD_BYTES:
            yield from _search_held(held, column, name, shared, window)
            held = []
    yield from _search_held(held, column, name, shared, window)


def _search_held(held: list[pa.RecordBatch], column: str, name: str, shared: list, window: int) -> Iterator[pa.RecordBatch]:
    parts = list(slices(iter(held), column))
    found: list[list[tuple[list, list]]] = [[([], []) for _ in range(part.num_rows)] for part in parts]
    count = [np.zeros(0, np.int64)] * len(parts)
    for give in shared:
        block = Block(*give(), window)
        for i, part in enumerate(parts):
            words, text, first = _words(part.column(column))
            count[i] = np.diff(first)
            at = block.starts(words)
            place, which = _locate(words, first[text[at] + 1], at, block)
            owner = text[place]
            for k, a, n in zip(owner.tolist(), (place - first[owner]).tolist(), block.size[which].tolist(), strict=True):
                found[i][k][0].append((a, a + n))
            row, item, offset = block.occurrences(which)
            for k, j, n, a, b in zip(*(x.tolist() for x in _longest(owner[row], (place - first[owner])[row], item, offset, block.size[which][row])), strict=True):
                found[i][k][1].append({"item": block.ids[j], "words": n, "first": a, "item_first": b})
    for part, own, n in zip(parts, found, count, strict=True):
        before = part.column(name).to_pylist() if name in part.schema.names else [None] * part.num_rows
        rows = []
        for k, (spans, matches) in enumerate(own):
            if before[k]:
                spans += [(x["first"], x["end"]) for x in before[k]["spans"]]
                matches += before[k]["matches"]
            best: dict[str, dict] = {}
            for m in sorted(matches, key=lambda m: (m["item"], -m["words"], m["first"], m["item_first"])):
                best.setdefault(m["item"], m)
            rows.append({"n_words": int(n[k]), "spans": [{"first": a, "end": b} for a, b in _merged(spans)], "matches": list(best.values())})
        if name in part.schema.names:
            part = part.drop_columns([name])
        yield with_columns(part, {name: pa.array(rows, _FOUND)})


def _blocks(benchmark: DataFrame) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """The benchmark's items in blocks of about BLOCK_BYTES: ids, hashed words, and where each item's begin. The driver
    reads a partition and holds a block at a time."""

    def block(ids: list, texts: list):
        words, _, first = _words(pa.array(texts, pa.large_string()))
        return [str(x) for x in ids], words, first

    ids, texts, size = [], [], 0
    for row in benchmark.select("item_id", "text").where("text is not null and item_id is not null").toLocalIterator():
        ids.append(row[0])
        texts.append(row[1])
        size += len(row[1])
        if size >= BLOCK_BYTES:
            yield block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield block(ids, texts)


def _covered(spans: Column) -> Column:
    """Words inside the union of intervals, which come sorted."""
    start = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("until"))

    def add(state: Column, x: Column) -> Column:
        more = F.greatest(x.end - F.greatest(x.first, state.until), F.lit(0))
        return F.struct((state.total + more).alias("total"), F.greatest(state.until, x.end).alias("until"))

    return F.aggregate(F.array_sort(spans), start, add, lambda state: state.total)


def find_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns and rows of ``docs``, and a struct ``matches`` (underscores go in front of a taken name) of
    n_words, spans (first word and end of each stretch of words inside benchmark windows), and matches: for each item
    with a window in the text the longest verbatim match, as item (id as string), words, first (its place in the text)
    and item_first (its place in the item); items are sorted, of matches of one length the first counts.

    A window is ``window`` consecutive words of an item; an item of fewer words, but not none, is one window.
    Null and empty texts, in either table, have no words and match nothing; an item without id is ignored; items of
    one id count as one item; repeated documents each get their row; empty tables give no rows, or no matches.
    """
    spark = docs.sparkSession
    name = fresh(docs.columns, "matches")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T._parse_datatype_string(_FOUND_SQL))])

    def search(found: DataFrame, shared: list) -> DataFrame:
        return found.mapInArrow(lambda b: _search(b, "text", name, shared, window), schema)

    found, shared, staged = docs, [], None
    for block in _blocks(benchmark):
        if len(shared) == BLOCKS:  # a further pass, over what the one before has written
            found, before = stage(search(found, shared)), staged
            staged, shared = found, []
            if before is not None:
                discard(before)
        shared.append(share(spark, block))
    return search(found, shared or [share(spark, ([], np.zeros(0, np.uint64), np.zeros(1, np.int64)))])


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with their own columns, in which no word is inside a benchmark window."""
    found = find_matches(docs, benchmark, window)
    return found.where(F.size(F.col(f"`{found.columns[-1]}`.matches")) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256, contaminated; longest_match (words of the longest verbatim
    match, 0 for none), longest_at (its first word, null for none) and longest_item (of equal ones the first place, then
    the first id)."""
    m = find_matches(docs.select("doc_id", "text"), benchmark, window)
    matches = F.col("matches.matches")
    items = F.transform(matches, lambda x: x["item"])
    best = F.array_min(F.transform(matches, lambda x: F.struct((-x["words"]).alias("less"), x["first"].alias("first"), x["item"].alias("item"))))
    return m.select(
        "doc_id",
        F.col("matches.n_words").alias("n_words"),
        _covered(F.col("matches.spans")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(items) > 0).alias("contaminated"),
        F.coalesce(-best["less"], F.lit(0).cast("long")).alias("longest_match"),
        best["first"].alias("longest_at"),
        best["item"].alias("longest_item"),
    )
