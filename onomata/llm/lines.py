"""Line deduplication with a tree of templates.

A line is a row of tokens; tokens with a digit are variable. The tree has a fixed
depth: a line goes to the leaf of its number of tokens and its leading tokens. In a
leaf, a line's template keeps the places in which other lines agree with it; lines
that agree in most places are of one template, whose other places are variable
fields. A line whose template occurs in enough different documents is recurring, and
is dropped from all of them.

Equal lines (after variable tokens are masked) are one row, with a few of their
documents: as many as make a line recurring, which is all of them for other lines.
The lines of a leaf meet in one group. A leaf with many different lines is cut into
groups first; lines that are not found recurring there meet, by further levels of the
tree, every line that may agree with them: two lines that differ in d places at most
agree wholly in one of d + 1 ranges of places. The result is the same for any size of
the groups.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpoint, fresh, slices, text_bytes
from .words import LINED, SPACED, mix, run_hashes, runs

#: Leading tokens that lead to a leaf; share of places in which lines of one template must agree.
LEADING, AGREE = 3, 0.7
#: Documents in which a template must occur to be recurring.
DOCUMENTS = 3
#: Different lines that are compared in one group, and bytes of their tokens, about.
PART, PART_BYTES = 1000, 16 << 20

_VARIABLE = np.uint64(0x5DEECE66D)
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True


class Lines:
    """The lines with tokens of some texts: text, number in it, leaf, shape (all masked tokens), first token and end."""

    def __init__(self, texts: pa.Array) -> None:
        data, at = text_bytes(texts)
        a, b, text = runs(data, at, LINED)
        starts, ends, _ = runs(data, at, SPACED)
        first, end = np.searchsorted(starts, a), np.searchsorted(starts, b)
        newlines = np.concatenate([[0], np.cumsum(data == 10)])
        number = newlines[a] - newlines[at[text]]
        some = end > first
        self.text, self.number, self.first, self.end = text[some], number[some], first[some], end[some]
        digits = np.concatenate([[0], np.cumsum(_DIGIT[data])])
        self.tokens = np.where(digits[ends] > digits[starts], _VARIABLE, run_hashes(data, starts, ends))
        size = self.end - self.first
        leaf = mix(size.astype(np.uint64))
        for k in range(LEADING):
            has = size > k
            leaf[has] = mix(leaf[has] + self.tokens[self.first[has] + k])
        self.leaf = leaf
        place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        whole = mix(self.tokens[place + np.repeat(self.first, size)] + mix(place.astype(np.uint64) + np.uint64(5)))
        self.shape = np.add.reduceat(whole, np.cumsum(size) - size) if len(size) else np.zeros(0, np.uint64)
        self.shape = mix(self.shape + leaf)


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each line, and one with line -1 for each document."""
    for batch in slices(batches):
        x = Lines(batch.column("text"))
        row = np.concatenate([np.arange(batch.num_rows), x.text])
        empty = np.zeros(batch.num_rows, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").take(pa.array(row)), batch.column("text_key").take(pa.array(row)), pa.array(np.concatenate([np.full(batch.num_rows, -1), x.number])), _signed(np.concatenate([empty, x.leaf])), _signed(np.concatenate([empty, x.shape]))],
            names=["doc_id", "text_key", "line", "leaf", "shape"],
        )


def _spelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The tokens (32 bits each) of every different line of a slice."""
    for batch in slices(batches):
        x = Lines(batch.column("text"))
        _, some = np.unique(x.shape, return_index=True)
        raw = (x.tokens >> np.uint64(32)).astype(np.uint32).tobytes()
        tokens = pa.array([raw[4 * a : 4 * b] for a, b in zip(x.first[some].tolist(), x.end[some].tolist(), strict=True)], pa.binary())
        yield pa.RecordBatch.from_arrays([_signed(x.leaf[some]), _signed(x.shape[some]), tokens], names=["leaf", "shape", "tokens"])


def least(size: int) -> int:
    """Places in which two lines of ``size`` tokens must agree at least."""
    return math.ceil(AGREE * size - 1e-9)


def meet(tokens: np.ndarray, docs: list[list[int]], asks: np.ndarray, enough: int) -> dict[int, list[int]]:
    """For each row that asks and that others agree with: the documents of them all, ``enough`` of them at most."""
    out = {}
    for k in np.flatnonzero(asks).tolist():
        like = np.flatnonzero((tokens == tokens[k]).sum(axis=1) >= least(tokens.shape[1]))
        if len(like) > 1:
            found: set[int] = set()
            for j in like.tolist():
                found.update(docs[j])
                if len(found) >= enough:
                    break
            out[k] = sorted(found)[:enough]
    return out


def _met(batches: Iterator[pa.RecordBatch], enough: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shapes: list[int] = []
        docs: list[list[int]] = []
        for members in batch.column("members").to_pylist():
            members.sort(key=lambda m: m["shape"])
            tokens = np.array([np.frombuffer(m["tokens"], np.uint32) for m in members])
            found = meet(tokens, [m["docs"] for m in members], np.array([m["asks"] for m in members]), enough)
            shapes += [members[k]["shape"] for k in found]
            docs += found.values()
        yield pa.RecordBatch.from_arrays([pa.array(shapes, pa.int64()), pa.array(docs, pa.list_(pa.int64()))], names=["shape", "docs"])


def _grouped(rows: DataFrame, by: list, enough: int) -> DataFrame:
    """shape and documents of the rows (shape, tokens, docs, asks) that others of their group agree with."""
    groups = rows.groupBy(*by).agg(F.max("asks").alias("asked"), F.collect_list(F.struct("shape", "tokens", "docs", "asks")).alias("members"))
    return groups.where("asked").select("members").mapInArrow(lambda b: _met(b, enough), "shape bigint, docs array<bigint>")


def _crossed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row once for each range of its places, with a bucket for what the range holds."""
    for batch in batches:
        sizes = np.array([len(x) // 4 for x in batch.column("tokens").to_pylist()], np.int64)
        for size in np.unique(sizes).tolist():
            own = batch.take(pa.array(np.flatnonzero(sizes == size)))
            tokens = np.frombuffer(b"".join(own.column("tokens").to_pylist()), np.uint32).reshape(own.num_rows, size).astype(np.uint64)
            leaf = own.column("leaf").to_numpy().view(np.uint64)
            for g, places in enumerate(np.array_split(np.arange(min(LEADING, size), size), size - least(size) + 1)):
                bucket = mix(leaf + np.uint64(g + 1))
                for k in places.tolist():
                    bucket = mix(bucket + tokens[:, k])
                yield pa.RecordBatch.from_arrays([_signed(bucket), *(own.column(c) for c in ("shape", "tokens", "docs", "asks"))], names=["bucket", "shape", "tokens", "docs", "asks"])


def _parts(lines: Column, width: Column) -> Column:
    """Groups for so many lines whose tokens have so many bytes each."""
    return F.ceil(F.greatest(lines / PART, lines * width / PART_BYTES)).cast("int")


def recurring_shapes(docs: DataFrame, lines: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """The shapes of lines whose template occurs in ``documents`` documents or more."""
    seen = lines.where("line >= 0").select("leaf", "shape", F.xxhash64("doc_id", "text_key").alias("doc")).distinct()
    # A very common line sends a few of its documents from each task only.
    few = seen.withColumn("k", F.row_number().over(Window.partitionBy("leaf", "shape").orderBy("doc"))).where(F.col("k") <= documents)
    shapes = checkpoint(few.groupBy("leaf", "shape").agg(F.collect_list("doc").alias("docs")))
    enough = F.size("docs") >= documents
    leaves = shapes.groupBy("leaf").agg(F.count(F.lit(1)).alias("shapes"), F.sum(F.size("docs")).alias("total"), F.max(~enough).alias("asks"))
    leaves = leaves.where((F.col("shapes") > 1) & (F.col("total") >= documents) & F.col("asks")).select("leaf", "shapes")
    spelled = docs.select("text").mapInArrow(_spelled, "leaf bigint, shape bigint, tokens binary")
    # A line in many slices comes once from each; the first is as good as any.
    rows = spelled.join(shapes.join(leaves, "leaf"), ["leaf", "shape"]).groupBy("leaf", "shape").agg(*(F.first(c).alias(c) for c in ("tokens", "docs", "shapes")))
    rows = checkpoint(rows.select("leaf", "shape", "tokens", "docs", _parts(F.col("shapes"), F.length("tokens")).alias("parts"), (~enough).alias("asks")))
    found = checkpoint(_grouped(rows, ["leaf", F.pmod(F.xxhash64("shape"), F.col("parts"))], documents).where(enough).select("shape"))

    # Large leaves: what is not found yet meets all lines that may agree with it, block by block where they are many.
    decided = found.withColumn("decided", F.lit(True))
    large = rows.where("parts > 1").drop("parts").join(decided, "shape", "left").withColumn("asks", F.col("asks") & F.col("decided").isNull()).drop("decided")
    crossed = large.select("leaf", "shape", "tokens", "docs", "asks").mapInArrow(_crossed, "bucket bigint, shape bigint, tokens binary, docs array<bigint>, asks boolean")
    sizes = crossed.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.max(F.length("tokens")).alias("width"), F.max("asks").alias("asked")).where("asked and size > 1")
    blocks = crossed.join(sizes.select("bucket", _parts(F.col("size"), F.col("width")).alias("blocks")), "bucket")
    blocks = blocks.withColumn("own", F.pmod(F.xxhash64("shape"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    late = _grouped(blocks, ["bucket", F.least("own", "other"), F.greatest("own", "other")], documents)
    late = late.groupBy("shape").agg(F.array_distinct(F.flatten(F.collect_list("docs"))).alias("docs")).where(enough)
    return shapes.where(enough).select("shape").union(found).union(late.select("shape")).distinct()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_key"))


def dropped_lines(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, text_key, copies (equal rows), n_lines and dropped (numbers of the lines dropped, from 0) of each
    different document."""
    keyed = _keyed(docs)
    lines = checkpoint(keyed.mapInArrow(_listed, "doc_id bigint, text_key bigint, line bigint, leaf bigint, shape bigint"))
    gone = recurring_shapes(keyed, lines, documents).withColumn("gone", F.lit(True))
    marked = lines.join(gone, "shape", "left")
    return marked.groupBy("doc_id", "text_key").agg(
        F.count(F.when(F.col("line") < 0, 1)).alias("copies"),
        F.count(F.when(F.col("line") >= 0, 1)).alias("rows"),
        F.array_sort(F.collect_set(F.when(F.col("gone") & (F.col("line") >= 0), F.col("line")))).alias("dropped"),
    ).select("doc_id", "text_key", "copies", (F.col("rows") / F.col("copies")).cast("long").alias("n_lines"), "dropped")


def line_report(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """doc_id, n_lines (lines with a token), n_dropped and dropped (their numbers, from 0) of every document.

    Null and empty texts have no lines; repeated rows get a row each but count as one document; lines of one template
    in one document count once for it; no rows give none.
    """
    found = dropped_lines(docs, documents)
    rows = found.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return rows.select("doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"), "dropped")


def _without(batches: Iterator[pa.RecordBatch], dropped: str, columns: list[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, gone in zip(batch.column("text").to_pylist(), batch.column(dropped).to_pylist(), strict=True):
            out = set(gone or ())
            texts.append("\n".join(x for k, x in enumerate(text.split("\n")) if k not in out) if text and out else text)
        kept = {c: batch.column(c) for c in columns} | {"text": pa.array(texts, pa.string())}
        yield pa.RecordBatch.from_arrays([kept[c] for c in columns], names=columns)


def drop_lines(docs: DataFrame, documents: int = DOCUMENTS) -> DataFrame:
    """The documents, with their own columns, without the lines of recurring templates."""
    key, dropped = fresh(docs.columns, "key"), fresh(docs.columns, "dropped")
    own_id, own_key = (fresh([*docs.columns, key, dropped], x) for x in ("own_id", "own_key"))
    found = dropped_lines(docs, documents).where(F.size("dropped") > 0).select(F.col("doc_id").alias(own_id), F.col("text_key").alias(own_key), F.col("dropped").alias(dropped))
    keyed = docs.withColumn(key, F.xxhash64(F.coalesce("text", F.lit(""))))
    both = keyed.join(found, F.col("doc_id").eqNullSafe(F.col(own_id)) & (F.col(key) == F.col(own_key)), "left").select(*(F.col(f"`{c}`") for c in docs.columns), dropped)
    columns = docs.columns
    return both.mapInArrow(lambda b: _without(b, dropped, columns), T.StructType(docs.schema.fields))
