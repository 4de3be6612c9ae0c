"""Source divergence audit by a recount through minimal perfect hashes.

The first pass counts exactly in how many documents of its language each term occurs; rare terms go. The kept terms
of a language are dealt to shards by their hash, and every shard gets a minimal perfect hash: levels of bits, on each
of which a key that lies alone sets its bit, so that the rank of the bit is the key's slot; the keys are stored by
slot. The second pass looks every term up in the broadcast shards, compares it with the key stored at its slot, and
counts it in a dense array of its (language, source). The smoothed counts of two sources, or of a source and its
language, are then compared block by block of slots, all in whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import slices, stage, text_bytes
from .words import lower_ascii, mix, run_hashes, runs

#: Documents of its language that a kept term occurs in; terms that are named for each source.
DOCUMENTS, TOP = 10, 10
#: Terms of a shard on average; levels of bits, after which the few terms that are left are searched by their bytes.
SHARD, LEVELS = 8192, 24
#: Bytes of all shards up to which they are broadcast. Beyond it terms meet their slots in a shuffle join.
BROADCAST_BYTES = 48 << 20
#: Bytes of dense counts that a task holds before it hands them on; bytes of text it handles at once.
HELD_BYTES, TEXT_BYTES = 48 << 20, 3 << 20
#: Counts (sources x slots) that are compared at once; groups (language, source) that are broadcast at most.
CELLS, GROUPS = 1 << 17, 200_000
#: Probabilities and their divergence are whole numbers of this part; added to each count.
PARTS, ADDED = 1_000_000_000, 2

#: True for bytes of terms: ASCII letters and all bytes of other characters.
TERMED = np.zeros(256, bool)
TERMED[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_LEVEL = np.random.Generator(np.random.PCG64(59)).integers(0, 2**64, LEVELS, dtype=np.uint64)


def terms_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The different terms of all texts, the number among these of every occurrence, and the text it is in."""
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, text = runs(data, at, TERMED)
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[TERMED[data]])).dictionary_encode()
    return found.dictionary, found.indices.to_numpy(), text


def term_hashes(terms: pa.Array) -> np.ndarray:
    data, at = text_bytes(terms)
    return run_hashes(data, at[:-1], at[1:])


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, term, n): documents with the term, of a slice of rows."""
    for batch in slices(batches, most=TEXT_BYTES):
        terms, code, text = terms_of(batch.column("text"))
        lang = batch.column("lang").dictionary_encode()
        doc, term = np.divmod(np.unique(text * len(terms) + code), max(1, len(terms)))
        key, n = np.unique(lang.indices.to_numpy().astype(np.int64)[doc] * len(terms) + term, return_counts=True)
        own, term = np.divmod(key, max(1, len(terms)))
        yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(own)), terms.take(pa.array(term)).cast(pa.string()), pa.array(n)], names=["lang", "term", "n"])


def _group_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, term, n): occurrences, of a slice of rows."""
    for batch in slices(batches, most=TEXT_BYTES):
        terms, code, text = terms_of(batch.column("text"))
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        key, n = np.unique(group[text] * len(terms) + code, return_counts=True)
        group, term = np.divmod(key, max(1, len(terms)))
        own, of = np.divmod(group, max(1, len(source.dictionary)))
        yield pa.RecordBatch.from_arrays([lang.dictionary.take(pa.array(own)), source.dictionary.take(pa.array(of)), terms.take(pa.array(term)).cast(pa.string()), pa.array(n)], names=["lang", "source", "term", "n"])


def _placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the shard of each term."""
    for batch in batches:
        shard = (term_hashes(batch.column("term")) % batch.column("shards").to_numpy().astype(np.uint64)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(shard), batch.column("term")], names=["lang", "shard", "term"])


def perfect_hash(h: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Slots 0 to n - 1 of n hashes, all different, and the bits of each level, in words of 64. Slots of equal hashes
    come last: no level tells them apart."""
    slot, rest, base, levels = np.zeros(len(h), np.int64), np.arange(len(h)), 0, []
    for k in range(LEVELS):
        if not len(rest):
            break
        size = 64 * (len(rest) * 2 // 64 + 1)
        place = (mix(h[rest] + _LEVEL[k]) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(place, minlength=size)[place] == 1
        bits = np.zeros(size, bool)
        bits[place[alone]] = True
        slot[rest[alone]] = base + np.cumsum(bits)[place[alone]] - 1
        base += int(alone.sum())
        rest = rest[~alone]
        levels.append(np.packbits(bits.reshape(-1, 64), axis=1, bitorder="little").view(np.uint64).ravel())
    slot[rest] = base + np.arange(len(rest))
    return slot, levels


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The perfect hash of each shard: words of its levels, their bits, and its terms by slot."""
    kind = pa.schema([("lang", pa.string()), ("shard", pa.int64()), ("sizes", pa.list_(pa.int64())), ("bits", pa.binary()), ("terms", pa.list_(pa.string()))])
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            terms = pa.array(sorted(row["terms"]), pa.string())
            slot, levels = perfect_hash(term_hashes(terms))
            bits = b"".join(x.tobytes() for x in levels)
            rows.append({"lang": row["lang"], "shard": row["shard"], "sizes": [len(x) for x in levels], "bits": bits, "terms": terms.take(pa.array(np.argsort(slot))).to_pylist()})
        yield pa.RecordBatch.from_pylist(rows, kind)


class Shards:
    """All shards of a language, one after the other, as they are looked up."""

    def __init__(self, sizes: list[list[int]], bits: bytes, terms: list[int], data: bytes, offsets: np.ndarray):
        self.n = len(sizes)
        self.bits = np.frombuffer(bits, np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])
        self.words = np.zeros((LEVELS, self.n), np.uint64)
        for k, own in enumerate(sizes):
            self.words[: len(own), k] = own
        ends = np.cumsum(self.words.T.ravel()).astype(np.int64).reshape(self.n, LEVELS).T
        self.at = ends - self.words.astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(terms)])
        set_before = self.before[self.at[0]]
        self.shift = self.first[:-1] - set_before
        self.terms = pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data))
        placed = np.diff(np.append(set_before, self.before[-1]))
        left = np.concatenate([np.arange(a + p, a + t) for a, p, t in zip(self.first, placed, terms, strict=False)] or [np.zeros(0, np.int64)])
        self.left = {t: int(k) for k, t in zip(left, self.terms.take(pa.array(left)).to_pylist(), strict=True)}

    def find(self, terms: pa.Array) -> np.ndarray:
        """Number of each term among all of the language, by shard and slot; -1 for a term that is not kept."""
        h = term_hashes(terms)
        shard = (h % np.uint64(self.n)).astype(np.int64)
        out, rest = np.full(len(h), -1, np.int64), np.arange(len(h))
        for k in range(LEVELS):
            words = self.words[k, shard[rest]]
            rest, words = rest[words > 0], words[words > 0]
            if not len(rest):
                break
            place = (mix(h[rest] + _LEVEL[k]) % (words * np.uint64(64))).astype(np.int64)
            word, bit = self.at[k, shard[rest]] + (place >> 6), (place & 63).astype(np.uint64)
            here = (self.bits[word] >> bit) & np.uint64(1) == 1
            below = self.bits[word] & ((np.uint64(1) << bit) - np.uint64(1))
            rank = self.before[word] + np.bitwise_count(below)
            out[rest[here]] = (rank + self.shift[shard[rest]])[here]
            rest = rest[~here]
        some = np.flatnonzero(out >= 0)
        same = pc.equal(self.terms.take(pa.array(out[some])), terms.take(pa.array(some)).cast(pa.large_string()))
        out[some[~same.to_numpy(zero_copy_only=False)]] = -1
        if self.left:
            for k in np.flatnonzero(out < 0).tolist():
                out[k] = self.left.get(terms[k].as_py(), -1)
        return out


def _recount(batches: Iterator[pa.RecordBatch], tables) -> Iterator[pa.RecordBatch]:
    """Rows (lang, source, shard, slot, n) of the dense counts of each group."""
    known: dict[str, Shards] = {}
    held: dict[tuple[str, str], np.ndarray] = {}

    def hand_on() -> Iterator[pa.RecordBatch]:
        for (lang, source), dense in held.items():
            some = np.flatnonzero(dense)
            shard = np.searchsorted(known[lang].first, some, "right") - 1
            slot = some - known[lang].first[shard]
            for a in range(0, len(some), 1 << 16):
                b = min(a + (1 << 16), len(some))
                yield pa.RecordBatch.from_arrays([pa.array([lang] * (b - a)), pa.array([source] * (b - a)), pa.array(shard[a:b]), pa.array(slot[a:b]), pa.array(dense[some[a:b]])], names=["lang", "source", "shard", "slot", "n"])
        held.clear()

    for batch in slices(batches, most=TEXT_BYTES):
        terms, code, text = terms_of(batch.column("text"))
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        lang_of, source_of = lang.indices.to_numpy()[text], source.indices.to_numpy()[text]
        sources = source.dictionary.to_pylist()
        for k, name in enumerate(lang.dictionary.to_pylist()):
            if name not in tables.value:
                continue
            if name not in known:
                known[name] = Shards(*tables.value[name])
            here = lang_of == k
            used = np.unique(code[here])
            place = np.full(len(terms), -1, np.int64)
            place[used] = known[name].find(terms.take(pa.array(used)))
            place, of = place[code[here]], source_of[here]
            total = int(known[name].first[-1])
            key, n = np.unique((of.astype(np.int64) * total + place)[place >= 0], return_counts=True)
            of, place = np.divmod(key, total)
            cuts = np.searchsorted(of, np.arange(len(sources) + 1))
            for s in np.unique(of).tolist():
                group = (name, sources[s])
                if group not in held:
                    if sum(x.nbytes for x in held.values()) + 8 * total > HELD_BYTES:
                        yield from hand_on()
                    held[group] = np.zeros(total, np.int64)
                held[group][place[cuts[s] : cuts[s + 1]]] += n[cuts[s] : cuts[s + 1]]
    yield from hand_on()


def parts_of(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(PARTS * count / total), exactly, by long division in three steps."""
    out = np.zeros(np.broadcast(count, total).shape, np.int64)
    rest = count
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For a block of slots: the divergence of every two sources, and the leading terms of each source."""
    kind = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])
    for batch in batches:
        for k in range(batch.num_rows):
            lang, groups, kept = (batch.column(c)[k].as_py() for c in ("lang", "groups", "kept"))
            names = pa.array([g["source"] for g in groups], pa.string())
            cells = batch.column("cells")[k].values
            cells = {f.name: pa.array([], f.type) for f in batch.schema.field("cells").type.value_type} if cells is None else dict(zip(cells.type.names, cells.flatten(), strict=True))
            # Rows with a term name the slots; the others are counts.
            named = cells["term"].is_valid()
            terms, slots = (cells[c].filter(named) for c in ("term", "slot"))
            counted = {c: cells[c].filter(pc.invert(named)) for c in ("source", "slot", "n")}
            count = np.zeros((len(names), len(terms)), np.int64)
            count[pc.index_in(counted["source"], names).to_numpy(), pc.index_in(counted["slot"], slots).to_numpy()] = counted["n"].to_numpy()
            names, kept = names.to_pylist(), 2 * kept
            own = np.array([g["n"] for g in groups], np.int64)
            p = parts_of(count + ADDED, own[:, None] + kept)
            q = parts_of(count.sum(axis=0) + ADDED, np.array(own.sum() + kept))
            out = []
            for i in range(len(names)):
                value = divergence(p[i], p[i + 1 :]).sum(axis=1).tolist()
                out += [(lang, names[i], "pair", names[i + 1 + j], v) for j, v in enumerate(value)]
                out += [(lang, names[i + 1 + j], "pair", names[i], v) for j, v in enumerate(value)]
                some = np.flatnonzero((count[i] > 0) & (p[i] > q))
                value = divergence(p[i, some], q[some])
                if len(some) > TOP:
                    least = np.partition(value, -TOP)[-TOP]
                    some, value = some[value >= least], value[value >= least]
                best = sorted(zip((-value).tolist(), terms.take(pa.array(some)).to_pylist(), strict=True))[:TOP]
                out += [(lang, names[i], "term", t, -v) for v, t in best]
            for a in range(0, len(out), 1 << 16):
                yield pa.RecordBatch.from_pylist([dict(zip(kind.names, x, strict=True)) for x in out[a : a + (1 << 16)]], kind)


def _counted(docs: DataFrame, shards: DataFrame, kept: DataFrame) -> DataFrame:
    """Occurrences (lang, source, shard, slot, n) of the kept terms, one row for each that occurs."""
    size = shards.select(F.length("bits").alias("x"), F.aggregate("terms", F.lit(0).cast("bigint"), lambda a, t: a + F.octet_length(t) + 8).alias("y")).agg(F.sum(F.col("x") + F.col("y"))).first()[0] or 0
    rows = docs.select("lang", "source", "text")
    if size > BROADCAST_BYTES:
        terms = rows.mapInArrow(_group_counts, "lang string, source string, term string, n bigint").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"))
        return terms.join(kept, ["lang", "term"]).select("lang", "source", "shard", "slot", "n")
    tables: dict[str, list] = {}
    for r in shards.orderBy("lang", "shard").toLocalIterator():
        own = tables.setdefault(r["lang"], [[], [], [], [], [np.zeros(1, np.int64)]])
        data, at = text_bytes(pa.array(r["terms"], pa.string()))
        for x, y in zip(own, (list(r["sizes"]), bytes(r["bits"]), len(r["terms"]), data.tobytes(), at[1:] + own[4][-1][-1]), strict=True):
            x.append(y)
    shared = docs.sparkSession.sparkContext.broadcast({k: (s, b"".join(b), t, b"".join(d), np.concatenate(o)) for k, (s, b, t, d, o) in tables.items()})
    return rows.mapInArrow(lambda b: _recount(b, shared), "lang string, source string, shard bigint, slot bigint, n bigint").groupBy("lang", "source", "shard", "slot").agg(F.sum("n").alias("n"))


def source_divergence(docs: DataFrame) -> DataFrame:
    """lang, source, part, item, value and rank: how far each source of a language is from each other one (part
    ``pair``), and the ten terms that set it apart from the whole language (part ``term``).

    Null texts, languages and sources count as empty ones; every row is a document, repeated ones too; a source without
    kept terms has its pairs, of value 0 where the language keeps none; ties go by the item; no rows, none.
    """
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")))
    frequent = stage(docs.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, n bigint").groupBy("lang", "term").agg(F.sum("n").alias("n")).where(F.col("n") >= DOCUMENTS).select("lang", "term"))
    sizes = frequent.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    sized = frequent.join(sizes.select("lang", F.ceil(F.col("kept") / SHARD).alias("shards")), "lang")
    placed = sized.mapInArrow(_placed, "lang string, shard bigint, term string")
    shards = stage(placed.groupBy("lang", "shard").agg(F.collect_list("term").alias("terms")).mapInArrow(_build, "lang string, shard bigint, sizes array<bigint>, bits binary, terms array<string>"))
    kept = shards.select("lang", "shard", F.posexplode("terms").alias("slot", "term")).withColumn("slot", F.col("slot").cast("bigint"))
    cells = stage(_counted(docs, shards, kept))

    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
    groups = docs.groupBy("lang", "source").agg(F.lit(0).cast("bigint").alias("n")).union(totals).groupBy("lang", "source").agg(F.sum("n").alias("n"))
    langs = groups.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("source", "n"))).alias("groups")).join(sizes, "lang", "left")
    langs = stage(langs.withColumn("kept", F.coalesce("kept", F.lit(0).cast("bigint"))))
    measured = langs.agg(F.sum(F.size("groups")).alias("n"), F.max(F.size("groups")).alias("most")).first()

    width = max(1, CELLS // (measured["most"] or 1))
    none = {"source": "string", "n": "bigint", "term": "string"}
    both = cells.select("lang", "shard", "slot", "source", "n", F.lit(None).cast(none["term"]).alias("term")).union(kept.select("lang", "shard", "slot", *(F.lit(None).cast(none[c]).alias(c) for c in ("source", "n")), "term"))
    blocks = both.groupBy("lang", "shard", F.floor(F.col("slot") / width).alias("block")).agg(F.collect_list(F.struct("source", "slot", "n", "term")).alias("cells")).select("lang", "cells")
    blocks = blocks.join(F.broadcast(langs) if (measured["n"] or 0) <= GROUPS else langs, "lang")
    bare = langs.where("kept = 0")
    blocks = blocks.unionByName(bare.withColumn("cells", F.lit(None).cast(blocks.schema["cells"].dataType)))
    out = blocks.mapInArrow(_compare, "lang string, source string, part string, item string, value bigint")
    summed = out.groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return summed.withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= TOP)).select("lang", "source", "part", "item", "value", "rank")
