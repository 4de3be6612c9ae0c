"""Near-duplicates by odd sketches.

Texts become sets of hashed two-word shingles; equal sets are one class. A class has a signature of minhashes, of which
bands of six are hashed to keys: classes with a key in common are candidates. All minhashes of a signature, each with
its place, are folded into an odd sketch, a bitmap in which every one flips a bit. Common minhashes cancel out in the
XOR of two sketches, so its population count tells how many differ, and high similarities precisely. Candidates whose
sketches say that they may reach the threshold are confirmed on the full sets:

1. In a few bands each class is linked to the members of its bucket that are surely like it, by a tree, and the
   tree's links are confirmed. What they connect gets one label.
2. In all bands, labels are connected where sketches of two members allow for the threshold. Buckets of one label are
   left out, and only links that connect labels go on.
3. Where several labels are connected, their members meet block by block on the full sets, except for two blocks of
   the same label, whose members are connected already.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, each, slices, stage, text_bytes
from .graph import blocks_that_meet, components, joins
from .words import SPACED, lower_ascii, mix, run_hashes, runs, windows

SIMILARITY = 0.8
#: Bands of a signature and minhashes of a band: a pair at the threshold shares no band with a probability of 4e-7.
BANDS, ROWS = 48, 6
SAMPLES = BANDS * ROWS
#: Bits of an odd sketch; parts of the hash range, each with minhashes of its own, in the scheme for large sets.
BITS, PARTS = 512, 16
#: Sets up to the first size have minhashes of the whole set, those from the second on minhashes by parts. The second is
#: at most SIMILARITY times the first, so that of any two sets as like as that one scheme has both.
SMALL, LARGE = 160, 128
#: Estimates that make a candidate (5 standard deviations of the estimate below the threshold), and a link of a tree.
MAYBE, SURELY = 0.63, 0.84
#: Bands of the first step. Members of a bucket that one task compares by their sketches; classes of a block of full sets.
FIRST, MEMBERS, BLOCK = 4, 1024, 128

_RANDOM = np.random.Generator(np.random.PCG64(67))
_TURNS = _RANDOM.integers(0, 2**64, (2, SAMPLES), dtype=np.uint64) | np.uint64(1)
_DEAL = _RANDOM.permutation(SAMPLES)
_MARK = _RANDOM.integers(0, 2**64, SAMPLES, dtype=np.uint64)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed two-word shingles of every text, sorted within each, and where each text's begin; a text of one
    word has that one."""
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, text = runs(data, at, SPACED)
    words = run_hashes(data, starts, ends)
    place, gram = windows(words, text, 2)
    owner = text[place]
    alone = np.flatnonzero(np.bincount(text, minlength=len(texts))[text] == 1)
    gram, owner = np.concatenate([gram, mix(words[alone])]), np.concatenate([owner, text[alone]])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.searchsorted(owner, np.arange(len(texts) + 1))


def fingerprints(gram: np.ndarray, first: np.ndarray) -> list[bytes]:
    """16 bytes for each set: equal for equal sets."""
    two = np.zeros((len(first) - 1, 2), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        two[some, 0] = np.add.reduceat(mix(gram), first[some])
        two[some, 1] = np.add.reduceat(mix(gram ^ np.uint64(0xA0761D6478BD642F)), first[some])
    return _rows(two)


def _rows(x: np.ndarray) -> list[bytes]:
    raw, size = np.ascontiguousarray(x).tobytes(), x.shape[1] * x.itemsize
    return [raw[size * k : size * (k + 1)] for k in range(len(x))]


def _minima(gram: np.ndarray, begin: np.ndarray, turns: range) -> np.ndarray:
    """(turns, sets): the least value of each turn among each set's shingles."""
    return np.stack([np.minimum.reduceat(((gram * _TURNS[0, k] + _TURNS[1, k]) >> np.uint64(32)).astype(np.uint32), begin) for k in turns])


def minhashes(gram: np.ndarray, first: np.ndarray, some: np.ndarray, by_parts: bool) -> np.ndarray:
    """(sets, SAMPLES) of 32 bits for the sets ``some``, none of them empty. By parts, the shingles of a set are dealt
    to parts by their leading bits, in which order they lie, and each part has minhashes of its own; an empty part has
    the largest value."""
    out = np.full((len(some), SAMPLES), 0xFFFFFFFF, np.uint32)
    size = np.diff(first)[some]
    total = np.concatenate([[0], np.cumsum(size)])
    a = 0
    while a < len(some):  # a bounded number of shingles at once, one set at least
        b = max(a + 1, int(np.searchsorted(total, total[a] + (1 << 17), "right")) - 1)
        begin = total[a:b] - total[a]
        place = np.arange(total[b] - total[a]) + np.repeat(first[some[a:b]] - begin, size[a:b])
        part = gram[place]
        if by_parts:
            owner = np.repeat(np.arange(b - a), size[a:b]) * PARTS + (part >> np.uint64(60)).astype(np.int64)
            cuts = np.flatnonzero(np.diff(owner, prepend=-1))
            value = np.full((SAMPLES // PARTS, (b - a) * PARTS), 0xFFFFFFFF, np.uint32)
            value[:, owner[cuts]] = _minima(part, cuts, range(SAMPLES // PARTS))
            out[a:b] = value.reshape(SAMPLES // PARTS, b - a, PARTS).transpose(1, 0, 2).reshape(b - a, SAMPLES)
        else:
            out[a:b] = _minima(part, begin, range(SAMPLES)).T
        a = b
    return out


def bands(values: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys; the minhashes of a band are dealt from all places."""
    dealt = values[:, _DEAL].astype(np.uint64).reshape(len(values), BANDS, ROWS)
    h = np.tile(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(5)), (len(values), 1))
    for k in range(ROWS):
        h = mix(h * np.uint64(0x9E3779B97F4A7C15) + dealt[:, :, k])
    return h


def odd_sketches(values: np.ndarray) -> np.ndarray:
    """(sets, BITS / 64) words: every minhash, with its place, flips one bit."""
    bit = (mix(values.astype(np.uint64) + _MARK) % np.uint64(BITS)).astype(np.int64)
    count = np.bincount((np.arange(len(values))[:, None] * BITS + bit).ravel(), minlength=len(values) * BITS)
    return np.packbits((count & 1).astype(bool).reshape(-1, 64), axis=1, bitorder="little").view(np.uint64).reshape(len(values), BITS // 64)


def differing_bits(similarity: float) -> float:
    """Bits that are expected to differ: of 2 m (1 - J) marks that do not cancel out, each flips one of BITS."""
    return BITS / 2 * (1 - (1 - 2 / BITS) ** (2 * SAMPLES * (1 - similarity)))


def estimate(differing: np.ndarray) -> np.ndarray:
    """The similarity that a number of differing bits tells of (0 where half of the bits or more differ)."""
    share = np.minimum(2 * np.asarray(differing) / BITS, 1 - 1e-12)
    return np.maximum(0, 1 - np.log(1 - share) / math.log(1 - 2 / BITS) / (2 * SAMPLES))


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text_key, class, n, entries): for each scheme that the set has, its number, keys and sketch."""
    kind = pa.list_(pa.struct([("scheme", pa.int32()), ("keys", pa.binary()), ("sketch", pa.binary())]))
    for batch in slices(batches):
        gram, first = shingle_sets(batch.column("text"))
        n = np.diff(first)
        entries: list[list[dict]] = [[] for _ in n]
        for scheme, some in enumerate((np.flatnonzero((n > 0) & (n <= SMALL)), np.flatnonzero(n >= LARGE))):
            values = minhashes(gram, first, some, by_parts=scheme == 1)
            for k, keys, sketch in zip(some.tolist(), _rows(bands(values)), _rows(odd_sketches(values)), strict=True):
                entries[k].append({"scheme": scheme, "keys": keys, "sketch": sketch})
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_key"), pa.array(fingerprints(gram, first), pa.binary()), pa.array(n), pa.array(entries, kind)], names=["doc_id", "text_key", "class", "n", "entries"])


def _keys(batches: Iterator[pa.RecordBatch], some: range) -> Iterator[pa.RecordBatch]:
    """A row (key, class, scheme) for each of the bands ``some`` of each entry."""
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.frombuffer(b"".join(batch.column("keys").to_pylist()), np.uint64).reshape(batch.num_rows, BANDS)[:, some.start : some.stop]
        keys = mix(keys + batch.column("scheme").to_numpy().astype(np.uint64)[:, None])
        row = np.repeat(np.arange(batch.num_rows), len(some))
        for a in range(0, len(row), 1 << 16):
            here = pa.array(row[a : a + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()[a : a + (1 << 16)].view(np.int64)), batch.column("class").take(here), batch.column("scheme").take(here)], names=["key", "class", "scheme"])


def tree(like, n: int) -> np.ndarray:
    """Parent of each of n members in trees of members that are like each other; the lowest member of each is its own.
    ``like(k, rest)`` tells which of ``rest`` are like member k.

    Each member that is reached is compared with those not reached yet, so a dense group costs little more than one
    comparison per member, and none goes without."""
    parent, rest = np.arange(n), np.arange(n)
    while len(rest):
        queue, rest = [int(rest[0])], rest[1:]
        while queue and len(rest):
            k = queue.pop()
            found = like(k, rest)
            parent[rest[found]] = k
            queue += rest[found].tolist()
            rest = rest[~found]
    return parent


def _by_sketch(batches: Iterator[pa.RecordBatch], similarity: float, labelled: bool) -> Iterator[pa.RecordBatch]:
    """Links (u, v) of trees of members whose estimated similarity is high enough: of classes, or only of labels that
    are not connected yet."""
    most = differing_bits(similarity)
    for batch in batches:
        us, vs = [], []
        for (members,) in each(batch, "members"):
            members.sort(key=lambda m: m["class"])
            sketch = np.frombuffer(b"".join(m["sketch"] for m in members), np.uint64).reshape(len(members), -1)
            own = [m["label"] for m in members] if labelled else [m["class"] for m in members]
            if labelled:
                number = {x: k for k, x in enumerate(dict.fromkeys(own))}
                pairs = joins(np.array([number[x] for x in own]), lambda k, others, sketch=sketch: np.bitwise_count(sketch[others] ^ sketch[k]).sum(axis=1) <= most)
                us += [own[k] for k, _ in pairs]
                vs += [own[k] for _, k in pairs]
            else:
                parent = tree(lambda k, rest, sketch=sketch: np.bitwise_count(sketch[rest] ^ sketch[k]).sum(axis=1) <= most, len(members))
                for k in np.flatnonzero(parent != np.arange(len(members))).tolist():
                    us.append(own[k])
                    vs.append(own[parent[k]])
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _common(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def confirmed(shared, sizes, other):
    """100 * intersection >= 100 * SIMILARITY * union, in whole numbers."""
    percent = round(100 * SIMILARITY)
    return 100 * shared >= percent * (sizes + other - shared)


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links (u, v) whose full sets reach the threshold."""
    for batch in batches:
        keep = []
        for one, other in each(batch, "u_set", "v_set"):
            a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            keep.append(bool(confirmed(_common(a, b), len(a), len(b))))
        yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))


def overlaps(one: list[np.ndarray], two: list[np.ndarray], step: int = 4096) -> np.ndarray:
    """How many shingles each set of ``one`` shares with each of ``two``, exactly."""
    gram = np.concatenate([*one, *two])
    owner = np.repeat(np.arange(len(one) + len(two)), [len(s) for s in (*one, *two)])
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = gram[1:] != gram[:-1]
    column = np.cumsum(new) - 1
    often = np.bincount(column)[column] > 1
    column, owner = np.unique(column[often], return_inverse=True)[1], owner[often]
    out = np.zeros((len(one), len(two)))
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k in range(len(cuts) - 1):
        x = np.zeros((len(one) + len(two), step), np.float32)
        x[owner[cuts[k] : cuts[k + 1]], column[cuts[k] : cuts[k + 1]] - k * step] = 1
        out += x[: len(one)] @ x[len(one) :].T
    return out.astype(np.int64)


def _by_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For two blocks of members: the links (u, v) of labels that full sets confirm, as many as connect them."""
    for batch in batches:
        us, vs = [], []
        for (members,) in each(batch, "members"):
            members.sort(key=lambda m: (m["own"], m["class"]))
            sets = [np.frombuffer(m["set"], np.uint64) for m in members]
            size = np.array([len(s) for s in sets])
            own = np.array([m["own"] for m in members])
            names = list(dict.fromkeys(m["label"] for m in members))
            label = np.array([names.index(m["label"]) for m in members])
            one = np.flatnonzero(own == own.min())
            two = np.flatnonzero(own == own.max())
            shared = overlaps([sets[k] for k in one], [sets[k] for k in two])
            like = confirmed(shared, size[one, None], size[two]) & (label[one, None] != label[two])
            joined = np.arange(len(names))
            for a, b in sorted({(int(label[one[i]]), int(label[two[j]])) for i, j in np.argwhere(like)}):
                if joined[a] != joined[b]:
                    us.append(names[a])
                    vs.append(names[b])
                    joined[joined == joined[b]] = joined[a]
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(class, set): the shingles of the texts that are their class's example."""
    for batch in slices(batches):
        gram, first = shingle_sets(batch.column("text"))
        same = np.array([a == b for a, b in zip(fingerprints(gram, first), batch.column("class").to_pylist(), strict=True)], bool)
        raw, some = gram.tobytes(), np.flatnonzero(same)
        yield pa.RecordBatch.from_arrays([batch.column("class").take(pa.array(some)), pa.array([raw[8 * first[k] : 8 * first[k + 1]] for k in some], pa.binary())], names=["class", "set"])


_LINK = "u binary, v binary"


def _named(classes: DataFrame, roots: DataFrame, name: str) -> DataFrame:
    """The rows with the root that a class has, or itself."""
    on = roots.select(F.col("node").alias("class"), F.col("root").alias("__root"))
    return classes.join(on, "class", "left").withColumn(name, F.coalesce("__root", "class")).drop("__root")


def linked_classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents' narrow rows (doc_id, class, n), and the components (node, root) of classes that are linked."""
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    described = stage(own.mapInArrow(_describe, "doc_id bigint, text_key bigint, class binary, n bigint, entries array<struct<scheme:int,keys:binary,sketch:binary>>"))
    narrow = described.select("doc_id", "class", "n")
    # A class's rows are alike; those of a hot one meet as partial aggregates only.
    classes = described.where("n > 0").groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("example"), F.first("entries").alias("entries"))
    entries = stage(classes.select("class", "example", F.explode("entries").alias("e")).select("class", "example", "e.*"))

    def buckets(some: range) -> DataFrame:
        rows = entries.select("keys", "scheme", "class").mapInArrow(lambda b: _keys(b, some), "key bigint, class binary, scheme int")
        sizes = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        return rows.join(sizes, "key")

    sketches = entries.select("class", "scheme", "sketch")

    # 1. Trees of what is surely alike, in a few bands. Large buckets are cut into blocks, other ones in each band.
    block = F.pmod(F.xxhash64("class", "key"), F.ceil(F.col("size") / MEMBERS))
    first = buckets(range(FIRST)).withColumn("block", block).join(sketches, ["class", "scheme"])
    trees = first.groupBy("key", "block").agg(F.collect_list(F.struct("class", "sketch")).alias("members")).where(F.size("members") > 1)
    links = stage(trees.select("members").mapInArrow(lambda b: _by_sketch(b, SURELY, labelled=False), _LINK).distinct())

    # 2. All bands. Of a large bucket, the blocks of its main label meet only those of others.
    meeting = stage(buckets(range(BANDS)))
    wanted = meeting.select("class").distinct()
    examples = entries.select("class", "example").dropDuplicates(["class"]).join(wanted, "class")
    texts = own.join(examples, F.col("doc_id").eqNullSafe(F.col("example.doc_id")) & (F.col("text_key") == F.col("example.text_key"))).select("class", "text")
    sets = stage(texts.mapInArrow(_sets, "class binary, set binary").dropDuplicates(["class"]))
    one, other = (sets.select(F.col("class").alias(c), F.col("set").alias(f"{c}_set")) for c in ("u", "v"))
    labels = components(links.join(one, "u").join(other, "v").mapInArrow(_confirm, _LINK))
    discard(links)

    labelled = _named(meeting, labels, "label")
    per = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"))
    mixed = per.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("of_main"), F.sum("n").alias("members"), F.count(F.lit(1)).alias("labels")).where("labels > 1").drop("labels")
    open_ = labelled.join(mixed, "key")
    paired = blocks_that_meet(open_, MEMBERS, ["key"]).join(sketches, ["class", "scheme"])
    groups = paired.groupBy("key", "left", "right").agg(F.collect_list(F.struct("class", "label", "sketch")).alias("members"))
    maybe = stage(groups.select("members").mapInArrow(lambda b: _by_sketch(b, MAYBE, labelled=True), _LINK).distinct())
    discard(meeting)

    # 3. Members of several labels that may be connected, on their full sets.
    groups = components(maybe)
    named = _named(sets.select("class"), labels, "label")
    within = groups.select(F.col("node").alias("label"), F.col("root").alias("group"))
    within = within.union(within.select(F.col("group").alias("label"), "group").distinct())
    members = stage(named.join(within, "label"))
    per = members.groupBy("group", "label").agg(F.count(F.lit(1)).alias("n"))
    main = per.groupBy("group").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("of_main"), F.sum("n").alias("members"))
    paired = blocks_that_meet(members.join(main, "group"), BLOCK, ["group"]).join(sets, "class")
    both = paired.groupBy("group", "left", "right").agg(F.collect_list(F.struct("class", "label", "own", "set")).alias("members"))
    last = components(both.select("members").mapInArrow(_by_sets, _LINK))
    ends = last.select(F.col("node").alias("root"), F.col("root").alias("end"))
    whole = labels.join(ends, "root", "left").select("node", F.coalesce("end", "root").alias("root")).union(last)
    whole = stage(whole)
    discard(maybe, members, entries, sets)
    return narrow, whole


def near_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles (size of the set), component_id (lowest doc_id that links lead to, its own included) and kept
    (whether that is its own) of every document.

    Null texts and texts without words have empty sets and are linked with nothing; a text of one word has that one; a
    null doc_id counts above all others, and is kept where its component has no other; repeated rows, and different
    rows of one doc_id, each get theirs; no rows, none.
    """
    rows, roots = linked_classes(docs)
    own = rows.where("n > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    named = stage(_named(own, roots, "root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("component_id"))
    known = named.join(lowest, "root").select("class", "component_id")
    full = rows.where("n > 0").join(known, "class").select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    bare = rows.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.union(bare).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
