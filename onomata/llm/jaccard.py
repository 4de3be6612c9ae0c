"""N-gram Jaccard join by chosen paths.

Texts become sets of hashed five-word shingles; equal sets are one class. A class
has a signature of minhashes, each a token (place, value) of an embedded set in
which the overlap of two sets estimates their Jaccard similarity. A run begins with
all classes in one node. A node picks places at random, the same for all its
members, and splits them by their tokens at these places; members that share a
chosen token go on together. Nodes of few members are compared by brute force, large
ones split again. Runs are repeated until a pair at the threshold has met in one
with the target probability.

Pairs whose signatures agree enough link classes to components of candidates.
Inside a component all pairs are compared exactly, on the shingles themselves, block
against block, so that a component of any size is spread over many tasks. What
comes out are links per class and the components of the exact graph; pairs are
counted where they are found and not sent on.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.filters import KeyFilter
from .common import discard, each, fresh, slices, stage, text_bytes
from .graph import blocks_that_meet, components, joins
from .words import SPACED, mix, run_hashes, runs, windows

SHINGLE, SIMILARITY = 5, 0.8
#: Minhashes of a signature; members that are compared by brute force; splits of a path at most.
PLACES, SMALL, DEPTH = 64, 2048, 4
#: Share of places that must agree for a candidate: five standard deviations below the threshold.
AGREE = 0.55
#: Probability with which a pair at the threshold meets in some run, for paths of up to DEPTH splits.
RECALL = 0.999
#: Runs of the first round, which need not find all: one split each, and large nodes in blocks. In the second, with all
#: runs, nodes whose members are connected already need no comparison.
FIRST_RUNS = 4
#: Classes of a block in the exact comparison.
BLOCK = 128


def _rate(similarity: float, places: int) -> float:
    """Probability with which a node picks each place: one shared token is chosen on average at the threshold."""
    return 1 / (similarity * places)


def run_count(similarity: float = SIMILARITY, places: int = PLACES, recall: float = RECALL, depth: int = DEPTH) -> int:
    """Runs that give the recall for pairs at the threshold: the chance to stay together is that of a branching process
    to live for ``depth`` rounds."""
    alive = 1.0
    for _ in range(depth):
        alive = 1 - (1 - _rate(similarity, places) * similarity * alive) ** places
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - alive)))


_TURNS = np.random.Generator(np.random.PCG64(41)).integers(0, 2**64, (2, PLACES), dtype=np.uint64) | np.uint64(1)


def shingle_sets(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of every text, sorted within each, and where each text's begin.

    A text of fewer than five words, but not none, is one shingle; one without words has none.
    """
    data, at = text_bytes(texts)
    starts, ends, text = runs(data, at, SPACED)
    words = run_hashes(data, starts, ends)
    place, gram = windows(words, text, SHINGLE)
    owner = text[place]
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    size = np.diff(first)
    for n in range(1, SHINGLE):
        some = np.flatnonzero(size == n)
        if len(some):
            short = np.zeros(len(some), np.uint64)
            for k in range(n):
                short = mix(short * np.uint64(0x9E3779B97F4A7C15) + words[first[some] + k])
            gram, owner = np.concatenate([gram, short]), np.concatenate([owner, some])
    order = np.lexsort((gram, owner))
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = (gram[1:] != gram[:-1]) | (owner[1:] != owner[:-1])
    gram, owner = gram[new], owner[new]
    return gram, np.searchsorted(owner, np.arange(len(texts) + 1))


def fingerprints(gram: np.ndarray, first: np.ndarray) -> list[bytes]:
    """16 bytes for each set: equal for equal sets."""
    n = len(first) - 1
    two = np.zeros((n, 2), np.uint64)
    some = np.flatnonzero(np.diff(first))
    if len(some):
        two[some, 0] = np.add.reduceat(mix(gram), first[some])
        two[some, 1] = np.add.reduceat(mix(gram ^ np.uint64(0xD6E8FEB86659FD93)), first[some])
    raw = two.tobytes()
    return [raw[16 * k : 16 * k + 16] for k in range(n)]


def signatures(gram: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Minhashes (sets, PLACES) of 32 bits; an empty set has the largest values."""
    n = len(first) - 1
    out = np.full((n, PLACES), 0xFFFFFFFF, np.uint32)
    some = np.flatnonzero(np.diff(first))
    step = 1 << 18
    a = 0
    while a < len(some):  # a bounded number of shingles at once, one set at least
        b = max(a + 1, int(np.searchsorted(first[some + 1], first[some[a]] + step, "right")))
        part = gram[first[some[a]] : first[some[b - 1] + 1]]
        begin = first[some[a:b]] - first[some[a]]
        for k in range(PLACES):
            out[some[a:b], k] = np.minimum.reduceat(((part * _TURNS[0, k] + _TURNS[1, k]) >> np.uint64(32)).astype(np.uint32), begin)
        a = b
    return out


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        gram, first = shingle_sets(batch.column("text"))
        sig = signatures(gram, first).tobytes()
        size = 4 * PLACES
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_key"), pa.array(fingerprints(gram, first), pa.binary()), pa.array(np.diff(first)), pa.array([sig[size * k : size * k + size] for k in range(batch.num_rows)], pa.binary())],
            names=["doc_id", "text_key", "class", "n", "sig"],
        )


def _picked(path: np.ndarray, similarity: float) -> np.ndarray:
    """Which places each path picks: (paths, PLACES)."""
    draw = mix(path[:, None] + mix(np.arange(PLACES, dtype=np.uint64) + np.uint64(77)))
    return (draw >> np.uint64(11)).astype(np.float64) / 2**53 < _rate(similarity, PLACES)


def _children(path: np.ndarray, place: np.ndarray, value: np.ndarray) -> np.ndarray:
    return mix(mix(path + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) + value.astype(np.uint64))


def _split(batches: Iterator[pa.RecordBatch], similarity: float, some_runs: range) -> Iterator[pa.RecordBatch]:
    """Rows (path, label, class) of the next level; the first one of the given runs where rows have no path yet."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(batch.num_rows, PLACES)
        if "path" in batch.schema.names:
            path = batch.column("path").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            row, place = np.nonzero(_picked(path, similarity))
            path = path[row]
        else:
            roots = mix(np.array(some_runs, np.uint64) + np.uint64(1))
            root, place = np.nonzero(_picked(roots, similarity))
            row = np.repeat(np.arange(batch.num_rows), len(root))
            path, place = np.tile(roots[root], batch.num_rows), np.tile(place, batch.num_rows)
        child = _children(path, place, sig[row, place])
        for a in range(0, len(row), 1 << 16):
            some = slice(a, a + (1 << 16))
            here = pa.array(row[some])
            yield pa.RecordBatch.from_arrays([pa.array(child[some].view(np.int64)), batch.column("label").take(here), batch.column("class").take(here)], names=["path", "label", "class"])


def _connect(similar, n: int) -> np.ndarray:
    """Root (lowest member) of each of n members. ``similar(k, rest)`` tells which of ``rest`` are like member k.

    Each member that is reached is compared with those not reached yet, so a dense group costs little more than one
    comparison per member, and none goes without."""
    root, rest = np.arange(n), np.arange(n)
    for seed in range(n):
        at = np.searchsorted(rest, seed)
        if at == len(rest) or rest[at] != seed:
            continue
        rest = np.delete(rest, at)
        queue = [seed]
        while queue and len(rest):
            k = queue.pop()
            like = similar(k, rest)
            queue += rest[like].tolist()
            root[rest[like]] = seed
            rest = rest[~like]
    return root


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) between roots of members of a bucket that are candidates, as many as connect the roots."""
    for batch in batches:
        us: list[bytes] = []
        vs: list[bytes] = []
        for (members,) in each(batch, "members"):
            members.sort(key=lambda m: m["class"])
            sig = np.frombuffer(b"".join(m["sig"] for m in members), np.uint32).reshape(len(members), PLACES)
            number = {x: k for k, x in enumerate(dict.fromkeys(m["root"] for m in members))}
            label = np.array([number[m["root"]] for m in members])
            for k, other in joins(label, lambda k, others, sig=sig: (sig[others] == sig[k]).sum(axis=1) >= AGREE * PLACES):
                us.append(members[k]["root"])
                vs.append(members[other]["root"])
        yield pa.RecordBatch.from_arrays([pa.array(us, pa.binary()), pa.array(vs, pa.binary())], names=["u", "v"])


def _candidates(classes: DataFrame, similarity: float, some_runs: range, whole: bool) -> DataFrame:
    """Edges (u, v) between the roots of classes that the given runs find, as many as connect what is connected.

    ``classes`` has class, sig and root; classes of one root are known to be connected, and nodes of one root go no
    further. Small nodes are compared by brute force. If the search is not to be whole, large ones are cut into blocks,
    each compared in itself. Else they are split again; those that stay large to the end are cut into blocks, of which
    every two are compared that do not both lie in the node's main root.
    """
    kind = "path bigint, label bigint, class binary"
    known = classes.select("class", "sig", "root", F.xxhash64("root").alias("label"))
    level = known.select("class", "sig", "label").mapInArrow(lambda b: _split(b, similarity, some_runs), kind)
    found, held = None, []
    for depth in range(1, DEPTH + 1):
        sizes = level.groupBy("path").agg(F.count(F.lit(1)).alias("size"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        sized = stage(level.join(sizes.select("path", "size"), "path"))
        held.append(sized)
        small = sized.where(F.col("size") <= SMALL).groupBy("path").agg(F.array_sort(F.collect_list("class")).alias("all")).select("all").distinct()
        small = small.select(F.xxhash64("all", F.lit(0)).alias("bucket"), F.explode("all").alias("class"))
        found = small if found is None else found.union(small)
        large = sized.where(F.col("size") > SMALL)
        if not whole:
            block = F.pmod(F.xxhash64("class", "path"), F.ceil(F.col("size") / SMALL))
            found = found.union(large.select(F.xxhash64("path", block).alias("bucket"), "class"))
            break
        if large.isEmpty():
            break
        if depth < DEPTH:
            level = large.select("path", "label", "class").join(known.select("class", "sig"), "class").mapInArrow(lambda b: _split(b, similarity, range(0)), kind)
        else:
            per = large.groupBy("path", "label").agg(F.count(F.lit(1)).alias("n"))
            main = per.groupBy("path").agg(F.max_by("label", F.struct("n", "label")).alias("main"), F.max("n").alias("of_main"), F.sum("n").alias("members"))
            pairs = blocks_that_meet(large.select("path", "label", "class").join(main, "path"), SMALL // 2, ["path"])
            found = found.union(pairs.select(F.xxhash64("path", "left", "right").alias("bucket"), "class"))
    members = found.join(known, "class").groupBy("bucket").agg(F.collect_list(F.struct("class", "sig", "root")).alias("members"))
    out = stage(members.select("members").mapInArrow(_brute, "u binary, v binary").distinct())
    discard(*held)
    return out


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The shingles of the texts that are their class's example."""
    for batch in slices(batches):
        gram, first = shingle_sets(batch.column("text"))
        same = np.array([a == b for a, b in zip(fingerprints(gram, first), batch.column("class").to_pylist(), strict=True)], bool)
        raw = gram.tobytes()
        some = np.flatnonzero(same)
        kept = batch.take(pa.array(some))
        sets = pa.array([raw[8 * first[k] : 8 * first[k + 1]] for k in some], pa.binary())
        yield pa.RecordBatch.from_arrays([kept.column("root"), kept.column("class"), kept.column("texts"), kept.column("blocks"), sets], names=["root", "class", "texts", "blocks", "set"])


def overlaps(sets: list[np.ndarray], step: int = 8192) -> np.ndarray:
    """How many shingles any two sets share, exactly."""
    n = len(sets)
    if n == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]], np.int64)
    gram = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(gram, kind="stable")
    gram, owner = gram[order], owner[order]
    new = np.ones(len(gram), bool)
    new[1:] = gram[1:] != gram[:-1]
    number = np.cumsum(new) - 1
    often = np.bincount(number)[number] > 1
    _, column = np.unique(number[often], return_inverse=True)
    owner = owner[often]
    out = np.zeros((n, n), np.float64)
    cuts = np.searchsorted(column, np.arange(0, (column[-1] + 1 if len(column) else 0) + step, step))
    for k in range(len(cuts) - 1):
        x = np.zeros((n, step), np.float32)
        x[owner[cuts[k] : cuts[k + 1]], column[cuts[k] : cuts[k + 1]] - k * step] = 1
        out += x @ x.T
    out[np.arange(n), np.arange(n)] = [len(s) for s in sets]
    return out.astype(np.int64)


def _exact(batches: Iterator[pa.RecordBatch], similarity: float) -> Iterator[pa.RecordBatch]:
    """For each class of a pair of blocks: texts it links to there, and the root of what it is connected with."""
    for batch in batches:
        rows = []
        for left, right, members in each(batch, "left", "right", "members"):
            members.sort(key=lambda m: m["class"])
            sets = [np.frombuffer(m["set"], np.uint64) for m in members]
            own = np.array([m["own"] for m in members])
            shared = overlaps(sets)
            size = np.array([len(s) for s in sets])
            like = shared * (1 + similarity) >= similarity * (size[:, None] + size) - 1e-9
            np.fill_diagonal(like, False)
            if left != right:
                like &= own[:, None] != own  # pairs within one block are counted where it meets itself
            links = like @ np.array([m["texts"] for m in members], np.int64)
            root = _connect(lambda k, rest, like=like: like[k, rest], len(members))
            rows += [{"class": m["class"], "links": int(links[k]), "root": members[root[k]]["class"]} for k, m in enumerate(members)]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("class", pa.binary()), ("links", pa.int64()), ("root", pa.binary())]))


def _text_key(docs: DataFrame):
    return F.xxhash64(F.coalesce(F.concat(F.lit("="), "text"), F.lit("")))


def join_near(docs: DataFrame, similarity: float = SIMILARITY) -> tuple[DataFrame, DataFrame]:
    """The documents' narrow rows (doc_id, text_key, class), and the classes (class, lowest doc_id, root, links).

    root is the same for all classes of a component of the exact graph. links counts other different texts: those of
    linked classes, and the class's own texts but one.
    """
    own = docs.select("doc_id", "text", _text_key(docs).alias("text_key"))
    described = stage(own.mapInArrow(_describe, "doc_id bigint, text_key bigint, class binary, n bigint, sig binary"))
    # One row for each different text first: the members of a hot group meet as partial aggregates only.
    texts = described.groupBy("class", "text_key").agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    classes = stage(texts.groupBy("class").agg(F.min(F.struct("doc_id", "text_key")).alias("example"), F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("texts"), F.first("n").alias("n"), F.first("sig").alias("sig")))

    worded = classes.where("n > 0").select("class", "sig")
    sure = components(_candidates(worded.withColumn("root", F.col("class")), similarity, range(FIRST_RUNS), whole=False))
    labelled = worded.join(sure.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    more = components(_candidates(labelled, similarity, range(run_count(similarity)), whole=True))
    ends = more.select(F.col("node").alias("root"), F.col("root").alias("end"))
    linked = stage(sure.join(ends, "root", "left").select("node", F.coalesce("end", "root").alias("root")).union(more))

    members = linked.union(linked.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("node", "class")
    sizes = linked.groupBy("root").agg((F.count(F.lit(1)) + 1).alias("size"))
    wanted = members.join(sizes, "root").join(classes.select("class", "example", "texts"), "class")
    wanted = stage(wanted.select("root", "class", "texts", "example", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")))

    # Only texts that may be an example are shuffled.
    n = wanted.count()
    if KeyFilter.useful(n):
        some = KeyFilter(wanted.select("example.text_key"), "text_key", n)
        examples = own.where(some.may_have(F.col("text_key"), some.bits()))
    else:
        examples = own
    examples = examples.join(wanted, F.col("doc_id").eqNullSafe(F.col("example.doc_id")) & (F.col("text_key") == F.col("example.text_key")))
    sets = examples.select("root", "class", "texts", "blocks", "text").mapInArrow(_sets, "root binary, class binary, texts bigint, blocks int, set binary").dropDuplicates(["class"])
    placed = sets.withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = placed.groupBy("root", F.least("own", "other").alias("left"), F.greatest("own", "other").alias("right")).agg(F.collect_list(F.struct("class", "texts", "own", "set")).alias("members"))
    exact = stage(paired.select("left", "right", "members").mapInArrow(lambda b: _exact(b, similarity), "class binary, links bigint, root binary"))

    final = components(exact.select(F.col("class").alias("u"), F.col("root").alias("v")))
    links = exact.groupBy("class").agg(F.sum("links").alias("links"))
    full = classes.select("class", "doc_id", "texts").join(links, "class", "left").join(final.withColumnRenamed("node", "class"), "class", "left")
    full = stage(full.select("class", "doc_id", F.coalesce("root", "class").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("links")))
    discard(classes, linked, wanted, exact)
    return described.select("doc_id", "text_key", "class"), full


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id (lowest doc_id of its component), copy_id (lowest doc_id with the same shingles) and n_links
    (other different texts with the similarity or more) of every document.

    Null and empty texts, and those of blanks only, have no shingles and are copies of each other; texts of fewer than
    five words are one shingle; a null doc_id counts above all others; repeated rows each get their row; no rows, none.
    """
    rows, classes = join_near(docs, similarity)
    lowest = classes.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    named = classes.join(lowest, "root").select("class", "class_id", F.col("doc_id").alias("copy_id"), F.col("links").alias("n_links"))
    return rows.join(named, "class").select("doc_id", "class_id", "copy_id", "n_links")


def keep_one(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """One document of each component, with its own columns: that of the lowest doc_id, then of the lowest text key; of
    several such rows any one."""
    rows, classes = join_near(docs, similarity)
    first = rows.join(classes.select("class", "root"), "class").groupBy("root", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("copies"))
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    kept = stage(first.groupBy("root").agg(F.min(F.struct(place.alias("place"), "copies")).alias("k")).select("k.place.doc_id", "k.place.text_key", "k.copies"))
    key = fresh(docs.columns, "text_key")
    one, wanted = fresh([*docs.columns, key], "kept_id"), fresh([*docs.columns, key], "kept_key")
    own = docs.withColumn(key, _text_key(docs))

    def chosen(some: DataFrame) -> DataFrame:
        named = some.select(F.col("doc_id").alias(one), F.col("text_key").alias(wanted))
        return own.join(named, F.col("doc_id").eqNullSafe(F.col(one)) & (F.col(key) == F.col(wanted)), "left_semi")

    out = chosen(kept.where("copies = 1")).drop(key)
    repeated = kept.where("copies > 1")
    if not repeated.isEmpty():
        out = out.union(chosen(repeated).dropDuplicates(["doc_id", key]).drop(key))
    return out
