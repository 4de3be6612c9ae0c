"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors.

A text becomes counts of hashed features (words, their character trigrams, and
marks of its style), weighted by term and inverse document frequency, which is
counted over all documents. A truncated singular value decomposition of a bounded sample of labelled texts gives the
latent space. The sample's vectors and labels are broadcast; each document's
cosine with all of them is computed exactly, in blocks, and its nearest neighbours
vote with weights by similarity.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, held_out, learns, share, slices, text_bytes, with_columns
from .words import SPACED, per_text, run_hashes, runs, windows

#: Bound of the labelled sample, half of it for each label. Only the hashed features of its texts go to the driver.
SAMPLE = 2400
FEATURE_BITS, RANK, NEIGHBOURS = 13, 48, 15
#: Votes count similarity to this power.
SHARPNESS = 4
THRESHOLD = 0.7
#: Documents that are compared with all labelled vectors at once.
BLOCK = 1024

FEATURES = 1 << FEATURE_BITS
_STYLES = 64


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sparse rows of features: (text, feature, value), values being 1 + log of the counts, or a style's weight."""
    data, at = text_bytes(texts)
    n = len(texts)
    starts, ends, text = runs(data, at, SPACED)
    hashes = run_hashes(data, starts, ends)
    word = (hashes >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    where = np.repeat(np.arange(n), np.diff(at))
    m = max(len(data) - 2, 0)
    code = ((data[:m].astype(np.uint32) << np.uint32(16)) | (data[1 : m + 1].astype(np.uint32) << np.uint32(8)) | data[2:].astype(np.uint32)) if m else np.zeros(0, np.uint32)
    code = ((code * np.uint32(2654435761)) >> np.uint32(32 - FEATURE_BITS)).astype(np.int64)
    inside = where[:m] == where[2:] if m else np.zeros(0, bool)
    # The last _STYLES features are for style alone.
    plain = FEATURES - _STYLES
    flat = np.concatenate([text * FEATURES + word % plain, where[:m][inside] * FEATURES + code[inside] % plain])
    counts = np.bincount(flat, minlength=n * FEATURES) if n * FEATURES < 1 << 24 else None
    if counts is None:
        cells, values = np.unique(flat, return_counts=True)
    else:
        cells = np.flatnonzero(counts)
        values = counts[cells]
    value = 1 + np.log(values)

    words = np.maximum(per_text(text, n), 1)
    size = np.maximum(np.diff(at), 1)
    place, gram = windows(hashes, text, 2)
    pair = gram + text[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = text[place]
    _, first = np.unique(pair, return_index=True)
    kinds = [
        np.bincount(where[((data < 128) & (data > 32) & ~_ALNUM[data])], minlength=n) / size,
        np.bincount(where[(data >= 65) & (data <= 90)], minlength=n) / size,
        np.bincount(where[(data >= 48) & (data <= 57)], minlength=n) / size,
        1 - np.bincount(own[first], minlength=n) / np.maximum(np.bincount(own, minlength=n), 1),
        np.diff(at) / words / 16,
    ]
    styles = [(np.arange(n), np.full(n, plain + 8 * k) + np.minimum((v * 16).astype(np.int64), 7), np.full(n, 6.0)) for k, v in enumerate(kinds)]
    return (
        np.concatenate([cells // FEATURES, *(s[0] for s in styles)]),
        np.concatenate([cells % FEATURES, *(s[1] for s in styles)]),
        np.concatenate([value, *(s[2] for s in styles)]).astype(np.float32),
    )


_ALNUM = np.zeros(256, bool)
_ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


class Space:
    """Latent space and labelled vectors in it."""

    def __init__(self, weight: np.ndarray, axes: np.ndarray) -> None:
        self.weight, self.axes = weight, axes
        self.vectors, self.labels, self.prior = np.zeros((0, axes.shape[1]), np.float32), np.zeros(0, np.float32), 0.5

    def place(self, texts: pa.Array) -> np.ndarray:
        """Unit vectors of the texts (zero where a text has nothing known)."""
        row, column, value = features(texts)
        order = np.argsort(row, kind="stable")
        row, column, value = row[order], column[order], value[order] * self.weight[column[order]]
        out = np.zeros((len(texts), self.axes.shape[1]), np.float32)
        step = 1 << 16
        for a in range(0, len(row), step):
            part = self.axes[column[a : a + step]] * value[a : a + step, None]
            here = row[a : a + step]
            first = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
            out[here[first]] += np.add.reduceat(part, first, axis=0)
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)

    def scores(self, texts: pa.Array) -> np.ndarray:
        """Share of the neighbours' votes for label 1, block by block of documents."""
        own = self.place(texts)
        if not len(self.labels):
            return np.full(len(own), self.prior)
        k = min(NEIGHBOURS, len(self.labels))
        out = np.empty(len(own))
        for a in range(0, len(own), BLOCK):
            cosine = own[a : a + BLOCK] @ self.vectors.T
            near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
            vote = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
            # The prior has a small vote, which decides where no labelled text is like the document.
            out[a : a + BLOCK] = ((vote * self.labels[near]).sum(axis=1) + 0.01 * self.prior) / (vote.sum(axis=1) + 0.01)
        return np.clip(out, 0, 1)


def fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, labels: list[int], prior: float, seed: int = 5, corpus: tuple[int, np.ndarray] | None = None) -> Space:
    """Weights and latent axes from the labelled texts' features (randomised truncated decomposition), and their
    vectors. ``corpus`` has the number of all texts and how many hold each feature; without it the labelled ones count."""
    n = len(labels)
    texts, there = corpus or (n, np.bincount(column, minlength=FEATURES))
    weight = np.log((1 + texts) / (1 + there)).astype(np.float32) + 0.1
    weight[FEATURES - _STYLES :] = 1.0
    value = value * weight[column]
    value /= np.sqrt(np.maximum(np.bincount(row, value.astype(np.float64) ** 2, n), 1e-9))[row].astype(np.float32)
    dense = np.zeros((n, FEATURES), np.float32)
    dense[row, column] = value
    rng = np.random.Generator(np.random.PCG64(seed))
    rank = min(RANK, n)
    some = dense @ rng.standard_normal((FEATURES, rank + 8)).astype(np.float32)
    for _ in range(3):
        some, _ = np.linalg.qr(some)
        some = dense @ (dense.T @ some)
    some, _ = np.linalg.qr(some)
    _, _, axes = np.linalg.svd(some.T @ dense, full_matrices=False)
    space = Space(weight, np.ascontiguousarray(axes[:rank].T, np.float32))
    vectors = dense @ space.axes
    space.vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    space.labels, space.prior = np.array(labels, np.float32), prior
    return space


def learn(docs: DataFrame, labels: DataFrame) -> Space:
    """The space from at most SAMPLE labelled documents whose id allows learning, half of each label, by order of a hash
    of the id. A document with labels that differ counts as its lowest; one without text is not learned from."""
    known = labels.where(learns(F.col("doc_id")) & F.col("quality").isin(0, 1)).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    counts = dict(known.groupBy("quality").count().collect())
    prior = counts.get(1, 0) / max(1, sum(counts.values())) if counts else 0.5
    picked = None
    for label in (0, 1):
        part = known.where(F.col("quality") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE // 2)
        picked = part if picked is None else picked.union(part)
    # At most SAMPLE ids are broadcast; of each one text stays, however many rows it has.
    chosen = docs.where(F.col("text").isNotNull()).join(F.broadcast(picked), "doc_id").select("doc_id", "text", "quality")
    lowest = chosen.mapInArrow(_lowest, T.StructType([*chosen.schema.fields, T.StructField("h", T.LongType())]))
    one = lowest.groupBy("doc_id").agg(F.min(F.struct("h", "text", "quality")).alias("own")).select("own.text", "own.quality")
    sparse = one.mapInArrow(_sparse, "quality int, h bigint, columns array<int>, values array<float>")
    quality, rows, columns, values = [], [], [], []
    for r in sparse.orderBy("quality", "h").toLocalIterator():  # SAMPLE rows at most
        rows.append(np.full(len(r["columns"]), len(quality)))
        columns.append(np.array(r["columns"], np.int64))
        values.append(np.array(r["values"], np.float32))
        quality.append(r["quality"])
    if not quality:
        return Space(np.ones(FEATURES, np.float32), np.zeros((FEATURES, 1), np.float32))
    return fit(np.concatenate(rows), np.concatenate(columns), np.concatenate(values), quality, prior, corpus=frequencies(docs))


def frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """How many documents there are, and how many hold each feature (FEATURES + 1 rows at most reach the driver)."""
    there = np.zeros(FEATURES + 1, np.int64)
    for feature, n in docs.select("text").mapInArrow(_count, "feature int, n bigint").groupBy("feature").agg(F.sum("n")).collect():
        there[feature] = n
    return int(there[FEATURES]), there[:FEATURES]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many texts each feature is, and as feature FEATURES the number of texts."""
    total = np.zeros(FEATURES + 1, np.int64)
    for batch in slices(batches):
        _, column, _ = features(batch.column("text"))
        total[:FEATURES] += np.bincount(column, minlength=FEATURES)
        total[FEATURES] += batch.num_rows
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["feature", "n"])


def _text_hash(data: np.ndarray) -> int:
    return zlib.crc32(data.tobytes())


def _lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each id the row of the lowest text hash (then text) among the task's rows."""
    best: dict[tuple, tuple] = {}
    for batch in slices(batches):
        data, at = text_bytes(batch.column("text"))
        for k, key in enumerate(batch.column("doc_id").to_pylist()):
            own = data[at[k] : at[k + 1]]
            own = _text_hash(own), own.tobytes()
            if key not in best or own < best[key][0]:
                best[key] = own, batch.take(pa.array([k]))
    for (h, _), row in best.values():
        yield with_columns(row, {"h": pa.array([h], pa.int64())})


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Label, an order by the text's bytes, and the features of each text."""
    for batch in slices(batches):
        texts = batch.column("text")
        row, column, value = features(texts)
        order = np.lexsort((column, row))
        row, column, value = row[order], column[order], value[order]
        cut = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
        data, at = text_bytes(texts)
        h = [_text_hash(data[at[k] : at[k + 1]]) for k in range(batch.num_rows)]
        lists = [pa.ListArray.from_arrays(cut, pa.array(column.astype(np.int32))), pa.ListArray.from_arrays(cut, pa.array(value))]
        yield pa.RecordBatch.from_arrays([batch.column("quality"), pa.array(h, pa.int64()), *lists], names=["quality", "h", "columns", "values"])


def classify(docs: DataFrame, space: Space, threshold: float = THRESHOLD) -> DataFrame:
    """All columns and rows of ``docs`` and a struct ``vote`` (underscores go in front of a taken name) of score (0 to
    1) and predicted (1 from the threshold on).

    Null texts count as empty, and empty ones are scored like others; repeated rows get equal scores; where nothing
    was learned every score is the prior (0.5 without labels); ties among neighbours at the last place are decided by
    their place in the sample; no rows give none.
    """
    name = fresh(docs.columns, "vote")
    shared = share(docs.sparkSession, space)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in slices(batches):
            score = own.scores(batch.column("text"))
            parts = [pa.array(score), pa.array((score >= threshold).astype(np.int32))]
            yield with_columns(batch, {name: pa.StructArray.from_arrays(parts, ["score", "predicted"])})

    kind = T._parse_datatype_string("struct<score:double,predicted:int>")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def classifier_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    narrow = docs.select("doc_id", "text")
    found = classify(narrow, learn(narrow, labels))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "vote.score", "vote.predicted")
