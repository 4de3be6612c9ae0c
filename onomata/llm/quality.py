"""Quality rules: base rules on words and lines, then a log-likelihood ratio of hashed n-grams.

Two multinomials over hashed character n-grams are counted: one over the trusted
documents (labelled good and not toxic), one over the whole raw corpus. A
document's score is the mean, over its n-grams, of log p_trusted - log p_raw.
Every document whose score reaches a fixed threshold is kept. All counts are
over all documents; only the table of log ratios, whose size is a parameter,
goes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.filters import KeyFilter
from .common import fresh, slices, text_bytes, with_columns
from .words import LINED, SPACED, mix, per_text, run_hashes, runs, windows

#: Bytes of an n-gram, and bits of its hash.
GRAM, BITS = 4, 16
#: Ids of trusted documents that are broadcast at most (16 MB). Past it the texts that may be trusted are shuffled.
TRUSTED_IDS = 1_000_000
#: Mean log ratio that a document needs at least.
THRESHOLD = -0.3
SYMBOLS = "#*$%&|<>"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def grams(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (BITS wide) of all n-grams that lie within one text, and each one's text."""
    m = len(data) - GRAM + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = np.zeros(m, np.uint32)
    for k in range(GRAM):
        code = (code << np.uint32(8)) | data[k : k + m]
    code = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    whole = text[:m] == text[GRAM - 1 :]
    return code[whole].astype(np.int64), text[:m][whole]


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The five counts of BASE for each text; a null text counts as empty."""
    data, at = text_bytes(texts)
    n = len(texts)
    starts, ends, text = runs(data, at, SPACED)
    hashes = run_hashes(data, starts, ends)
    counts = per_text(text, n)

    where = np.repeat(np.arange(n), np.diff(at))
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS.encode())] = True
    chars = per_text(where[((data & 0xC0) != 0x80) & SPACED[data]], n)
    symbols = per_text(where[symbol[data]], n)

    a, b, owner = runs(data, at, LINED)
    worded = np.searchsorted(starts, b) > np.searchsorted(starts, a)
    a, b, owner = a[worded], b[worded], owner[worded]
    line = mix(run_hashes(data, a, b) + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    _, first = np.unique(line, return_index=True)
    dup = per_text(owner, n) - per_text(owner[first], n)

    place, gram = windows(hashes, text, 3)
    _, back, times = np.unique(mix(gram + text[place].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True, return_counts=True)
    again = np.zeros(len(hashes), bool)
    for k in range(3):
        again[place[times[back] > 1] + k] = True
    return dict(zip(BASE, (counts, chars, symbols, dup, per_text(text[again], n)), strict=True))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((2, 1 << BITS), np.int64)
    for batch in slices(batches):
        trusted = batch.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
        code, text = grams(*text_bytes(batch.column("text")))
        total[0] += np.bincount(code, minlength=1 << BITS)
        total[1] += np.bincount(code[trusted[text]], minlength=1 << BITS)
    some = np.flatnonzero(total[0])
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[0, some]), pa.array(total[1, some])], names=["gram", "raw", "trusted"])


def log_ratios(docs: DataFrame, labels: DataFrame) -> np.ndarray:
    """log p_trusted - log p_raw of every hashed n-gram, with one added to each count.

    Without any trusted document all ratios are 0: nothing is known against a document.
    """
    good = labels.where("quality = 1 and coalesce(toxic, 0) = 0 and doc_id is not null").select("doc_id").distinct()
    rows = docs.select("doc_id", "text")
    n = good.count()
    if n <= TRUSTED_IDS:  # texts stay where they are
        marked = rows.join(F.broadcast(good.withColumn("trusted", F.lit(True))), "doc_id", "left").select("text", F.coalesce("trusted", F.lit(False)).alias("trusted"))
        counted = marked.mapInArrow(_count, "gram bigint, raw bigint, trusted bigint")
    else:  # all texts are counted where they are; those that may be trusted are shuffled and counted for that
        kind = "gram bigint, raw bigint, trusted bigint"
        if KeyFilter.useful(n):
            ids = KeyFilter(good, "doc_id", n)
            some = rows.where(ids.may_have(F.col("doc_id"), ids.bits()))
        else:
            some = rows.where("doc_id is not null")
        trusted = some.join(good, "doc_id", "left_semi").select("text", F.lit(True).alias("trusted")).mapInArrow(_count, kind)
        raw = rows.select("text", F.lit(False).alias("trusted")).mapInArrow(_count, kind)
        counted = raw.union(trusted.select("gram", F.lit(0).cast("bigint").alias("raw"), "trusted"))
    rows = counted.groupBy("gram").agg(F.sum("raw"), F.sum("trusted")).collect()  # 2**BITS rows at most
    counts = np.ones((2, 1 << BITS))
    for gram, raw, trusted in rows:
        counts[:, gram] += raw, trusted
    if not any(r[2] for r in rows):
        return np.zeros(1 << BITS, np.float32)
    p = np.log(counts / counts.sum(axis=1, keepdims=True))
    return (p[1] - p[0]).astype(np.float32)


def assess(docs: DataFrame, ratios: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """All columns and rows of ``docs`` and a struct ``quality`` (underscores go in front of a taken name) of the five
    base counts, base_failed, llr (mean log ratio; 0 for texts shorter than an n-gram) and kept.

    A null text is an empty one: no words, so base_failed. Repeated rows get the same values each; ties with the
    threshold are kept; an empty table gives none.
    """
    name = fresh(docs.columns, "quality")
    shared = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = batch.column("text")
            base = base_counts(texts)
            code, text = grams(*text_bytes(texts))
            n = batch.num_rows
            llr = np.bincount(text, shared.value[code], n) / np.maximum(np.bincount(text, minlength=n), 1)
            failed = (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])
            columns = {k: pa.array(v, pa.int64()) for k, v in base.items()}
            columns |= {"base_failed": pa.array(failed), "llr": pa.array(llr), "kept": pa.array(~failed & (llr >= threshold))}
            yield with_columns(batch, {name: pa.StructArray.from_arrays(list(columns.values()), list(columns))})

    kinds = [T.StructField(k, T.LongType()) for k in BASE] + [T.StructField("base_failed", T.BooleanType()), T.StructField("llr", T.DoubleType()), T.StructField("kept", T.BooleanType())]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StructType(kinds))]))


def quality_rules(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and llr of every document.

    A null text is an empty one: no words, so base_failed. Repeated rows get the same values each; a null doc_id is
    never trusted; ties with the threshold are kept; without labels all ratios are 0; an empty table gives none.
    """
    found = assess(docs.select("doc_id", "text"), log_ratios(docs, labels), threshold)
    return found.select("doc_id", *(F.col(f"quality.{k}").alias(k) for k in (*BASE, "base_failed", "kept", "llr")))
