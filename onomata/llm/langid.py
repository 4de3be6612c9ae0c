"""Language identification as multilingual mixture inference.

Every language has a multinomial over hashed byte trigrams inside words. A
document's words come from a mixture of the languages; expectation-maximisation
estimates its proportions. The set of languages is the one, among the sets of the
largest proportions, with the best penalised likelihood, whatever its size; the
proportions are estimated anew within it, and the largest is the prediction. Its
score is the mean, over the words, of its posterior against all languages.
Counts are over all documents that may be learned from.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh, held_out, learns, share, slices, text_bytes, with_columns
from .words import lower_ascii, runs

#: Bits of a hashed trigram; rounds of expectation-maximisation, and of those within a set of languages.
BITS, ROUNDS, SET_ROUNDS = 16, 8, 3
#: A further language must raise the log-likelihood by this many times the log of the document's words.
PENALTY = 2.0
#: What is added to each count.
SMOOTH = 0.5
UNKNOWN = "und"
#: Languages that the model knows at most: those of most documents. It bounds the table that is broadcast (50 MB).
LANGUAGES = 200

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x61, 0x7B), *range(0x80, 0x100)]] = True


def _trigrams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashed trigrams of all words (a blank before and after each), each word's first one, and its text."""
    data, at = text_bytes(texts)
    data = lower_ascii(data)
    starts, ends, text = runs(data, at, _LETTER)
    size = ends - starts + 1
    first = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(first, size)
    where = place + np.repeat(starts, size)
    padded = np.append(data, np.uint8(32)).astype(np.uint32)
    last = np.zeros(len(place), bool)
    last[first + size - 1] = True
    c = np.where(last, np.uint32(32), padded[where])
    b = np.where(place >= 1, padded[where - 1], np.uint32(32))
    a = np.where(place >= 2, padded[where - 2], np.uint32(32))
    code = ((a << np.uint32(16) | b << np.uint32(8) | c) * np.uint32(2654435761)) >> np.uint32(32 - BITS)
    return code.astype(np.int32), first, text, at


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        code, first, text, _ = _trigrams(batch.column("text"))
        lang = batch.column("lang").dictionary_encode()
        names, index = lang.dictionary.to_pylist(), lang.indices.to_numpy(zero_copy_only=False)
        if not len(first):
            continue
        of = index[np.repeat(text, np.diff(np.append(first, len(code))))]
        for k, name in enumerate(names):
            own = np.bincount(code[of == k], minlength=1 << BITS)
            total[name] = total.get(name, 0) + own
    for name, counts in total.items():
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some), pa.array(counts[some])], names=["lang", "gram", "n"])


class Model:
    """Log-probabilities of the hashed trigrams: one row each, one column per language."""

    def __init__(self, languages: list[str], table: np.ndarray) -> None:
        self.languages, self.table = languages, table


def learn(docs: DataFrame) -> Model:
    """Trigram counts by language, over all documents with text and lang whose id allows learning, of the LANGUAGES
    languages with most such documents (then those that sort first).

    What reaches the driver is at most 2**BITS rows per language.
    """
    known = docs.where(learns(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    named = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES).select("lang").collect()
    known = known.where(F.col("lang").isin([r[0] for r in named]))
    rows = known.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(set(rows["lang"]))
    counts = np.full((1 << BITS, len(languages)), SMOOTH)
    if languages:
        column = {x: k for k, x in enumerate(languages)}
        np.add.at(counts, (rows["gram"].to_numpy(np.int64), rows["lang"].map(column).to_numpy(np.int64)), rows["n"].to_numpy(np.float64))
    return Model(languages, np.log(counts / counts.sum(axis=0)).astype(np.float32))


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0) if len(first) else values[:0]


def _fit(likely: np.ndarray, cut: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions after some rounds, and each document's log-likelihood under them (less the words' maxima)."""
    size = np.diff(np.append(cut, len(likely)))
    for _ in range(rounds):
        joint = likely * np.repeat(share, size, axis=0)
        joint /= np.maximum(joint.sum(axis=1, keepdims=True), 1e-30)
        share = _sums(joint, cut) / size[:, None]
    mixed = (likely * np.repeat(share, size, axis=0)).sum(axis=1)
    return share, _sums(np.log(np.maximum(mixed, 1e-30)), cut)


def _most(likely: np.ndarray, cut: np.ndarray, share: np.ndarray) -> np.ndarray:
    """What no proportions of any languages can lift each document's log-likelihood above.

    The log-likelihood is concave, so its gain over that of ``share`` is at most the number of words times the log of
    the largest mean of a language's likelihood over the mixture's.
    """
    size = np.diff(np.append(cut, len(likely)))
    mixed = np.maximum((likely * np.repeat(share, size, axis=0)).sum(axis=1), 1e-30)
    mean = _sums(likely / mixed[:, None], cut).max(axis=1) / size
    return np.minimum(0, _sums(np.log(mixed), cut) + size * np.log(np.maximum(mean, 1)))


def infer(texts: pa.Array, model: Model) -> tuple[list[str], np.ndarray, list[list[str]]]:
    """Predicted language, its mean posterior over the text's words, and the chosen set (largest first) of each text.

    A larger set is tried until its penalty alone rules out that it or any after it is better.
    """
    n, k = len(texts), len(model.languages)
    lang, score, chosen = [UNKNOWN] * n, np.zeros(n), [[] for _ in range(n)]
    code, first, text, _ = _trigrams(texts)
    if not len(first) or not k:
        return lang, score, chosen
    likely = np.empty((len(first), k), np.float32)
    for j in range(k):
        likely[:, j] = np.add.reduceat(np.ascontiguousarray(model.table[:, j])[code], first)
    likely = np.exp(likely - likely.max(axis=1, keepdims=True))
    docs, cut = np.unique(text, return_index=True)
    words = np.diff(np.append(cut, len(first)))
    posterior = _sums(likely / likely.sum(axis=1, keepdims=True), cut) / words[:, None]
    share, _ = _fit(likely, cut, np.full((len(docs), k), 1 / k, np.float32), ROUNDS)
    order = np.argsort(-share, axis=1, kind="stable")
    best = np.full(len(docs), -np.inf)
    size = np.ones(len(docs), np.int64)
    fitted = np.zeros((len(docs), k), np.float32)
    most, price = _most(likely, cut, share), PENALTY * np.log(np.maximum(words, 2))
    for m in range(1, k + 1):
        live = np.flatnonzero(most - price * (m - 1) > best)
        if not len(live):
            break
        inside = np.zeros((len(live), k), np.float32)
        np.put_along_axis(inside, order[live, :m], 1.0, axis=1)
        rows = np.repeat(cut[live] - np.concatenate([[0], np.cumsum(words[live])[:-1]]), words[live]) + np.arange(words[live].sum())
        part = np.concatenate([[0], np.cumsum(words[live])[:-1]])
        start = share[live] * inside
        start /= np.maximum(start.sum(axis=1, keepdims=True), 1e-30)
        own, value = _fit(likely[rows], part, start, 0 if m == 1 else SET_ROUNDS)
        value = value - price[live] * (m - 1)
        better = value > best[live]
        best[live[better]], size[live[better]], fitted[live[better]] = value[better], m, own[better]
    # Languages outside a document's set have no proportion in it.
    order = np.argsort(-fitted, axis=1, kind="stable")
    for i, d in enumerate(docs.tolist()):
        lang[d] = model.languages[order[i, 0]]
        score[d] = min(1.0, float(posterior[i, order[i, 0]]))
        chosen[d] = [model.languages[j] for j in order[i, : size[i]]]
    return lang, score, chosen


def _lettered(texts: pa.Array) -> list[bool]:
    """Whether each text has a letter (of any script)."""
    return [x is not None and any(map(str.isalpha, x)) for x in texts.to_pylist()]


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """All columns and rows of ``docs`` and a struct ``language`` (underscores go in front of a taken name) of
    lang_pred, score (the mean of its posterior over the words, all languages being as likely before) and languages (the
    chosen set, largest first).

    ``und`` with score 0 and no set: null and empty texts, texts without a letter, and all texts where nothing was
    learned. Ties go to the language that sorts first. Repeated rows get the same values; no rows give none.
    """
    name = fresh(docs.columns, "language")
    shared = share(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared()
        for batch in slices(batches):
            texts = batch.column("text")
            lang, score, chosen = infer(texts, own)
            for k, lettered in enumerate(_lettered(texts)):
                if not lettered:
                    lang[k], score[k], chosen[k] = UNKNOWN, 0.0, []
            parts = [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(chosen, pa.list_(pa.string()))]
            yield with_columns(batch, {name: pa.StructArray.from_arrays(parts, ["lang_pred", "score", "languages"])})

    kind = T._parse_datatype_string("struct<lang_pred:string,score:double,languages:array<string>>")
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def language_report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and languages of every document."""
    found = identify(docs.select("doc_id", "text"), learn(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "language.lang_pred", "language.score", "language.languages")


def keep_identified(docs: DataFrame) -> DataFrame:
    """The documents, with their own columns, whose chosen set has a language, however many share the text."""
    found = identify(docs, learn(docs))
    at = F.col(f"`{found.columns[-1]}`")
    return found.where(F.size(at.languages) > 0).select(*(F.col(f"`{c}`") for c in docs.columns))
