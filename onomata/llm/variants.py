"""Spelling variants by finite-state composition.

Two words are near if the composition of the vocabulary's minimal acceptor, a transducer of one edit, and the acceptor
again has a path for them. Before the edit both acceptors are in one state, the one reached by the words' common
beginning, so the composition falls into parts by that state: words are dealt out by their beginnings, as many code
points as make a part small enough for one task. There the part's acceptor is built and composed, and the accepted
pairs are listed. For beginnings of too many words the edits at their ends are listed by joins: what follows the edit
must be equal.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, each, stage
from .graph import follow

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points and occurrences of a word at least; how many times more often its form occurs at least.
LETTERS, TIMES, RATIO = 6, 5, 5
#: Of the hashes of runs, the multiples of this mark those that lose a code point.
SLIPS = 199
#: Words of a part, and their code points, that one task composes at most; beginnings that are broadcast at most.
WORDS, POINTS, BEGINNINGS = 20_000, 1_000_000, 100_000

_NEAR = "word string, n_near bigint, form_n bigint, form string"


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n: the words of all texts and their occurrences, after the slips."""
    own = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    own = own.where(F.length("run") >= LETTERS)
    own = own.select("id", F.when(F.lower("run") == F.col("run"), F.col("run")).otherwise(F.translate("run", UPPER, LOWER)).alias("run"))
    own = own.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    slipped = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = own.select(F.when(F.col("h") % SLIPS == 0, slipped).otherwise(F.col("run")).alias("word")).where(F.length("word") >= LETTERS)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= TIMES)


class Acceptor:
    """The minimal acceptor of sorted different words. A state has its edges, whether it accepts, and the least and the
    greatest length of what it accepts."""

    def __init__(self, words: list[str]):
        self.edges: list[dict[str, int]] = []
        self.accepts: list[bool] = []
        self.least: list[int] = []
        self.most: list[int] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, {}]]
        before = ""

        def close(depth: int) -> None:
            while len(path) > depth:
                accepts, edges = path.pop()
                key = (accepts, *edges.items())
                state = known.get(key)
                if state is None:
                    state = known[key] = len(self.edges)
                    self.edges.append(edges)
                    self.accepts.append(accepts)
                    self.least.append(0 if accepts or not edges else 1 + min(self.least[s] for s in edges.values()))
                    self.most.append(1 + max(self.most[s] for s in edges.values()) if edges else 0)
                if path:
                    path[-1][1][before[len(path) - 1]] = state
                else:
                    self.start = state

        for word in words:
            same = 0
            while same < min(len(before), len(word)) and before[same] == word[same]:
                same += 1
            close(same + 1)
            path.extend([False, {}] for _ in range(len(word) - same))
            path[-1][0] = True
            before = word
        close(0)

    def common(self, x: int, y: int, never: str = "") -> Iterator[str]:
        """All strings that both states accept and that do not begin with the symbol ``never``."""
        todo = [(x, y, "")]
        while todo:
            x, y, done = todo.pop()
            if self.accepts[x] and self.accepts[y]:
                yield done
            one, two = self.edges[x], self.edges[y]
            if len(two) < len(one):
                one, two = two, one
            for c in one:
                if c in two and (done or c != never):
                    x2, y2 = one[c], two[c]
                    if self.least[x2] <= self.most[y2] and self.least[y2] <= self.most[x2]:
                        todo.append((x2, y2, done + c))

    def near_pairs(self) -> Iterator[tuple[str, str]]:
        """Every two accepted words that are one edit apart, once: paths of the composition from its start."""
        todo = [(self.start, "")]
        while todo:
            q, done = todo.pop()
            chain = []
            while len(self.edges[q]) == 1 and not self.accepts[q] and self.least[q] == self.most[q]:
                # Nothing to replace, and a word with one symbol more would be of another length.
                (c, q), = self.edges[q].items()
                chain.append(c)
            done += "".join(chain)
            edges = list(self.edges[q].items())
            for k, (a, x) in enumerate(edges):
                todo.append((x, done + a))
                if self.least[q] <= self.most[x] and self.least[x] <= self.most[q]:
                    for rest in self.common(q, x, never=a):
                        yield done + rest, done + a + rest
                for b, y in edges[k + 1 :]:
                    if self.least[x] <= self.most[y] and self.least[y] <= self.most[x]:
                        for rest in self.common(x, y):
                            yield done + a + rest, done + b + rest


def _summed(pairs: Iterator[tuple[str, str]], n: dict[str, int], begin: str, out: list[dict]) -> None:
    """For each word of a pair: how many it is near to, and the most frequent of these."""
    count: dict[str, int] = {}
    best: dict[str, tuple[int, str]] = {}
    for pair in pairs:
        for one, other in (pair, pair[::-1]):
            count[one] = count.get(one, 0) + 1
            form = (-n[other], other)
            if one not in best or form < best[one]:
                best[one] = form
    out += [{"word": begin + w, "n_near": k, "form_n": -best[w][0], "form": begin + best[w][1]} for w, k in count.items()]


_ARROW = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for begin, words in each(batch, "begin", "words"):
            out: list[dict] = []
            n = {w["word"][len(begin) :]: w["n"] for w in words}
            _summed(Acceptor(sorted(n)).near_pairs(), n, begin, out)
            yield pa.RecordBatch.from_pylist(out, _ARROW)


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that are equal but for the symbol at one place: any two with a symbol there, or one without."""
    for batch in batches:
        out: list[dict] = []
        for at, words in zip(batch.column("at").to_pylist(), batch.column("words").to_pylist(), strict=True):
            n = {w["word"]: w["n"] for w in words}
            longest = max(map(len, n))
            long = sorted(w for w in n if len(w) == longest)
            pairs = [(u, v) for u, v in ((s, w) for s in n if len(s) < longest for w in long) if u[at : at + 1] != v[at]]
            if len(long) == len(n):
                pairs = [(u, v) for k, u in enumerate(long) for v in long[k + 1 :]]
            _summed(iter(pairs), n, "", out)
        yield pa.RecordBatch.from_pylist(out, _ARROW)


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many code points the first and the last word of a group, and so all, begin with."""
    for batch in batches:
        at = []
        for low, high in zip(batch.column("low").to_pylist(), batch.column("high").to_pylist(), strict=True):
            k = 0
            while k < min(len(low), len(high)) and low[k] == high[k]:
                k += 1
            at.append(k)
        yield pa.RecordBatch.from_arrays([batch.column("begin"), pa.array(at, pa.int32())], names=["begin", "at"])


def near_words(words: DataFrame, most: int = WORDS, points: int = POINTS) -> DataFrame:
    """For the words (word, n) that are one edit from another: n_near, and the most frequent such word with its n.

    Each round, the words of a beginning that too many share go on by one code point more than all of them share; pairs
    that differ first at that place are found there."""
    level, near = words.withColumn("begin", F.substr("word", F.lit(1), F.lit(0))), None
    while True:
        sizes = level.groupBy("begin").agg(F.count(F.lit(1)).alias("size"), F.sum(F.length("word")).alias("points"), F.min("word").alias("low"), F.max("word").alias("high"))
        large = (F.col("size") > 1) & ((F.col("size") > most) | (F.col("points") > points))
        split = stage(sizes.where(large).select("begin", "low", "high").mapInArrow(_shared, "begin string, at int"))
        few = split.count()
        held = F.broadcast(split) if few <= BEGINNINGS else split
        small = level.join(held, "begin", "left_anti") if few else level
        parts = small.groupBy("begin").agg(F.collect_list(F.struct("word", "n")).alias("words")).where(F.size("words") > 1)
        found = parts.repartition("begin").mapInArrow(_compose, _NEAR)
        near = found if near is None else near.union(found)
        if not few:
            break
        level = stage(level.join(held, "begin"))
        # What follows the place: with a symbol there (in pairs of one length, or as the longer word), or with none.
        begin, after, here = F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + 2), F.substr("word", F.col("at") + 1)
        has = F.length("word") > F.col("at")
        key = lambda kind, rest: F.concat(F.lit(kind), begin, F.lit("|"), rest)
        keys = F.array(F.when(has, key("=", after)), F.when(has, key("+", after)), key("+", here))
        rows = level.select("word", "n", "at", F.explode(F.filter(keys, lambda k: k.isNotNull())).alias("key"))
        met = rows.groupBy("key", "at").agg(F.collect_list(F.struct("word", "n")).alias("words")).where(F.size("words") > 1)
        plain = F.col("key").startswith("=")
        met = met.where(plain | (F.array_min(F.transform("words", lambda w: F.length(w["word"]))) < F.array_max(F.transform("words", lambda w: F.length(w["word"])))))
        near = near.union(met.select("at", "words").mapInArrow(_meet, _NEAR))
        level = level.where(has).select("word", "n", F.substr("word", F.lit(1), F.col("at") + 1).alias("begin"))
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form"))
    return near.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def spelling_variants(docs: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of every word of six code points or more that occurs five times or more.

    Null texts and texts without letters have no words; a null doc_id is empty text in the hash of a run; repeated rows
    count again; ties for the form go to the smallest word; no words, no rows.
    """
    words = stage(vocabulary(docs))
    near = near_words(words)
    joined = words.join(near, "word", "left")
    enough = F.col("form_n") >= RATIO * F.col("n")
    joined = joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), F.when(enough, F.col("form")).alias("form"), F.when(enough, F.col("form_n")).alias("form_n"))
    joined = stage(joined)
    discard(words)
    ends = follow(joined.where("form IS NOT NULL").select(F.col("word").alias("node"), F.col("form").alias("root")))
    return joined.join(ends.withColumnRenamed("node", "word"), "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
