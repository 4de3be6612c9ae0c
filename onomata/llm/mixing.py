"""Mixing sources to target weights by weighted fair queueing. DataFrame functions only.

Documents of a source are shuffled by a hash. A document's virtual finish time is
the source's words up to its end in that order, divided by the source's target;
a second pass over the source goes on counting where the first ended. All copies
are ordered by finish time over the whole corpus and taken until the budget is
spent. Running sums come in two steps, per bucket and inside buckets, so that
neither a source nor the corpus is ever in one task; only the place of the cut
goes through the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, checkpoint, fresh

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Share of all words that the mix takes, and how often at most a source is used.
BUDGET, REPEATS = 1.5, 2


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(docs: DataFrame) -> Column:
    """Order of the shuffle: equal for equal rows only (nulls are marked, and the source's length tells where it ends)."""
    own = F.col("doc_id").cast("string"), F.length("source").cast("string"), F.col("source"), F.concat(F.lit("="), "text")
    return F.md5(F.concat_ws("|", *(F.coalesce(c, F.lit("")) for c in own)).cast("binary"))


def source_targets(totals: DataFrame) -> DataFrame:
    """``totals`` (src, source, source_size; one row per source) with rank, weight and target.

    Targets share the budget by weight, none above REPEATS times its source. The water level is found in one sorted
    pass: sources whose limit per weight lies below the level are capped, the others get weight times level.
    """
    weights = F.array(*map(F.lit, WEIGHTS))
    ranked = totals.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")))
    ranked = ranked.withColumn("weight", F.element_at(weights, ((F.col("rank") - 1) % len(WEIGHTS) + 1).cast("int")))
    limit = F.col("source_size") * REPEATS
    order = Window.orderBy(limit / F.col("weight"), "rank")
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) * BUDGET - F.coalesce(F.sum(limit).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    level = left / F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    found = ranked.withColumn("level", level).withColumn("place", F.row_number().over(order))
    first = F.min(F.when(F.col("level") <= limit / F.col("weight"), F.struct("place", "level"))).over(everything)["level"]
    return found.withColumn("target", F.least(limit.cast("double"), F.col("weight") * first)).select("src", "source_size", "rank", "target")


def finish_times(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """One narrow row per document (doc_id, key, size, source_size, rank, target, done: words of its source up to its
    end), and the cut: the last copy that the mix takes as (time, rank, key, copy), None where nothing is taken."""
    sized = checkpoint(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), _key(docs).alias("key")).withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))))
    rows, words = sized.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    digits = max(1, min(8, math.ceil(math.log(max(rows, 1) / 2000 + 1, 16))))
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))

    per_bucket = sized.groupBy("src", "source", "bucket").agg(F.sum("size").alias("words"))
    totals = source_targets(per_bucket.groupBy("src", "source").agg(F.sum("words").alias("source_size")))
    before = Window.partitionBy("src").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    begun = per_bucket.select("src", "bucket", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("begun")).join(totals, "src")
    inside = Window.partitionBy("src", "bucket").orderBy("key").rangeBetween(Window.unboundedPreceding, 0)
    timed = sized.join(begun, ["src", "bucket"]).withColumn("done", F.col("begun") + F.sum("size").over(inside))
    timed = checkpoint(timed.select("doc_id", "key", "size", "source_size", "rank", "target", "done"))

    copies = timed.where("size > 0 and target > 0").select(
        "size", "key", "rank", "target", F.explode(F.transform(F.sequence(F.lit(0), F.lit(REPEATS - 1)), lambda c: F.struct(c.alias("copy"), ((F.col("done") + c * F.col("source_size")) / F.col("target")).alias("time")))).alias("at")
    ).select("size", "key", "rank", "at.copy", "at.time")
    cells = max(16, int(math.sqrt(2 * rows)))
    celled = copies.withColumn("cell", F.floor(F.col("time") * cells))
    budget = words * BUDGET
    upto = Window.orderBy("cell")
    sums = celled.groupBy("cell").agg(F.sum("size").alias("words")).withColumn("ends", F.sum("words").over(upto))
    full = sums.agg(F.max(F.when(F.col("ends") <= budget, F.struct("ends", "cell")))).first()[0]
    ends, cell = (full["ends"], full["cell"]) if full else (0, -1)
    place = F.struct("time", "rank", "key", "copy")
    later = celled.where(F.col("cell") == (sums.where(F.col("ends") > budget).agg(F.min("cell")).first()[0] if words else None))
    running = later.withColumn("ends", ends + F.sum("size").over(Window.orderBy(place).rangeBetween(Window.unboundedPreceding, 0)))
    cut = running.where(F.col("ends") <= budget).agg(F.max(place)).first()[0] if words else None
    if cut is None and full:
        cut = celled.where(F.col("cell") == cell).agg(F.max(place)).first()[0]
    return timed, cut


def _copies(cut) -> Column:
    """How many of a document's copies are not after the cut."""
    if cut is None:
        return F.lit(0)
    at = lambda c: F.struct(((F.col("done") + c * F.col("source_size")) / F.col("target")).alias("time"), F.col("rank"), F.col("key"), F.lit(c).alias("copy"))
    end = F.struct(F.lit(cut["time"]).alias("time"), F.lit(cut["rank"]).alias("rank"), F.lit(cut["key"]).alias("key"), F.lit(cut["copy"]).alias("copy"))
    taken = [F.when((F.col("target") > 0) & (F.col("size") > 0) & (at(c) <= end), 1).otherwise(0) for c in range(REPEATS)]
    return sum(taken[1:], taken[0])


def mixing_report(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken of every document.

    Null and empty texts have size 0 and nothing is taken of them; a null source is a source of its own, the last;
    equal rows are ordered as one and are taken together; a corpus without words gives targets of 0; no rows, none.
    """
    timed, cut = finish_times(docs.select("doc_id", "source", "text"))
    return timed.select("doc_id", "size", "source_size", "target", (_copies(cut) * F.col("size")).cast("long").alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mix: rows with the documents' own columns, once for each copy taken, in global order of finish time."""
    timed, cut = finish_times(docs)
    order, key, copies, copy, time = (fresh(docs.columns, x) for x in ("order", "key", "copies", "copy", "time"))
    taken = timed.withColumn("n", _copies(cut)).where("n > 0").groupBy(F.col("key").alias(key)).agg(
        F.max("n").alias(copies), F.max(F.struct("done", "source_size", "target", "rank")).alias(order)
    )
    rows = docs.withColumn(key, _key(docs)).join(taken, key).withColumn(copy, F.explode(F.sequence(F.lit(0), F.col(copies) - 1)))
    at = F.col(order)
    rows = rows.withColumn(time, (at.done + F.col(copy) * at.source_size) / at.target)
    return rows.orderBy(time, at.rank, key, copy).select(*(F.col(f"`{c}`") for c in docs.columns))
