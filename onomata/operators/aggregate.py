"""Counts by type (with a total row) and the ranked top-k."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..constants import ENTITY_TYPES, PARENT_TYPE, TOTAL_LABEL


def entity_type_dimension(spark: SparkSession) -> DataFrame:
    """Seven labels in report order: the six types, then ``total`` (order 0)."""
    rows = [(t, i + 1) for i, t in enumerate(ENTITY_TYPES)] + [(TOTAL_LABEL, 0)]
    return spark.createDataFrame(rows, "entity_type string, display_order int")


def count_by_type(counts: DataFrame) -> DataFrame:
    """``(entity_type, n, display_order)``: all six types zero-filled, plus ``total``.

    Rolls up the per-name counts (already small) instead of re-reading
    mentions, then adds a zero row per label and sums per label: no join, and
    an empty input still yields all seven rows. The total counts every
    mention, including types outside the six.
    """
    labels = list(ENTITY_TYPES) + [TOTAL_LABEL]
    order = F.create_map(*[x for i, t in enumerate(labels) for x in (F.lit(t), F.lit((i + 1) % len(labels)))])
    rolled = counts.rollup("entity_type").agg(
        F.sum("n").cast("bigint").alias("n"), F.grouping("entity_type").alias("g")
    )
    labelled = rolled.select(
        F.when(F.col("g") == 1, F.lit(TOTAL_LABEL)).otherwise(F.col("entity_type")).alias("entity_type"), "n"
    ).filter(F.col("entity_type").isin(labels))
    zeros = entity_type_dimension(counts.sparkSession).select("entity_type", F.lit(0).cast("bigint").alias("n"))
    return (
        labelled.unionByName(zeros)
        .groupBy("entity_type")
        .agg(F.sum("n").cast("bigint").alias("n"))
        .select("entity_type", "n", order[F.col("entity_type")].cast("int").alias("display_order"))
    )


def _rank_order():
    return (F.desc("n"), F.asc("entity_type"), F.asc("entity_name"))


def rank_entities(counts: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` by count desc, type asc, name asc, with ``rank`` 1..k.

    ``orderBy().limit()`` plans as TakeOrderedAndProject: each task keeps its
    own top k and only k rows per task reach the driver-side merge. The rank
    window then runs over those k rows only.
    """
    if not isinstance(k, int) or k <= 0:
        raise ValueError("k must be a positive integer")
    top = counts.select("entity_type", "entity_name", "n").orderBy(*_rank_order()).limit(k)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*_rank_order())))


def with_parent_type(type_stats: DataFrame) -> DataFrame:
    """Type statistics with ``parent_type`` (null for types without one, and for the total); nothing is rolled up."""
    pairs = [x for t, p in PARENT_TYPE.items() if p for x in (F.lit(t), F.lit(p))]
    return type_stats.withColumn("parent_type", F.create_map(*pairs)[F.col("entity_type")])
