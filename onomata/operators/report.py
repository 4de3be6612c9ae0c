"""Text reports as small DataFrames ``(line_no int, line string)``.

The cluster computes the aggregates; a report is a projection of at most a
few rows, so nothing large is formatted or collected on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C

REPORT_SCHEMA = "line_no int, line string"


def _lines(spark: SparkSession, rows: list[tuple[int, str]]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def processing_report(stats: DataFrame) -> DataFrame:
    """Banner and six counter lines from the one-row ``processing_stats`` frame."""
    labels = [
        (C.LABEL_FEEDS_OK, "feeds_ok"),
        (C.LABEL_FEEDS_FAILED, "feeds_failed"),
        (C.LABEL_POSTS_OK, "posts_ok"),
        (C.LABEL_POSTS_FAILED, "feeds_without_posts"),
        (C.LABEL_POSTS_FILTERED, "posts_filtered"),
        (C.LABEL_AVG_CHARS, "avg_chars_int"),
    ]
    pairs = F.array(
        *[
            F.struct(F.lit(i + 2).alias("line_no"), F.concat(F.lit(label + ": "), F.col(c).cast("string")).alias("line"))
            for i, (label, c) in enumerate(labels)
        ]
    )
    body = stats.select(F.inline(pairs))
    return _lines(stats.sparkSession, [(1, C.BANNER_PROCESSING)]).unionByName(body)


def type_report(type_stats: DataFrame) -> DataFrame:
    """Banner, total, heading, then the six types in fixed order (zero-filled)."""
    spark = type_stats.sparkSession
    total = type_stats.filter(F.col("entity_type") == C.TOTAL_LABEL).select(
        F.lit(2).alias("line_no"), F.concat(F.lit(C.LABEL_TOTAL_ENTITIES + ": "), F.col("n").cast("string")).alias("line")
    )
    typed = type_stats.filter(F.col("entity_type") != C.TOTAL_LABEL).select(
        (F.col("display_order") + 3).cast("int").alias("line_no"),
        F.format_string(C.TYPE_LINE_FORMAT, F.col("entity_type"), F.col("n")).alias("line"),
    )
    head = _lines(spark, [(1, C.BANNER_TYPES), (3, C.LABEL_BY_CATEGORY)])
    return head.unionByName(total).unionByName(typed)


def entity_report(ranked: DataFrame) -> DataFrame:
    """Banner and one ``[Type=t] name: n apariciones`` line per ranked entity."""
    lines = ranked.select(
        (F.col("rank") + 1).cast("int").alias("line_no"),
        F.format_string(C.ENTITY_LINE_FORMAT, F.col("entity_type"), F.col("entity_name"), F.col("n")).alias("line"),
    )
    return _lines(ranked.sparkSession, [(1, C.BANNER_ENTITIES)]).unionByName(lines)


def diagnostics(*frames: DataFrame) -> DataFrame:
    """Union of diagnostic frames ``(severity, code, subject, message)``."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out
