"""Joins whose large side has frequent keys.

Adaptive execution splits large partitions after the shuffle, by the bytes it
has measured, and only where a join reads plain shuffles. Here the frequent
keys are known before: a frequent-items sketch counts all rows in one pass
(partial sketches per task, merged), so no key with more than a task's fair
share is missed. Rows of such a key are dealt to several tasks and the other
side's rows of that key are repeated for each of them.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Items that a sketch reports and tracks at most (the function's own limits), and how many it tracks per reported one.
REPORTED_MAX, TRACKED_MAX, TRACKED_PER_ITEM = 10_000, 1_000_000, 32
# Parts of a fair share that the rows of a frequent key are cut into: many small parts meet by chance in few tasks less
# unevenly than few large ones. All keys together are repeated this many times per task, and no more.
PARTS = 8


def frequent_items(rows: DataFrame, column: str, share: int) -> tuple[int, dict]:
    """The number of rows, and the values that may have more than one row in ``share`` with their estimated counts.

    Fewer than ``share`` values can have that many rows, so the list is short whatever the data. Estimates are upper
    bounds by less than a fair share, and null values count as rows only.
    """
    report = min(share, REPORTED_MAX)
    tracked = min(max(report * TRACKED_PER_ITEM, 1000), TRACKED_MAX)
    top = F.expr(f"approx_top_k(`{column}`, {report}, {tracked})")
    total, items = rows.agg(F.count(F.lit(1)), top).first()
    return total, {i["item"]: i["count"] for i in items or [] if i["item"] is not None and i["count"] * share > total}


def join_with_salts(
    large: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: Sequence[Column],
    share: int | None = None,
    how: str = "inner",
    hint: str | None = None,
) -> DataFrame:
    """``large`` joined to ``small`` on ``key`` (a column of both), rows of frequent keys dealt to several tasks.

    ``spread_by`` are expressions of the large side that tell rows of a key apart; the task of a row depends on them
    only, so a task that runs again deals its rows alike. ``share`` is the number of tasks that the rows should spread
    over (the shuffle partitions by default). Column order: the large side's, then the small side's without the key.
    """
    spark = large.sparkSession
    share = share or int(spark.conf.get("spark.sql.shuffle.partitions"))
    total, heavy = frequent_items(large, key, share)
    small = small.hint(hint) if hint else small
    if not heavy:
        return large.join(small, key, how)
    fair = max(1.0, total / share)
    kind = large.schema[key].dataType.simpleString()
    salts = spark.createDataFrame([(v, math.ceil(PARTS * n / fair)) for v, n in heavy.items()], f"`{key}` {kind}, _salts int")
    salts = F.broadcast(salts)  # fewer rows than share
    dealt = large.join(salts, key, "left").withColumn(
        "_salt", F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(*spread_by), F.col("_salts"))).otherwise(F.lit(0)).cast("int")
    )
    copies = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    repeated = small.join(salts, key, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    repeated = repeated.hint(hint) if hint else repeated
    joined = dealt.drop("_salts").join(repeated, [key, "_salt"], how)
    return joined.select(*large.columns, *(c for c in small.columns if c != key))
