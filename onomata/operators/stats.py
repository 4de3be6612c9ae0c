"""Processing statistics in aggregate passes (no accumulators, no repeated actions)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import post_length
from .ledger import feed_ledger, ledger_stats
from .posts import keep_post

STATS_COLUMNS = (
    "subscriptions_skipped",
    "feeds_ok",
    "feeds_failed",
    "posts_ok",
    "feeds_without_posts",
    "posts_filtered",
    "posts_kept",
    "avg_chars",
    "avg_chars_int",
)


def post_length_stats(posts: DataFrame, mode: str | None = "blank", utf16: bool = False) -> DataFrame:
    """``(posts, posts_kept, total_chars, avg_chars, avg_chars_int)`` over the kept posts."""
    keep = keep_post(mode) if mode else F.lit(True)
    agg = posts.agg(
        F.count(F.lit(1)).alias("posts"),
        F.count_if(keep).alias("posts_kept"),
        F.coalesce(F.sum(F.when(keep, post_length(utf16=utf16))), F.lit(0)).cast("bigint").alias("total_chars"),
    )
    avg = F.when(F.col("posts_kept") > 0, F.col("total_chars") / F.col("posts_kept")).otherwise(F.lit(0.0))
    return agg.select(
        "posts", "posts_kept", "total_chars", avg.alias("avg_chars"), avg.cast("bigint").alias("avg_chars_int")
    )


def processing_stats(
    parsed: DataFrame, subscriptions: DataFrame, mode: str = "blank", utf16: bool = False
) -> DataFrame:
    """One row of run counters from decoded feeds (``sources.feeds.parse_feeds``, with or without rows for missing feeds)
    and the classified entries; see ``ledger.ledger_stats``."""
    return ledger_stats(feed_ledger(parsed, subscriptions, mode, utf16))


def observe_posts(posts: DataFrame, mode: str = "blank", name: str = "posts") -> tuple[DataFrame, Observation]:
    """Counters gathered while ``posts`` is written by some other action.

    ``Observation`` values are collected once per successful action, so a
    retried task is not counted twice (unlike an accumulator updated in a
    transformation). Read ``observation.get`` after the action.
    """
    obs = Observation(name)
    keep = keep_post(mode)
    observed = posts.observe(
        obs,
        F.count(F.lit(1)).alias("posts"),
        F.count_if(keep).alias("posts_kept"),
        F.coalesce(F.sum(F.when(keep, post_length())), F.lit(0)).cast("bigint").alias("total_chars"),
    )
    return observed, obs
