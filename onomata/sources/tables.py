"""Adapters from stored tables to the post / feed model.

Posts have ``(post_id, feed, title, selftext)``. Text tables carry no feeds, so
a text row becomes a post (first line = title, the rest = selftext) and its
``source`` becomes the feed. ``land_feed_pages`` renders posts back into JSON
listing pages of bounded size, the shape a feed download has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import after_first_line, first_line
from ..plans.strategy import spread_scan

FEED_URL_PREFIX = "feeds/"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One stored table; a single-split file is spread over the cores (see ``spread_scan``)."""
    return spread_scan(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))


def posts_from_documents(documents: DataFrame) -> DataFrame:
    """documents -> posts: feed = source, title = first line, selftext = the rest."""
    return documents.select(
        F.col("doc_id").alias("post_id"),
        F.col("source").alias("feed"),
        first_line("text").alias("title"),
        after_first_line("text").alias("selftext"),
    )


def posts_from_conversations(conversations: DataFrame) -> DataFrame:
    """conversations -> posts: one post per turn, title = role, selftext = text."""
    return conversations.select(
        "conv_id",
        "turn",
        F.col("role").alias("title"),
        F.col("text").alias("selftext"),
    )


def feed_url(feed: str | Column) -> Column:
    c = F.col(feed) if isinstance(feed, str) else feed
    return F.concat(F.lit(FEED_URL_PREFIX), c)


def subscriptions_from_posts(posts: DataFrame) -> DataFrame:
    """One subscription per distinct feed: ``(name, url)`` (partial aggregation, tiny output)."""
    return posts.select(F.col("feed").alias("name")).distinct().select("name", feed_url("name").alias("url"))


def default_child_json() -> Column:
    """One listing child: ``{"kind":"t3","data":{"id":..,"title":..,"selftext":..}}``."""
    return F.to_json(
        F.struct(
            F.lit("t3").alias("kind"),
            F.struct(
                F.col("post_id").cast("string").alias("id"),
                F.col("title").alias("title"),
                F.col("selftext").alias("selftext"),
            ).alias("data"),
        )
    )


def land_feed_pages(posts: DataFrame, page_rows: int = 500, child_json: Column | None = None) -> DataFrame:
    """Render posts as feed pages ``(url, page, body)``.

    A page holds the posts of one feed whose ids share ``post_id div page_rows``,
    so no page exceeds ``page_rows`` children whatever the size of the feed: a
    hot feed becomes many pages, never one huge group. ``post_id`` must be a
    unique integer.
    """
    child = child_json if child_json is not None else default_child_json()
    keyed = posts.select(
        feed_url("feed").alias("url"),
        F.floor(F.col("post_id") / F.lit(page_rows)).cast("bigint").alias("page"),
        child.alias("child"),
    )
    return keyed.groupBy("url", "page").agg(
        F.concat(
            F.lit('{"kind":"Listing","data":{"children":['),
            F.array_join(F.collect_list("child"), ","),
            F.lit("]}}"),
        ).alias("body")
    )
