"""Test scenario laid over the stored text tables.

The tables carry no feeds, so feeds are derived from ``documents``: feed =
``source``, one subscription per source, bodies rendered as listing pages.
Every rule below is applied by Spark to whole tables; the fixed values only
pick which feeds receive which fault.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .constants import DICTIONARY_FILES
from .sources.feeds import attach_feeds, fetched_feeds, parse_feeds
from .sources.subscriptions import classify_subscriptions, parse_subscription_records
from .sources.tables import (
    FEED_URL_PREFIX,
    default_child_json,
    feed_url,
    land_feed_pages,
    posts_from_documents,
    read_table,
    subscriptions_from_posts,
)

# Probe dictionary used on the driver tables (a duplicate line
# and case variants included on purpose).
PROBE_DICTIONARY = [
    ("University", "MIT"),
    ("ProgrammingLanguage", "Go"),
    ("Person", "The"),
    ("Place", "THAN"),
    ("Place", "Than"),
    ("Place", "THAN"),
    ("Organization", "Elle"),
    ("Technology", "the."),
]

# Multi-word names added for phrase matching.
PHRASE_DICTIONARY = PROBE_DICTIONARY + [
    ("Technology", "MIT License"),
    ("Technology", "Apache License"),
    ("Technology", "GNU General Public License"),
    ("Organization", "Apache"),
]

# Words, and bytes of them and their runs, that a task holds before it hands them on.
RUNS_HELD, RUN_BYTES_HELD = 200_000, 32 << 20

# Raw subscription entries appended to the derived ones.
EXTRA_SUBSCRIPTION_RECORDS = [
    '{"title": "neither name nor url"}',
    '{"name": "", "url": "feeds/empty-name"}',
    '{"name": "no-url"}',
    '{"name": "empty-url", "url": ""}',
    '{"name": "   ", "url": "feeds/blank-name"}',
    "plain words, no braces",
]

# Posts per landed page, and which feeds get which fault.
PAGE_ROWS = 500
FEED_NOT_LANDED = "src5"
FEED_TRUNCATED = "src3"
FEED_MISSING_SELFTEXT = "src7"
FEED_OBJECT_TITLE = "src11"
FEED_NO_CHILDREN = "src13"
FEED_EMPTY = "src17"
BODY_NO_CHILDREN = '{"data":{}}'
BODY_EMPTY = '{"data":{"children":[]}}'

# A feed whose bodies are blanked for the blank-post filter.
FEED_BLANKED = "src2"


def documents_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts_from_documents(read_table(spark, sf_dir, "documents"))


def subscription_records(spark: SparkSession, posts: DataFrame) -> DataFrame:
    """JSON object per derived subscription, plus the fixed raw entries."""
    derived = subscriptions_from_posts(posts).select(F.to_json(F.struct("name", "url")).alias("value"))
    extra = spark.createDataFrame([(r,) for r in EXTRA_SUBSCRIPTION_RECORDS], "value string")
    return derived.unionByName(extra)


def classified_subscriptions(spark: SparkSession, posts: DataFrame) -> DataFrame:
    return classify_subscriptions(parse_subscription_records(subscription_records(spark, posts)))


def clean_pages(posts: DataFrame) -> DataFrame:
    return land_feed_pages(posts, PAGE_ROWS)


def faulty_pages(posts: DataFrame) -> DataFrame:
    """Landed pages with one fault per chosen feed; ``FEED_NOT_LANDED`` is absent."""
    feed = F.col("feed")
    object_title = F.to_json(
        F.struct(
            F.lit("t3").alias("kind"),
            F.struct(
                F.col("post_id").cast("string").alias("id"),
                F.struct(F.col("title").alias("text")).alias("title"),
                F.col("selftext").alias("selftext"),
            ).alias("data"),
        )
    )
    no_selftext = F.to_json(
        F.struct(
            F.lit("t3").alias("kind"),
            F.struct(F.col("post_id").cast("string").alias("id"), F.col("title").alias("title")).alias("data"),
        )
    )
    child = (
        F.when(feed == FEED_OBJECT_TITLE, object_title)
        .when((feed == FEED_MISSING_SELFTEXT) & (F.col("selftext") == ""), no_selftext)
        .otherwise(default_child_json())
    )
    pages = land_feed_pages(posts.filter(feed != FEED_NOT_LANDED), PAGE_ROWS, child)
    url, body = F.col("url"), F.col("body")
    faulted = (
        F.when(url == FEED_URL_PREFIX + FEED_TRUNCATED, F.expr("substr(body, 1, length(body) div 2)"))
        .when(url == FEED_URL_PREFIX + FEED_NO_CHILDREN, F.lit(BODY_NO_CHILDREN))
        .when(url == FEED_URL_PREFIX + FEED_EMPTY, F.lit(BODY_EMPTY))
        .otherwise(body)
    )
    return pages.select("url", "page", faulted.alias("body"))


def parsed_feeds(spark: SparkSession, sf_dir: str, faulty: bool = True, missing: bool = True) -> tuple[DataFrame, DataFrame]:
    """``(parsed, classified_subscriptions)`` for the derived feeds, with or without rows for those not landed."""
    posts = documents_posts(spark, sf_dir)
    classified = classified_subscriptions(spark, posts)
    valid = classified.filter(F.col("sub_status") == "VALID").select("name", "url")
    landed = faulty_pages(posts) if faulty else clean_pages(posts)
    return parse_feeds((attach_feeds if missing else fetched_feeds)(valid, landed)), classified


def blanked_posts(posts: DataFrame) -> DataFrame:
    """Posts of ``FEED_BLANKED`` keep only their whitespace and control chars."""
    blanked = F.regexp_replace(F.col("selftext"), r"[^\x00-\x20]", "")
    return posts.withColumn(
        "selftext", F.when(F.col("feed") == FEED_BLANKED, blanked).otherwise(F.col("selftext"))
    )


def document_dictionary_lines(documents: DataFrame) -> DataFrame:
    """Raw dictionary lines ``(declared_type, value)`` from document lines.

    Each language plays one dictionary file: German lines are commented out,
    French lines are padded with tabs and spaces, Spanish lines are followed by
    a blank line and declare an unknown type (so they fall back to Person).
    """
    lang = F.col("lang")
    text = F.when(lang == "es", F.regexp_replace("text", "\n", "\n \t\n")).otherwise(F.col("text"))
    lines = documents.select(lang, F.explode(F.split(text, "\n")).alias("line"))
    raw = (
        F.when(lang == "de", F.concat(F.lit("# "), F.col("line")))
        .when(lang == "fr", F.concat(F.lit("\t "), F.col("line"), F.lit(" \t")))
        .otherwise(F.col("line"))
    )
    declared = (
        F.when(lang == "en", F.lit("Person"))
        .when(lang == "fr", F.lit("Place"))
        .when(lang == "de", F.lit("University"))
        .otherwise(F.lit("Spanish"))
    )
    return lines.select(declared.alias("declared_type"), raw.alias("value"))


# The file that each declared type's lines are landed in; lines of an unknown type go to the people.
_FILE_OF_TYPE = {"Person": "people.txt", "Place": "places.txt", "University": "universities.txt", "Spanish": "people.txt"}


def land_dictionary_files(documents: DataFrame, folder: str) -> None:
    """The lines of ``document_dictionary_lines`` as text files named by type (folders of part files)."""
    lines = document_dictionary_lines(documents)
    for name in sorted(set(_FILE_OF_TYPE.values())):
        own = [t for t, n in _FILE_OF_TYPE.items() if n == name]
        lines.where(F.col("declared_type").isin(own)).select("value").write.text(f"{folder}/{name}")


def land_run(spark: SparkSession, posts: DataFrame, folder: str) -> None:
    """Everything that a run reads, as files: the subscription entries as JSON lines, the landed pages as JSON lines and
    the probe dictionary as text by type."""
    subscription_records(spark, posts).coalesce(1).write.text(f"{folder}/subscriptions")
    faulty_pages(posts).write.json(f"{folder}/landed")
    probe = spark.createDataFrame(list(PROBE_DICTIONARY), "entity_type string, entity_name string")
    for name, kind in DICTIONARY_FILES:
        probe.where(F.col("entity_type") == kind).select("entity_name").coalesce(1).write.text(f"{folder}/entities/{name}")


__all__ = [
    "PROBE_DICTIONARY",
    "PHRASE_DICTIONARY",
    "EXTRA_SUBSCRIPTION_RECORDS",
    "documents_posts",
    "classified_subscriptions",
    "clean_pages",
    "faulty_pages",
    "parsed_feeds",
    "blanked_posts",
    "document_dictionary_lines",
    "feed_url",
]


def _least_runs_of_task(batches: Iterator[pa.RecordBatch], held_max: int, bytes_max: int) -> Iterator[pa.RecordBatch]:
    """``(first, two, three)`` of the texts of a task, as bytes: they compare like Spark's strings. Rows of a word come
    again when more words than a task may hold were handed on between them."""
    held: dict[bytes, list[bytes]] = {}
    size = 0

    def handed_on() -> pa.RecordBatch:
        kind = pa.binary()
        return pa.RecordBatch.from_arrays(
            [pa.array(held, kind), *(pa.array([v[k] for v in held.values()], kind) for k in (0, 1))], ["first", "two", "three"]
        )

    for batch in batches:
        for text in batch.column(0):
            if not text.is_valid:
                continue
            words = text.as_py().replace(b"\n", b" ").split(b" ")
            last, runs = words[-1], zip(words, islice(words, 1, None), islice(words, 2, None))
            at_end = [(last, last, last)] if len(words) < 2 else [(words[-2], b" ".join(words[-2:]), b" ".join(words[-2:])), (last, last, last)]
            for first, two, three in chain(((a, t := a + b" " + b, t + b" " + c) for a, b, c in runs), at_end):
                least = held.get(first)
                if least is None:
                    if first:
                        held[first] = [two, three]
                        size += len(first) + len(two) + len(three)
                    continue
                if two < least[0]:
                    least[0] = two
                if three < least[1]:
                    least[1] = three
            if len(held) >= held_max or size >= bytes_max:
                yield handed_on()
                held.clear()
                size = 0
    if held:
        yield handed_on()


def least_runs(texts: DataFrame, held_max: int = RUNS_HELD, bytes_max: int = RUN_BYTES_HELD) -> DataFrame:
    """``(first, two, three)``: every word of the column ``text`` with the least two and the least three words from one of
    its places on (fewer where the text ends). Words are what blanks and line feeds separate.

    The least of strings is aggregated by a sort, so each task first reduces its own texts by a hash table of bounded
    size: what is sorted and shuffled is rows of words, not of places.
    """
    parts = texts.select(F.col("text").cast("binary").alias("text")).mapInArrow(
        lambda batches: _least_runs_of_task(batches, held_max, bytes_max), "first binary, two binary, three binary"
    )
    least = parts.groupBy("first").agg(F.min("two").alias("two"), F.min("three").alias("three"))
    return least.select(*(F.col(c).cast("string").alias(c) for c in ("first", "two", "three")))
