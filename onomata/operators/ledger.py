"""The run's ledger: one row per feed, from which counters, warnings and guards follow.

The decoded pages and the listed subscriptions are brought together by one
aggregate. Statistics and diagnostics are each one more aggregate over it, so a
query decodes the bodies once and reads the landed pages once, and needs no
anti join to tell which feeds are missing: a listed feed without any body is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..constants import FEED_STATUSES, MSG_FETCH_FAILED, MSG_NO_POSTS, MSG_NO_SUBSCRIPTIONS, MSG_PARSE_FAILED
from ..functions.text import post_length
from ..sources.subscriptions import refusal
from .posts import keep_post

# What a page may come to; those that are reported are all but the last two.
_PAGE = [s for s in FEED_STATUSES if s != "SKIPPED"]
_REPORTED = [s for s in _PAGE if s not in ("EMPTY", "OK")]
_NOTE = ("severity", "code", "subject", "message")
_NOTE_TYPE = "struct<severity:string,code:string,subject:string,message:string>"


def _count(n: Column | int) -> Column:
    return (F.lit(n) if isinstance(n, int) else n).cast("bigint")


def feed_ledger(parsed: DataFrame, classified: DataFrame, mode: str = "blank", utf16: bool = False) -> DataFrame:
    """``(name, url, note, listed, bodies_<status>..., posts, kept, chars)``.

    One row per feed (name and url), and one per note on a refused entry, whose
    ``listed`` says how many entries have it. ``parsed`` are decoded feeds, with
    or without rows for feeds that are missing; ``classified`` the entries.
    """
    is_post = F.col("child_pos").isNotNull()
    keep = is_post & keep_post(mode)
    first = ~is_post | (F.col("child_pos") == 0)
    bodies = {s: F.when(first & (F.col("status") == s), 1).otherwise(0) for s in _PAGE}
    sums = [*(f"bodies_{s}" for s in _PAGE), "posts", "kept", "chars"]
    pages = parsed.select(
        "name", "url", F.lit(None).cast(_NOTE_TYPE).alias("note"), _count(0).alias("listed"),
        *(_count(c).alias(f"bodies_{s}") for s, c in bodies.items()),
        _count(is_post.cast("int")).alias("posts"), _count(keep.cast("int")).alias("kept"),
        F.when(keep, post_length(utf16=utf16)).otherwise(0).cast("bigint").alias("chars"),
    )
    valid = F.col("sub_status") == "VALID"
    note = subscription_note(classified)
    entries = classified.select(
        F.when(valid, F.col("name")).alias("name"), F.when(valid, F.col("url")).alias("url"),
        F.when(~valid, note).cast(_NOTE_TYPE).alias("note"), _count(1).alias("listed"), *(_count(0).alias(c) for c in sums),
    )
    return pages.unionByName(entries).groupBy("name", "url", "note").agg(*(F.sum(c).alias(c) for c in ("listed", *sums)))


def subscription_note(classified: DataFrame) -> Column:
    """The diagnostic of a refused entry as a struct, in the words of ``subscription_diagnostics``."""
    return F.struct(*(c.alias(n) for n, c in zip(_NOTE, refusal(classified.columns), strict=True)))


def ledger_stats(ledger: DataFrame) -> DataFrame:
    """One row of run counters.

    Feeds are counted, not pages. ``feeds_ok``: valid subscriptions with at
    least one body; ``feeds_failed``: those without (nothing landed, or null
    bodies only); ``feeds_without_posts``: those of which no page gave a post,
    failed ones included; a subscription listed twice counts twice.
    ``posts_filtered``: posts dropped by the filter.
    """
    valid = F.when(F.col("note").isNull(), F.col("listed")).otherwise(0)
    body = sum((F.col(f"bodies_{s}") for s in _PAGE if s != "FETCH_FAILED"), F.lit(0)) > 0

    def total(c: Column) -> Column:
        return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

    agg = ledger.agg(
        total(F.col("listed") - valid).alias("subscriptions_skipped"),
        total(F.when(body, valid)).alias("feeds_ok"),
        total(F.when(~body, valid)).alias("feeds_failed"),
        total(F.col("posts")).alias("posts_ok"),
        total(F.when(F.col("posts") == 0, valid)).alias("feeds_without_posts"),
        total(F.col("kept")).alias("posts_kept"),
        total(F.col("chars")).alias("total_chars"),
    )
    avg = F.when(F.col("posts_kept") > 0, F.col("total_chars") / F.col("posts_kept")).otherwise(F.lit(0.0))
    return agg.select(
        "subscriptions_skipped", "feeds_ok", "feeds_failed", "posts_ok", "feeds_without_posts",
        (F.col("posts_ok") - F.col("posts_kept")).alias("posts_filtered"), "posts_kept",
        avg.alias("avg_chars"), avg.cast("bigint").alias("avg_chars_int"),
    )


def _note(severity: str, code: str, subject: Column, message: Column) -> Column:
    return F.struct(F.lit(severity).alias("severity"), F.lit(code).alias("code"), subject.alias("subject"), message.alias("message"))


def ledger_diagnostics(ledger: DataFrame) -> DataFrame:
    """``(severity, code, subject, message)``: refused entries, one row each; feeds that failed to download or decode,
    one row per body, and per entry where nothing landed; an ERROR where there is no valid entry, or no post is kept."""
    name, url = F.col("name"), F.col("url")
    bodies = sum((F.col(f"bodies_{s}") for s in _PAGE), F.lit(0))
    is_feed = F.col("note").isNull()

    def row(note: Column, copies: Column, valid: Column | int = 0, kept: Column | int = 0) -> Column:
        return F.struct(note.cast(_NOTE_TYPE).alias("note"), _count(copies).alias("copies"), _count(valid).alias("valid"), _count(kept).alias("kept"))

    def warned(status: str) -> Column:
        words = MSG_FETCH_FAILED if status == "FETCH_FAILED" else MSG_PARSE_FAILED
        n = F.col(f"bodies_{status}")
        if status == "FETCH_FAILED":
            n = n + F.when(bodies == 0, F.col("listed")).otherwise(0)
        return row(_note("WARN", status, url, F.format_string(words, name, url)), F.when(is_feed, n).otherwise(0))

    refused = row(F.col("note"), F.when(~is_feed, F.col("listed")).otherwise(0))
    # The row without a note adds up the run; every ledger has it, an empty one by the row put in here.
    run = row(F.lit(None), F.lit(1), F.when(is_feed, F.col("listed")).otherwise(0), F.col("kept"))
    items = ledger.select(F.inline(F.filter(F.array(refused, *map(warned, _REPORTED), run), lambda x: x["copies"] > 0)))
    none = ledger.sparkSession.range(1).select(F.lit(None).cast(_NOTE_TYPE).alias("note"), *(_count(0).alias(c) for c in ("copies", "valid", "kept")))
    summed = items.union(none).groupBy("note").agg(*(F.sum(c).alias(c) for c in ("copies", "valid", "kept")))
    guards = F.array(
        F.when(F.col("valid") == 0, _note("ERROR", "NO_SUBSCRIPTIONS", F.lit(""), F.lit(MSG_NO_SUBSCRIPTIONS))),
        F.when(F.col("kept") == 0, _note("ERROR", "NO_POSTS", F.lit(""), F.lit(MSG_NO_POSTS))),
    ).cast(f"array<{_NOTE_TYPE}>")
    rows = F.when(F.col("note").isNull(), F.filter(guards, lambda g: g.isNotNull())).otherwise(F.array_repeat("note", F.col("copies").cast("int")))
    return summed.select(F.explode(rows).alias("note")).select("note.*")
