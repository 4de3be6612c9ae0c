"""onomata: count known names in large text collections, on Spark.

Public API (all functions take and return DataFrames):

    load_subscriptions(spark, path) -> (valid, diagnostics)
    load_dictionary(spark, dir, dedupe=False) -> (dictionary, diagnostics)
    attach_feeds(subscriptions, landed) -> attached
    parse_feeds(attached) -> parsed;  feed_posts(parsed);  feed_status(parsed)
    filter_posts(posts, mode="blank"|"empty")
    detect_entities(posts, dictionary, match="token"|"phrase") -> mentions
    count_entities(mentions) / entity_counts(posts, dictionary) / count_by_type(counts)
    rank_entities(counts, k=10)
    processing_stats(parsed, skipped) / post_length_stats(posts)
    entity_report / type_report / processing_report
"""

from .operators.aggregate import count_by_type, rank_entities
from .operators.detect import Detection, count_entities, detect_entities, entity_counts
from .operators.posts import filter_posts
from .operators.report import diagnostics, entity_report, processing_report, type_report
from .operators.stats import post_length_stats, processing_stats
from .sources.dictionary import dictionary_from_rows, load_dictionary, typed_dictionary
from .plans.analysis import Analysis, analyze, analyze_paths
from .sources.feeds import (
    attach_feeds,
    feed_posts,
    feed_status,
    parse_diagnostics,
    parse_feeds,
    read_landed_bodies,
    read_landed_pages,
)
from .sources.subscriptions import (
    classify_subscriptions,
    load_subscriptions,
    parse_subscription_records,
    read_subscriptions,
    subscription_diagnostics,
    valid_subscriptions,
)

__all__ = [
    "Analysis",
    "Detection",
    "analyze",
    "analyze_paths",
    "classify_subscriptions",
    "read_landed_bodies",
    "read_landed_pages",
    "read_subscriptions",
    "valid_subscriptions",
    "attach_feeds",
    "count_by_type",
    "count_entities",
    "detect_entities",
    "diagnostics",
    "dictionary_from_rows",
    "entity_counts",
    "entity_report",
    "feed_posts",
    "feed_status",
    "filter_posts",
    "load_dictionary",
    "load_subscriptions",
    "parse_diagnostics",
    "parse_feeds",
    "parse_subscription_records",
    "post_length_stats",
    "processing_report",
    "processing_stats",
    "rank_entities",
    "subscription_diagnostics",
    "type_report",
    "typed_dictionary",
]
