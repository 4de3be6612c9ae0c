"""End-to-end analysis: subscriptions + landed feeds + dictionaries -> reports.

Each output is its own DataFrame; the caller decides what to run or write.
Decoded posts are never cached: at scale they are the size of the input.
Warnings, guards and statistics come from the run's ledger, one row per feed
(``operators/ledger.py``): each of these outputs decodes the bodies once.
Detection is a pass of its own. ``stage_parsed`` decodes once for all, into a
table of the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..constants import DEFAULT_TOP_K, MSG_FILE_NOT_FOUND
from ..operators.aggregate import count_by_type, rank_entities
from ..operators.detect import Detection
from ..operators.ledger import feed_ledger, ledger_diagnostics, ledger_stats
from ..operators.posts import filter_posts
from ..operators.report import diagnostics, entity_report, processing_report, type_report
from .strategy import remove_table, stage_table
from ..sources.diagnostics import diagnostics_frame
from ..sources.dictionary import load_dictionary, path_exists
from ..sources.feeds import (
    LANDED_SCHEMA,
    feed_posts,
    fetched_feeds,
    missing_feeds,
    parse_feeds,
    read_landed_pages,
)
from ..sources.subscriptions import (
    SUBSCRIPTION_SCHEMA,
    classify_subscriptions,
    read_subscriptions,
    valid_subscriptions,
)


@dataclass
class Analysis:
    valid_subscriptions: DataFrame
    parsed: DataFrame
    posts: DataFrame
    counts: DataFrame
    ranking: DataFrame
    type_stats: DataFrame
    stats: DataFrame
    entity_report: DataFrame
    type_report: DataFrame
    processing_report: DataFrame
    diagnostics: DataFrame
    staged: str | None = None

    OUTPUTS = ("counts", "ranking", "type_stats", "stats", "entity_report", "type_report", "processing_report",
               "diagnostics")

    def write(self, path: str, mode: str = "overwrite") -> None:
        """Write every result as parquet under ``path/<name>``; each is small except the counts.

        The per-name counts are held while the results are written, so the
        ranking and type statistics do not rescan the posts.
        """
        self.counts.cache()
        try:
            for name in self.OUTPUTS:
                getattr(self, name).write.mode(mode).parquet(f"{path.rstrip('/')}/{name}")
        finally:
            self.counts.unpersist()

    def release(self) -> None:
        """Drop what the run holds once every output has been used: cached counts and the staged table."""
        self.counts.unpersist()
        if self.staged:
            remove_table(self.counts.sparkSession, self.staged)
            self.staged = None


def analyze(
    classified_subscriptions: DataFrame,
    landed: DataFrame,
    dictionary: DataFrame,
    k: int = DEFAULT_TOP_K,
    mode: str = "blank",
    match: str = "token",
    strategy: str = "auto",
    dictionary_diagnostics: DataFrame | None = None,
    stage_parsed: bool = False,
) -> Analysis:
    """Wire the operators the way a full run uses them.

    ``classified_subscriptions`` comes from ``classify_subscriptions`` (or the
    file reader); ``landed`` is ``(url, page, body)``.

    ``stage_parsed=True`` decodes the landed JSON once and writes the decoded
    pages as a parquet table under ``spark.checkpoint.dir``; detection, the
    statistics and the diagnostics then read that table, until ``release``.
    """
    valid = valid_subscriptions(classified_subscriptions)
    fetched, staged = parse_feeds(fetched_feeds(valid, landed)), None
    if stage_parsed:
        fetched, staged = stage_table(fetched, "parsed-feeds")
    # Feeds with nothing landed have no posts; the ledger tells them without looking for them.
    parsed = fetched.unionByName(parse_feeds(missing_feeds(valid, landed)))
    posts = filter_posts(feed_posts(fetched), mode)
    counts = Detection(dictionary, match, strategy).counts(posts)
    ranking = rank_entities(counts, k)
    type_stats = count_by_type(counts)
    ledger = feed_ledger(fetched, classified_subscriptions, mode)
    stats = ledger_stats(ledger)
    parts = [ledger_diagnostics(ledger)]
    if dictionary_diagnostics is not None:
        parts.append(dictionary_diagnostics)
    return Analysis(
        valid_subscriptions=valid,
        parsed=parsed,
        posts=posts,
        counts=counts,
        ranking=ranking,
        type_stats=type_stats,
        stats=stats,
        entity_report=entity_report(ranking),
        type_report=type_report(type_stats),
        processing_report=processing_report(stats),
        diagnostics=diagnostics(*parts),
        staged=staged,
    )


def _present(spark, paths: str | list[str]) -> tuple[list[str], list[str]]:
    """Paths and globs that match something, and those that match nothing."""
    wanted = [paths] if isinstance(paths, str) else list(paths)
    there = [p for p in wanted if path_exists(spark, p)]
    return there, [p for p in wanted if p not in there]


def analyze_paths(
    spark,
    subscription_file: str | list[str],
    entities_dir: str,
    landed: str | list[str] | DataFrame,
    k: int = DEFAULT_TOP_K,
    mode: str = "blank",
    match: str = "token",
    dedupe: bool = False,
    strategy: str = "auto",
    stage_parsed: bool = False,
    subscription_lines: bool = False,
) -> Analysis:
    """The same run from paths: subscription JSON files (an array per file, or an entry per line), a dictionary directory
    and landed pages (JSON lines, or a DataFrame ``(url, page, body)``). Files may
    be paths, globs, directories or lists of them.

    A subscription or landed path that matches nothing gives an ERROR row (the
    others are still used); a missing dictionary directory raises
    ``ValueError``; a missing dictionary file gives a WARN row.
    """
    dictionary, dict_diag = load_dictionary(spark, entities_dir, dedupe=dedupe)
    files, lost = _present(spark, subscription_file)
    errors = [("ERROR", "SUBSCRIPTIONS_NOT_FOUND", p, MSG_FILE_NOT_FOUND % p) for p in lost]
    raw = read_subscriptions(spark, files, multiline=not subscription_lines) if files else spark.createDataFrame([], SUBSCRIPTION_SCHEMA)
    pages = landed
    if not isinstance(landed, DataFrame):
        files, lost = _present(spark, landed)
        errors += [("ERROR", "LANDED_NOT_FOUND", p, MSG_FILE_NOT_FOUND % p) for p in lost]
        pages = read_landed_pages(spark, files) if files else spark.createDataFrame([], LANDED_SCHEMA)
    result = analyze(
        classify_subscriptions(raw), pages, dictionary, k, mode, match, strategy,
        dictionary_diagnostics=dict_diag, stage_parsed=stage_parsed,
    )
    if errors:
        result.diagnostics = diagnostics(result.diagnostics, diagnostics_frame(spark, errors))
    return result
