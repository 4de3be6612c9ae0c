"""Registered queries over the stored tables, each with an equivalent DuckDB SQL.

Every query reads whole tables (documents, conversations, pages, benchmark)
through Spark; the SQL text computes the same result independently and is
used as the oracle. Column names and types agree on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import scenario as S
from .constants import (
    DICTIONARY_FILES,
    ENTITY_TYPES,
    PARENT_TYPE,
    TOTAL_LABEL,
)
from .functions.text import describe
from .operators.aggregate import count_by_type, rank_entities, with_parent_type
from .operators.detect import Detection, count_entities, post_terms
from .operators.posts import filter_posts
from .operators.report import entity_report, processing_report, type_report
from .operators.stats import observe_posts, post_length_stats, processing_stats
from .plans.analysis import Analysis, analyze, analyze_paths
from .plans.strategy import landing_dir
from .sources.dictionary import dictionary_from_rows, load_dictionary, typed_dictionary
from .sources.feeds import attach_feeds, feed_posts, feed_status
from .sources.subscriptions import subscription_diagnostics, valid_subscriptions
from .sources.tables import posts_from_conversations, read_table

QueryFn = Callable[[SparkSession, str], DataFrame]

# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------


def _kept_posts(spark: SparkSession, sf_dir: str, mode: str = "blank") -> DataFrame:
    return filter_posts(S.documents_posts(spark, sf_dir), mode)


def _probe(spark: SparkSession) -> DataFrame:
    return dictionary_from_rows(spark, S.PROBE_DICTIONARY)


def _counts(spark: SparkSession, sf_dir: str, mode: str | None = "blank", strategy: str = "auto") -> DataFrame:
    posts = S.documents_posts(spark, sf_dir)
    if mode:
        posts = filter_posts(posts, mode)
    return Detection(_probe(spark), "token", strategy).counts(posts)


def q_subscriptions_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = S.classified_subscriptions(spark, S.documents_posts(spark, sf_dir))
    return valid_subscriptions(classified)


def q_subscriptions_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    classified = S.classified_subscriptions(spark, S.documents_posts(spark, sf_dir))
    return subscription_diagnostics(classified)


def q_feed_fetch_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = S.documents_posts(spark, sf_dir)
    valid = valid_subscriptions(S.classified_subscriptions(spark, posts))
    attached = attach_feeds(valid, S.faulty_pages(posts).select("url", "page", F.lit(None).cast("string").alias("body")))
    per_sub = attached.groupBy("name", "url").agg(F.count("page").alias("n_pages"))
    return per_sub.select(
        "name",
        "url",
        F.when(F.col("n_pages") > 0, F.lit("FETCHED")).otherwise(F.lit("FETCH_FAILED")).alias("fetch_status"),
        F.col("n_pages").cast("bigint").alias("n_pages"),
    )


def q_feed_parse_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, _ = S.parsed_feeds(spark, sf_dir, faulty=False, missing=False)
    return feed_posts(parsed).select(
        "feed", F.col("post_id").cast("bigint").alias("post_id"), "title", "selftext"
    )


def q_feed_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, classified = S.parsed_feeds(spark, sf_dir, faulty=True)
    return feed_status(parsed, classified.filter(F.col("sub_status") != "VALID"))


def q_posts_filter_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_posts(spark, sf_dir, "empty")


def q_posts_filter_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_posts(S.blanked_posts(S.documents_posts(spark, sf_dir)), "blank")


def q_avg_post_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_length_stats(S.documents_posts(spark, sf_dir), "blank")


def q_avg_post_chars_utf16(spark: SparkSession, sf_dir: str) -> DataFrame:
    return post_length_stats(S.documents_posts(spark, sf_dir), "blank", utf16=True)


def _document_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = S.document_dictionary_lines(read_table(spark, sf_dir, "documents"))
    return typed_dictionary(lines, "declared_type")


def q_dictionary_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _document_dictionary(spark, sf_dir)


def q_dictionary_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _document_dictionary(spark, sf_dir)
    bench_lines = read_table(spark, sf_dir, "benchmark").select(
        F.lit("Technology").alias("declared_type"), F.explode(F.split("text", "\n")).alias("value")
    )
    union = docs.unionByName(typed_dictionary(bench_lines, "declared_type"))
    return union.groupBy("entity_type").agg(
        F.count(F.lit(1)).alias("n_lines"), F.count_distinct("entity_name").alias("n_names")
    )


def q_post_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = post_terms(S.documents_posts(spark, sf_dir), (), "token")
    return terms.filter(F.col("term") != "").groupBy(F.col("term").alias("token")).agg(
        F.count(F.lit(1)).alias("n_posts")
    )


def q_entity_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_probe(spark)).mentions(_kept_posts(spark, sf_dir))


def q_entity_mentions_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_probe(spark), strategy="shuffle").mentions(_kept_posts(spark, sf_dir))


def q_entity_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir)


def q_entity_counts_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir, strategy="shuffle")


def q_entity_counts_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.createDataFrame([(t, n) for t, n in S.PROBE_DICTIONARY], "declared_type string, value string")
    dictionary = typed_dictionary(lines, "declared_type", dedupe=True)
    return Detection(dictionary).counts(_kept_posts(spark, sf_dir))


def q_entity_type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_type(_counts(spark, sf_dir))


def q_entity_top_10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entities(_counts(spark, sf_dir), 10)


def q_entity_top_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entities(_counts(spark, sf_dir), 2)


def q_entity_top_10_empty_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entities(_counts(spark, sf_dir, mode="empty"), 10)


def q_entity_top_10_unfiltered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entities(_counts(spark, sf_dir, mode=None), 10)


def q_processing_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed, classified = S.parsed_feeds(spark, sf_dir, faulty=True, missing=False)
    return processing_stats(parsed, classified, "blank")


def q_describe_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _counts(spark, sf_dir).select("entity_type", "entity_name", describe().alias("description"), "n")


def q_entity_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entity_report(rank_entities(_counts(spark, sf_dir), 10))


def q_type_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return type_report(count_by_type(_counts(spark, sf_dir)))


def q_processing_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return processing_report(q_processing_stats(spark, sf_dir))


def q_entity_phrase_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = dictionary_from_rows(spark, S.PHRASE_DICTIONARY)
    return Detection(dictionary, "phrase").counts(_kept_posts(spark, sf_dir))


def q_entity_phrase_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    dictionary = dictionary_from_rows(spark, S.PHRASE_DICTIONARY)
    return Detection(dictionary, "phrase").mentions(_kept_posts(spark, sf_dir))


def q_entity_top_10_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = filter_posts(posts_from_conversations(read_table(spark, sf_dir, "conversations")), "blank")
    return rank_entities(Detection(_probe(spark)).counts(posts), 10)


def q_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    posts = S.documents_posts(spark, sf_dir)
    classified = S.classified_subscriptions(spark, posts)
    return analyze(classified, S.faulty_pages(posts), _probe(spark)).diagnostics


def q_entity_counts_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select(
        "page_id", F.col("url").alias("title"), F.col("html").alias("selftext")
    )
    mentions = Detection(_probe(spark)).mentions(pages, ("page_id",))
    return count_entities(mentions)


def _vocabulary(spark: SparkSession, sf_dir: str, table: str, where: str | None = None) -> DataFrame:
    """A dictionary of all words of a table's texts, each with a type by its length."""
    rows = read_table(spark, sf_dir, table)
    words = (rows.where(where) if where else rows).select(F.explode(F.split("text", " ")).alias("entity_name"))
    return words.where("entity_name <> '' and not contains(entity_name, chr(10))").distinct().select(
        F.element_at(F.array(*map(F.lit, ENTITY_TYPES)), (F.length("entity_name") % 6 + 1).cast("int")).alias("entity_type"), "entity_name"
    )


def _phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary of the first two, three and twelve words of every benchmark text."""
    words = F.split(F.regexp_replace("text", "\n", " "), " ")
    names = read_table(spark, sf_dir, "benchmark").select(
        F.explode(F.array(*(F.array_join(F.slice(words, 1, n), " ") for n in (2, 3, 12)))).alias("entity_name")
    )
    return names.distinct().select(F.lit("Place").alias("entity_type"), "entity_name")


def q_entity_counts_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_vocabulary(spark, sf_dir, "benchmark")).counts(_kept_posts(spark, sf_dir))


def q_entity_top_25_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_entities(q_entity_counts_vocabulary(spark, sf_dir), 25)


def q_entity_mentions_vocabulary_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_vocabulary(spark, sf_dir, "benchmark"), strategy="shuffle").mentions(_kept_posts(spark, sf_dir))


def _conversation_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_posts(posts_from_conversations(read_table(spark, sf_dir, "conversations")), "blank")


def q_entity_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_vocabulary(spark, sf_dir, "documents", "lang = 'en'")).counts(_conversation_posts(spark, sf_dir))


def q_entity_counts_wide_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    detection = Detection(_vocabulary(spark, sf_dir, "documents", "lang = 'en'"), strategy="shuffle")
    return detection.counts(_conversation_posts(spark, sf_dir))


def q_entity_mentions_wide_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    detection = Detection(_vocabulary(spark, sf_dir, "documents", "lang = 'en'"), strategy="shuffle")
    return detection.mentions(_conversation_posts(spark, sf_dir), ("conv_id", "turn"))


def q_entity_phrase_counts_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_phrases(spark, sf_dir), "phrase").counts(_kept_posts(spark, sf_dir))


def q_entity_phrase_counts_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_phrases(spark, sf_dir), "phrase", "shuffle").counts(_kept_posts(spark, sf_dir))


def _wide_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dictionary with two phrases for every word of the documents: the least two and the least three words from one
    of its places on."""
    least = S.least_runs(read_table(spark, sf_dir, "documents"))
    # A phrase tells its first word, so no other word has it too.
    names = least.select(F.explode(F.array_distinct(F.array("two", "three"))).alias("entity_name"))
    return names.select(F.lit("Place").alias("entity_type"), "entity_name")


def q_entity_phrase_counts_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_wide_phrases(spark, sf_dir), "phrase", stage_keys=True).counts(_kept_posts(spark, sf_dir))


def q_entity_phrase_mentions_wide_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Detection(_wide_phrases(spark, sf_dir), "phrase", "shuffle", stage_keys=True).mentions(_kept_posts(spark, sf_dir))


def q_dictionary_from_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary read back from files, one per type, that the query lands first."""
    folder = landing_dir(spark)
    S.land_dictionary_files(read_table(spark, sf_dir, "documents"), folder)
    return load_dictionary(spark, folder)[0]


def _run_from_files(spark: SparkSession, sf_dir: str) -> Analysis:
    """A whole run from files that the query lands first: subscriptions, landed pages and dictionary files."""
    folder = landing_dir(spark)
    S.land_run(spark, S.documents_posts(spark, sf_dir), folder)
    return analyze_paths(spark, f"{folder}/subscriptions", f"{folder}/entities", f"{folder}/landed", subscription_lines=True)


def q_run_from_files_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_from_files(spark, sf_dir).stats


def q_run_from_files_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_from_files(spark, sf_dir).counts


def q_type_parents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_parent_type(q_entity_type_stats(spark, sf_dir))


def q_diagnostics_no_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's diagnostics where every landed post has an empty body, so the filter keeps none."""
    posts = S.documents_posts(spark, sf_dir).withColumn("selftext", F.lit(""))
    classified = S.classified_subscriptions(spark, posts)
    return analyze(classified, S.clean_pages(posts), _probe(spark)).diagnostics


def q_diagnostics_no_subscriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run's diagnostics where no subscription is valid."""
    posts = S.documents_posts(spark, sf_dir)
    classified = S.classified_subscriptions(spark, posts).where("sub_status <> 'VALID'")
    return analyze(classified, S.clean_pages(posts), _probe(spark)).diagnostics


def q_observed_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counters observed while the posts are written by another action."""
    observed, metrics = observe_posts(S.documents_posts(spark, sf_dir))
    observed.write.format("noop").mode("overwrite").save()
    row = metrics.get
    return spark.createDataFrame(
        [(row["posts"], row["posts_kept"], row["total_chars"])], "posts bigint, posts_kept bigint, total_chars bigint"
    )


QUERIES: dict[str, QueryFn] = {
    "entity_counts_vocabulary": q_entity_counts_vocabulary,
    "entity_top_25_vocabulary": q_entity_top_25_vocabulary,
    "entity_mentions_vocabulary_shuffle": q_entity_mentions_vocabulary_shuffle,
    "entity_counts_wide": q_entity_counts_wide,
    "entity_counts_wide_shuffle": q_entity_counts_wide_shuffle,
    "entity_mentions_wide_shuffle": q_entity_mentions_wide_shuffle,
    "entity_phrase_counts_vocabulary": q_entity_phrase_counts_vocabulary,
    "entity_phrase_counts_shuffle": q_entity_phrase_counts_shuffle,
    "entity_phrase_counts_wide": q_entity_phrase_counts_wide,
    "dictionary_from_files": q_dictionary_from_files,
    "run_from_files_stats": q_run_from_files_stats,
    "run_from_files_counts": q_run_from_files_counts,
    "entity_phrase_mentions_wide_shuffle": q_entity_phrase_mentions_wide_shuffle,
    "type_parents": q_type_parents,
    "diagnostics_no_posts": q_diagnostics_no_posts,
    "diagnostics_no_subscriptions": q_diagnostics_no_subscriptions,
    "observed_posts": q_observed_posts,
    "subscriptions_valid": q_subscriptions_valid,
    "subscriptions_skipped": q_subscriptions_skipped,
    "feed_fetch_status": q_feed_fetch_status,
    "feed_parse_posts": q_feed_parse_posts,
    "feed_status": q_feed_status,
    "posts_filter_empty": q_posts_filter_empty,
    "posts_filter_blank": q_posts_filter_blank,
    "avg_post_chars": q_avg_post_chars,
    "avg_post_chars_utf16": q_avg_post_chars_utf16,
    "dictionary_clean": q_dictionary_clean,
    "dictionary_union": q_dictionary_union,
    "post_tokens": q_post_tokens,
    "entity_mentions": q_entity_mentions,
    "entity_mentions_shuffle": q_entity_mentions_shuffle,
    "entity_counts": q_entity_counts,
    "entity_counts_shuffle": q_entity_counts_shuffle,
    "entity_counts_dedupe": q_entity_counts_dedupe,
    "entity_type_stats": q_entity_type_stats,
    "entity_top_10": q_entity_top_10,
    "entity_top_2": q_entity_top_2,
    "entity_top_10_unfiltered": q_entity_top_10_unfiltered,
    "entity_top_10_empty_filter": q_entity_top_10_empty_filter,
    "processing_stats": q_processing_stats,
    "describe_entities": q_describe_entities,
    "entity_report": q_entity_report,
    "type_report": q_type_report,
    "processing_report": q_processing_report,
    "entity_phrase_counts": q_entity_phrase_counts,
    "entity_phrase_mentions": q_entity_phrase_mentions,
    "entity_top_10_conversations": q_entity_top_10_conversations,
    "entity_counts_pages": q_entity_counts_pages,
    "diagnostics": q_diagnostics,
}

# --------------------------------------------------------------------------
# DuckDB oracle side
# --------------------------------------------------------------------------


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(_q(v) if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)


WS = r"'[ \t\n\x0B\f\r]+'"
PUNCT_EDGES = r"""'^[!"$%&''()*,\-./:;<=>?@\[\\\]^_`{|}~]+|[!"$%&''()*,\-./:;<=>?@\[\\\]^_`{|}~]+$'"""
JAVA_TRIM = r"'^[\x00-\x20]+|[\x00-\x20]+$'"
NOT_BLANK = r"'[^\x00-\x20]'"

POSTS = r"""posts AS (
  SELECT doc_id AS post_id, source AS feed,
         split_part(text, chr(10), 1) AS title,
         CASE WHEN instr(text, chr(10)) > 0 THEN substr(text, instr(text, chr(10)) + 1) ELSE '' END AS selftext
  FROM documents)"""

KEEP_EMPTY = "title <> '' AND selftext <> ''"
# characters outside the BMP take two UTF-16 units
_ASTRAL = (
    r"length(regexp_replace(title, '[^\x{10000}-\x{10FFFF}]', '', 'g'))"
    r" + length(regexp_replace(selftext, '[^\x{10000}-\x{10FFFF}]', '', 'g'))"
)
KEEP_BLANK = f"title <> '' AND selftext <> '' AND regexp_matches(selftext, {NOT_BLANK})"


def _dict_cte(rows: list[tuple[str, str]]) -> str:
    return f"dict(entity_type, entity_name) AS (VALUES {_values(rows)})"


def _token_terms(src: str, ids: str = "post_id") -> str:
    return (
        f"SELECT {ids}, unnest(list_distinct(regexp_split_to_array("
        f"lower(concat(title, ' ', selftext)), {WS}))) AS term FROM {src}"
    )


def _counts_sql(where: str | None = KEEP_BLANK) -> str:
    w = f" WHERE {where}" if where else ""
    return f"""WITH {POSTS},
kept AS (SELECT * FROM posts{w}),
{_dict_cte(S.PROBE_DICTIONARY)},
terms AS ({_token_terms('kept')}),
counts AS (
  SELECT entity_type, entity_name, count(*) AS n
  FROM terms JOIN dict ON term = lower(entity_name)
  GROUP BY entity_type, entity_name)"""


def _rank_sql(k: int, counts_with: str) -> str:
    return f"""{counts_with}
SELECT entity_type, entity_name, n,
       CAST(row_number() OVER (ORDER BY n DESC, entity_type, entity_name) AS INTEGER) AS rank
FROM counts ORDER BY n DESC, entity_type, entity_name LIMIT {k}"""


_TYPE_DIM = _values([(t, i + 1) for i, t in enumerate(ENTITY_TYPES)] + [(TOTAL_LABEL, 0)])


def _type_stats_sql() -> str:
    return f"""{_counts_sql()},
dim(entity_type, display_order) AS (VALUES {_TYPE_DIM}),
by_type AS (
  SELECT entity_type, sum(n) AS n FROM counts GROUP BY entity_type
  UNION ALL SELECT '{TOTAL_LABEL}', sum(n) FROM counts)
SELECT d.entity_type, CAST(coalesce(b.n, 0) AS BIGINT) AS n, CAST(d.display_order AS INTEGER) AS display_order
FROM dim d LEFT JOIN by_type b ON d.entity_type = b.entity_type"""


SUBS = f"""raw_subs AS (
  SELECT CAST(to_json({{'name': source, 'url': 'feeds/' || source}}) AS VARCHAR) AS value
  FROM (SELECT DISTINCT source FROM documents)
  UNION ALL SELECT value FROM (VALUES {_values([(r,) for r in S.EXTRA_SUBSCRIPTION_RECORDS])}) t(value)),
parsed_subs AS (
  SELECT CASE WHEN coalesce(json_valid(value), false) THEN value END AS value,
         coalesce(CASE WHEN json_valid(value) THEN json_type(CASE WHEN json_valid(value) THEN value END) = 'OBJECT' END, false)
           AS is_obj
  FROM raw_subs),
subs AS (
  SELECT CASE WHEN is_obj THEN json_extract_string(value, '$.name') END AS name,
         CASE WHEN is_obj THEN json_extract_string(value, '$.url') END AS url,
         is_obj
  FROM parsed_subs),
classified AS (
  SELECT name, url,
         CASE WHEN NOT is_obj THEN 'INVALID_JSON'
              WHEN coalesce(name, '') <> '' AND coalesce(url, '') <> '' THEN 'VALID'
              ELSE 'SKIPPED' END AS sub_status,
         CASE WHEN NOT is_obj THEN 'not a JSON object'
              WHEN name IS NULL THEN 'missing name'
              WHEN url IS NULL THEN 'missing url'
              WHEN name = '' THEN 'empty name'
              WHEN url = '' THEN 'empty url' END AS reason
  FROM subs),
valid AS (SELECT name, url FROM classified WHERE sub_status = 'VALID')"""

PAGES = f"""pg AS (
  SELECT feed, post_id // {S.PAGE_ROWS} AS page, count(*) AS n, bool_or(selftext = '') AS has_empty
  FROM posts WHERE feed <> '{S.FEED_NOT_LANDED}' GROUP BY feed, post_id // {S.PAGE_ROWS}),
st AS (
  SELECT feed, 'feeds/' || feed AS url, page, n,
         CASE WHEN feed = '{S.FEED_TRUNCATED}' THEN 'BAD_JSON'
              WHEN feed = '{S.FEED_NO_CHILDREN}' THEN 'NO_CHILDREN'
              WHEN feed = '{S.FEED_MISSING_SELFTEXT}' AND has_empty THEN 'MISSING_FIELD'
              WHEN feed = '{S.FEED_OBJECT_TITLE}' THEN 'BAD_FIELD'
              WHEN feed = '{S.FEED_EMPTY}' THEN 'EMPTY'
              ELSE 'OK' END AS status
  FROM pg)"""

# The expected texts are written out here, not taken from the code under test.
_SKIP_MSG = _q("Skipping malformed subscription (missing 'name' or 'url' field): ")
_INVALID_MSG = _q("Could not load subscriptions - invalid JSON format")
_SUB_DIAG = f"""SELECT CASE WHEN sub_status = 'INVALID_JSON' THEN 'ERROR' ELSE 'WARN' END AS severity,
       CASE WHEN sub_status = 'INVALID_JSON' THEN 'INVALID_JSON' ELSE 'SUBSCRIPTION_SKIPPED' END AS code,
       coalesce(name, url, '') AS subject,
       CASE WHEN sub_status = 'INVALID_JSON' THEN {_INVALID_MSG} ELSE {_SKIP_MSG} || reason END AS message
FROM classified WHERE sub_status <> 'VALID'"""

_STATS_SQL = f"""WITH {POSTS}, {SUBS}, {PAGES},
okp AS (SELECT p.* FROM posts p JOIN st ON p.feed = st.feed AND p.post_id // {S.PAGE_ROWS} = st.page
        WHERE st.status = 'OK'),
failed AS (SELECT v.url FROM valid v WHERE v.url NOT IN (SELECT url FROM st)),
a AS (
  SELECT (SELECT count(*) FROM classified WHERE sub_status <> 'VALID') AS subscriptions_skipped,
         (SELECT count(*) FROM valid v WHERE v.url IN (SELECT url FROM st)) AS feeds_ok,
         (SELECT count(*) FROM failed) AS feeds_failed,
         (SELECT count(*) FROM okp) AS posts_ok,
         (SELECT count(*) FROM valid v WHERE v.url NOT IN (SELECT url FROM st WHERE status = 'OK')) AS feeds_without_posts,
         (SELECT count(*) FROM okp WHERE {KEEP_BLANK}) AS posts_kept,
         (SELECT coalesce(sum(length(title) + length(selftext)), 0) FROM okp WHERE {KEEP_BLANK}) AS total_chars)
SELECT CAST(subscriptions_skipped AS BIGINT) AS subscriptions_skipped,
       CAST(feeds_ok AS BIGINT) AS feeds_ok,
       CAST(feeds_failed AS BIGINT) AS feeds_failed,
       CAST(posts_ok AS BIGINT) AS posts_ok,
       CAST(feeds_without_posts AS BIGINT) AS feeds_without_posts,
       CAST(posts_ok - posts_kept AS BIGINT) AS posts_filtered,
       CAST(posts_kept AS BIGINT) AS posts_kept,
       CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END AS avg_chars,
       CAST(trunc(CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END) AS BIGINT)
         AS avg_chars_int
FROM a"""

_DOC_DICT = f"""raw_lines AS (
  SELECT lang, unnest(string_split(
           CASE WHEN lang = 'es' THEN replace(text, chr(10), chr(10) || ' ' || chr(9) || chr(10)) ELSE text END,
           chr(10))) AS line
  FROM documents),
decorated AS (
  SELECT CASE WHEN lang = 'en' THEN 'Person' WHEN lang = 'fr' THEN 'Place'
              WHEN lang = 'de' THEN 'University' ELSE 'Spanish' END AS declared_type,
         CASE WHEN lang = 'de' THEN '# ' || line
              WHEN lang = 'fr' THEN chr(9) || ' ' || line || ' ' || chr(9)
              ELSE line END AS value
  FROM raw_lines),
docdict AS (
  SELECT CASE WHEN declared_type IN ({', '.join(_q(t) for t in ENTITY_TYPES)}) THEN declared_type ELSE 'Person' END
           AS entity_type,
         regexp_replace(value, {JAVA_TRIM}, '', 'g') AS entity_name
  FROM decorated)"""

_DOC_DICT_CLEAN = "SELECT entity_type, entity_name FROM docdict WHERE entity_name <> '' AND NOT starts_with(entity_name, '#')"


def _phrase_words(expr: str) -> str:
    return (
        f"list_filter(list_transform(regexp_split_to_array(lower({expr}), {WS}), "
        f"lambda w: regexp_replace(w, {PUNCT_EDGES}, '', 'g')), lambda w: w <> '')"
    )


def _phrase_sql(per_post: bool = False) -> str:
    max_words = max(len(n.split()) for _, n in S.PHRASE_DICTIONARY)
    grams = ", ".join(
        f"list_transform(range(1, len(words) - {n - 1} + 1), lambda i: array_to_string(words[i:i + {n - 1}], ' '))"
        for n in range(1, max_words + 1)
    )
    return f"""WITH {POSTS},
kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}),
{_dict_cte(S.PHRASE_DICTIONARY)},
keyed AS (SELECT entity_type, entity_name, array_to_string({_phrase_words('entity_name')}, ' ') AS match_key FROM dict),
w AS (SELECT post_id, {_phrase_words("concat(title, ' ', selftext)")} AS words FROM kept),
terms AS (SELECT post_id, unnest(list_distinct(flatten([{grams}]))) AS term FROM w),
matched AS (SELECT post_id, entity_type, entity_name FROM terms JOIN keyed ON term = match_key WHERE match_key <> '')
""" + ("SELECT post_id, entity_type, entity_name FROM matched" if per_post else
       "SELECT entity_type, entity_name, count(*) AS n FROM matched GROUP BY entity_type, entity_name")


def _processing_report_sql() -> str:
    from . import constants as C

    rows = [
        (2, C.LABEL_FEEDS_OK, "feeds_ok"),
        (3, C.LABEL_FEEDS_FAILED, "feeds_failed"),
        (4, C.LABEL_POSTS_OK, "posts_ok"),
        (5, C.LABEL_POSTS_FAILED, "feeds_without_posts"),
        (6, C.LABEL_POSTS_FILTERED, "posts_filtered"),
        (7, C.LABEL_AVG_CHARS, "avg_chars_int"),
    ]
    body = "\nUNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS line_no, {_q(label + ': ')} || CAST({c} AS VARCHAR) AS line FROM stats"
        for i, label, c in rows
    )
    return f"""WITH stats AS ({_STATS_SQL})
SELECT CAST(1 AS INTEGER) AS line_no, {_q(C.BANNER_PROCESSING)} AS line
UNION ALL {body}"""


def _type_report_sql() -> str:
    from . import constants as C

    return f"""WITH ts AS ({_type_stats_sql()})
SELECT CAST(1 AS INTEGER) AS line_no, {_q(C.BANNER_TYPES)} AS line
UNION ALL SELECT CAST(3 AS INTEGER), {_q(C.LABEL_BY_CATEGORY)}
UNION ALL SELECT CAST(2 AS INTEGER), {_q(C.LABEL_TOTAL_ENTITIES + ': ')} || CAST(n AS VARCHAR) FROM ts
  WHERE entity_type = '{TOTAL_LABEL}'
UNION ALL SELECT CAST(display_order + 3 AS INTEGER), '    [' || entity_type || ']: ' || CAST(n AS VARCHAR) FROM ts
  WHERE entity_type <> '{TOTAL_LABEL}'"""


def _entity_report_sql() -> str:
    from . import constants as C

    return f"""WITH r AS ({_rank_sql(10, _counts_sql())})
SELECT CAST(1 AS INTEGER) AS line_no, {_q(C.BANNER_ENTITIES)} AS line
UNION ALL SELECT CAST(rank + 1 AS INTEGER), '[Type=' || entity_type || '] ' || entity_name || ': '
  || CAST(n AS VARCHAR) || ' apariciones' FROM r"""


_TYPE_CASE = "CASE length(w) % 6 " + " ".join(f"WHEN {i} THEN {_q(t)}" for i, t in enumerate(ENTITY_TYPES)) + " END"


def _vocabulary_cte(table: str, where: str = "") -> str:
    return f"""dict AS (SELECT DISTINCT {_TYPE_CASE} AS entity_type, w AS entity_name
  FROM (SELECT unnest(string_split(text, ' ')) AS w FROM {table}{where}) WHERE w <> '' AND instr(w, chr(10)) = 0)"""


_CONV_KEPT = f"""kept AS (SELECT conv_id, turn, role AS title, text AS selftext FROM conversations
  WHERE role <> '' AND text <> '' AND regexp_matches(text, {NOT_BLANK}))"""
_COUNTED = """counts AS (SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN dict ON term = lower(entity_name)
  GROUP BY entity_type, entity_name)"""


def _vocabulary_sql() -> str:
    return f"""WITH {POSTS}, kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}), {_vocabulary_cte('benchmark')},
terms AS ({_token_terms('kept')}), {_COUNTED}"""


def _wide_sql() -> str:
    return f"""WITH {_CONV_KEPT}, {_vocabulary_cte('documents', " WHERE lang = 'en'")},
terms AS ({_token_terms('kept', 'conv_id, turn')}), {_COUNTED}"""


def _benchmark_phrase_sql() -> str:
    grams = ", ".join(
        f"list_transform(range(1, len(words) - {n - 1} + 1), lambda i: array_to_string(words[i:i + {n - 1}], ' '))" for n in range(1, 13)
    )
    starts = " UNION ALL ".join(
        f"SELECT array_to_string(list_slice(string_split(replace(text, chr(10), ' '), ' '), 1, {n}), ' ') AS entity_name FROM benchmark" for n in (2, 3, 12)
    )
    return f"""WITH {POSTS}, kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}),
dict AS (SELECT DISTINCT 'Place' AS entity_type, entity_name FROM ({starts})),
keyed AS (SELECT entity_type, entity_name, array_to_string({_phrase_words('entity_name')}, ' ') AS match_key FROM dict),
w AS (SELECT post_id, {_phrase_words("concat(title, ' ', selftext)")} AS words FROM kept),
terms AS (SELECT post_id, unnest(list_distinct(flatten([{grams}]))) AS term FROM w)
SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN keyed ON term = match_key WHERE match_key <> ''
GROUP BY entity_type, entity_name"""


def _run_counts_sql() -> str:
    filed = {t for _, t in DICTIONARY_FILES}
    return f"""WITH {POSTS}, {SUBS}, {PAGES},
kept AS (SELECT p.* FROM posts p JOIN st ON p.feed = st.feed AND p.post_id // {S.PAGE_ROWS} = st.page
         WHERE st.status = 'OK' AND {KEEP_BLANK}),
{_dict_cte([(t, n) for t, n in S.PROBE_DICTIONARY if t in filed])},
terms AS ({_token_terms('kept')})
SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN dict ON term = lower(entity_name) GROUP BY entity_type, entity_name"""


def _wide_phrase_sql(per_post: bool = False) -> str:
    grams = ", ".join(
        f"list_transform(range(1, len(words) - {n - 1} + 1), lambda i: array_to_string(words[i:i + {n - 1}], ' '))" for n in (1, 2, 3)
    )
    return f"""WITH {POSTS}, kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}),
split AS (SELECT string_split(replace(text, chr(10), ' '), ' ') AS words FROM documents),
places AS (SELECT words, unnest(range(1, len(words) + 1)) AS i FROM split),
least AS (SELECT min(array_to_string(words[i:i + 1], ' ')) AS two, min(array_to_string(words[i:i + 2], ' ')) AS three FROM places WHERE words[i] <> '' GROUP BY words[i]),
dict AS (SELECT DISTINCT 'Place' AS entity_type, unnest([two, three]) AS entity_name FROM least),
keyed AS (SELECT entity_type, entity_name, array_to_string({_phrase_words('entity_name')}, ' ') AS match_key FROM dict),
w AS (SELECT post_id, {_phrase_words("concat(title, ' ', selftext)")} AS words FROM kept),
terms AS (SELECT post_id, unnest(list_distinct(flatten([{grams}]))) AS term FROM w),
matched AS (SELECT post_id, entity_type, entity_name FROM terms JOIN keyed ON term = match_key WHERE match_key <> '')
""" + ("SELECT post_id, entity_type, entity_name FROM matched" if per_post else
       "SELECT entity_type, entity_name, count(*) AS n FROM matched GROUP BY entity_type, entity_name")


_PARENTS = _values([(t, p) for t, p in PARENT_TYPE.items() if p])


def oracle_sql() -> dict[str, str]:
    counts = _counts_sql()
    vocabulary, wide = _vocabulary_sql(), _wide_sql()
    mentions = f"""WITH {POSTS},
kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}),
{_dict_cte(S.PROBE_DICTIONARY)},
terms AS ({_token_terms('kept')})
SELECT post_id, entity_type, entity_name FROM terms JOIN dict ON term = lower(entity_name)"""
    conv_counts = f"""WITH conv AS (SELECT conv_id, turn, role AS title, text AS selftext FROM conversations),
kept AS (SELECT * FROM conv WHERE {KEEP_BLANK}),
{_dict_cte(S.PROBE_DICTIONARY)},
terms AS ({_token_terms('kept', 'conv_id, turn')}),
counts AS (SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN dict ON term = lower(entity_name)
           GROUP BY entity_type, entity_name)"""
    return {
        "entity_counts_vocabulary": f"{vocabulary} SELECT entity_type, entity_name, n FROM counts",
        "entity_top_25_vocabulary": _rank_sql(25, vocabulary),
        "entity_mentions_vocabulary_shuffle": f"{vocabulary} SELECT post_id, entity_type, entity_name FROM terms JOIN dict ON term = lower(entity_name)",
        "entity_counts_wide": f"{wide} SELECT entity_type, entity_name, n FROM counts",
        "entity_counts_wide_shuffle": f"{wide} SELECT entity_type, entity_name, n FROM counts",
        "entity_mentions_wide_shuffle": f"{wide} SELECT conv_id, turn, entity_type, entity_name FROM terms JOIN dict ON term = lower(entity_name)",
        "entity_phrase_counts_vocabulary": _benchmark_phrase_sql(),
        "entity_phrase_counts_shuffle": _benchmark_phrase_sql(),
        "entity_phrase_counts_wide": _wide_phrase_sql(),
        "dictionary_from_files": f"WITH {_DOC_DICT} {_DOC_DICT_CLEAN}",
        "run_from_files_stats": _STATS_SQL,
        "run_from_files_counts": _run_counts_sql(),
        "entity_phrase_mentions_wide_shuffle": _wide_phrase_sql(per_post=True),
        "type_parents": f"""SELECT ts.*, p.parent_type FROM ({_type_stats_sql()}) ts
LEFT JOIN (VALUES {_PARENTS}) p(entity_type, parent_type) ON ts.entity_type = p.entity_type""",
        "diagnostics_no_posts": f"""WITH {POSTS}, {SUBS}
{_SUB_DIAG}
UNION ALL SELECT 'WARN', 'FETCH_FAILED', url, 'Failed to download from ''' || name || ''' (' || url || ')'
FROM valid WHERE name NOT IN (SELECT source FROM documents)
UNION ALL SELECT 'ERROR', 'NO_POSTS', '', 'No valid posts downloaded after filtering'""",
        "diagnostics_no_subscriptions": f"""WITH {POSTS}, {SUBS}
{_SUB_DIAG}
UNION ALL SELECT 'ERROR', 'NO_SUBSCRIPTIONS', '', 'No valid subscriptions found'
UNION ALL SELECT 'ERROR', 'NO_POSTS', '', 'No valid posts downloaded after filtering'""",
        "observed_posts": f"""WITH {POSTS} SELECT count(*) AS posts, count(*) FILTER (WHERE {KEEP_BLANK}) AS posts_kept,
       CAST(coalesce(sum(length(title) + length(selftext)) FILTER (WHERE {KEEP_BLANK}), 0) AS BIGINT) AS total_chars FROM posts""",
        "subscriptions_valid": f"WITH {POSTS}, {SUBS} SELECT name, url FROM valid",
        "diagnostics": f"""WITH {POSTS}, {SUBS}, {PAGES}
{_SUB_DIAG}
UNION ALL SELECT 'WARN', st.status, v.url, 'Failed to parse posts from ''' || v.name || ''' (' || v.url || ')'
FROM valid v JOIN st ON v.url = st.url WHERE st.status NOT IN ('OK', 'EMPTY')
UNION ALL SELECT 'WARN', 'FETCH_FAILED', url, 'Failed to download from ''' || name || ''' (' || url || ')'
FROM valid WHERE url NOT IN (SELECT url FROM st)""",
        "subscriptions_skipped": f"""WITH {POSTS}, {SUBS}
SELECT CASE WHEN sub_status = 'INVALID_JSON' THEN 'ERROR' ELSE 'WARN' END AS severity,
       CASE WHEN sub_status = 'INVALID_JSON' THEN 'INVALID_JSON' ELSE 'SUBSCRIPTION_SKIPPED' END AS code,
       coalesce(name, url, '') AS subject,
       CASE WHEN sub_status = 'INVALID_JSON' THEN {_INVALID_MSG} ELSE {_SKIP_MSG} || reason END AS message
FROM classified WHERE sub_status <> 'VALID'""",
        "feed_fetch_status": f"""WITH {POSTS}, {SUBS}, {PAGES}
SELECT v.name, v.url,
       CASE WHEN count(st.page) > 0 THEN 'FETCHED' ELSE 'FETCH_FAILED' END AS fetch_status,
       CAST(count(st.page) AS BIGINT) AS n_pages
FROM valid v LEFT JOIN st ON v.url = st.url GROUP BY v.name, v.url""",
        "feed_parse_posts": f"WITH {POSTS} SELECT feed, post_id, title, selftext FROM posts",
        "feed_status": f"""WITH {POSTS}, {SUBS}, {PAGES}
SELECT v.name, v.url, st.page, st.status,
       CAST(CASE WHEN st.status = 'OK' THEN st.n ELSE 0 END AS BIGINT) AS n_posts
FROM valid v JOIN st ON v.url = st.url
UNION ALL SELECT name, url, CAST(NULL AS BIGINT), 'FETCH_FAILED', CAST(0 AS BIGINT)
FROM valid WHERE url NOT IN (SELECT url FROM st)
UNION ALL SELECT name, url, CAST(NULL AS BIGINT), 'SKIPPED', CAST(0 AS BIGINT)
FROM classified WHERE sub_status <> 'VALID'""",
        "posts_filter_empty": f"WITH {POSTS} SELECT post_id, feed, title, selftext FROM posts WHERE {KEEP_EMPTY}",
        "posts_filter_blank": f"""WITH {POSTS},
bp AS (SELECT post_id, feed, title,
              CASE WHEN feed = '{S.FEED_BLANKED}' THEN regexp_replace(selftext, {NOT_BLANK}, '', 'g')
                   ELSE selftext END AS selftext
       FROM posts)
SELECT post_id, feed, title, selftext FROM bp WHERE {KEEP_BLANK}""",
        "avg_post_chars": f"""WITH {POSTS},
a AS (SELECT count(*) AS posts, count(*) FILTER (WHERE {KEEP_BLANK}) AS posts_kept,
             coalesce(sum(length(title) + length(selftext)) FILTER (WHERE {KEEP_BLANK}), 0) AS total_chars
      FROM posts)
SELECT CAST(posts AS BIGINT) AS posts, CAST(posts_kept AS BIGINT) AS posts_kept,
       CAST(total_chars AS BIGINT) AS total_chars,
       CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END AS avg_chars,
       CAST(trunc(CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END) AS BIGINT)
         AS avg_chars_int
FROM a""",
        "avg_post_chars_utf16": f"""WITH {POSTS},
a AS (SELECT count(*) AS posts, count(*) FILTER (WHERE {KEEP_BLANK}) AS posts_kept,
             coalesce(sum(length(title) + length(selftext) + {_ASTRAL}) FILTER (WHERE {KEEP_BLANK}), 0) AS total_chars
      FROM posts)
SELECT CAST(posts AS BIGINT) AS posts, CAST(posts_kept AS BIGINT) AS posts_kept,
       CAST(total_chars AS BIGINT) AS total_chars,
       CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END AS avg_chars,
       CAST(trunc(CASE WHEN posts_kept > 0 THEN CAST(total_chars AS DOUBLE) / posts_kept ELSE 0.0 END) AS BIGINT)
         AS avg_chars_int
FROM a""",
        "dictionary_clean": f"WITH {_DOC_DICT} {_DOC_DICT_CLEAN}",
        "dictionary_union": f"""WITH {_DOC_DICT},
bench AS (
  SELECT 'Technology' AS entity_type,
         regexp_replace(unnest(string_split(text, chr(10))), {JAVA_TRIM}, '', 'g') AS entity_name
  FROM benchmark),
u AS ({_DOC_DICT_CLEAN}
      UNION ALL SELECT entity_type, entity_name FROM bench
      WHERE entity_name <> '' AND NOT starts_with(entity_name, '#'))
SELECT entity_type, count(*) AS n_lines, count(DISTINCT entity_name) AS n_names FROM u GROUP BY entity_type""",
        "post_tokens": f"""WITH {POSTS}, terms AS ({_token_terms('posts')})
SELECT term AS token, count(*) AS n_posts FROM terms WHERE term <> '' GROUP BY term""",
        "entity_mentions": mentions,
        "entity_mentions_shuffle": mentions,
        "entity_counts": f"{counts} SELECT entity_type, entity_name, n FROM counts",
        "entity_counts_shuffle": f"{counts} SELECT entity_type, entity_name, n FROM counts",
        "entity_counts_dedupe": f"""WITH {POSTS},
kept AS (SELECT * FROM posts WHERE {KEEP_BLANK}),
{_dict_cte(S.PROBE_DICTIONARY)},
ddict AS (SELECT DISTINCT entity_type, entity_name FROM dict),
terms AS ({_token_terms('kept')})
SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN ddict ON term = lower(entity_name)
GROUP BY entity_type, entity_name""",
        "entity_type_stats": _type_stats_sql(),
        "entity_top_10": _rank_sql(10, counts),
        "entity_top_2": _rank_sql(2, counts),
        "entity_top_10_unfiltered": _rank_sql(10, _counts_sql(None)),
        "entity_top_10_empty_filter": _rank_sql(10, _counts_sql(KEEP_EMPTY)),
        "processing_stats": _STATS_SQL,
        "describe_entities": f"""{counts}
SELECT entity_type, entity_name, '[' || entity_type || '] ' || entity_name AS description, n FROM counts""",
        "entity_report": _entity_report_sql(),
        "type_report": _type_report_sql(),
        "processing_report": _processing_report_sql(),
        "entity_phrase_counts": _phrase_sql(),
        "entity_phrase_mentions": _phrase_sql(per_post=True),
        "entity_top_10_conversations": _rank_sql(10, conv_counts),
        "entity_counts_pages": f"""WITH pg AS (SELECT page_id, url AS title, html AS selftext FROM pages),
{_dict_cte(S.PROBE_DICTIONARY)},
terms AS ({_token_terms('pg', 'page_id')})
SELECT entity_type, entity_name, count(*) AS n FROM terms JOIN dict ON term = lower(entity_name)
GROUP BY entity_type, entity_name""",
    }


def queries() -> dict[str, QueryFn]:
    return dict(QUERIES)
