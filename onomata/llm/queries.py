"""Registered queries of the operators, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import conversation_report, with_probe
from .common import table
from .decontam import contamination_report
from .divergence import source_divergence
from .jaccard import near_duplicates
from .langid import language_report
from .lines import line_report
from .mixing import mixing_report
from .neighbours import classifier_report
from .oddsketch import near_components
from .pii import personal_data_report
from .quality import quality_rules
from .sharding import sharding_report
from .variants import spelling_variants


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing_report(table(spark, sf_dir, "documents"))


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding_report(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = line_report(table(spark, sf_dir, "documents"))
    return report.withColumn("dropped", F.array_join(F.col("dropped").cast("array<string>"), ","))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_report(with_probe(table(spark, sf_dir, "conversations")))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_report(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op12_odd_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


#: One statement over the tables of the given names, registered as views.
OP5_SQL = r"""
WITH w AS (
  SELECT 'd' AS kind, doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
  UNION ALL
  SELECT 'b', item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark
), items AS (
  SELECT id, words, least(10, len(words)) AS n, row_number() OVER () AS row FROM w WHERE kind = 'b' AND len(words) > 0
), win AS (
  SELECT id AS item_id, row, i, n, list_slice(words, i, i + n - 1) AS win FROM (SELECT id, row, words, n, unnest(generate_series(1, len(words) - n + 1)) AS i FROM items)
), sizes AS (SELECT DISTINCT n FROM win),
pos AS (
  SELECT d.id AS doc_id, s.n, unnest(generate_series(1, len(d.words) - s.n + 1)) AS i, d.words FROM w d, sizes s WHERE d.kind = 'd' AND len(d.words) >= s.n
), hits AS (
  SELECT a.doc_id, a.i, a.n, win.item_id, win.row, a.i - win.i AS diagonal FROM (SELECT doc_id, i, n, list_slice(words, i, i + n - 1) AS win FROM pos) a JOIN win ON a.n = win.n AND a.win = win.win
), places AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
), stretches AS (
  SELECT doc_id, CAST(item_id AS VARCHAR) AS item, count(*) + any_value(n) - 1 AS words, min(i) - 1 AS first
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, row, diagonal ORDER BY i) AS part FROM hits) GROUP BY doc_id, row, item_id, diagonal, part
), longest AS (
  SELECT doc_id, words, first, item FROM stretches QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY words DESC, first, item) = 1
)
SELECT w.id AS doc_id, CAST(coalesce(len(w.words), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
       CAST(coalesce(longest.words, 0) AS BIGINT) AS longest_match, CAST(longest.first AS BIGINT) AS longest_at, longest.item AS longest_item
FROM w LEFT JOIN places ON places.doc_id = w.id LEFT JOIN found ON found.doc_id = w.id LEFT JOIN longest ON longest.doc_id = w.id WHERE w.kind = 'd'
"""


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         md5(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR), ''), coalesce(CAST(length(source) AS VARCHAR), ''), coalesce(source, ''), coalesce('=' || text, ''))) AS key FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) AS rank FROM d GROUP BY source
), w AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s
), l AS (
  SELECT *, row_number() OVER o AS place,
         (CAST(sum(source_size) OVER () AS DOUBLE) * CAST(1.5 AS DOUBLE) - CAST(coalesce(sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE))
         / CAST(sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
  FROM w WINDOW o AS (ORDER BY CAST(2 * source_size AS DOUBLE) / weight, rank)
), f AS (
  SELECT level FROM l WHERE level <= CAST(2 * source_size AS DOUBLE) / weight ORDER BY place LIMIT 1
), t AS (
  SELECT l.source, source_size, rank, least(CAST(2 * source_size AS DOUBLE), weight * f.level) AS target FROM l, f
), timed AS (
  SELECT d.doc_id, d.size, d.key, t.source_size, t.rank, t.target,
         CAST(sum(size) OVER (PARTITION BY d.source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS done
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), copies AS (
  SELECT *, CAST(done + copy * source_size AS DOUBLE) / target AS time FROM timed, (SELECT unnest([0, 1]) AS copy) WHERE size > 0 AND target > 0
), ended AS (
  SELECT *, sum(size) OVER (ORDER BY time, rank, key, copy RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ends FROM copies
), taken AS (
  SELECT key, count(DISTINCT copy) AS n FROM ended WHERE ends <= (SELECT CAST(sum(size) AS DOUBLE) * CAST(1.5 AS DOUBLE) FROM d) GROUP BY key
)
SELECT doc_id, size, source_size, target, CAST(coalesce(n, 0) * size AS BIGINT) AS taken FROM timed LEFT JOIN taken USING (key)
"""


OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce('=' || text, '') AS key, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, key, CASE WHEN len(words) < 5 THEN list_filter([array_to_string(words, ' ')], lambda x: x <> '')
                           ELSE list_sort(list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')))) END AS shingles FROM d
), m AS (
  SELECT doc_id, key, shingles, md5(array_to_string(shingles, chr(10))) AS class FROM s
), c AS (
  SELECT class, min(doc_id) AS copy_id, count(DISTINCT key) AS texts, any_value(shingles) AS shingles FROM m GROUP BY class
), e AS (
  SELECT copy_id, len(shingles) AS n, unnest(shingles) AS shingle FROM c
), p AS (
  SELECT a.copy_id AS u, b.copy_id AS v FROM e a JOIN e b ON a.shingle = b.shingle AND a.copy_id <> b.copy_id
  GROUP BY a.copy_id, b.copy_id, a.n, b.n HAVING count(*) * 18 >= 8 * (a.n + b.n)
), r AS (
  SELECT copy_id AS u, copy_id AS v FROM c UNION SELECT r.u, p.v FROM r JOIN p ON p.u = r.v
), g AS (
  SELECT u, min(v) AS class_id FROM r GROUP BY u
), n AS (
  SELECT p.u, sum(c.texts) AS links FROM p JOIN c ON c.copy_id = p.v GROUP BY p.u
)
SELECT m.doc_id, g.class_id, c.copy_id, CAST(coalesce(n.links, 0) + c.texts - 1 AS BIGINT) AS n_links
FROM m JOIN c ON c.class = m.class JOIN g ON g.u = c.copy_id LEFT JOIN n ON n.u = c.copy_id
"""


OP6_SQL = r"""
WITH t AS (
  SELECT doc_id, md5(concat_ws('|', CAST(doc_id AS VARCHAR), text)) AS doc, string_split(text, chr(10)) AS lines FROM documents
), l AS (
  SELECT doc_id, doc, i - 1 AS line, list_transform(regexp_extract_all(x, '[^\x20\x09-\x0D]+'), lambda w: CASE WHEN regexp_matches(w, '[0-9]') THEN chr(10) ELSE w END) AS tokens
  FROM (SELECT doc_id, doc, unnest(lines) AS x, unnest(range(1, len(lines) + 1)) AS i FROM t)
), k AS (
  SELECT tokens, len(tokens) AS n, tokens[1:3] AS leading, list(DISTINCT doc) AS docs FROM l WHERE len(tokens) > 0 GROUP BY tokens
), a AS (
  SELECT a.tokens FROM k a JOIN k b ON a.n = b.n AND a.leading = b.leading
  WHERE list_sum(list_transform(range(1, a.n + 1), lambda i: CAST(a.tokens[i] = b.tokens[i] AS BIGINT))) * 10 >= 7 * a.n
  GROUP BY a.tokens HAVING len(list_distinct(flatten(list(b.docs)))) >= 3
), f AS (
  SELECT l.doc_id, count(*) AS n_lines, count(a.tokens) AS n_dropped, string_agg(CAST(line AS VARCHAR), ',' ORDER BY line) FILTER (WHERE a.tokens IS NOT NULL) AS dropped
  FROM l LEFT JOIN a ON a.tokens = l.tokens WHERE len(l.tokens) > 0 GROUP BY l.doc_id
)
SELECT t.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_dropped, 0) AS BIGINT) AS n_dropped, coalesce(dropped, '') AS dropped FROM t LEFT JOIN f ON f.doc_id = t.doc_id
"""


OP9_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + length(text) + len(regexp_extract_all(role || chr(10) || text, '\\|<\||</s>|<s>|\[/INST\]|\[INST\]|<</SYS>>|<<SYS>>')) AS chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars + 25) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
), t AS (
  SELECT id, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), k AS (
  SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10
), g AS (
  SELECT DISTINCT lang, source FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term
), a AS (
  SELECT g.lang, g.source, k.term, CAST(coalesce(n, 0) AS HUGEINT) AS n FROM g JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), p AS (
  SELECT *, 1 + (1000000000 * (n + 2)) // (CAST(sum(n) OVER (PARTITION BY lang, source) AS HUGEINT) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM a
), w AS (
  SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n FROM a GROUP BY lang, term
), q AS (
  SELECT *, 1 + (1000000000 * (n + 2)) // (CAST(sum(n) OVER (PARTITION BY lang) AS HUGEINT) + 2 * count(*) OVER (PARTITION BY lang)) AS q FROM w
), f AS (
  SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p)) AS value
  FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY x.lang, x.source, y.source
), v AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, CAST((p.p - q.q) * (p.p - q.q) // (p.p + q.q) AS BIGINT) FROM p JOIN q ON p.lang = q.lang AND p.term = q.term WHERE p.n > 0 AND p.p > q.q
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM v
)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= 10
"""


OP12_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS id, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT id, doc_id, CASE WHEN len(words) < 2 THEN words ELSE list_sort(list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]))) END AS shingles FROM d
), m AS (
  SELECT id, doc_id, len(shingles) AS n, shingles, md5(array_to_string(shingles, chr(10))) AS class FROM s
), c AS (
  SELECT class, min(doc_id) AS low, any_value(n) AS n, any_value(shingles) AS shingles FROM m WHERE n > 0 GROUP BY class
), e AS (
  SELECT class, n, unnest(shingles) AS shingle FROM c
), p AS (
  SELECT a.class AS u, b.class AS v FROM e a JOIN e b ON a.shingle = b.shingle AND a.class <> b.class AND a.n * 10 >= b.n * 8 AND b.n * 10 >= a.n * 8
  GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), r AS (
  SELECT class AS u, class AS v FROM c UNION SELECT r.u, p.v FROM r JOIN p ON p.u = r.v
), g AS (
  SELECT r.u AS class, min(c.low) AS component_id FROM r JOIN c ON c.class = r.v GROUP BY r.u
), o AS (
  SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, CASE WHEN n = 0 THEN doc_id ELSE component_id END AS component_id FROM m LEFT JOIN g ON g.class = m.class
)
SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM o
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {"op2_mixing": OP2_SQL, "op4_ngram_jaccard_join": OP4_SQL, "op5_decontamination": OP5_SQL, "op6_line_dedup": OP6_SQL, "op9_chat_formatting": OP9_SQL, "op11_source_divergence": OP11_SQL, "op12_odd_sketches": OP12_SQL}
