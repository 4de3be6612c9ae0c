import pytest

from onomata.constants import ENTITY_TYPES
from onomata.operators.aggregate import count_by_type, rank_entities
from onomata.operators.posts import filter_posts
from onomata.operators.report import entity_report, processing_report, type_report
from onomata.operators.stats import post_length_stats, processing_stats
from onomata.sources.feeds import attach_feeds, parse_feeds

COUNTS = "entity_type string, entity_name string, n bigint"


def test_type_stats_zero_fill_and_total(spark):
    c = spark.createDataFrame([("Place", "A", 3), ("Place", "B", 1), ("Person", "C", 2)], COUNTS)
    got = {r["entity_type"]: r["n"] for r in count_by_type(c).collect()}
    assert got == {"Person": 2, "Organization": 0, "University": 0, "Place": 4, "Technology": 0,
                   "ProgrammingLanguage": 0, "total": 6}


def test_type_stats_on_empty_input(spark):
    got = {r["entity_type"]: r["n"] for r in count_by_type(spark.createDataFrame([], COUNTS)).collect()}
    assert got == {**{t: 0 for t in ENTITY_TYPES}, "total": 0}


def test_rank_order_ties_and_prefix(spark):
    c = spark.createDataFrame([("Place", "b", 5), ("Person", "z", 5), ("Place", "a", 5), ("Person", "y", 9),
                               ("Place", "c", 1)], COUNTS)
    full = [tuple(r) for r in rank_entities(c, 10).orderBy("rank").collect()]
    assert [x[:3] for x in full] == [("Person", "y", 9), ("Person", "z", 5), ("Place", "a", 5), ("Place", "b", 5),
                                     ("Place", "c", 1)]
    assert [x[3] for x in full] == [1, 2, 3, 4, 5]
    top2 = [tuple(r) for r in rank_entities(c, 2).orderBy("rank").collect()]
    assert top2 == full[:2]
    with pytest.raises(ValueError):
        rank_entities(c, 0)


def test_filters(spark):
    rows = [(1, "f", "t", "body"), (2, "f", "", "body"), (3, "f", "t", ""), (4, "f", "t", "   "),
            (5, "f", "t", "\t\n"), (6, "f", None, "b"), (7, "f", "t", " x ")]
    p = spark.createDataFrame(rows, "post_id bigint, feed string, title string, selftext string")
    assert sorted(r["post_id"] for r in filter_posts(p, "empty").collect()) == [1, 4, 5, 7]
    assert sorted(r["post_id"] for r in filter_posts(p, "blank").collect()) == [1, 7]
    s = post_length_stats(p, "blank").first()
    assert (s["posts"], s["posts_kept"], s["total_chars"], s["avg_chars_int"]) == (7, 2, 9, 4)
    with pytest.raises(ValueError):
        filter_posts(p, "other")


def test_processing_stats_and_reports(spark):
    subs = spark.createDataFrame([("a", "u/a"), ("b", "u/b"), ("c", "u/c")], "name string, url string")
    classified = spark.createDataFrame(
        [("a", "u/a", "VALID"), ("b", "u/b", "VALID"), ("c", "u/c", "VALID"), (None, "u/x", "SKIPPED")],
        "name string, url string, sub_status string")
    ok = '{"data":{"children":[{"data":{"title":"t","selftext":"hello"}},{"data":{"title":"t","selftext":" "}}]}}'
    landed = spark.createDataFrame([("u/a", 0, ok), ("u/a", 1, ok), ("u/b", 0, "bad")],
                                   "url string, page bigint, body string")
    parsed = parse_feeds(attach_feeds(subs, landed))
    s = processing_stats(parsed, classified).first().asDict()
    assert s == {"subscriptions_skipped": 1, "feeds_ok": 2, "feeds_failed": 1, "posts_ok": 4,
                 "feeds_without_posts": 2, "posts_filtered": 2, "posts_kept": 2, "avg_chars": 6.0,
                 "avg_chars_int": 6}
    lines = [r["line"] for r in processing_report(processing_stats(parsed, classified)).orderBy("line_no").collect()]
    assert lines[1:] == ["Feeds descargados exitosamente: 2", "Feeds fallidos: 1",
                         "Posts descargados exitosamente: 4", "Posts fallidos: 2",
                         "Posts filtrados (vacíos/nulos): 2", "Largo promedio en posts: 6"]


def test_type_and_entity_reports(spark):
    c = spark.createDataFrame([("Place", "Cordoba", 3), ("Person", "Turing", 1)], COUNTS)
    t = [r["line"] for r in type_report(count_by_type(c)).orderBy("line_no").collect()]
    assert t[1:4] == ["Entidades totales: 4", "Entidades por categoría:", "    [Person]: 1"]
    assert t[-1] == "    [ProgrammingLanguage]: 0" and len(t) == 9
    e = [r["line"] for r in entity_report(rank_entities(c, 10)).orderBy("line_no").collect()]
    assert e[1:] == ["[Type=Place] Cordoba: 3 apariciones", "[Type=Person] Turing: 1 apariciones"]


def test_observed_counters_on_write(spark):
    from onomata.operators.stats import observe_posts

    rows = [(1, "f", "t", "body"), (2, "f", "", "body"), (3, "f", "t", "  ")]
    p = spark.createDataFrame(rows, "post_id bigint, feed string, title string, selftext string")
    observed, obs = observe_posts(p)
    observed.write.format("noop").mode("overwrite").save()
    assert obs.get == {"posts": 3, "posts_kept": 1, "total_chars": 5}
