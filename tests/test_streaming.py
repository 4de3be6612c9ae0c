import json
import os
import tempfile

from onomata.sources.dictionary import dictionary_from_rows
from onomata.streaming.feed_counts import entity_count_stream, read_landed_stream, start_entity_counts


def _page(url, page, posts):
    body = json.dumps({"data": {"children": [{"data": {"title": t, "selftext": s}} for t, s in posts]}})
    return json.dumps({"url": url, "page": page, "body": body})


def test_stream_counts_accumulate(spark):
    landing = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")
    subs = spark.createDataFrame([("a", "u/a"), ("b", "u/b")], "name string, url string")
    d = dictionary_from_rows(spark, [("ProgrammingLanguage", "Scala"), ("Place", "Berkeley")])
    with open(os.path.join(landing, "p1.json"), "w") as f:
        f.write(_page("u/a", 0, [("Scala news", "about scala"), ("empty", "")]) + "\n")
        f.write(_page("u/x", 0, [("Scala", "not subscribed")]) + "\n")
    counts = entity_count_stream(read_landed_stream(spark, landing), subs, d)
    q = start_entity_counts(counts, "stream_counts_test", ckpt + "/q")
    try:
        q.processAllAvailable()
        got = {r["entity_name"]: r["n"] for r in spark.sql("select * from stream_counts_test").collect()}
        assert got == {"Scala": 1}
        with open(os.path.join(landing, "p2.json"), "w") as f:
            f.write(_page("u/b", 0, [("Berkeley", "and Scala"), ("bad", "  ")]) + "\n")
        q.processAllAvailable()
        got = {r["entity_name"]: r["n"] for r in spark.sql("select * from stream_counts_test").collect()}
        assert got == {"Scala": 2, "Berkeley": 1}
    finally:
        q.stop()


def test_stream_counts_to_parquet_path(spark):
    from onomata.streaming.feed_counts import read_current_counts, start_entity_counts_to_path

    landing = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    out = tempfile.mkdtemp(prefix="out-", dir="/tmp") + "/counts"
    ckpt = tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")
    subs = spark.createDataFrame([("a", "u/a")], "name string, url string")
    d = dictionary_from_rows(spark, [("ProgrammingLanguage", "Scala")])
    with open(os.path.join(landing, "p1.json"), "w") as f:
        f.write(_page("u/a", 0, [("Scala", "scala again"), ("x", "Scala")]) + "\n")
    q = start_entity_counts_to_path(entity_count_stream(read_landed_stream(spark, landing), subs, d), out, ckpt + "/q")
    try:
        q.processAllAvailable()
        assert [tuple(r) for r in read_current_counts(spark, out).collect()] == [("ProgrammingLanguage", "Scala", 2)]
    finally:
        q.stop()


def test_batch_and_stream_read_bodies_of_any_length(spark):
    from onomata.sources.feeds import attach_feeds, feed_posts, parse_feeds, read_landed_pages

    landing = tempfile.mkdtemp(prefix="landing-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="ckpt-", dir="/tmp")
    subs = spark.createDataFrame([("a", "u/a")], "name string, url string")
    d = dictionary_from_rows(spark, [("ProgrammingLanguage", "Scala")])
    with open(os.path.join(landing, "p1.json"), "w") as f:
        f.write(_page("u/a", 0, [("Scala", "s"), ("long", "x" * 21_000_000)]) + "\n")
        f.write(_page("u/a", 1, [("Scala", "t")]) + "\n")
    assert feed_posts(parse_feeds(attach_feeds(subs, read_landed_pages(spark, landing)))).count() == 3
    q = start_entity_counts(entity_count_stream(read_landed_stream(spark, landing), subs, d), "stream_long_test", ckpt + "/q")
    try:
        q.processAllAvailable()
        assert [r["n"] for r in spark.sql("select * from stream_long_test").collect()] == [2]
    finally:
        q.stop()
