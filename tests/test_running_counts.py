"""Running counts as deltas: pages that land again, changing dictionaries, counters of each batch, compaction."""

import json
import os
import time

import pytest

from onomata.operators.detect import Detection
from onomata.operators.stats import observe_posts
from onomata.sources.dictionary import dictionary_from_rows
from onomata.sources.feeds import attach_feeds, feed_posts, parse_feeds, read_landed_pages
from onomata.streaming.feed_counts import read_landed_stream
from onomata.streaming.running_counts import BatchCounters, DictionaryVersions, RunningCounts, drop_relanded, post_stream, read_batch_counters, start_running_counts


def page(url, number, *texts):
    body = json.dumps({"data": {"children": [{"data": {"id": "1", "title": t, "selftext": "text"}} for t in texts]}})
    return json.dumps({"url": url, "page": number, "body": body})


@pytest.fixture
def landing(tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()

    def land(name, *pages):
        (tmp_path / name).write_text("\n".join(pages) + "\n")
        os.rename(tmp_path / name, folder / name)  # a file appears whole

    land.folder = str(folder)
    return land


@pytest.fixture
def subs(spark):
    return spark.createDataFrame([("a", "u/a"), ("b", "u/b")], "name string, url string")


def found(counts):
    return {r["entity_name"]: r["n"] for r in counts.read().collect()}


def parquet_rows(spark, path):
    return spark.read.parquet(path).count()


def test_pages_that_land_again_count_once(spark, tmp_path, landing, subs):
    detection = Detection(dictionary_from_rows(spark, [("Place", "Scala"), ("Place", "Berkeley")]))
    counts = RunningCounts(spark, str(tmp_path / "counts"))
    posts = post_stream(drop_relanded(read_landed_stream(spark, landing.folder), "1 day"), subs)
    landing("p1.json", page("u/a", 0, "scala", "scala berkeley"), page("u/x", 0, "scala"))
    query = start_running_counts(posts, detection, counts, str(tmp_path / "ckpt"))
    try:
        query.processAllAvailable()
        assert found(counts) == {"Scala": 2, "Berkeley": 1}
        landing("p2.json", page("u/a", 0, "scala", "scala berkeley"), page("u/a", 1, "berkeley"), page("u/b", 0, "none"))
        query.processAllAvailable()
        assert found(counts) == {"Scala": 2, "Berkeley": 2}
        # Only what the batch has changed is written.
        deltas = sorted(os.listdir(tmp_path / "counts/delta"))[1:]
        assert sum(parquet_rows(spark, str(tmp_path / "counts/delta" / d)) for d in deltas) == 1
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] == 4  # (url, page) keys that landed within the time
    finally:
        query.stop()
    # From the checkpoint on: what landed before the stop is still known.
    landing("p3.json", page("u/a", 1, "berkeley"), page("u/b", 0, "scala"), page("u/b", 7, "scala"))
    query = start_running_counts(posts, detection, counts, str(tmp_path / "ckpt"))
    try:
        query.processAllAvailable()
        assert found(counts) == {"Scala": 3, "Berkeley": 2}
    finally:
        query.stop()


def test_state_is_bounded_by_the_time(spark, tmp_path, landing, subs):
    detection = Detection(dictionary_from_rows(spark, [("Place", "Scala")]))
    counts = RunningCounts(spark, str(tmp_path / "counts"))
    query = start_running_counts(post_stream(drop_relanded(read_landed_stream(spark, landing.folder), "1 second"), subs), detection, counts, str(tmp_path / "ckpt"))
    try:
        landing("p1.json", *(page("u/a", k, "scala") for k in range(50)))
        query.processAllAvailable()
        for k in range(3):  # time goes on with the batches
            time.sleep(1.5)
            landing(f"q{k}.json", page("u/b", k, "scala"))
            query.processAllAvailable()
        assert query.lastProgress["stateOperators"][0]["numRowsTotal"] < 10
        assert found(counts) == {"Scala": 53}
    finally:
        query.stop()


def test_late_pages_by_a_time_of_their_own(spark, tmp_path, subs):
    from pyspark.sql import functions as F

    folder = tmp_path / "timed"
    folder.mkdir()
    stream = spark.readStream.schema("url string, page bigint, body string, at timestamp").json(str(folder))
    kept = drop_relanded(stream, "1 hour", "at").select("url", "page", F.col("at").cast("string").alias("at"))
    query = kept.writeStream.format("memory").queryName("late_pages").option("checkpointLocation", str(tmp_path / "ckpt")).start()
    rows = [[("u", 1, "12:00"), ("u", 1, "12:10")], [("u", 2, "15:00")], [("u", 3, "12:30"), ("u", 4, "14:30"), ("u", 1, "14:31")]]
    try:
        for k, part in enumerate(rows):
            (folder / f"{k}.json").write_text("".join(json.dumps({"url": u, "page": p, "at": f"2024-01-01 {t}:00"}) + "\n" for u, p, t in part))
            query.processAllAvailable()
        got = {(r["page"], r["at"][11:16]) for r in spark.sql("select * from late_pages").collect()}
        # 12:30 is over an hour before 15:00 and late; page 1 of 14:31 lands after the time of the first and is new.
        assert {(2, "15:00"), (4, "14:30"), (1, "14:31")} <= got and len(got) == 4 and (3, "12:30") not in got
    finally:
        query.stop()


def test_a_name_added_between_batches_counts_from_then_on(spark, tmp_path, landing, subs):
    versions = DictionaryVersions(spark, str(tmp_path / "dictionary"))
    with pytest.raises(ValueError):
        versions.current()
    versions.publish(dictionary_from_rows(spark, [("Place", "Scala")]))
    first = versions.current()
    assert versions.current() is first or versions.current()[1] is first[1]  # measured once per version
    counts = RunningCounts(spark, str(tmp_path / "counts"))
    query = start_running_counts(post_stream(drop_relanded(read_landed_stream(spark, landing.folder), "1 day"), subs), versions, counts, str(tmp_path / "ckpt"))
    try:
        landing("p1.json", page("u/a", 0, "scala berkeley"))
        query.processAllAvailable()
        assert found(counts) == {"Scala": 1}
        assert versions.publish(dictionary_from_rows(spark, [("Place", "Scala"), ("University", "Berkeley")])) == 2
        landing("p2.json", page("u/a", 1, "scala berkeley"))
        query.processAllAvailable()
        assert found(counts) == {"Scala": 2, "Berkeley": 1}
    finally:
        query.stop()


def test_counters_of_each_batch_equal_those_of_a_batch_run(spark, tmp_path, landing, subs):
    listener = BatchCounters(spark, "run", str(tmp_path / "counters"))
    spark.streams.addListener(listener)
    detection = Detection(dictionary_from_rows(spark, [("Place", "Scala")]))
    posts = post_stream(drop_relanded(read_landed_stream(spark, landing.folder), "1 day"), subs, observed="run")
    query = start_running_counts(posts, detection, RunningCounts(spark, str(tmp_path / "counts")), str(tmp_path / "ckpt"))
    try:
        landing("p1.json", page("u/a", 0, "scala", "", "more"), page("u/b", 0, "one"))
        query.processAllAvailable()
        landing("p2.json", page("u/a", 1, "scala é"))
        query.processAllAvailable()
        for _ in range(100):
            if read_batch_counters(spark, str(tmp_path / "counters")).count() == 2:
                break
            time.sleep(0.2)
    finally:
        query.stop()
        spark.streams.removeListener(listener)
    rows = [tuple(r) for r in read_batch_counters(spark, str(tmp_path / "counters")).orderBy("batch").collect()]
    assert [r[1] for r in rows] == [4, 1]  # batches without data, which only move the watermark, have no row
    observed, observation = observe_posts(feed_posts(parse_feeds(attach_feeds(subs, read_landed_pages(spark, landing.folder)))))
    observed.write.format("noop").mode("overwrite").save()
    whole = observation.get
    assert [sum(r[k] for r in rows) for k in (1, 2, 3)] == [whole["posts"], whole["posts_kept"], whole["total_chars"]]


def test_compaction_and_replayed_batches(spark, tmp_path):
    counts = RunningCounts(spark, str(tmp_path / "counts"), compact_every=3)
    assert counts.read().collect() == []
    batch = lambda *rows: spark.createDataFrame([("Place", *r) for r in rows], "entity_type string, entity_name string, n bigint")
    for k in range(11):
        counts.add(batch(("x", 1), (f"y{k}", 2)), k)
        counts.add(batch(("x", 1), (f"y{k}", 2)), k)  # the batch is replayed
        assert found(counts) == {"x": k + 1, **{f"y{j}": 2 for j in range(k + 1)}}
    left = sorted(os.listdir(tmp_path / "counts/base")), sorted(os.listdir(tmp_path / "counts/delta"))
    # The last two bases, and the deltas after the one before the last.
    assert left[0] == ["batch=5", "batch=8"] and len(left[1]) == 5
    counts.add(batch(("x", 100)), 4)  # long since part of a base
    assert found(counts)["x"] == 11
