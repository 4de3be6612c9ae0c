"""In-row filters over a dictionary, frequent items and joins with salts."""

import statistics

import pytest
from pyspark.sql import functions as F

from onomata.operators.detect import Detection
from onomata.plans import filters as P
from onomata.plans.skew import frequent_items, join_with_salts
from onomata.plans.strategy import physical_plan
from onomata.sources.dictionary import dictionary_from_rows
from onomata.sources.feeds import attach_feeds


@pytest.mark.parametrize("n", [1, 300, 20_000])
def test_key_filter_has_all_keys_and_few_others(spark, n):
    keys = spark.range(n).select(F.concat(F.lit("key "), "id").alias("k"))
    f = P.KeyFilter(keys, "k", n)
    asked = spark.range(n + 20_000).select("id", F.concat(F.lit("key "), "id").alias("k"))
    found = {r["id"] for r in asked.where(f.may_have(F.col("k"), f.bits())).collect()}
    assert set(range(n)) <= found
    assert len(found) - n < 0.01 * 20_000


def test_filters_of_no_keys_and_of_too_many(spark, monkeypatch):
    none = spark.createDataFrame([], "k string")
    f = P.KeyFilter(none, "k", 0)
    assert spark.createDataFrame([("a",)], "k string").where(f.may_have(F.col("k"), f.bits())).count() == 0
    assert P.KeyFilter.useful(10_000_000) and not P.KeyFilter.useful(10**10)
    monkeypatch.setattr(P, "WORDS_MAX", 16)  # full arrays let all through, and lose nothing
    keys = spark.range(500).select(F.col("id").cast("string").alias("k"))
    full = P.KeyFilter(keys, "k", 500)
    assert full.words == 16 and keys.where(full.may_have(F.col("k"), full.bits())).count() == 500


def test_first_word_index(spark):
    names = ["a b", "a b c", "d", " ".join(["z"] * 70), "z z"]
    index = P.FirstWordIndex(spark.createDataFrame([(n,) for n in names], "k string"), "k", len(names))
    words = spark.createDataFrame([(w, n) for w in ("a", "d", "z", "q") for n in (1, 2, 3, 64, 70, 90)], "w string, n int")
    got = {(r["w"], r["n"]) for r in words.where(P.has_length(index.lengths_at(F.col("w"), index.bits()), F.col("n"))).collect()}
    assert got == {("a", 2), ("a", 3), ("d", 1), ("z", 2), ("z", 64), ("z", 70), ("z", 90)}  # all long ones share a bit


def test_frequent_items_are_all_found(spark):
    rows = spark.range(40_000).select(F.when(F.col("id") % 3 == 0, "the").when(F.col("id") % 10 == 1, "of").when(F.col("id") % 100 < 90, F.concat(F.lit("w"), "id")).alias("w"))
    total, items = frequent_items(rows, "w", 20)
    assert total == 40_000 and set(items) == {"the", "of"}
    assert abs(items["the"] - 13_334) < 100
    assert frequent_items(rows.where("false"), "w", 20) == (0, {})


@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_with_salts_gives_the_same(spark, how):
    large = spark.createDataFrame([(k, "hot" if k % 2 else f"k{k % 50}") for k in range(4_000)] + [(9, None)], "id bigint, key string")
    small = spark.createDataFrame([("hot", "x"), ("hot", "y"), ("k2", "z"), ("none", "w"), (None, "v")], "key string, name string")
    got = join_with_salts(large, small, "key", [F.col("id")], share=8, how=how)
    assert got.columns == ["id", "key", "name"]
    key = lambda rows: sorted(map(str, rows))
    want = large.join(small, "key", how).select("id", "key", "name")
    assert key(got.collect()) == key(want.collect())


def test_a_word_in_every_post_is_dealt_to_many_tasks(spark):
    names = [("Person", "The"), *(("Place", f"w{k}") for k in range(400))]
    posts = spark.range(3_000).select(F.col("id").alias("post_id"), F.concat(F.lit("the w"), F.col("id") % 400, F.lit(" and others "), "id").alias("title"), F.lit("").alias("selftext"))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "24"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        det = Detection(dictionary_from_rows(spark, names), strategy="shuffle")
        assert det.keys is None and det.key_filter is not None
        mentions = det.mentions(posts)
        assert "ShuffledHashJoin" in physical_plan(mentions)
        per = [r["n"] for r in mentions.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per) == 6_000 and len(per) == 24
        assert max(per) <= 3 * statistics.median(per)
        # What is shuffled is close to the matches: the other two words of a post are left out before.
        assert 6_000 <= det.terms(posts, ("post_id",)).count() < 6_100
        det.release()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_phrases_of_a_large_dictionary(spark):
    """No literal list in the plan, and only phrases that may match leave the row."""
    names = [("Place", f"w{k} x{k % 7} y{j}") for k in range(6_000) for j in (0, 1)] + [("Place", "w1 x1"), ("Place", "solo")]
    text = " ".join(f"w{k} x{k % 7} y{k % 3}, solo" for k in range(0, 6_000, 3))
    posts = spark.createDataFrame([(k, text, "w1 x1 y1 w1 x1") for k in range(3)], "post_id bigint, title string, selftext string")
    for strategy in ("broadcast", "shuffle"):
        det = Detection(dictionary_from_rows(spark, names), "phrase", strategy)
        got = {r["entity_name"]: r["n"] for r in det.counts(posts).collect()}
        want = {f"w{k} x{k % 7} y0" for k in range(0, 6_000, 3)} | {"w1 x1 y1", "w1 x1", "solo"}
        assert got == dict.fromkeys(want, 3)
        terms = det.terms(posts, ("post_id",))
        assert terms.count() < 1.05 * 3 * len(want)
        assert "w5999" not in physical_plan(terms)


def test_a_feed_with_half_of_the_pages(spark):
    subs = spark.createDataFrame([(f"n{k}", f"u{k}") for k in range(60)] + [("again", "u0")], "name string, url string")
    landed = spark.range(4_000).select(F.when(F.col("id") % 2 == 0, F.lit("u0")).otherwise(F.concat(F.lit("u"), F.col("id") % 50)).alias("url"), F.col("id").alias("page"), F.lit("{}").alias("body"))
    key = lambda df: sorted(map(str, df.select("name", "url", "page", "body").collect()))
    dealt = attach_feeds(subs, landed, max_broadcast_subscriptions=0)
    assert key(dealt) == key(attach_feeds(subs, landed))
    off = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in off}
    try:
        for k, v in off.items():
            spark.conf.set(k, v)
        fetched = attach_feeds(subs, landed, max_broadcast_subscriptions=0).where("page IS NOT NULL")
        per = [r["n"] for r in fetched.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
        assert sum(per) == 6_000 and max(per) <= 3 * statistics.median(per)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
