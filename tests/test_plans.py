"""Plan-shape checks: the physical plans the scale design depends on."""

from onomata import queries as Q
from onomata.plans.strategy import physical_plan

from .conftest import SF_SMALL


def _plan(df):
    df.collect()  # AQE final plan
    return physical_plan(df).split("== Initial Plan ==")[0]


def test_counts_broadcast_one_exchange_pruned_scan(spark):
    plan = _plan(Q.q_entity_counts(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan
    # one hash exchange for the aggregation (plus the round-robin spread of a single-split scan)
    assert plan.count("Exchange hashpartitioning") == 1
    assert "ReadSchema: struct<text:string>" in plan


def test_top_k_is_take_ordered(spark):
    df = Q.q_entity_top_10(spark, SF_SMALL)
    assert "TakeOrderedAndProject" in physical_plan(df) or "TakeOrderedAndProject" in _plan(df)


def test_shuffle_strategy_preaggregates_terms(spark):
    df = Q.q_entity_counts_shuffle(spark, SF_SMALL)
    plan = _plan(df)
    assert "HashAggregate(keys=[term" in plan and "partial_count" in plan


def test_feed_pages_are_bounded_groups(spark):
    from pyspark.sql import functions as F

    from onomata import scenario as S

    pages = S.clean_pages(S.documents_posts(spark, SF_SMALL))
    biggest = pages.select(F.size(F.split("body", '"kind":"t3"')).alias("n")).agg(F.max("n")).first()[0] - 1
    assert 0 < biggest <= S.PAGE_ROWS


def test_spread_scan_only_for_few_splits(spark, tmp_path):
    from onomata.plans.strategy import spread_scan

    one = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert one.rdd.getNumPartitions() == 1
    assert spread_scan(one).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism)
    assert spread_scan(many) is many
    import onomata.plans.strategy as S

    big = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    old = S.SPREAD_MAX_BYTES
    try:
        S.SPREAD_MAX_BYTES = 1  # pretend the file is huge relative to the cluster
        assert spread_scan(big) is big
    finally:
        S.SPREAD_MAX_BYTES = old


def test_broadcast_mentions_never_shuffle_posts(spark):
    plan = _plan(Q.q_entity_mentions(spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan
    assert "Exchange hashpartitioning" not in plan


def test_dictionary_past_bound_goes_to_shuffle(spark, monkeypatch):
    import onomata.plans.strategy as S
    from onomata.operators.detect import Detection

    posts = Q._kept_posts(spark, SF_SMALL)
    small = sorted(tuple(r) for r in Detection(Q._probe(spark)).counts(posts).collect())
    monkeypatch.setattr(S, "BROADCAST_MAX_ROWS", 3)
    wide = Detection(Q._probe(spark))
    assert wide.strategy == "shuffle" and wide.keys
    assert sorted(tuple(r) for r in wide.counts(posts).collect()) == small
