import importlib


def test_entry_and_registry(spark):
    entry = importlib.import_module("__spark_entry__")
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["entity_type", "entity_name", "n", "rank"]
    from onomata import queries as own

    assert set(own.oracle_sql()) == set(own.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_sf001_expected_counts(spark):
    """Known counts at sf0.01 over unfiltered documents with the probe dictionary."""
    from onomata import queries as Q

    from .conftest import SF_MID

    got = {r["entity_name"]: r["n"] for r in Q.q_entity_top_10_unfiltered(spark, SF_MID).collect()}
    assert got == {"The": 579, "THAN": 400, "the.": 365, "Than": 200, "MIT": 100, "Elle": 60}
    s = Q.q_avg_post_chars(spark, SF_MID).first()
    assert s["posts"] == 1000
    emp = Q.q_posts_filter_empty(spark, SF_MID).count()
    assert emp == 931
    from onomata.operators.stats import post_length_stats

    kept = post_length_stats(Q.S.documents_posts(spark, SF_MID), "empty").first()
    assert (kept["posts_kept"], round(kept["avg_chars"], 2), kept["avg_chars_int"]) == (931, 2503.84, 2503)
