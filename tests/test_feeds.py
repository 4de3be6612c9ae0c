import collections
import json

import pytest

from onomata.constants import FEED_STATUSES
from onomata.sources.feeds import attach_feeds, feed_posts, fetched_feeds, feed_status, page_summary, parse_diagnostics, parse_feeds
from onomata.sources.subscriptions import (
    classify_subscriptions,
    load_subscriptions,
    parse_subscription_records,
    subscription_diagnostics,
)


def child(title="t", selftext="s", **extra):
    d = {}
    if title is not ...:
        d["title"] = title
    if selftext is not ...:
        d["selftext"] = selftext
    d.update(extra)
    return {"kind": "t3", "data": d}


def listing(*children):
    return json.dumps({"data": {"children": list(children)}})


BODIES = {
    "ok": listing(child("a", "b"), child("c", "d")),
    "missing": listing(child("a", "b"), child("c", ...)),
    "nulltitle": listing(child(None, "b")),
    "numtitle": listing(child(12, "b")),
    "objtitle": listing(child({"x": 1}, "b")),
    "notjson": "no braces in here",
    "truncated": listing(child("a", "b"))[:20],
    "nodata": '{"data":{}}',
    "empty": '{"data":{"children":[]}}',
    "error": '{"error":"404"}',
    "garbage": listing(child("a", "b")) + " trailing",
}
EXPECTED = {
    "ok": "OK", "missing": "MISSING_FIELD", "nulltitle": "OK", "numtitle": "OK", "objtitle": "BAD_FIELD",
    "notjson": "BAD_JSON", "truncated": "BAD_JSON", "nodata": "NO_CHILDREN", "empty": "EMPTY",
    "error": "NO_CHILDREN", "garbage": "OK", "unfetched": "FETCH_FAILED",
}


def _parsed(spark):
    subs = spark.createDataFrame([(k, f"u/{k}") for k in EXPECTED], "name string, url string")
    landed = spark.createDataFrame([(f"u/{k}", 0, b) for k, b in BODIES.items()], "url string, page bigint, body string")
    return parse_feeds(attach_feeds(subs, landed))


def test_every_status(spark):
    got = {r["name"]: r["status"] for r in feed_status(_parsed(spark)).collect()}
    assert got == EXPECTED
    assert set(got.values()) <= set(FEED_STATUSES)


def test_posts_only_from_ok_bodies(spark):
    posts = {(r["feed"], r["title"], r["selftext"]) for r in feed_posts(_parsed(spark)).collect()}
    assert posts == {
        ("ok", "a", "b"), ("ok", "c", "d"), ("nulltitle", None, "b"), ("numtitle", "12", "b"), ("garbage", "a", "b"),
    }


def test_post_counts_and_diagnostics(spark):
    parsed = _parsed(spark)
    n = {r["name"]: r["n_posts"] for r in feed_status(parsed).collect()}
    assert n["ok"] == 2 and n["empty"] == 0 and n["missing"] == 0
    codes = sorted(r["code"] for r in parse_diagnostics(page_summary(parsed)).collect())
    assert "FETCH_FAILED" in codes and "BAD_JSON" in codes and "OK" not in codes


def test_subscription_file_rules(spark, tmp_path):
    good = tmp_path / "subs.json"
    good.write_text(json.dumps([
        {"name": "Scala", "url": "u/scala"},
        {"name": "", "url": "u/empty"},
        {"name": "   ", "url": "u/blank"},
        {"label": "incorrect_value"},
        {"name": "no-url"},
    ]))
    valid, diag = load_subscriptions(spark, str(good))
    assert sorted(tuple(r) for r in valid.collect()) == [("   ", "u/blank"), ("Scala", "u/scala")]
    assert diag.count() == 3
    bad = tmp_path / "bad.json"
    bad.write_text("no braces in here")
    valid, diag = load_subscriptions(spark, str(bad))
    assert valid.count() == 0
    assert [r["code"] for r in diag.collect()] == ["INVALID_JSON"]


def test_subscription_records(spark):
    recs = spark.createDataFrame([('{"name":"a","url":"b"}',), ("nope",), ('[1,2]',), ('{"url":"x"}',)], "value string")
    classified = classify_subscriptions(parse_subscription_records(recs))
    got = sorted((r["sub_status"], r["reason"] or "") for r in classified.collect())
    assert got == [("INVALID_JSON", "not a JSON object"), ("INVALID_JSON", "not a JSON object"),
                   ("SKIPPED", "missing name"), ("VALID", "")]
    assert subscription_diagnostics(classified).count() == 3


def test_landed_readers(spark, tmp_path):
    from onomata.sources.feeds import read_landed_bodies, read_landed_pages

    d = tmp_path / "bodies"
    d.mkdir()
    (d / "scala.json").write_text(listing(child("a", "b")))
    (d / "broken.json").write_text("{not json")
    bodies = read_landed_bodies(spark, str(d), url_prefix="u/")
    subs = spark.createDataFrame([("s", "u/scala.json"), ("b", "u/broken.json")], "name string, url string")
    got = {r["name"]: r["status"] for r in feed_status(parse_feeds(attach_feeds(subs, bodies))).collect()}
    assert got == {"s": "OK", "b": "BAD_JSON"}
    j = tmp_path / "pages.jsonl"
    j.write_text("\n".join(json.dumps({"url": "u/x", "page": i, "body": listing(child(f"t{i}", "s"))}) for i in range(3)))
    pages = read_landed_pages(spark, str(j))
    subs = spark.createDataFrame([("x", "u/x")], "name string, url string")
    assert feed_posts(parse_feeds(attach_feeds(subs, pages))).count() == 3


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_MISSING = object()
VALUES = st.sampled_from([_MISSING, None, "text", "", 7, 1.5, True, {"x": 1}, [1]])


def _child(title, selftext):
    data = {}
    if title is not _MISSING:
        data["title"] = title
    if selftext is not _MISSING:
        data["selftext"] = selftext
    return {"data": data}


def _status_model(children):
    if children is None:
        return "NO_CHILDREN"
    fields = [(c, k) for c in children for k in ("title", "selftext")]
    if any(not isinstance(c, dict) or k not in c.get("data", {}) for c, k in fields):
        return "MISSING_FIELD"
    if any(isinstance(c["data"][k], (dict, list)) for c, k in fields):
        return "BAD_FIELD"
    return "EMPTY" if not children else "OK"


PAGE = st.one_of(
    st.none(),
    st.lists(st.one_of(st.tuples(VALUES, VALUES).map(lambda p: _child(*p)), st.just(5)), max_size=4),
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(PAGE, min_size=1, max_size=6))
def test_status_matches_model(spark, pages):
    bodies = [json.dumps({"data": {} if ch is None else {"children": ch}}) for ch in pages]
    subs = spark.createDataFrame([(f"f{i}", f"u/{i}") for i in range(len(pages))], "name string, url string")
    landed = spark.createDataFrame([(f"u/{i}", 0, b) for i, b in enumerate(bodies)], "url string, page bigint, body string")
    parsed = parse_feeds(attach_feeds(subs, landed))
    got = {r["name"]: (r["status"], r["n_posts"]) for r in feed_status(parsed).collect()}
    want = {}
    for i, ch in enumerate(pages):
        status = _status_model(ch)
        want[f"f{i}"] = (status, len(ch) if status == "OK" else 0)
    assert got == want


def test_subscriptions_as_json_lines(spark, tmp_path):
    from onomata.sources.subscriptions import read_subscriptions

    p = tmp_path / "subs.jsonl"
    p.write_text('{"name": "a", "url": "u/a"}\n{"name": "", "url": "u/b"}\nnot json\n{"url": "u/c"}\n')
    classified = classify_subscriptions(read_subscriptions(spark, str(p), multiline=False))
    got = sorted((r["sub_status"], r["reason"] or "") for r in classified.collect())
    assert got == [("INVALID_JSON", "not a JSON object"), ("SKIPPED", "empty name"), ("SKIPPED", "missing name"),
                   ("VALID", "")]


def _one(spark, body):
    return parse_feeds(spark.createDataFrame([("n", "u", 0, body)], "name string, url string, page bigint, body string"))


def test_a_body_over_20_mb_keeps_all_posts(spark):
    import json

    children = [{"data": {"title": f"t{i}", "selftext": "x" * 1_000_000}} for i in range(21)]
    parsed = _one(spark, json.dumps({"data": {"children": children}}))
    assert [tuple(r) for r in feed_status(parsed).collect()] == [("n", "u", 0, "OK", 21)]
    assert feed_posts(parsed).selectExpr("sum(length(selftext))").first()[0] == 21_000_000


def test_children_and_strings_of_any_size(spark):
    long = "x" * 21_000_000
    parsed = _one(spark, listing(child("a", "b"), child("large", long[:17_000_000]), child(long, 7, id="p")))
    assert [tuple(r) for r in feed_status(parsed).collect()] == [("n", "u", 0, "OK", 3)]
    got = feed_posts(parsed).selectExpr("post_id", "length(title)", "length(selftext)").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, 1, 1), (None, 5, 17_000_000), ("p", 21_000_000, 1)], key=str)
    for body, status in (
        (listing(child("a", "b"), child(long, ...)), "MISSING_FIELD"),
        (listing(child("a", "b"), child({"x": long}, "s")), "BAD_FIELD"),
        (json.dumps({"error": long}), "NO_CHILDREN"),
        (json.dumps({"data": {"children": [child("a", long)]}})[:-1], "BAD_JSON"),
    ):
        assert feed_status(_one(spark, body)).first()["status"] == status


def test_large_children_are_read_by_the_same_rules(spark, monkeypatch):
    from onomata.sources import feeds

    values = [..., None, "text", "", "12", "NaN", "[1]", '{"x":1}', 7, 1.5, 1e30, True, {}, {"x": 1}, [], [1]]
    raw = ['"text"', "null", "5", "[1]", "{}", '{"data":null}', '{"data":5}', '{"data":{"title":"a","title":"b","selftext":"c"}}', '{"data":{"title":"a","selftext":"c"},"data":{"title":"a","selftext":"c"}}', '{"data":{"title":1.50,"selftext":1e3,"id":12345678901234567890}}']
    children = [json.dumps(child(a, b)) for a in values for b in ("s", *values[:3], 7, [1])] + [json.dumps(child("a", "b", id=x)) for x in values[1:-4]] + raw
    rows = [(f"n{k}", "u", 0, '{"data":{"children":[' + c + "]}}") for k, c in enumerate(children)]
    attached = spark.createDataFrame(rows, "name string, url string, page bigint, body string")
    small = sorted(map(str, parse_feeds(attached).collect()))
    monkeypatch.setattr(feeds, "VARIANT_MAX_BYTES", 0)
    assert sorted(map(str, parse_feeds(attached).collect())) == small


def test_children_that_are_no_readable_objects(spark):
    for child, status in (('"text"', "MISSING_FIELD"), ("null", "MISSING_FIELD"), ('{"data":{"title":"a","title":"b","selftext":"c"}}', "MISSING_FIELD"), ("[1]", "MISSING_FIELD")):
        body = '{"data":{"children":[' + child + "]}}"
        assert feed_status(_one(spark, body)).first()["status"] == status, child
    for body, status in (('{"data":{"children":"x"}}', "NO_CHILDREN"), ('{"data":"x"}', "NO_CHILDREN"), ("[]", "NO_CHILDREN"), ("{", "BAD_JSON"), ("", "BAD_JSON")):
        assert feed_status(_one(spark, body)).first()["status"] == status, body


def test_feeds_are_counted_not_pages(spark):
    import random

    from onomata.operators.stats import processing_stats
    from onomata.sources.subscriptions import classify_subscriptions

    good, empty = '{"data":{"children":[{"data":{"title":"a","selftext":"b"}}]}}', '{"data":{"children":[]}}'
    rng = random.Random(3)
    for _ in range(4):
        names = [f"f{k}" for k in range(rng.randint(1, 5))]
        pages = [(f"u/{n}", p, rng.choice([None, good, empty, "{"])) for n in names for p in range(rng.randint(0, 4))]
        subs = spark.createDataFrame([(n, f"u/{n}") for n in names] + [("", "x")], "name string, url string")
        landed = spark.createDataFrame(pages, "url string, page bigint, body string")
        classified = classify_subscriptions(subs)
        parsed = parse_feeds(attach_feeds(classified.where("sub_status = 'VALID'"), landed))
        got = processing_stats(parsed, classified).first()
        bodies = {n: [b for u, _, b in pages if u == f"u/{n}" and b is not None] for n in names}
        assert (got["subscriptions_skipped"], got["feeds_ok"], got["feeds_failed"]) == (1, sum(map(bool, bodies.values())), sum(not b for b in bodies.values()))
        assert got["feeds_without_posts"] == sum(good not in b for b in bodies.values())
        assert got["posts_ok"] == sum(b.count(good) for b in bodies.values())


@pytest.mark.parametrize("query", ["q_diagnostics", "q_processing_stats"])
def test_one_decoding_and_one_pass_over_the_pages(spark, query):
    from onomata import queries as Q
    from onomata.plans.strategy import physical_plan

    from .conftest import SF_SMALL

    df = getattr(Q, query)(spark, SF_SMALL)
    df.collect()
    final = physical_plan(df).split("== Initial Plan ==")[0]
    assert final.count("posexplode") == 1
    # The pages, and the subscriptions (here drawn from the same table) for the join and as entries: no anti join.
    assert final.count("Scan parquet") <= 3 and "LeftAnti" not in final


def test_ledger_of_feeds_listed_twice_and_of_nothing(spark):
    from onomata.operators.ledger import feed_ledger, ledger_diagnostics, ledger_stats

    entries = [("a", "u/a", "VALID", None), ("a", "u/a", "VALID", None), ("b", "u/b", "VALID", None), ("b", "u/b", "VALID", None)]
    entries += [(None, "u/c", "SKIPPED", "missing name")] * 3
    classified = spark.createDataFrame(entries, "name string, url string, sub_status string, reason string")
    good = json.dumps({"data": {"children": [{"data": {"id": "1", "title": "t", "selftext": "text"}}]}})
    landed = spark.createDataFrame([("u/a", 0, good), ("u/a", 0, good), ("u/a", 1, "{"), ("u/a", 2, None)], "url string, page bigint, body string")
    valid = classified.where("sub_status = 'VALID'")
    for attach in (attach_feeds, fetched_feeds):  # rows for missing feeds change nothing
        ledger = feed_ledger(parse_feeds(attach(valid, landed)), classified)
        stats = ledger_stats(ledger).first()
        assert (stats["subscriptions_skipped"], stats["feeds_ok"], stats["feeds_failed"], stats["posts_ok"]) == (3, 2, 2, 4)
        codes = collections.Counter((r["code"], r["subject"]) for r in ledger_diagnostics(ledger).collect())
        assert codes == {("SUBSCRIPTION_SKIPPED", "u/c"): 3, ("BAD_JSON", "u/a"): 2, ("FETCH_FAILED", "u/a"): 2, ("FETCH_FAILED", "u/b"): 2}
    none = feed_ledger(parse_feeds(fetched_feeds(valid, landed.where("false"))).where("false"), classified.where("false"))
    assert sorted(r["code"] for r in ledger_diagnostics(none).collect()) == ["NO_POSTS", "NO_SUBSCRIPTIONS"]
    assert ledger_stats(none).first()["feeds_ok"] == 0
