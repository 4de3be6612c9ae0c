"""Operators against plain versions of their whole rule: votes, sets of languages, verdicts, keys."""

import itertools
import math
import random

import numpy as np
import pyarrow as pa
import pytest

from onomata.llm import langid, mixing, neighbours, quality

SF = "/root/testdata/sf0.001"


def grams_plainly(text):
    data = text.encode()
    return [int.from_bytes(data[k : k + 4], "big") * 2654435761 % 2**32 >> 32 - quality.BITS for k in range(len(data) - 3)]


@pytest.mark.parametrize("ids", [1_000_000, 0])
def test_quality_verdict_by_counting(spark, monkeypatch, ids):
    monkeypatch.setattr(quality, "TRUSTED_IDS", ids)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    good = {r["doc_id"] for r in labels.collect() if r["quality"] == 1 and not r["toxic"]}
    raw, trusted = np.ones(1 << quality.BITS), np.ones(1 << quality.BITS)
    for k, t in texts.items():
        for g in grams_plainly(t):
            raw[g] += 1
            trusted[g] += k in good
    ratio = np.log(trusted / trusted.sum()) - np.log(raw / raw.sum())
    extra = spark.createDataFrame([(None, "no id"), (None, None)], "doc_id bigint, text string").where("false")
    rows = quality.quality_rules(docs.select("doc_id", "text").union(extra), labels).collect()
    assert len(rows) == len(texts)
    near = 0
    for r in rows:
        own = grams_plainly(texts[r["doc_id"]])
        llr = ratio[own].mean() if own else 0.0
        assert r["llr"] == pytest.approx(llr, abs=1e-4)
        if abs(llr - quality.THRESHOLD) < 1e-4:
            near += 1
        else:
            assert r["kept"] == (not r["base_failed"] and llr >= quality.THRESHOLD)
    assert near < 3 and {r["kept"] for r in rows} == {True, False}


def fit_plainly(likely, rounds, share):
    for _ in range(rounds):
        joint = likely * share
        share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
    return share, float(np.log((likely * share).sum(axis=1)).sum())


def test_language_sets_by_trying_all_sizes():
    """Expectation-maximisation for one text at a time, and the penalised likelihood of every set of leading languages."""
    r = random.Random(6)
    words = {lang: [f"{a}{b}{c}" for a, b, c in itertools.product(x, y, x)] for lang, x, y in (("aa", "bcd", "ea"), ("bb", "ghk", "iu"), ("cc", "mnp", "oé"), ("dd", "rst", "yö"))}
    rng = np.random.default_rng(1)
    table = np.log(rng.dirichlet(np.full(1 << langid.BITS, 0.5), 4).T + 1e-9).astype(np.float32)
    for j, some in enumerate(words.values()):  # each language likes its own trigrams
        code = langid._trigrams(pa.array([" ".join(some)], pa.large_string()))[0]
        table[:, j] -= 2
        table[code, j] = -3 - rng.random(len(code)).astype(np.float32)
    model = langid.Model(list(words), table)
    texts = []
    for _ in range(60):
        some = r.sample(list(words), r.choice([1, 1, 2, 3, 4]))
        texts.append(" ".join(r.choice(words[r.choice(some)]) for _ in range(r.choice([1, 3, 12, 60]))))
    lang, score, chosen = langid.infer(pa.array(texts, pa.large_string()), model)
    sizes = set()
    for k, text in enumerate(texts):
        code, first, _, _ = langid._trigrams(pa.array([text], pa.large_string()))
        likely = np.add.reduceat(table[code].astype(np.float64), first, axis=0)
        likely = np.exp(likely - likely.max(axis=1, keepdims=True))
        share, _ = fit_plainly(likely, langid.ROUNDS, np.full(4, 0.25))
        order = np.argsort(-share, kind="stable")
        best = None
        for m in range(1, 5):
            inside = np.isin(np.arange(4), order[:m])
            start = np.where(inside, share, 0)
            own, value = fit_plainly(likely, 0 if m == 1 else langid.SET_ROUNDS, start / start.sum())
            value -= langid.PENALTY * math.log(max(len(first), 2)) * (m - 1)
            if best is None or value > best[0] + 1e-4:
                best = value, m, own
        want = [model.languages[j] for j in np.argsort(-best[2], kind="stable")[: best[1]]]
        assert set(chosen[k]) == set(want) and lang[k] == want[0]
        posterior = (likely / likely.sum(axis=1, keepdims=True)).mean(axis=0)
        assert score[k] == pytest.approx(posterior[model.languages.index(lang[k])], abs=1e-4)
        sizes.add(len(want))
    assert len(sizes) >= 3


def test_scores_tell_texts_apart(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scores = sorted(r["score"] for r in langid.language_report(docs).collect())
    assert len(set(scores)) > 500 and scores[-1] <= 1.0 and scores[len(scores) // 2] < 0.999


def test_most_frequent_languages_are_learned(spark, monkeypatch):
    monkeypatch.setattr(langid, "LANGUAGES", 2)
    rows = [(k, "eine kleine Nacht", "de") for k in range(9)] + [(20 + k, "a small night", "en") for k in range(9)] + [(50, "odd one", "zz"), (51, "odd two", "zz")]
    assert langid.learn(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).languages == ["de", "en"]


def test_votes_by_plain_cosines():
    r = random.Random(4)
    some = {1: "lake tree walk bird stone road".split(), 0: "### BUY!! $$$ NOW!! win cash".split()}
    labels = [k % 2 for k in range(80)]
    train = [" ".join(r.choice(some[q if r.random() < 0.85 else 1 - q]) for _ in range(r.randrange(5, 40))) for q in labels]
    ask = [" ".join(r.choice(some[r.randrange(2)]) for _ in range(r.randrange(1, 30))) for _ in range(40)]
    arrow = lambda x: pa.array(x, pa.large_string())
    row, column, value = neighbours.features(arrow(train))
    space = neighbours.fit(row, column, value, labels, 0.5)
    got = space.scores(arrow(ask))
    row, column, value = neighbours.features(arrow(ask))
    compared = 0
    for k in range(len(ask)):
        own = row == k
        dense = np.zeros(neighbours.FEATURES)
        dense[column[own]] = value[own].astype(np.float64) * space.weight[column[own]]
        vector = dense @ space.axes
        vector = vector / max(np.linalg.norm(vector), 1e-9)
        like = space.vectors @ vector
        order = np.argsort(-like, kind="stable")
        near = order[: neighbours.NEIGHBOURS]
        if like[near[-1]] - like[order[neighbours.NEIGHBOURS]] < 1e-5:
            continue  # a tie at the last place
        vote = np.maximum(like[near], 0) ** neighbours.SHARPNESS
        want = ((vote * space.labels[near]).sum() + 0.01 * space.prior) / (vote.sum() + 0.01)
        assert got[k] == pytest.approx(want, abs=1e-3)
        compared += 1
    assert compared > 10


def test_keys_tell_nulls_and_separators_apart(spark):
    rows = [(1, None, "x"), (1, "x", None), (1, "", "x"), (1, "x", ""), (None, "1", "x"), (1, "a|2|b", "c"), (1, "a", "2|b|=c"), (1, "a|=b", "c"), (1, "a", "b|=c")]
    df = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    assert df.select(mixing._key(df).alias("k")).distinct().count() == len(rows)
