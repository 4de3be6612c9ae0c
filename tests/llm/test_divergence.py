"""Source divergence audit: perfect hashes, whole-number shares and the query against plain versions."""

import collections
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onomata.llm import divergence

SCHEMA = "doc_id bigint, text string, lang string, source string, n string, term string, value string, rank string, kept string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plainly(rows):
    """The contract word for word, with Python's whole numbers. rows: (text, lang, source)."""
    rows = [tuple(x or "" for x in r) for r in rows]
    terms = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER)) for text, _, _ in rows]
    docs, count, total = collections.Counter(), collections.Counter(), collections.Counter()
    for own, (_, lang, source) in zip(terms, rows, strict=True):
        docs.update((lang, t) for t in set(own))
        count.update((lang, source, t) for t in own)
        total.update((lang, t) for t in own)
    out = set()
    for lang in {r[1] for r in rows}:
        kept = [t for (x, t), n in docs.items() if x == lang and n >= 10]
        sources = sorted({r[2] for r in rows if r[1] == lang})

        def shares(of, kept=kept):
            n = [of(t) for t in kept]
            return [1 + 10**9 * (k + 2) // (sum(n) + 2 * len(kept)) for k in n]

        whole = shares(lambda t, lang=lang: total[lang, t])
        own = {s: shares(lambda t, s=s, lang=lang: count[lang, s, t]) for s in sources}
        for s in sources:
            pairs = sorted((-sum((p - q) ** 2 // (p + q) for p, q in zip(own[s], own[o], strict=True)), o) for o in sources if o != s)
            named = sorted((-((p - q) ** 2 // (p + q)), t) for t, p, q in zip(kept, own[s], whole, strict=True) if count[lang, s, t] and p > q)
            out |= {(lang, s, "pair", o, -v, k + 1) for k, (v, o) in enumerate(pairs)}
            out |= {(lang, s, "term", t, -v, k + 1) for k, (v, t) in enumerate(named[:10])}
    return out


def answers(df):
    rows = df.collect()
    got = {tuple(r[c] for c in ("lang", "source", "part", "item", "value", "rank")) for r in rows}
    assert len(got) == len(rows)
    return got


@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=300))
@settings(deadline=None)
def test_perfect_hash_numbers_every_key_once(keys):
    slot, levels = divergence.perfect_hash(np.array(sorted(keys), np.uint64))
    assert sorted(slot.tolist()) == list(range(len(keys)))
    assert sum(int(np.bitwise_count(x).sum()) for x in levels) <= len(keys)


def shards_of(terms, n):
    """Shards of a language as the query builds them."""
    terms = pa.array(sorted(terms), pa.string())
    place = divergence.term_hashes(terms) % np.uint64(n)
    rows = [{"lang": "x", "shard": k, "terms": terms.filter(pa.array(place == k)).to_pylist()} for k in range(n)]
    batch = pa.RecordBatch.from_pylist([r for r in rows if r["terms"]])
    assert batch.num_rows == n
    built = [r for b in divergence._build(iter([batch])) for r in b.to_pylist()]
    stored = [t.encode() for r in built for t in r["terms"]]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in stored])])
    return [t.decode() for t in stored], divergence.Shards([r["sizes"] for r in built], b"".join(r["bits"] for r in built), [len(r["terms"]) for r in built], b"".join(stored), offsets)


@pytest.mark.parametrize("bits", [64, 6])
def test_find_compares_the_stored_keys(monkeypatch, bits):
    own = divergence.term_hashes
    if bits < 64:  # many terms of one hash
        monkeypatch.setattr(divergence, "term_hashes", lambda terms: own(terms) >> np.uint64(64 - bits))
    kept = {f"é{k * k}w" for k in range(700)}
    order, shards = shards_of(kept, 5)
    assert set(order) == kept
    asked = [*sorted(kept), *(f"é{k}w" for k in range(2_000)), "other"]
    got = shards.find(pa.array(asked, pa.large_string()))
    assert [order[k] if k >= 0 else None for k in got.tolist()] == [t if t in kept else None for t in asked]


@given(st.integers(1, 9 * 10**15), st.data())
@settings(deadline=None)
def test_shares_are_exact(total, data):
    count = data.draw(st.integers(0, total))
    assert divergence.parts_of(np.array([count]), np.array([total])).tolist() == [1 + 10**9 * count // total]


@pytest.fixture(scope="module")
def rows():
    r = np.random.default_rng(5)
    words = [f"{a}{b}" for a in ("Wort", "été", "x", "Y", "zoo") for b in ("", "er", "ß", "一二")]
    out = []
    for k in range(240):
        text = " ".join(r.choice(words, r.integers(0, 30), p=np.arange(1, 21) / 210).tolist())
        out.append((text, ["de", "fr", None, ""][k % 4], [None, "a", "b", "c"][k // 4 % 4]))
    out += [(None, "de", "d"), ("", "it", "a"), ("rare words only", "it", "b"), ("123 ---", "de", "é"), ("wort " * 30_000, "de", "z"), ("one", "xx", "alone")]
    return out + out[:20]


def frame(spark, rows):
    return spark.createDataFrame([(k % 9 or None, *r, "a", "b", "c", "d", "e") for k, r in enumerate(rows)], SCHEMA)


def test_against_counting(spark, rows, monkeypatch):
    docs, want = frame(spark, rows), plainly(rows)
    assert {part for _, _, part, *_ in want} == {"pair", "term"}
    got = divergence.source_divergence(docs)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert answers(got) == want
    monkeypatch.setattr(divergence, "SHARD", 3)
    monkeypatch.setattr(divergence, "CELLS", 10)
    monkeypatch.setattr(divergence, "HELD_BYTES", 200)
    monkeypatch.setattr(divergence, "TEXT_BYTES", 500)
    monkeypatch.setattr(divergence, "GROUPS", 0)
    assert answers(divergence.source_divergence(docs.repartition(3))) == want
    monkeypatch.setattr(divergence, "BROADCAST_BYTES", 0)
    assert answers(divergence.source_divergence(docs)) == want


def test_no_rows(spark, rows):
    assert divergence.source_divergence(frame(spark, rows).where("false")).collect() == []
    few = [("a few words", "en", "a"), ("and others", "en", "b"), (None, None, None)]
    assert answers(divergence.source_divergence(frame(spark, few))) == plainly(few) == {("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)}
