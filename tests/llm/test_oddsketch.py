"""Odd sketches: estimates, the steps and the query against comparing every two sets; the graph helper."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onomata.llm import graph, oddsketch

SCHEMA = "doc_id bigint, text string, lang string, label string, size string, own string, other string, text_key string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(zip(words, words[1:], strict=False)) if len(words) > 1 else frozenset(words)


def plainly(rows):
    """For each row (doc_id, text): n_shingles and the lowest doc_id that links lead to."""
    sets = [shingles(text) for _, text in rows]
    seen, out = {}, []
    classes = [s for s in dict.fromkeys(sets) if s]
    todo = set(classes)
    while todo:
        queue, group = [todo.pop()], []
        while queue:
            a = queue.pop()
            group.append(a)
            near = [b for b in todo if 100 * len(a & b) >= 80 * len(a | b)]
            todo.difference_update(near)
            queue += near
        ids = [k for (k, _), s in zip(rows, sets, strict=True) if s in group and k is not None]
        seen.update((s, min(ids, default=None)) for s in group)
    for (k, _), s in zip(rows, sets, strict=True):
        low = seen[s] if s else k
        out.append((k, len(s), low, k == low))
    return sorted(out, key=str)


def answers(df):
    return sorted((tuple(r[c] for c in ("doc_id", "n_shingles", "component_id", "kept")) for r in df.collect()), key=str)


def family(r, words, copies, most):
    base = [f"w{r.randrange(5000)}" for _ in range(words)]
    out = [" ".join(base)]
    for _ in range(copies):
        own = list(base)
        for _ in range(r.randrange(most + 1)):
            own[r.randrange(words)] = f"x{r.randrange(5000)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size", [5, 60, 140, 1_000])
@pytest.mark.parametrize("scheme", [0, 1])
def test_estimates_are_near_the_similarity(size, scheme):
    if scheme == 1 and size < oddsketch.LARGE:
        pytest.skip("no such set in this scheme")
    r = np.random.default_rng(size)
    wrong = []
    for _ in range(60):
        pool = r.integers(0, 2**64, size * 2, dtype=np.uint64)
        shared = r.integers(size // 2, size + 1)
        two = [np.unique(pool[:size]), np.unique(np.concatenate([pool[:shared], pool[size : 2 * size - shared]]))]
        gram, first = np.concatenate(two), np.array([0, len(two[0]), len(two[0]) + len(two[1])])
        sketch = oddsketch.odd_sketches(oddsketch.minhashes(gram, first, np.array([0, 1]), scheme == 1))
        true = len(np.intersect1d(*two)) / len(np.union1d(*two))
        got = float(oddsketch.estimate(np.bitwise_count(sketch[0] ^ sketch[1]).sum()))
        if true >= 0.6:
            wrong.append(got - true)
    assert wrong and np.abs(wrong).max() < 0.14 and abs(np.mean(wrong)) < 0.03
    assert oddsketch.estimate(oddsketch.differing_bits(0.9)) == pytest.approx(0.9)


def test_schemes_meet():
    assert oddsketch.LARGE <= oddsketch.SIMILARITY * oddsketch.SMALL
    assert (1 - oddsketch.SIMILARITY**oddsketch.ROWS) ** oddsketch.BANDS < 1e-6


@given(st.lists(st.text("aB \n.é", max_size=40) | st.none(), max_size=12))
@settings(deadline=None)
def test_sets_as_plainly(texts):
    gram, first = oddsketch.shingle_sets(pa.array(texts, pa.string()))
    assert np.diff(first).tolist() == [len(shingles(t)) for t in texts]
    prints = oddsketch.fingerprints(gram, first)
    assert len(set(prints)) == len({shingles(t) for t in texts})


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=50, deadline=None)
def test_tree_spans_what_is_connected(links):
    like = np.eye(31, dtype=bool)
    for a, b in links:
        like[a, b] = like[b, a] = True
    parent = oddsketch.tree(lambda k, rest: like[k, rest], 31)
    assert all(like[k, p] for k, p in enumerate(parent))
    reach = np.linalg.matrix_power(like.astype(float), 31) > 0
    top = np.arange(31)
    for _ in range(31):
        top = parent[top]
    assert ((top[:, None] == top) == reach).all()


def test_overlaps():
    r = random.Random(2)
    sets = [np.array(sorted(r.sample(range(80), r.randrange(1, 40))), np.uint64) for _ in range(20)]
    got = oddsketch.overlaps(sets[:7], sets[7:], step=16)
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[7:]] for a in sets[:7]]


@pytest.fixture(scope="module")
def rows():
    r = random.Random(11)
    texts = [t for words, copies, most in ((12, 60, 3), (30, 90, 6), (150, 80, 24), (170, 60, 20), (400, 40, 60)) for t in family(r, words, copies, most)]
    texts += [" ".join(f"u{r.randrange(400)}" for _ in range(r.randrange(1, 60))) for _ in range(60)]
    texts += [None, "", " \n\t", None, "", "One", "oNE", "one", "É", "é", "long " * 30_000 + "end", "long " * 20_000 + "END", "a b", "b a", "a b a b"]
    r.shuffle(texts)
    out = [(k, t) for k, t in enumerate(texts)] + [(None, t) for t in texts[:9]] + [(None, "an own text without an id")] * 2 + [(3, texts[3]), (4, texts[9])]
    return out + [(10_000 + k, "The Same Text for Very many rows") for k in range(200)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], SCHEMA)


@pytest.mark.parametrize("members, block", [(1024, 128), (6, 4)])
def test_against_comparing_every_two(spark, rows, monkeypatch, members, block):
    monkeypatch.setattr(oddsketch, "MEMBERS", members)
    monkeypatch.setattr(oddsketch, "BLOCK", block)
    got = oddsketch.near_components(frame(spark, rows).repartition(5))
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = plainly(rows)
    assert len({x[2] for x in want}) < len(rows) - 300 and answers(got) == want


def test_no_rows_and_no_pairs(spark, rows):
    assert oddsketch.near_components(frame(spark, rows).where("false")).collect() == []
    few = [(1, None), (2, ""), (3, "one text"), (4, "another text")]
    assert answers(oddsketch.near_components(frame(spark, few))) == plainly(few)


@given(st.lists(st.tuples(st.integers(0, 25), st.integers(0, 25)), max_size=30))
@settings(max_examples=4, deadline=None)
def test_components(spark, edges):
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    low = {x: x for e in edges for x in e}
    for _ in low:
        for a, b in edges:
            low[a] = low[b] = min(low[a], low[b])
    assert got == {x: y for x, y in low.items() if x != y}


def test_components_of_a_path_and_a_hub(spark):
    path = [(k, k + 1) for k in range(60)] + [(1000 + k, 999) for k in range(1, 300)] + [(30, 30)]
    random.Random(3).shuffle(path)
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(path, "u bigint, v bigint")).collect()}
    assert got == {**{k: 0 for k in range(1, 61)}, **{1000 + k: 999 for k in range(1, 300)}}
