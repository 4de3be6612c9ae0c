"""Spelling variants: the acceptor, the composition and the query against plain versions."""

import collections
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from onomata.llm import graph, variants

SCHEMA = "doc_id bigint, text string, word string, n string, form string, begin string"


def near(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v, strict=True)) == 1
    return len(u) + 1 == len(v) and any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def plainly(rows):
    """The contract word for word: every word against every other."""
    count = collections.Counter()
    lower = str.maketrans(variants.UPPER, variants.LOWER)
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    n = {w: k for w, k in count.items() if len(w) >= 6 and k >= 5}
    by_length = collections.defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    links = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if near(w, v)] for w in n}
    form = {}
    for w, some in links.items():
        best = min(some, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], len(links[w]), n[form[w]] if form[w] is not None else None)
    return out


def answers(df):
    rows = df.collect()
    assert len({r["word"] for r in rows}) == len(rows)
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in rows}


@given(st.sets(st.text("abé", max_size=6), max_size=60))
@settings(max_examples=200, deadline=None)
def test_composition_lists_each_near_pair_once(words):
    pairs = [tuple(sorted(p)) for p in variants.Acceptor(sorted(words)).near_pairs()] if words else []
    assert len(set(pairs)) == len(pairs)
    assert set(pairs) == {(u, v) for u in words for v in words if u < v and near(u, v)}


def test_acceptor_is_minimal():
    words = sorted(f"{a}{b}{c}" for a in "abcd" for b in "abcd" for c in ("ing", "ed", ""))
    assert len(variants.Acceptor(words).edges) == 7
    long = ["a" * 30_000, "a" * 30_001, "b" * 30_000]
    assert list(variants.Acceptor(long).near_pairs()) == [("a" * 30_000, "a" * 30_001)]


@pytest.mark.parametrize("most", [2, 7, 40, 20_000])
def test_parts_of_any_size_give_the_same(spark, most):
    words = sorted({a + b + c + d for a in ("", "x", "y") for b in ("part", "pard", "port") for c in ("", "s", "ss") for d in ("word", "ward", "é")})
    n = {w: 5 + k * k % 97 for k, w in enumerate(words)}
    got = variants.near_words(spark.createDataFrame(list(n.items()), "word string, n bigint"), most=most).collect()
    want = {w: [v for v in words if near(w, v)] for w in words}
    assert {r["word"]: r["n_near"] for r in got} == {w: len(v) for w, v in want.items() if v}
    for r in got:
        assert (-r["form_n"], r["form"]) == min((-n[v], v) for v in want[r["word"]])


def test_few_words_of_many_letters(spark):
    words = {"a" * 5_000: 9, "a" * 4_999 + "b": 6, "a" * 5_001: 5, "c" * 50: 8}
    got = variants.near_words(spark.createDataFrame(list(words.items()), "word string, n bigint"), points=100).collect()
    assert {r["word"]: r["n_near"] for r in got} == {"a" * 5_000: 2, "a" * 4_999 + "b": 1, "a" * 5_001: 1}


def test_against_every_pair(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = plainly(rows)
    assert len(want) > 300 and any(w[0] for w in want.values())
    assert answers(variants.spelling_variants(docs)) == want


def test_awkward_rows(spark):
    long = "zebra " * 3 + "lengthy" * 2_000 + " " + "lengthy" * 1_999 + "lengthx"
    rows = [(None, None), (1, ""), (2, "12 34"), (None, "Colours COLOURS colours"), (3, "colours colours colour colour colour colour colour")]
    rows += [(k, "résumés résumés ÉtÉtÉt resumés") for k in range(40, 46)] * 2 + [(k, long) for k in range(60, 66)]
    rows += [(k, "chained chaine chainedd" + " chained" * 40 + " chainee" * 30 + " chaine" * 2) for k in range(90, 95)]
    df = spark.createDataFrame([(*r, "x", "y", "z", "q") for r in rows], SCHEMA)
    got = variants.spelling_variants(df)
    assert answers(got) == plainly(rows)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert variants.spelling_variants(df.where("false")).collect() == []


def test_forms_lead_to_their_last(spark):
    chain = [(f"word{k:03}", f"word{k + 1:03}") for k in range(40)] + [("other", "word020")]
    got = {r["node"]: r["root"] for r in graph.follow(spark.createDataFrame(chain, "node string, root string")).collect()}
    assert got == {w: "word040" for w, _ in chain}
