"""Large groups of near copies: what is sent on stays in proportion to the texts."""

import random

from onomata.llm import jaccard, oddsketch


def near_copies(copies, others, seed=3):
    r = random.Random(seed)
    base = [f"w{r.randrange(4000)}" for _ in range(200)]
    texts = []
    for _ in range(copies):
        own = list(base)
        for _ in range(r.randrange(1, 3)):
            own[r.randrange(200)] = f"x{r.randrange(4000)}"
        texts.append(" ".join(own))
    texts += [" ".join(f"u{r.randrange(9000)}" for _ in range(60)) for _ in range(others)]
    return texts


def test_edges_of_the_join_only_connect_roots(spark, monkeypatch):
    texts = near_copies(3_000, 1_000)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    seen, own = [], jaccard._candidates

    def counted(classes, similarity, some_runs, whole):
        edges = own(classes, similarity, some_runs, whole)
        seen.append((classes.select("root").distinct().count(), edges.count()))
        return edges

    monkeypatch.setattr(jaccard, "_candidates", counted)
    rows = jaccard.near_duplicates(docs).collect()
    (classes, first), (roots, second) = seen
    assert classes > 3_500 and roots < 2_500  # most copies are connected in the first round
    assert first < 40 * classes and second < 2 * roots
    group = [r["class_id"] for r in rows if r["doc_id"] < 3_000]
    assert max(map(group.count, set(group))) > 2_900
    assert all(r["class_id"] == r["doc_id"] for r in rows if r["doc_id"] >= 3_000)


def test_links_of_labels_only_connect_labels(spark, monkeypatch):
    texts = near_copies(2_500, 500, seed=4)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6)
    seen, own = [], oddsketch.components

    def counted(edges):
        seen.append(edges.count())
        return own(edges)

    monkeypatch.setattr(oddsketch, "components", counted)
    rows = oddsketch.near_components(docs).collect()
    surely, maybe, last = seen
    assert surely < 2 * oddsketch.FIRST * len(texts) and maybe < 200 and last < 200
    group = [r["component_id"] for r in rows if r["doc_id"] < 2_500]
    assert max(map(group.count, set(group))) > 2_450
    assert all(r["kept"] for r in rows if r["doc_id"] >= 2_500)
