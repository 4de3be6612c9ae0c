"""The pipeline: each stage on what its predecessor kept, and the whole against the operators' own tests' rules."""

import collections

import corpus_pipeline as pipeline
from onomata.llm import decontam, jaccard, langid

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_their_effects(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in pipeline.STAGES] == ["language_id", "ngram_jaccard_join", "benchmark_decontamination", "mixing", "sharding"]
    kept = docs
    seen = {}
    for name, stage in pipeline.STAGES:
        kept = stage(spark, kept, SF).cache()
        seen[name] = kept
        if name != "sharding":
            assert kept.columns == docs.columns

    ids = {name: [r["doc_id"] for r in df.select("doc_id").collect()] for name, df in seen.items()}
    everything = {r["doc_id"]: r["text"] for r in docs.collect()}
    languages = {r["doc_id"]: r for r in langid.language_report(docs).collect()}
    assert sorted(ids["language_id"]) == sorted(k for k, r in languages.items() if r["lang_pred"] != "und")

    near = {r["doc_id"]: r["class_id"] for r in jaccard.near_duplicates(seen["language_id"]).collect()}
    assert sorted(ids["ngram_jaccard_join"]) == sorted(set(near.values()))

    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    dirty = {r["doc_id"] for r in decontam.contamination_report(docs, bench).collect() if r["contaminated"]}
    assert set(ids["benchmark_decontamination"]) == set(ids["ngram_jaccard_join"]) - dirty

    copies = collections.Counter(ids["mixing"])
    assert set(copies) <= set(ids["benchmark_decontamination"]) and max(copies.values()) == 2
    words = lambda k: len(everything[k].split())
    total = sum(words(k) for k in ids["benchmark_decontamination"])
    taken = sum(words(k) * n for k, n in copies.items())
    assert 1.5 * total - max(map(words, everything)) <= taken <= 1.5 * total

    assert sorted(ids["sharding"]) == sorted(ids["mixing"])
    slots = collections.defaultdict(list)
    for r in seen["sharding"].collect():
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) <= set(range(40))


def test_run_writes_and_reads_every_stage(spark):
    rows = pipeline.run(spark, SF)
    assert rows.columns == ["doc_id", "text", "lang", "source", "n_chars", "shard", "slot"]
    again = pipeline.run(spark, SF)
    key = ["doc_id", "shard"]
    assert sorted(map(tuple, rows.select(key).collect())) == sorted(map(tuple, again.select(key).collect()))
