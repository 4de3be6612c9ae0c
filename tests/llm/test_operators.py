"""The operators on Spark: contracts, brute force on small inputs, and awkward rows."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from onomata.llm import chat, decontam, graph, jaccard, langid, lines, mixing, neighbours, pii, quality, sharding
from onomata.llm import queries as registered
from onomata.llm.common import learns

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    held = {t: spark.read.parquet(f"{SF}/{t}.parquet").cache() for t in ("documents", "labels", "benchmark", "conversations")}
    yield held
    # A cached table would replace the scans in the plans of later tests.
    for df in held.values():
        df.unpersist()


def awkward_rows():
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    return [
        (None, None, None, None, None),
        (1, "", "en", "a", 0),
        (2, " \n\t ", None, "", 4),
        (3, long, "en", "a", len(long)),
        (4, "the same text twice in a row of words", "en", "b", 1),
        (4, "the same text twice in a row of words", "en", "b", 1),
        (5, "the same text twice in a row of words", "de", None, 1),
        (6, "1234 5678", "xx", "b", 9),
        (7, "é", "fr", "b", 1),
        (None, "a text without any number to call it by", "en", "b", 5),
    ]


@pytest.fixture(scope="module")
def awkward(spark):
    clash = ("quality", "matches", "language", "vote", "personal", "shard", "slot", "key", "salt", "bucket", "number", "copy", "time", "order", "dropped", "Kept")
    return spark.createDataFrame(awkward_rows(), SCHEMA).select("*", *(F.lit(k).alias(c) for k, c in enumerate(clash)))


@pytest.fixture(scope="module")
def nothing(awkward):
    return awkward.where("false")


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_quality_rules(spark, tables):
    rows = by_id(quality.quality_rules(tables["documents"], tables["labels"]))
    assert len(rows) == tables["documents"].count()
    labels = {r["doc_id"]: r for r in tables["labels"].collect()}
    good = [rows[k] for k, r in labels.items() if r["quality"] == 1 and not r["toxic"]]
    bad = [rows[k] for k, r in labels.items() if r["quality"] == 0]
    assert all(r["kept"] for r in good if not r["base_failed"])
    assert not any(r["kept"] for r in bad)


def test_log_ratios_by_counting(spark):
    docs = spark.createDataFrame([(1, "abcdab"), (2, "abcdzz"), (3, None)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0), (1, 1, 0)], "doc_id bigint, quality int, toxic int")
    ratio = quality.log_ratios(docs, labels)
    size = 1 << quality.BITS
    code = int.from_bytes(b"abcd", "big") * 2654435761 % 2**32 >> 32 - quality.BITS
    import math

    assert ratio[code] == pytest.approx(math.log(2 / (size + 3)) - math.log(3 / (size + 6)), abs=1e-5)


def test_mixing(spark, tables):
    docs = tables["documents"]
    report = mixing.mixing_report(docs)
    rows, sources = by_id(report), {r["doc_id"]: r["source"] for r in docs.collect()}
    per = collections.defaultdict(lambda: [0, 0, 0, 0])
    for k, r in rows.items():
        x = per[sources[k]]
        x[0], x[1], x[2], x[3] = r["target"], r["source_size"], x[2] + r["taken"], max(x[3], r["size"])
        assert r["taken"] in (0, r["size"], 2 * r["size"])
    assert sum(x[0] for x in per.values()) == pytest.approx(1.5 * sum(x[1] for x in per.values()))
    for target, size, taken, largest in per.values():
        assert abs(taken - target) <= largest and target <= 2 * size
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    copies = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert copies == {k: r["taken"] // r["size"] for k, r in rows.items() if r["taken"]}
    assert by_id(mixing.mixing_report(docs.repartition(7))) == rows


def level_plainly(sizes, budget):
    """Targets by giving excess back until none is above its limit."""
    weights = [(5, 2, 1)[k % 3] for k in range(len(sizes))]
    capped = set()
    while True:
        free = [k for k in range(len(sizes)) if k not in capped]
        rest = budget - sum(2 * sizes[k] for k in capped)
        share = {k: rest * weights[k] / sum(weights[j] for j in free) for k in free}
        over = {k for k in free if share[k] > 2 * sizes[k]}
        if not over:
            return [2 * sizes[k] if k in capped else share[k] for k in range(len(sizes))]
        capped |= over


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 100, 3, 50, 2], [0, 5], [7], [0, 0]])
def test_targets_by_repeated_sharing(spark, sizes):
    totals = spark.createDataFrame([(f"={k}", f"s{k}", s) for k, s in enumerate(sizes)], "src string, source string, source_size bigint")
    got = {r["src"]: r["target"] for r in mixing.source_targets(totals).collect()}
    assert [got[f"={k}"] for k in range(len(sizes))] == pytest.approx(level_plainly(sizes, 1.5 * sum(sizes)))


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_sharding(spark, tables, shards):
    docs = tables["documents"].select("doc_id", "text")
    rows = by_id(sharding.sharding_report(docs, shards))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    groups = collections.Counter()
    where = {}
    for k, r in rows.items():
        key = hashlib.md5(("=" + texts[k]).encode()).hexdigest()
        assert where.setdefault(key, r["shard"]) == r["shard"]
        groups[key] += len(texts[k].encode()) + 16
        assert r["size"] == len(texts[k].encode()) + 16
    filled, slots = collections.Counter(), collections.defaultdict(list)
    for r in rows.values():
        filled[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The plain version: large groups by themselves, then the smallest capacity by trying the greedy filling.
    total, left, own = sum(groups.values()), shards, []
    for key, size in sorted(groups.items(), key=lambda x: (-x[1], x[0])):
        if left == 1 or size * left <= total:
            break
        own.append(key)
        total, left = total - size, left - 1
    rest = [(k, groups[k], 1) for k in sorted(groups) if k not in own]
    low, high = max(s for _, s, _ in rest), total
    while low < high:
        middle = (low + high) // 2
        if sharding.greedy(rest, middle, False)[0] <= left:
            high = middle
        else:
            low = middle + 1
    assert max(filled[s] for s in filled if s >= len(own)) == low
    assert sharding.plan(spark.createDataFrame(list(groups.items()), "key string, bytes bigint"), shards)[2] == low


def test_sharding_a_group_with_a_third_of_all_rows(spark):
    docs = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "copy").otherwise(F.concat(F.lit("t"), "id")).alias("text")).withColumnRenamed("id", "doc_id")
    rows = by_id(sharding.sharding_report(docs, 10))
    assert {r["shard"] for k, r in rows.items() if k % 3 == 0} == {0}
    filled = collections.Counter()
    for r in rows.values():
        filled[r["shard"]] += r["size"]
    assert len(filled) == 10 and max(v for s, v in filled.items() if s) < 1.1 * min(v for s, v in filled.items() if s)


def near_plainly(texts, similarity=0.8):
    """(class, copy, links) of each id, by comparing all pairs."""
    sets = {}
    for k, t in texts.items():
        w = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        sets[k] = frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) or frozenset([tuple(w)] if w else [])
    like = lambda a, b: a == b or (a and b and len(a & b) >= similarity * len(a | b))
    near = {k: {j for j in sets if like(sets[k], sets[j])} for k in sets}
    out = {}
    for k in sets:
        group, queue = {k}, [k]
        while queue:
            more = near[queue.pop()] - group
            group |= more
            queue += more
        out[k] = (min(group), min(j for j in sets if sets[j] == sets[k]), len({texts[j] for j in near[k]} - {texts[k]}))
    return out


def edited(words, rng, n):
    out = list(words)
    for k in rng.sample(range(len(out)), n):
        out[k] = f"e{rng.randint(0, 9999)}"
    return " ".join(out)


def test_near_duplicates_against_all_pairs(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard, "BLOCK", 8)  # several blocks for the large group
    rng = random.Random(8)
    texts = {}
    for g in range(30):
        words = [f"v{rng.randint(0, 5000)}" for _ in range(rng.choice([3, 6, 80, 300]))]
        for _ in range(rng.choice([1, 2, 3, 40 if g == 3 else 1])):
            texts[len(texts)] = edited(words, rng, rng.choice([0, 0, 1, 2, min(3, len(words))]))
    shared = [f"s{k}" for k in range(100)]
    for _ in range(60):  # a passage that many share, not enough to be near copies
        texts[len(texts)] = " ".join(shared + [f"q{rng.randint(0, 5000)}" for _ in range(100)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["copy_id"], r["n_links"]) for r in jaccard.near_duplicates(docs).collect()}
    want = near_plainly(texts)
    assert got == want
    kept = sorted(r["doc_id"] for r in jaccard.keep_one(docs).collect())
    assert kept == sorted({c for c, _, _ in want.values()})


def test_large_nodes_are_split_and_blocked(spark, monkeypatch):
    import random

    monkeypatch.setattr(jaccard, "SMALL", 6)
    monkeypatch.setattr(jaccard, "DEPTH", 2)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = random.Random(1)
    words = [f"v{k}" for k in range(200)]
    texts = {k: edited(words, rng, rng.choice([1, 2])) for k in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    got = {r["doc_id"]: (r["class_id"], r["copy_id"], r["n_links"]) for r in jaccard.near_duplicates(docs).collect()}
    assert got == near_plainly(texts)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(64)] + [(100, 101), (7, 7)], "u bigint, v bigint")
    got = {r["node"]: r["root"] for r in graph.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 65)} | {101: 100}


def test_conversations_with_very_long_texts_and_clashing_columns(spark):
    long = "say </s> it [INST] again | " * 40_000
    rows = [(1, 1, "assistant", long, "x", "y", "z"), (1, 0, "user", "[/INST]" * 50_000, "x", "y", "z")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, turns string, formatted string, spans string")
    (got,) = chat.conversation_report(df).collect()
    assert (got["n_turns"], got["loss_chars"]) == (2, len(long))
    assert got["loss_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert got["turns_sha256"] == hashlib.sha256(f"user\n{rows[1][3]}\nassistant\n{long}\n".encode()).hexdigest()


@pytest.mark.parametrize("operator", ["keep_one", "drop_lines"])
def test_columns_of_the_operators_own_names(spark, operator):
    names = ("__text_key", "__doc_id", "__wanted", "__id", "__key", "text_key", "kept_id", "kept_key", "own_id", "own_key", "dropped", "key", "root", "class")
    rows = [(k, "the same words in this line here\nand more", *("v" for _ in names)) for k in range(4)] + [(9, None, *("w" for _ in names))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, " + ", ".join(f"{n} string" for n in names))
    out = {"keep_one": jaccard.keep_one, "drop_lines": lines.drop_lines}[operator](df)
    assert out.columns == df.columns
    ids = sorted(r["doc_id"] for r in out.collect())
    assert ids == ([0, 9] if operator == "keep_one" else [0, 1, 2, 3, 9])


def test_decontamination_drops_documents_with_passages(spark, tables, monkeypatch):
    docs, bench = tables["documents"], tables["benchmark"]
    want = by_id(decontam.contamination_report(docs, bench))
    kept = {r["doc_id"] for r in decontam.decontaminate(docs, bench).collect()}
    assert kept == {k for k, r in want.items() if not r["contaminated"]} and 0 < len(kept) < len(want)
    # The benchmark in several blocks and passes, and a task's documents in several parts.
    monkeypatch.setattr(decontam, "BLOCK_BYTES", 1000)
    monkeypatch.setattr(decontam, "BLOCKS", 3)
    monkeypatch.setattr(decontam, "HELD_BYTES", 1)
    assert by_id(decontam.contamination_report(docs, bench.repartition(3))) == want


def test_recurring_lines(spark):
    rows = [(k, f"user {k} logged in at host{k} from port alpha{'xyz'[k % 3]}\nown words of {' '.join(chr(97 + (k * 7 + j) % 26) * 2 for j in range(6))}") for k in range(8)]
    rows += [(10, "All rights reserved.\nsomething else"), (11, "All rights reserved.\n"), (12, "x\nAll rights reserved."), (12, "x\nAll rights reserved."), (13, "twice\ntwice\ntwice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = collections.defaultdict(list)
    for r in lines.line_report(docs).collect():
        got[r["doc_id"]].append((r["n_lines"], r["n_dropped"], list(r["dropped"])))
    assert all(got[k] == [(2, 1, [0])] for k in range(8))
    assert got[10] == [(2, 1, [0])] and got[11] == [(1, 1, [0])] and got[12] == [(2, 1, [1])] * 2 and got[13] == [(3, 0, [])]
    clean = {r["doc_id"]: r["text"] for r in lines.drop_lines(docs).collect()}
    assert clean[10] == "something else" and clean[12] == "x" and clean[11] == "" and clean[13] == "twice\ntwice\ntwice"


def test_large_leaves_in_parts(spark, monkeypatch):
    monkeypatch.setattr(lines, "PART", 10)
    names = [a + b for a in "abcdefgh" for b in "klmnopqr"]
    docs = spark.createDataFrame([(k, f"dear valued customer {n} we write to you again today") for k, n in enumerate(names)], "doc_id bigint, text string")
    assert all(r["n_dropped"] == 1 for r in lines.line_report(docs).collect())


@pytest.mark.parametrize(("part", "size"), [(1000, 1 << 20), (5, 1 << 20), (2, 1 << 20), (1000, 100)])
def test_templates_against_brute_force(spark, monkeypatch, part, size):
    monkeypatch.setattr(lines, "PART", part)
    monkeypatch.setattr(lines, "PART_BYTES", size)
    rng = random.Random(5)
    texts = [["to all of " + " ".join(rng.choice("abcd") for _ in range(rng.choice([1, 3, 7]))) for _ in range(rng.randint(0, 4))] for _ in range(40)]
    texts.append([f"seen in one only {x} y z u v w" for x in "klmn"])
    got = {r["doc_id"]: list(r["dropped"]) for r in lines.line_report(spark.createDataFrame([(k, "\n".join(x)) for k, x in enumerate(texts)], "doc_id bigint, text string")).collect()}
    where = [(k, line.split()) for k, x in enumerate(texts) for line in x]

    def recurring(line):
        own = line.split()
        like = {k for k, x in where if len(x) == len(own) and x[:3] == own[:3] and sum(map(str.__eq__, x, own)) >= lines.least(len(own))}
        return len(like) >= lines.DOCUMENTS

    want = {k: [i for i, line in enumerate(x) if recurring(line)] for k, x in enumerate(texts)}
    assert got == want and want[40] == [] and 0 < sum(map(len, want.values())) < sum(map(len, texts))


def test_personal_data(spark, tables):
    docs = tables["documents"].select("doc_id", "text")
    rows = by_id(pii.personal_data_report(docs))
    for r in docs.collect():
        base = pii.base_spans(r["text"])
        got = rows[r["doc_id"]]
        assert got["base_sha256"] == hashlib.sha256(pii.told(base).encode()).hexdigest()
        assert set(pii.told(base).split(",")) <= set(got["spans"].split(","))
        assert [got[f"n_{k}"] for k in pii.KINDS] == [sum(s[1] == i for s in base) for i in range(4)]


def test_quality_classifier_on_held_out_rows(spark, tables):
    docs, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = neighbours.classifier_report(docs, labels).join(labels, "doc_id").where("held_out").collect()
    good = [r["score"] for r in rows if r["quality"] == 1]
    bad = [r["score"] for r in rows if r["quality"] == 0]
    assert sum(g > b for g in good for b in bad) > 0.93 * len(good) * len(bad)
    # Labels of held-out rows change nothing.
    other = labels.withColumn("quality", F.when(learns(F.col("doc_id")), F.col("quality")).otherwise(1 - F.col("quality")))
    some = lambda x: sorted(neighbours.classifier_report(docs, x).select("doc_id", "score").collect())[:50]
    assert some(labels) == some(other)


def test_classifier_sample_has_both_labels_where_rows_repeat(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SAMPLE", 20)
    ids = [k for k in range(100) if zlib.crc32(str(k).encode()) % 4 != 2]
    text = lambda k: f"lake tree walk bird {k}" if k % 2 else f"### BUY!! $$$ NOW!! {k}"
    docs = spark.createDataFrame([(k, text(k)) for k in ids for _ in range(2)] + [(ids[0], text(ids[0]))] * 50, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in ids], "doc_id bigint, quality int")
    space = neighbours.learn(docs, labels)
    assert sorted(space.labels.tolist()) == [0.0] * 10 + [1.0] * 10
    scores = {r["doc_id"]: r["score"] for r in neighbours.classifier_report(docs, labels).collect()}
    assert all((scores[k] > 0.9) if k % 2 else (scores[k] < 0.1) for k in ids)


def test_classifier_weights_count_all_documents(spark):
    docs = spark.createDataFrame([(0, "alpha beta"), (1, "alpha gamma"), (2, "alpha delta"), (6, None), (None, "alpha")], "doc_id bigint, text string")
    n, there = neighbours.frequencies(docs)
    assert n == 5
    want = collections.Counter()
    for r in docs.collect():
        want.update(set(neighbours.features(pa.array([r["text"]], pa.string()))[1].tolist()))
    assert {k: there[k] for k in there.nonzero()[0].tolist()} == dict(want)
    labels = spark.createDataFrame([(0, 1), (1, 0)], "doc_id bigint, quality int")
    space = neighbours.learn(docs, labels)
    plain = neighbours.FEATURES - neighbours._STYLES
    assert space.weight[:plain] == pytest.approx(np.log(6 / (1 + there[:plain])) + 0.1, abs=1e-5)


def test_language_id_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) > 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_a_text_in_six_languages_is_kept(spark):
    rng = random.Random(5)
    speak = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop", "ee": "qrst", "ff": "uvwx"}
    words = lambda lang, n: " ".join("".join(rng.choice(speak[lang]) for _ in range(4)) for _ in range(n))
    ids = [k for k in range(40) if zlib.crc32(str(k).encode()) % 4 != 2]
    rows = [(k, words(lang, 2000), lang) for k, lang in zip(ids, speak)]
    rows += [(1000, " ".join(words(lang, 50) for lang in speak), None), (1001, "12 34", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    found = {r["doc_id"]: r for r in langid.language_report(docs).collect()}
    assert sorted(found[1000]["languages"]) == list(speak) and found[1000]["score"] < 0.25
    assert sorted(r["doc_id"] for r in langid.keep_identified(docs).collect()) == sorted([*ids[:6], 1000])


def test_conversations(spark, tables):
    rows = {r["conv_id"]: r for r in chat.conversation_report(chat.with_probe(tables["conversations"])).collect()}
    turns = collections.defaultdict(list)
    for r in tables["conversations"].collect():
        turns[r["conv_id"]].append((r["turn"], r["role"], r["text"]))
    said = "</s>[INST] ok [/INST]"
    turns[-1] = [(0, "user", said), (1, "assistant", said)]
    assert rows.keys() == turns.keys()
    for k, own in turns.items():
        own.sort()
        loss = "".join(t for _, r, t in own if r == "assistant")
        whole = "".join(f"{r}\n{t}\n" for _, r, t in own)
        got = rows[k]
        assert (got["n_turns"], got["loss_chars"]) == (len(own), len(loss))
        assert got["turns_sha256"] == hashlib.sha256(whole.encode()).hexdigest()
        assert got["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_with_awkward_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "user", "a"), (None, 2, "assistant", "b"), (2, 1, "assistant", "")]
    got = {r["conv_id"]: r for r in chat.conversation_report(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")).collect()}
    assert {k: (r["n_turns"], r["loss_chars"]) for k, r in got.items()} == {1: (3, 0), None: (1, 1), 2: (1, 0)}
    assert chat.conversation_report(spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")).count() == 0


KEEPS_COLUMNS = {
    "language": langid.keep_identified,
    "near": jaccard.keep_one,
    "benchmark": lambda d: decontam.decontaminate(d, d.sparkSession.createDataFrame([(1, "same text twice"), (None, "x"), (2, None), (3, "")], "item_id bigint, text string")),
    "mix": mixing.mix,
    "lines": lines.drop_lines,
}


@pytest.mark.parametrize("name", KEEPS_COLUMNS)
def test_awkward_rows_keep_their_columns(awkward, nothing, name):
    out = KEEPS_COLUMNS[name](awkward)
    assert out.columns == awkward.columns
    ids = [r["doc_id"] for r in out.collect()]
    if name == "language":
        assert sorted(map(str, ids)) == ["3", "4", "4", "5", "7", "None"]
    if name == "near":
        assert sorted(map(str, ids)) == ["1", "3", "4", "6", "7", "None"]
    if name == "benchmark":
        assert sorted(map(str, ids)) == ["1", "2", "3", "6", "7", "None", "None"]
    assert KEEPS_COLUMNS[name](nothing).count() == 0


REPORTS = {
    "quality": lambda d: quality.quality_rules(d, _labels(d)),
    "mixing": mixing.mixing_report,
    "sharding": sharding.sharding_report,
    "near": jaccard.near_duplicates,
    "benchmark": lambda d: decontam.contamination_report(d, d.sparkSession.createDataFrame([], "item_id bigint, text string")),
    "lines": lines.line_report,
    "personal": pii.personal_data_report,
    "classifier": lambda d: neighbours.classifier_report(d, _labels(d)),
    "language": langid.language_report,
}


def _labels(docs):
    return docs.sparkSession.createDataFrame([(3, 1, 0), (4, 0, None), (None, 1, 1), (4, 0, 0), (99, 1, 0)], "doc_id bigint, quality int, toxic int")


@pytest.mark.parametrize("name", REPORTS)
def test_awkward_rows_each_get_a_row(awkward, nothing, name):
    rows = REPORTS[name](awkward).collect()
    assert sorted(str(r["doc_id"]) for r in rows) == sorted(str(r[0]) for r in awkward_rows())
    assert REPORTS[name](nothing).count() == 0


def test_shard_keeps_all_columns(awkward, nothing):
    out = sharding.shard(awkward, 4)
    assert out.columns == [*awkward.columns, "_shard", "_slot"]
    rows = out.collect()
    assert len(rows) == awkward.count()
    for s in {r["_shard"] for r in rows}:
        assert sorted(r["_slot"] for r in rows if r["_shard"] == s) == list(range(sum(r["_shard"] == s for r in rows)))
    assert sharding.shard(nothing).count() == 0


def test_every_number_is_registered_once():
    names = list(registered.queries())
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert set(registered.oracle_sql()) <= set(names)


@pytest.mark.parametrize("name", sorted(registered.oracle_sql()))
def test_sql_gives_the_same_rows(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got = registered.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(columns)} FROM ({registered.oracle_sql()[name]})").fetchall()
    assert sorted(tuple(r) for r in got.select(columns).collect()) == sorted(want)
