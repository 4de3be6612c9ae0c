import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from onomata.operators.detect import Detection, count_entities, detect_entities, entity_counts
from onomata.sources.dictionary import dictionary_from_rows

DICT = [
    ("ProgrammingLanguage", "Java"), ("ProgrammingLanguage", "JavaScript"), ("ProgrammingLanguage", "Scala"),
    ("ProgrammingLanguage", "C++"), ("Place", "New York"), ("Person", "Berners-Lee"),
    ("Place", "THAN"), ("Place", "Than"), ("Place", "THAN"), ("Place", "Berkeley"), ("University", "Berkeley"),
]


def posts(spark, texts):
    return spark.createDataFrame([(i, "f", t, "") for i, t in enumerate(texts)],
                                 "post_id bigint, feed string, title string, selftext string")


def found(spark, text, match="token", strategy="auto"):
    d = dictionary_from_rows(spark, DICT)
    m = detect_entities(posts(spark, [text]), d, match=match, strategy=strategy)
    return sorted((r["entity_type"], r["entity_name"]) for r in m.collect())


@pytest.mark.parametrize("strategy", ["broadcast", "shuffle"])
def test_token_rules(spark, strategy):
    assert found(spark, "I like JavaScript", strategy=strategy) == [("ProgrammingLanguage", "JavaScript")]
    assert found(spark, "ScalaTest and Scala, here", strategy=strategy) == []
    assert found(spark, "C++ and Berners-Lee", strategy=strategy) == [("Person", "Berners-Lee"),
                                                                      ("ProgrammingLanguage", "C++")]
    assert found(spark, "java JAVA Java", strategy=strategy) == [("ProgrammingLanguage", "Java")]
    assert found(spark, "  New York  ", strategy=strategy) == []
    assert found(spark, "Scala Java", strategy=strategy) == []  # NBSP does not separate words
    assert found(spark, "\tScala\n", strategy=strategy) == [("ProgrammingLanguage", "Scala")]
    assert found(spark, "java scala", strategy=strategy) == []


def test_multiplicity_case_variants_and_shared_names(spark):
    assert found(spark, "than") == [("Place", "THAN"), ("Place", "THAN"), ("Place", "Than")]
    assert found(spark, "berkeley") == [("Place", "Berkeley"), ("University", "Berkeley")]


def test_phrase_mode(spark):
    assert found(spark, "Trip to New York, then (Scala).", match="phrase") == [
        ("Place", "New York"), ("ProgrammingLanguage", "Scala")]
    assert found(spark, "ScalaTest newyork", match="phrase") == []


def test_counts_same_for_both_strategies(spark):
    d = dictionary_from_rows(spark, DICT)
    p = posts(spark, ["Java than", "java Than", "nothing", "Scala THAN than"])
    a = sorted(tuple(r) for r in entity_counts(p, d, strategy="broadcast").collect())
    b = sorted(tuple(r) for r in entity_counts(p, d, strategy="shuffle").collect())
    c = sorted(tuple(r) for r in count_entities(detect_entities(p, d)).collect())
    assert a == b == c
    assert ("Place", "THAN", 6) in a


def test_broadcast_past_bound_refused(spark, monkeypatch):
    import onomata.plans.strategy as S

    d = dictionary_from_rows(spark, [("Person", "Turing"), ("Person", "Knuth")])
    monkeypatch.setattr(S, "BROADCAST_MAX_ROWS", 1)
    with pytest.raises(ValueError):
        S.choose_join(S.DictionaryShape(2, 10, 1), "broadcast")
    assert S.choose_join(S.DictionaryShape(2, 10, 1), "auto") == "shuffle"
    assert Detection(d).strategy in ("broadcast", "shuffle")


def _model(texts, dictionary):
    """Plain-Python statement of the token rule: document frequency per dictionary line."""
    out = {}
    for t in texts:
        words = set(re.split(r"[ \t\n\x0b\f\r]+", t.lower()))
        for etype, name in dictionary:
            if name.lower() in words:
                out[(etype, name)] = out.get((etype, name), 0) + 1
    return out


WORDS = st.sampled_from(["java", "Java", "scala", "C++", "than", "THAN", "x", "y", "New", "York", "", "Scala,"])
SEPS = st.sampled_from([" ", "\t", "\n", "  ", " "])


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(WORDS, SEPS), max_size=8), min_size=1, max_size=6))
def test_counts_match_python_model(spark, docs):
    texts = ["".join(w + s for w, s in doc) for doc in docs]
    d = dictionary_from_rows(spark, DICT)
    p = spark.createDataFrame([(i, "f", t, "") for i, t in enumerate(texts)],
                              "post_id bigint, feed string, title string, selftext string")
    got = {(r["entity_type"], r["entity_name"]): r["n"] for r in entity_counts(p, d).collect()}
    # title + " " + "" is what gets tokenised
    assert got == _model([t + " " for t in texts], DICT)


def test_shuffled_join_with_a_word_in_every_post(spark, monkeypatch):
    """Past the bound and past the key list: terms are shuffled, the empty one is not among them."""
    import onomata.operators.detect as D
    from onomata.plans.strategy import physical_plan

    monkeypatch.setattr(D, "literal_keys", lambda keyed, shape: None)
    texts = [f"the w{i} than" if i % 3 else f"the w{i}" for i in range(300)]
    p = posts(spark, texts)
    d = dictionary_from_rows(spark, DICT + [("Person", "The"), ("Person", "w7")])
    det = Detection(d, strategy="shuffle")
    assert det.terms(posts(spark, ["  the  "])).collect() == [("the",)]
    m = det.mentions(p)
    got = sorted((r["post_id"], r["entity_name"]) for r in m.collect())
    want = sorted(
        [(i, "The") for i in range(300)]
        + [(i, n) for i in range(300) if i % 3 for n in ("THAN", "THAN", "Than")]
        + [(7, "w7")]
    )
    assert got == want
    plan = physical_plan(m)
    assert "ShuffledHashJoin" in plan


_PUNCT = "".join(c for c in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" if c not in "+#")


def _phrase_model(texts, dictionary):
    def words(t):
        ws = [w.strip(_PUNCT) for w in re.split(r"[ \t\n\x0b\f\r]+", t.lower())]
        return [w for w in ws if w]

    out = {}
    for t in texts:
        ws = words(t)
        grams = {" ".join(ws[i:i + n]) for n in range(1, 5) for i in range(len(ws) - n + 1)}
        for etype, name in dictionary:
            key = " ".join(words(name))
            if key and key in grams:
                out[(etype, name)] = out.get((etype, name), 0) + 1
    return out


PHRASE_DICT = DICT + [("Place", "Ho Chi Minh City"), ("Technology", "MIT License"), ("Place", "York")]
PWORDS = st.sampled_from(["New", "York,", "(Ho", "Chi", "Minh", "City).", "MIT", "License.", "x", "C++", "than!"])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.tuples(PWORDS, SEPS), max_size=10), min_size=1, max_size=5))
def test_phrase_counts_match_model_with_and_without_profile(spark, docs):
    texts = ["".join(w + s for w, s in doc) for doc in docs]
    d = dictionary_from_rows(spark, PHRASE_DICT)
    p = posts(spark, texts)
    bounded = Detection(d, "phrase", "broadcast")
    assert bounded.index is not None and 4 in bounded.shape.lengths
    a = {(r["entity_type"], r["entity_name"]): r["n"] for r in bounded.counts(p).collect()}
    b = {(r["entity_type"], r["entity_name"]): r["n"] for r in Detection(d, "phrase", "shuffle").counts(p).collect()}
    assert a == b == _phrase_model(texts, PHRASE_DICT)


def test_a_long_phrase_builds_its_own_length_only(spark):
    words = [f"w{i}" for i in range(300)]
    d = dictionary_from_rows(spark, [("Place", " ".join(words)), ("Place", "a b")])
    p = posts(spark, ["x a b " + " ".join(words) + " y", "a c b"])
    for strategy in ("broadcast", "shuffle"):
        det = Detection(d, "phrase", strategy)
        assert det.shape.lengths == (2, 300)
        assert {(r["entity_name"][:3], r["n"]) for r in det.counts(p).collect()} == {("a b", 1), ("w0 ", 1)}


def test_shuffled_terms_of_a_small_dictionary_are_matches(spark):
    d = dictionary_from_rows(spark, [("Place", "Than")])
    p = posts(spark, ["one two three than", "four five"])
    assert Detection(d, strategy="shuffle").terms(p).count() == 1


def test_an_unknown_type_falls_back(spark):
    assert dictionary_from_rows(spark, [("Alien", "x")]).first()["entity_type"] == "Person"


@pytest.mark.parametrize("held", [(200_000, 1 << 25), (2, 1 << 25), (200_000, 30)])
def test_least_runs_match_a_plain_model(spark, held):
    from onomata.scenario import least_runs

    texts = ["b a\nc b a", "b a", "", None, "a", " a  b ", "b \tx a", "é b a é", "a\x01 b", "a", "b a\nc b a"]
    want = {}
    for words in (t.replace("\n", " ").split(" ") for t in texts if t is not None):
        for i, first in enumerate(words):
            runs = [" ".join(words[i:i + n]) for n in (2, 3)]
            want[first] = [min(p) for p in zip(want.get(first, runs), runs)] if first else None
    want.pop("")
    rows = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(2)
    assert sorted(least_runs(rows, *held).collect()) == sorted((w, *v) for w, v in want.items())


def test_a_wide_dictionary_is_computed_once(spark):
    """The documents are split into the dictionary once and for the posts once, not for each use of the dictionary; what
    is sorted for it are the words of a task, not their places; and no lambda tests a phrase."""
    from onomata import queries as Q
    from onomata.plans.strategy import physical_plan

    from .conftest import SF_SMALL

    det = Detection(Q._wide_phrases(spark, SF_SMALL), "phrase", "shuffle", stage_keys=True)
    assert {f.split("/")[-2].split("-")[0] for f in det.keyed.inputFiles()} == {"keys"}
    assert "explode(transform" not in physical_plan(Q._wide_phrases(spark, SF_SMALL)).lower()
    posts = Q._kept_posts(spark, SF_SMALL)
    for rows in (det.counts(posts), det.terms(posts, ("post_id",))):
        plan = physical_plan(rows).split("Subqueries")[0]
        assert "namedlambda" not in plan and "shiftright(xxhash64(lambda" not in plan
    plain = Detection(Q._wide_phrases(spark, SF_SMALL), "phrase", "broadcast")
    assert sorted(det.counts(posts).collect()) == sorted(plain.counts(posts).collect())
    det.release()
    assert not det._staged


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from(list("aB+#-_.'(é\U0001d400İ \t\n\x0b\x85 ")), max_size=20), min_size=1, max_size=6))
def test_phrase_words_stripped_at_once_as_one_by_one(spark, texts):
    from pyspark.sql import functions as F

    from onomata.functions.text import phrase_words, strip_edge_punct, word_tokens

    one_by_one = F.filter(F.transform(word_tokens("t"), strip_edge_punct), lambda w: w != "")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(phrase_words("t").alias("a"), one_by_one.alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows)
