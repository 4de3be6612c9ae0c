from pyspark.sql import functions as F

from onomata.functions import text as T


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first()["r"]


def test_java_trim_strips_control_chars(spark):
    assert one(spark, T.java_trim("s"), "\t  Scala \n\x0b") == "Scala"
    assert one(spark, T.java_trim("s"), " x ") == " x "  # NBSP is not trimmed
    assert one(spark, T.java_trim("s"), None) is None


def test_is_not_blank(spark):
    assert one(spark, T.is_not_blank("s"), " \t\n") is False
    assert one(spark, T.is_not_blank("s"), " ") is True
    assert one(spark, T.is_not_blank("s"), "a") is True
    assert one(spark, T.is_not_blank("s"), None) is None


def test_token_set_ascii_whitespace_only(spark):
    toks = one(spark, T.token_set("s"), " Java\tJava\nSCALA, x  ")
    assert set(toks) == {"", "java", "scala, x"}


def test_phrase_words_strip_edge_punct_but_keep_plus_and_hash(spark):
    words = one(spark, T.phrase_words("s"), "(Ho Chi Minh City). C++ C# Scala, Berners-Lee! --")
    assert words == ["ho", "chi", "minh", "city", "c++", "c#", "scala", "berners-lee"]


def test_ngrams_short_arrays(spark):
    df = spark.createDataFrame([(["a", "b", "c"],), ([],), (["a"],)], "w array<string>")
    rows = [r["g"] for r in df.select(T.ngrams(F.col("w"), 2).alias("g")).collect()]
    assert rows == [["a b", "b c"], [], []]


def test_phrase_set_of_words(spark):
    df = spark.createDataFrame([(["new", "york", "new", "york"],)], "w array<string>")
    got = df.select(T.phrase_set_of_words(F.col("w"), 2).alias("g")).first()["g"]
    assert sorted(got) == sorted(["new", "york", "new york", "york new"])


def test_post_length_code_points_and_utf16(spark):
    df = spark.createDataFrame([("a\U0001F600", "bc")], "title string, selftext string")
    r = df.select(T.post_length().alias("cp"), T.post_length(utf16=True).alias("u16")).first()
    assert (r["cp"], r["u16"]) == (4, 5)


def test_describe_and_lines(spark):
    assert one(spark, T.describe(F.lit("Place"), F.col("s")), "Cordoba") == "[Place] Cordoba"
    assert one(spark, T.first_line("s"), "t\nb\nc") == "t"
    assert one(spark, T.after_first_line("s"), "t\nb\nc") == "b\nc"
    assert one(spark, T.after_first_line("s"), "only") == ""


def test_matching_set_both_forms(spark):
    df = spark.createDataFrame([(["a", "b", "a", "c", ""],)], "t array<string>")
    small = df.select(T.matching_set(F.col("t"), ("a", "c", "z")).alias("m")).first()["m"]
    many = tuple(["a", "c"] + [f"k{i}" for i in range(200)])
    big = df.select(T.matching_set(F.col("t"), many).alias("m")).first()["m"]
    assert sorted(small) == sorted(big) == ["a", "c"]
    assert sorted(df.select(T.matching_set(F.col("t")).alias("m")).first()["m"]) == ["", "a", "b", "c"]


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_LOW = "".join(chr(i) for i in range(0x21))
CHARS = st.sampled_from(list("ab #+") + ["\t", "\n", "\x0b", "\x00", "\x1f", " ", "é", " "])


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=CHARS, max_size=8), min_size=1, max_size=20))
def test_java_trim_and_blank_match_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")
    got = {r["i"]: (r["t"], r["b"]) for r in df.select("i", T.java_trim("s").alias("t"), T.is_not_blank("s").alias("b")).collect()}
    want = {i: (v.strip(_LOW), v.strip(_LOW) != "") for i, v in enumerate(values)}
    assert got == want


def test_trim_at_line_terminators(spark):
    from onomata.functions.text import java_trim

    texts = ["a \u0085", "a \u2028", "a \u2029", "a \n", "\x01 a\x00"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = [t.strip("".join(map(chr, range(33)))) for t in texts]
    assert [r[0] for r in df.select(java_trim("t")).collect()] == want
