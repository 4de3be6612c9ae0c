import pytest
from pyspark.sql import functions as F

from onomata.sources.dictionary import clean_lines, load_dictionary, typed_dictionary


def test_clean_lines(spark):
    raw = ["", "   ", "\tScala\t", "# comment", "  # indented comment", "C#", "Scala", "THAN", "Than"]
    df = spark.createDataFrame([(x,) for x in raw], "value string")
    got = [r["value"] for r in clean_lines(df).collect()]
    assert sorted(got) == sorted(["Scala", "C#", "Scala", "THAN", "Than"])


def test_type_fallback_and_dedupe(spark):
    df = spark.createDataFrame([("Scala", "ProgrammingLanguage"), ("Scala", "ProgrammingLanguage"), ("X", "Alien")],
                               "value string, t string")
    got = sorted(tuple(r) for r in typed_dictionary(df, "t").collect())
    assert got == [("Person", "X"), ("ProgrammingLanguage", "Scala"), ("ProgrammingLanguage", "Scala")]
    assert typed_dictionary(df, "t", dedupe=True).count() == 2


def test_load_dictionary_with_missing_file(spark, tmp_path):
    (tmp_path / "people.txt").write_text("# people\nTuring\n  Berners-Lee  \n\n")
    (tmp_path / "languages.txt").write_text("Scala\nC++\nJava\n")
    (tmp_path / "places.txt").write_text("Valencia\nNew York\nValencia\n")
    d, diag = load_dictionary(spark, str(tmp_path))
    got = sorted(tuple(r) for r in d.collect())
    assert got == sorted([
        ("Person", "Turing"), ("Person", "Berners-Lee"),
        ("ProgrammingLanguage", "Scala"), ("ProgrammingLanguage", "C++"), ("ProgrammingLanguage", "Java"),
        ("Place", "Valencia"), ("Place", "New York"), ("Place", "Valencia"),
    ])
    missing = sorted(r["subject"].rsplit("/", 1)[1] for r in diag.collect())
    assert missing == ["organizations.txt", "universities.txt"]
    assert {r["code"] for r in diag.collect()} == {"DICT_FILE_MISSING"}
    dd, _ = load_dictionary(spark, str(tmp_path), dedupe=True)
    assert dd.filter(F.col("entity_name") == "Valencia").count() == 1


def test_load_dictionary_missing_directory(spark, tmp_path):
    with pytest.raises(ValueError, match="not found"):
        load_dictionary(spark, str(tmp_path / "nonexistent"))
