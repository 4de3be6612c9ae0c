"""Typed name dictionaries: one name per line, '#' comments, one file per type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import DICTIONARY_FILES, ENTITY_TYPES, FALLBACK_TYPE, MSG_DICT_MISSING
from ..functions.text import java_trim
from .diagnostics import diagnostics_frame

DICTIONARY_SCHEMA = "entity_type string, entity_name string"


def resolve_type(type_col: str | Column) -> Column:
    """Known type names pass; anything else becomes the fallback type."""
    c = F.col(type_col) if isinstance(type_col, str) else type_col
    return F.when(c.isin(*ENTITY_TYPES), c).otherwise(F.lit(FALLBACK_TYPE))


def clean_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Trim (Java rules), then drop blank lines and lines starting with '#'.

    The trim runs before the comment test, so an indented '# x' is a comment,
    while a '#' inside a name (``C#``) stays.
    """
    trimmed = java_trim(F.col(line_col))
    return (
        lines.withColumn(line_col, trimmed)
        .filter((F.col(line_col) != "") & ~F.col(line_col).startswith("#"))
    )


def typed_dictionary(lines: DataFrame, type_col: str, line_col: str = "value", dedupe: bool = False) -> DataFrame:
    """Raw lines plus a declared type -> ``(entity_type, entity_name)``.

    Multiplicity is kept (a name listed twice counts twice) unless ``dedupe``.
    """
    out = clean_lines(lines, line_col).select(
        resolve_type(type_col).alias("entity_type"), F.col(line_col).alias("entity_name")
    )
    return out.dropDuplicates(["entity_type", "entity_name"]) if dedupe else out


def _matches(spark: SparkSession, path: str) -> list:
    """File statuses that a path or glob matches (empty for none), on any Hadoop file system."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.globStatus(hpath) or [])


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is at the path, or matches it if it is a glob."""
    return bool(_matches(spark, path))


def is_directory(spark: SparkSession, path: str) -> bool:
    return any(s.isDirectory() for s in _matches(spark, path))


def load_dictionary(
    spark: SparkSession,
    directory: str,
    dedupe: bool = False,
    files: tuple[tuple[str, str], ...] = DICTIONARY_FILES,
) -> tuple[DataFrame, DataFrame]:
    """Read every dictionary file of ``directory`` in one distributed text scan.

    Returns ``(dictionary, diagnostics)``. A path that is missing or no directory
    is an error; a missing file gives a WARN row and the other files are still used.
    A file may be a folder of part files, as Spark writes it.
    """
    base = directory.rstrip("/")
    if not is_directory(spark, base):
        raise ValueError(f"entities directory '{directory}' not found")
    present, missing = [], []
    for name, etype in files:
        (present if path_exists(spark, f"{base}/{name}") else missing).append((name, etype))
    diagnostics = diagnostics_frame(
        spark,
        [("WARN", "DICT_FILE_MISSING", f"{base}/{n}", MSG_DICT_MISSING % f"{base}/{n}") for n, _ in missing],
    )
    if not present:
        return spark.createDataFrame([], DICTIONARY_SCHEMA), diagnostics
    path = F.col("_metadata.file_path")
    of = [F.when(path.endswith(f"/{n}") | path.contains(f"/{n}/"), F.lit(t)) for n, t in present]
    raw = spark.read.text([f"{base}/{n}" for n, _ in present]).select("value", F.coalesce(*of).alias("declared_type"))
    return typed_dictionary(raw, "declared_type", dedupe=dedupe), diagnostics


def dictionary_from_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """An inline dictionary of ``(entity_type, entity_name)`` rows; an unknown type becomes the fallback type."""
    given = spark.createDataFrame(rows, DICTIONARY_SCHEMA)
    return given.select(resolve_type("entity_type").alias("entity_type"), "entity_name")
