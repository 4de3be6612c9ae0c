"""Diagnostics: warnings and errors as rows ``(severity, code, subject, message)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DIAGNOSTICS_SCHEMA = "severity string, code string, subject string, message string"


def diagnostics_frame(spark: SparkSession, rows: list[tuple[str, str, str, str]]) -> DataFrame:
    return spark.createDataFrame(rows, DIAGNOSTICS_SCHEMA)
