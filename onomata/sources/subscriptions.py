"""Feed subscriptions: ``name`` and ``url`` per entry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import MSG_INVALID_JSON, MSG_SKIPPED_SUBSCRIPTION

SUBSCRIPTION_SCHEMA = "name string, url string, _corrupt_record string"


def _is_valid(name: Column, url: Column) -> Column:
    # No trim: a blank name is a valid name; only absent or empty is refused.
    return (F.coalesce(name, F.lit("")) != "") & (F.coalesce(url, F.lit("")) != "")


def classify_subscriptions(raw: DataFrame) -> DataFrame:
    """``(name, url, sub_status, reason)`` with sub_status VALID / SKIPPED / INVALID_JSON."""
    corrupt = F.col("_corrupt_record").isNotNull() if "_corrupt_record" in raw.columns else F.lit(False)
    return raw.select(
        "name",
        "url",
        F.when(corrupt, F.lit("INVALID_JSON"))
        .when(_is_valid(F.col("name"), F.col("url")), F.lit("VALID"))
        .otherwise(F.lit("SKIPPED"))
        .alias("sub_status"),
        F.when(corrupt, F.lit("not a JSON object"))
        .when(F.col("name").isNull(), F.lit("missing name"))
        .when(F.col("url").isNull(), F.lit("missing url"))
        .when(F.col("name") == "", F.lit("empty name"))
        .when(F.col("url") == "", F.lit("empty url"))
        .alias("reason"),
        *([F.col("source_file")] if "source_file" in raw.columns else []),
    )


def valid_subscriptions(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("sub_status") == "VALID").select("name", "url")


def refusal(columns: list[str]) -> tuple[Column, Column, Column, Column]:
    """Severity, code, subject and message of a refused entry, over classified entries of these columns."""
    not_json = F.col("sub_status") == "INVALID_JSON"
    # The file is named where it is known, so a bad one among several can be told.
    file = F.col("source_file") if "source_file" in columns else F.lit("")
    reason = F.col("reason") if "reason" in columns else F.lit("")
    return (
        F.when(not_json, F.lit("ERROR")).otherwise(F.lit("WARN")),
        F.when(not_json, F.lit("INVALID_JSON")).otherwise(F.lit("SUBSCRIPTION_SKIPPED")),
        F.coalesce(F.col("name"), F.col("url"), file),
        F.when(not_json, F.lit(MSG_INVALID_JSON)).otherwise(F.concat(F.lit(MSG_SKIPPED_SUBSCRIPTION + ": "), reason)),
    )


def subscription_diagnostics(classified: DataFrame) -> DataFrame:
    """One diagnostic row per refused entry."""
    named = zip(("severity", "code", "subject", "message"), refusal(classified.columns), strict=True)
    return classified.filter(F.col("sub_status") != "VALID").select(*(c.alias(n) for n, c in named))


def read_subscriptions(spark: SparkSession, path: str | list[str], multiline: bool = True) -> DataFrame:
    """Raw subscription entries from JSON files (an array per file, or JSON lines).

    A file that is not JSON yields a row with ``_corrupt_record`` set, so one bad
    file never hides the entries of another.
    """
    reader = spark.read.schema(SUBSCRIPTION_SCHEMA).option("mode", "PERMISSIVE")
    entries = reader.option("multiLine", multiline).json(path)
    return entries.select("name", "url", "_corrupt_record", F.col("_metadata.file_path").alias("source_file"))


def parse_subscription_records(records: DataFrame, json_col: str = "value") -> DataFrame:
    """Raw entries from a column of JSON object strings (same rules as the file reader).

    Text that is not a JSON object becomes the corrupt record; a missing key
    gives a null field.
    """
    v = F.try_parse_json(F.col(json_col))
    is_object = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    return records.select(
        F.when(is_object, F.try_variant_get(v, "$.name", "string")).alias("name"),
        F.when(is_object, F.try_variant_get(v, "$.url", "string")).alias("url"),
        F.when(~is_object & F.col(json_col).isNotNull(), F.col(json_col)).alias("_corrupt_record"),
    )


def load_subscriptions(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """``(valid, diagnostics)`` for the subscription file(s) at ``path``."""
    classified = classify_subscriptions(read_subscriptions(spark, path))
    return valid_subscriptions(classified), subscription_diagnostics(classified)
