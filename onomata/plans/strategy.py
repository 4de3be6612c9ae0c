"""Physical-strategy choices that Catalyst cannot make on its own.

The main one is whether the dictionary side of entity detection may be
broadcast. Catalyst's estimate for a file or VALUES source is not a proof of
size (string widths are guessed, parquet is compressed), so the size is
measured with one aggregate over the dictionary before the plan is built.
The dictionary is tiny next to the posts, so the extra job is cheap.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A broadcast table is copied to every executor and held in memory; keep it
# well under executor memory. 2M names / 256 MB of key+name text.
BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 256 * 1024 * 1024


@dataclass(frozen=True)
class DictionaryShape:
    rows: int
    text_bytes: int
    max_words: int
    lengths: tuple[int, ...] = (1,)  # word counts that occur among the keys

    def fits_broadcast(self, max_rows: int | None = None, max_bytes: int | None = None) -> bool:
        max_rows = BROADCAST_MAX_ROWS if max_rows is None else max_rows
        max_bytes = BROADCAST_MAX_BYTES if max_bytes is None else max_bytes
        return self.rows <= max_rows and self.text_bytes <= max_bytes


# Dictionaries of at most this many lines are also matched with an in-row set
# intersection against the literal key list before the join; longer ones with
# an in-row filter over their keys (plans/filters.py).
LITERAL_KEYS_MAX = 100


def literal_keys(keyed: DataFrame, shape: DictionaryShape, key_col: str = "match_key") -> tuple[str, ...] | None:
    """Sorted distinct keys of a dictionary of at most ``LITERAL_KEYS_MAX`` lines; else None."""
    if shape.rows > LITERAL_KEYS_MAX:
        return None
    return tuple(sorted({r[0] for r in keyed.select(key_col).collect()}))


def measure_dictionary(keyed: DataFrame, key_col: str = "match_key") -> DictionaryShape:
    """Exact row count, key+name byte total and the keys' lengths (in words), in one job."""
    words = F.size(F.split(F.col(key_col), " "))
    row = keyed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(
            F.sum(F.octet_length(key_col) + F.octet_length("entity_name") + F.octet_length("entity_type")),
            F.lit(0),
        ).alias("text_bytes"),
        # No more lengths than the longest key has words.
        F.array_sort(F.collect_set(words)).alias("lengths"),
    ).first()
    lengths = tuple(row["lengths"]) or (1,)
    return DictionaryShape(int(row["rows"]), int(row["text_bytes"]), lengths[-1], lengths)


def choose_join(shape: DictionaryShape, strategy: str = "auto") -> str:
    """'broadcast' or 'shuffle'. Forcing 'broadcast' past the bound is refused."""
    if strategy not in ("auto", "broadcast", "shuffle"):
        raise ValueError(f"unknown join strategy {strategy!r}")
    if strategy == "shuffle":
        return "shuffle"
    if shape.fits_broadcast():
        return "broadcast"
    if strategy == "broadcast":
        raise ValueError(
            f"dictionary of {shape.rows} rows / {shape.text_bytes} bytes exceeds the broadcast bound"
        )
    return "shuffle"


def physical_plan(df: DataFrame) -> str:
    """Executed-plan text (for plan tests and notes)."""
    return df._jdf.queryExecution().executedPlan().toString()


# Spread a scan only when it has fewer input splits than the cluster has cores
# and its estimated size is at most this much in all, whatever the cluster.
# Parquet splits are byte ranges, so a file with few row groups can show several
# splits of which only one holds rows; the split count alone overstates the
# parallelism of small inputs. A large table is never reshuffled.
SPREAD_MAX_BYTES = 1024 * 1024 * 1024


def _estimated_bytes(df: DataFrame) -> int | None:
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size if isinstance(size, int) else size.toString())
    except Exception:
        return None


def spread_scan(df: DataFrame) -> DataFrame:
    """Round-robin a small scan that would otherwise run in fewer tasks than cores.

    A table stored as one unsplittable unit (one parquet row group, one gzip
    file) is read by a single task, and every narrow operator above it (text
    splitting, JSON decoding, the broadcast probe) stays in that task. Both
    the split count (file listing) and the size estimate (file sizes) are
    known at planning time, so the check costs no job. Only inputs of at most
    ``SPREAD_MAX_BYTES`` are shuffled; larger tables are left as they are on
    any cluster.
    """
    try:
        parallelism = df.sparkSession.sparkContext.defaultParallelism
        splits = df.rdd.getNumPartitions()
    except Exception:  # Spark Connect has no RDD view; leave the scan as it is
        return df
    size = _estimated_bytes(df)
    if splits < parallelism and size is not None and size <= SPREAD_MAX_BYTES:
        return df.repartition(parallelism)
    return df


def shared_dir(spark) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir`` (or the context's checkpoint dir).

    Never falls back to a machine-local folder: on a cluster only a shared
    file system survives the loss of an executor.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        try:
            base = spark.sparkContext.getCheckpointDir()
        except Exception:
            base = None
    if not base:
        raise ValueError("set spark.checkpoint.dir to a shared folder to stage intermediate tables")
    return base.rstrip("/")


def landing_dir(spark) -> str:
    """A new folder for files that a run lands before it reads them: in the shared folder, or for a local session
    without one in a temporary folder of this machine."""
    import tempfile
    import uuid

    try:
        base = shared_dir(spark)
    except ValueError:
        if not spark.sparkContext.master.startswith("local["):
            raise
        base = tempfile.mkdtemp(prefix="onomata-landing-")
    return f"{base}/landing-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` once as parquet under the shared folder; the table read back, and its path.

    Cuts the lineage (a lost executor re-reads the table instead of recomputing
    the plan) and lets several consumers share one computation; the columnar
    copy is pruned to the columns each consumer reads. The caller removes the
    path with ``remove_table`` when it is done.
    """
    import uuid

    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.parquet(path), path


def remove_table(spark, path: str) -> None:
    """Delete a staged table through the file system of its path."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)
