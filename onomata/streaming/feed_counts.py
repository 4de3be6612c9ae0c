"""Incremental form of the entity count over feed pages as they land.

Landed pages arrive as JSON-lines files ``{"url", "page", "body"}`` in a
directory. The same stateless steps as the batch path run per micro-batch
(decode, filter, dictionary join); the only state is the running count per
(type, name), bounded by the dictionary size, kept by Spark's state store and
recovered from the checkpoint after a failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.detect import Detection, count_entities
from ..operators.posts import filter_posts
from ..plans.strategy import shared_dir
from ..sources.feeds import feed_posts, fits_broadcast, landed_json, parse_feeds


def read_landed_stream(spark: SparkSession, landing_dir: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming DataFrame of landed pages (file source, exactly-once with a checkpoint)."""
    return landed_json(spark.readStream).option("maxFilesPerTrigger", max_files_per_trigger).json(landing_dir)


def entity_count_stream(
    landed: DataFrame,
    subscriptions: DataFrame,
    dictionary: DataFrame,
    mode: str = "blank",
    match: str = "token",
) -> DataFrame:
    """Running ``(entity_type, entity_name, n)`` over the pages of subscribed feeds.

    ``subscriptions`` and ``dictionary`` are static and measured like in a batch
    run: within the bounds they are broadcast, past them each micro-batch joins
    them by a shuffle. A page that lands twice counts twice.
    """
    detection = Detection(dictionary, match)
    subs = subscriptions.select("name", "url")
    if fits_broadcast(subs):
        subs = F.broadcast(subs)
    attached = landed.join(subs, "url", "inner").select("name", "url", "page", "body")
    posts = filter_posts(feed_posts(parse_feeds(attached)), mode)
    return count_entities(detection.mentions(posts, ()))


def checkpoint_location(spark: SparkSession, name: str) -> str:
    """``<spark.checkpoint.dir>/<name>``; the directory must be set by the cluster (or a test)."""
    return f"{shared_dir(spark)}/{name}"


def start_entity_counts(counts: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Write the running counts as a complete-mode in-memory table (for inspection and tests)."""
    return (
        counts.writeStream.outputMode("complete")
        .format("memory")
        .queryName(table)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def start_entity_counts_to_path(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the running counts under ``path``, a folder ``batch=<id>`` for each micro-batch.

    Complete mode hands each micro-batch the whole count table (at most one row
    per dictionary line). Earlier folders stay as they are, so readers never
    meet a missing table; the highest batch with a ``_SUCCESS`` file is the
    current one (``read_current_counts``). A batch replayed after a failure
    rewrites its own folder with the same rows.
    """
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def read_current_counts(spark: SparkSession, path: str) -> DataFrame:
    """The counts of the last finished micro-batch below ``path``."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/batch=*/_SUCCESS")
    fs = hpath.getFileSystem(spark._jsc.hadoopConfiguration())
    done = [s.getPath().getParent() for s in fs.globStatus(hpath) or []]
    if not done:
        raise ValueError(f"no finished batch below '{path}'")
    last = max(done, key=lambda p: int(p.getName().split("=")[1]))
    return spark.read.parquet(last.toString())
