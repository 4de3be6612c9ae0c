"""Running entity counts over landing feed pages, as deltas.

Each micro-batch counts its own new posts and writes only the names that it
has changed; now and then the deltas are added up to a new base. The only state
of the stream is which pages have landed lately, bounded by a watermark.

``path`` holds ``base/batch=<id>`` (all counts up to that batch) and
``delta/batch=<id>`` (what that batch adds). The current counts are those of the
last finished base plus the finished deltas after it. A batch that is replayed
after a failure rewrites its own delta with the same rows, so it counts once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from ..functions.text import post_length
from ..operators.detect import Detection
from ..operators.posts import filter_posts, keep_post
from ..sources.feeds import feed_posts, fits_broadcast, parse_feeds

COUNTS_SCHEMA = "entity_type string, entity_name string, n bigint"
METRICS = ("posts", "posts_kept", "total_chars")


def _files(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath, hpath.getFileSystem(spark._jsc.hadoopConfiguration())


def _finished(spark: SparkSession, folder: str, key: str) -> dict[int, str]:
    """Finished tables ``<key>=<number>`` below a folder, on any Hadoop file system."""
    hpath, fs = _files(spark, f"{folder}/{key}=*/_SUCCESS")
    done = [s.getPath().getParent() for s in fs.globStatus(hpath) or []]
    return {int(p.getName().split("=")[1]): p.toString() for p in done}


def _delete(spark: SparkSession, path: str) -> None:
    hpath, fs = _files(spark, path)
    fs.delete(hpath, True)


class RunningCounts:
    """The counts below ``path``; a new base after every ``compact_every`` deltas."""

    def __init__(self, spark: SparkSession, path: str, compact_every: int = 20):
        self.spark, self.path, self.compact_every = spark, path.rstrip("/"), compact_every

    def _parts(self) -> tuple[dict[int, str], dict[int, str]]:
        bases = _finished(self.spark, f"{self.path}/base", "batch")
        deltas = _finished(self.spark, f"{self.path}/delta", "batch")
        return bases, {k: p for k, p in deltas.items() if k > max(bases, default=-1)}

    def read(self) -> DataFrame:
        """``(entity_type, entity_name, n)`` up to the last finished batch; without any, no rows."""
        bases, deltas = self._parts()
        paths = [bases[max(bases)]] if bases else []
        paths += deltas.values()
        if not paths:
            return self.spark.createDataFrame([], COUNTS_SCHEMA)
        rows = self.spark.read.schema(COUNTS_SCHEMA).parquet(*paths)
        return rows.groupBy("entity_type", "entity_name").agg(F.sum("n").alias("n"))

    def add(self, counts: DataFrame, batch_id: int) -> None:
        """The counts of one batch: a row for each name that it has changed."""
        if batch_id <= max(_finished(self.spark, f"{self.path}/base", "batch"), default=-1):
            return  # a replayed batch that a base has already
        counts.write.mode("overwrite").parquet(f"{self.path}/delta/batch={batch_id}")
        if len(self._parts()[1]) >= self.compact_every:
            self.compact()

    def compact(self) -> None:
        """Add the deltas up to a new base. What the base before it needs stays until the next time, for readers that
        have begun with it."""
        bases, deltas = self._parts()
        if not deltas:
            return
        last = max(deltas)
        self.read().write.mode("overwrite").parquet(f"{self.path}/base/batch={last}")
        before = max(bases, default=-1)
        for k, p in [*bases.items(), *_finished(self.spark, f"{self.path}/delta", "batch").items()]:
            if k < before or (k == before and p != bases.get(before)):
                _delete(self.spark, p)


class DictionaryVersions:
    """A dictionary that may change while a stream runs: tables ``version=<n>`` below a folder, the last finished one
    is current."""

    def __init__(self, spark: SparkSession, path: str, match: str = "token", strategy: str = "auto"):
        self.spark, self.path, self.match, self.strategy = spark, path.rstrip("/"), match, strategy
        self._held: tuple[int, Detection] | None = None

    def publish(self, dictionary: DataFrame) -> int:
        """Write ``(entity_type, entity_name)`` as the next version; batches that begin later use it."""
        number = max(_finished(self.spark, self.path, "version"), default=0) + 1
        dictionary.select("entity_type", "entity_name").write.mode("overwrite").parquet(f"{self.path}/version={number}")
        return number

    def current(self) -> tuple[int, Detection]:
        """The current version and its detection; a new version is measured and its join chosen anew."""
        versions = _finished(self.spark, self.path, "version")
        if not versions:
            raise ValueError(f"no finished dictionary version below '{self.path}'")
        number = max(versions)
        if self._held is None or self._held[0] != number:
            self._held = number, Detection(self.spark.read.parquet(versions[number]), self.match, self.strategy)
        return self._held


def drop_relanded(landed: DataFrame, within: str, landed_at: str | None = None) -> DataFrame:
    """The pages of a stream, each (url, page) once within a time.

    ``landed_at`` names the time of a page; by default it is the time of the
    micro-batch, so no page is ever late. With a column of its own, a page whose
    time lies more than ``within`` before the latest one seen is late and
    dropped, as the state that would know it is gone. A page that lands again
    after its time is a new one. The state holds one key for each page that
    landed within the time.
    """
    timed = landed.withColumn("_at", F.col(landed_at) if landed_at else F.current_timestamp())
    return timed.withWatermark("_at", within).dropDuplicatesWithinWatermark(["url", "page"]).drop("_at")


def post_stream(landed: DataFrame, subscriptions: DataFrame, mode: str = "blank", observed: str | None = None) -> DataFrame:
    """The kept posts of the pages of subscribed feeds, in append mode. With ``observed``, the run's counters are
    gathered under that name on the way (``BatchCounters`` reads them)."""
    subs = subscriptions.select("name", "url")
    attached = landed.join(F.broadcast(subs) if fits_broadcast(subs) else subs, "url", "inner")
    posts = feed_posts(parse_feeds(attached.select("name", "url", "page", "body")))
    if observed:
        keep = keep_post(mode)
        posts = posts.observe(
            observed,
            F.count(F.lit(1)).alias("posts"),
            F.count_if(keep).alias("posts_kept"),
            F.coalesce(F.sum(F.when(keep, post_length())), F.lit(0)).cast("bigint").alias("total_chars"),
        )
    return filter_posts(posts, mode)


class BatchCounters(StreamingQueryListener):
    """Writes the counters of each batch that a query observed as ``<path>/batch=<id>``, one row each.

    Spark reports them once per finished batch, so a task that ran twice does
    not count twice; a replayed batch rewrites its own row.
    """

    def __init__(self, spark: SparkSession, name: str, path: str):
        self.spark, self.name, self.path = spark, name, path.rstrip("/")

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = (event.progress.observedMetrics or {}).get(self.name)
        if row is not None and event.progress.numInputRows:
            values = [tuple(int(row[m] or 0) for m in METRICS)]
            table = self.spark.createDataFrame(values, ", ".join(f"{m} bigint" for m in METRICS))
            table.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={event.progress.batchId}")

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def read_batch_counters(spark: SparkSession, path: str) -> DataFrame:
    """``(batch, posts, posts_kept, total_chars)`` of the finished batches."""
    there = _finished(spark, path.rstrip("/"), "batch")
    kind = ", ".join(f"{m} bigint" for m in METRICS)
    if not there:
        return spark.createDataFrame([], f"batch bigint, {kind}")
    rows = spark.read.option("basePath", path).schema(f"{kind}, batch bigint").parquet(*there.values())
    return rows.select("batch", *METRICS)


def start_running_counts(
    posts: DataFrame, dictionary: DictionaryVersions | Detection, counts: RunningCounts, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Count the posts of each micro-batch with the dictionary that is current when it begins.

    The batch is read by one action, the write of its delta, so observed
    counters are gathered once. ``checkpoint`` lies in the shared folder
    (``feed_counts.checkpoint_location``).
    """
    detection: Callable[[], Detection] = (lambda: dictionary.current()[1]) if isinstance(dictionary, DictionaryVersions) else (lambda: dictionary)

    def count(batch: DataFrame, batch_id: int) -> None:
        counts.add(detection().counts(batch), batch_id)

    writer = posts.writeStream.outputMode("append").foreachBatch(count).option("checkpointLocation", checkpoint)
    return (writer.queryName(name) if name else writer).start()
