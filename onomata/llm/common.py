"""Helpers shared by the operators: tables, reliable checkpoints, bounded slices of Arrow batches."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one vectorised step handles at once (a longer single text is one step).
SLICE_BYTES = 2 << 20

#: Java's and Python's regular expression for a word: a run without blanks, tabs and line ends.
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder that the cluster names in ``spark.checkpoint.dir``; only a local session without that setting
    gets one of its own."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="llm-checkpoint-"))
    return sc.getCheckpointDir()


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with files in the shared checkpoint folder, which outlive lost executors."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stage(df: DataFrame) -> DataFrame:
    """The rows, written as a Parquet table into the shared checkpoint folder and read again."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_at = path
    return out


def discard(*staged: DataFrame) -> None:
    """Delete staged tables that nothing reads any more."""
    for df in staged:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def share(spark: SparkSession, value: object) -> Callable[[], object]:
    """Broadcast a value that tasks need; what is returned gives it there.

    It goes with the code of its class, so executors need no installation of this package.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(held.value)


def learns(doc_id: Column) -> Column:
    """Rows that models may learn from: crc32 of the id as text, modulo 4, is not 2 (a null id never learns)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 != 2, F.lit(False))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins (one more entry than texts)."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each has about ``most`` bytes of text, and one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, at = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(at, at[start] + most, "right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def each(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """The values of the columns row by row: of rows that hold whole groups, one is in Python's memory at a time."""
    columns = [batch.column(c) for c in names]
    for k in range(batch.num_rows):
        yield tuple(c[k].as_py() for c in columns)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """The batch's own columns in their order, then the new ones."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], names=[*batch.schema.names, *columns])


def fresh(taken: list[str], name: str) -> str:
    """The name, with underscores in front until no column of ``taken`` has it (in any case of letters)."""
    low = {x.lower() for x in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
