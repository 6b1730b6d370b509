"""Helpers shared by the training-data operators."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word contracts: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"

#: Rows of an Arrow batch that a Python worker turns into objects at a time.
SLICE_ROWS = 256

#: Largest number of rows that is ever broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a local master (tests) gets a fresh folder; on a cluster it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spindle-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: The tables written by this process, of every session.
_written: list[str] = []


def fresh_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/spindle/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: computed once, and readable after the loss of any executor."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    schema = df.schema
    df.write.parquet(path)
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def discard(*tables: DataFrame) -> None:
    """Deletes tables made by :func:`written` that no later plan reads."""
    for t in tables:
        _written.remove(t.written_to)
        _delete(t.sparkSession, t.written_to)


def clean(spark: SparkSession) -> None:
    """Deletes all tables that this process has written and not discarded yet; results that aren't stored are gone then."""
    while _written:
        _delete(spark, _written.pop())


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices of a few rows, so that a task holds few texts as objects at a time.

    Spark bounds the batches themselves by bytes. When the task ends, freed memory goes back to the system: a worker
    serves many stages.
    """
    try:
        for batch in batches:
            for k in range(0, batch.num_rows, rows):
                yield batch.slice(k, rows)
    finally:
        pa.default_memory_pool().release_unused()
        _trim()


def _trim() -> None:
    import ctypes

    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def maybe_broadcast(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """A broadcast hint where ``rows``, counted by the caller, is within the bound; else the join may shuffle."""
    return F.broadcast(df) if rows <= most else df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
