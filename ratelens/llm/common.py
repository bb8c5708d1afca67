"""Shared pieces of the training-data operators.

Everything written between stages goes to the shared folder the cluster
names (``spark.checkpoint.dir``), so a lost executor never takes data along.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import checkpoint_dir, remove_path, scratch_path

#: The white space that separates words, fixed by the query contracts.
SPACES = " \t\n\x0b\x0c\r"

_STORED: list[tuple[str, str]] = []  # (application, path) of the tables written


def materialize(df: DataFrame, label: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back.

    Cuts the lineage like a checkpoint does, but as a table that Spark reads
    with column pruning.  ``large_rows`` writes small row groups: a reader
    holds a row group's rows at once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    writer = df.write
    if large_rows:
        writer = writer.option("parquet.block.size", 16 << 20).option(
            "parquet.page.size.row.check.min", 1).option("parquet.page.size.row.check.max", 4)
    with files_go(spark):
        writer.parquet(path)
    _STORED.append((spark.sparkContext.applicationId, path))
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


@contextlib.contextmanager
def files_go(spark: SparkSession) -> Iterator[None]:
    """Spark deletes the shuffle files of a result that is made and written (or
    collected) in here at its end, not when the driver happens to collect its
    garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def remove_stored(df: DataFrame) -> None:
    """Delete the table that ``materialize`` returned as ``df``, when nothing
    reads it any more."""
    path = df._stored_at
    remove_path(df.sparkSession, path)
    _STORED.remove((df.sparkSession.sparkContext.applicationId, path))


def clear_stored(spark: SparkSession) -> None:
    """Delete the tables of ``materialize`` so far.  Results that still read
    them must have been written."""
    app = spark.sparkContext.applicationId
    for entry in [e for e in _STORED if e[0] == app]:
        remove_path(spark, entry[1])
        _STORED.remove(entry)
    release(spark)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files and broadcasts of steps that have been
    written: it does so when the driver's objects for them are collected, which
    by itself may be long after.  The driver's Python hands its memory back too."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    _trim()


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def lean(run: Callable) -> Callable:
    """A function for ``mapInArrow`` that hands its memory back at the end of
    the task: workers are reused, and would hold on to the largest task's."""

    def wrapped(batches):
        yield from run(batches)
        _trim()

    return wrapped


def small_side(df: DataFrame, rows: int) -> DataFrame:
    """A stored table as the small side of a join: broadcast if it has at most
    ``rows`` rows (counted), else left to a shuffle join."""
    return F.broadcast(df) if df.count() <= rows else df


def read_table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """One given table, with the columns an operator needs."""
    checkpoint_dir(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*cols) if cols else df


def numbered_rows(df: DataFrame, out: str, label: str) -> DataFrame:
    """``df`` with a column that tells its rows apart, the same at every read:
    the file that a row stands in (a hash of its path) and its place there.
    What isn't read from Parquet files is written first."""
    try:
        df.select("_metadata.row_index")
    except AnalysisException:
        df = materialize(df, label)
    return df.withColumn(out, F.struct(F.xxhash64("_metadata.file_path").alias("file"),
                                       F.col("_metadata.row_index").alias("place")))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` (inside one expression)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives an empty array."""
    spaced = F.translate(F.coalesce(text, F.lit("")), SPACES, " " * len(SPACES))
    return F.filter(F.split(spaced, " ", -1), lambda w: w != F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit mixing hash, vectorised (uint64 in and out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
