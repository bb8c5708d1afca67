"""Text sink: one line per row, globally ordered, no key/value separator."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.session import remove_path, scratch_path

#: Compressions (and their file endings) whose files may follow one another in one file.
_JOINABLE = {"none": "", "uncompressed": "", "gzip": ".gz", "bzip2": ".bz2"}


def write_lines(
    df: DataFrame,
    path: str,
    order_by: Sequence[Column | str],
    line_col: str = "line",
    mode: str = "errorifexists",
    single_file: bool = False,
    compression: str | None = None,
) -> None:
    """Write ``line_col`` as text, ordered by ``order_by`` across part files.

    The order is a range-partitioned sort: part file ``i`` holds the ``i``-th
    key range, each sorted, so reading the part files by name gives the
    global order and no task holds all rows.  ``mode`` is ``errorifexists``
    (an existing output is an error) or ``overwrite``.  ``single_file`` puts
    everything in one part file: the ordered parts are written to the shared
    scratch folder and then joined byte by byte, so the sort stays spread out.
    (Compressed files of other kinds than gzip and bzip2 can't be joined; for
    these one task sorts and writes.)

    The line itself is the last sort key: rows with equal keys are spread
    over several ranges instead of all landing in one task.
    """
    keys = [*order_by, F.col(line_col)]
    joined = single_file and (compression or "none").lower() in _JOINABLE
    if single_file and not joined:
        ordered = df.repartition(1).sortWithinPartitions(*keys)
    else:
        ordered = df.orderBy(*keys)
    spark = df.sparkSession
    writer = ordered.select(line_col).write
    if compression:
        writer = writer.option("compression", compression)
    if not joined:
        writer.mode(mode).text(path)
        return
    _free_output(spark, path, mode)
    parts = scratch_path(spark, "ordered-parts")
    writer.text(parts)
    _join_files(spark, parts, path, f"part-00000.txt{_JOINABLE[(compression or 'none').lower()]}")
    remove_path(spark, parts)


def _free_output(spark: SparkSession, path: str, mode: str) -> None:
    """What Spark's writers do about an existing output."""
    at, fs = _file_system(spark, path)
    if fs.exists(at):
        if mode != "overwrite":
            raise FileExistsError(f"output exists: {path}")
        fs.delete(at, True)


def _file_system(spark: SparkSession, path: str):
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(sc._jsc.hadoopConfiguration())


def _join_files(spark: SparkSession, parts: str, path: str, name: str) -> None:
    """One file of all part files, in the order of their numbers, copied in
    small buffers; it takes its name when it is complete."""
    sc = spark.sparkContext
    conf = sc._jsc.hadoopConfiguration()
    source, source_fs = _file_system(spark, parts)
    target, fs = _file_system(spark, path)
    found = [s.getPath() for s in source_fs.listStatus(source)]
    found = sorted((p for p in found if p.getName().startswith("part-")),
                   key=lambda p: int(p.getName().split("-")[1]))
    new_path = sc._jvm.org.apache.hadoop.fs.Path
    whole = new_path(target, f"_{name}.joining")  # hidden from readers by its first character
    out = fs.create(whole, True)
    try:
        for p in found:
            into = source_fs.open(p)
            sc._jvm.org.apache.hadoop.io.IOUtils.copyBytes(into, out, conf, False)
            into.close()
    finally:
        out.close()
    fs.rename(whole, new_path(target, name))
    fs.create(new_path(target, "_SUCCESS"), True).close()
