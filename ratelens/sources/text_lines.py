"""Headerless text input: every file of one or more directories as lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.ordering import file_order_key


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str | None = None,
    recursive: bool = False,
) -> DataFrame:
    """All lines of all files below ``paths`` as one bag of rows (``value``).

    Several files (or several paths) are an implicit UNION ALL.  Line breaks
    ``\\n``, ``\\r\\n`` and ``\\r`` all end a line, compressed files are read
    transparently and files are split for parallel reading.  ``glob`` keeps
    only matching file names (for example ``ratings_*.txt``).
    """
    reader = spark.read
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if isinstance(paths, str):
        paths = [paths]
    return reader.text(list(paths))


def parse_once(lines: DataFrame, fields: Sequence[Column], keep: Column) -> DataFrame:
    """Parsed ``fields`` of every line, then the rows where ``keep`` holds.

    Left alone, Catalyst pushes the filter below the projection and inlines
    the whole parse into each condition (a text scan takes no pushed filters
    anyway), so every line is split and converted several times.  A
    nondeterministic column in the projection is a barrier the filter is not
    pushed through: the projection computes the shared sub-expressions (the
    split fields) once, and the filter reads the computed columns.  The
    marker is a seeded ``rand`` (also allowed on streams); ``>= 0`` always
    holds, and it is dropped after the filter.
    """
    marked = lines.select(*fields, F.rand(seed=0).alias("_barrier"))
    return marked.where((F.col("_barrier") >= 0) & keep).drop("_barrier")


def line_position(lines: DataFrame) -> Column:
    """Sortable position of a line within its input.

    ``(file, split start, row id)``, files by folder, part number and name:
    inside one split the row id grows with the line order, so the struct
    orders lines as they appear in each file.  It needs the reader's own DataFrame (the file metadata column);
    for other inputs the row id alone is used.
    """
    try:
        lines.select("_metadata.file_path")
        return F.struct(
            *file_order_key(F.col("_metadata.file_path")),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
    except Exception:  # not a file scan: no metadata column
        return F.struct(
            *file_order_key(F.lit("")),
            F.lit(0).cast("long").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        )
