"""Global order without a single task: ordinal positions of sorted rows.

Spark sorts globally by range-partitioning on the sort key and sorting each
partition; no task ever sees all rows.  A 0-based ordinal is then
``rows in earlier partitions + index inside the partition``.  The per
partition counts are one row per partition (bounded by the partition
count), so their running sum and its broadcast are small.  Each row is
written once, with the number of its sorted partition and its index there, to
the session's shared folder, so the count and the numbering read the same rows
even if a task is re-executed.  Lines of written files need no sort at all:
their file, split and row already number them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.session import scratch_path

_LOCAL_BITS = 33  # monotonically_increasing_id = partition << 33 | row index


def _segments_offsets(df: DataFrame, seg_cols: Sequence[str], count_col: str) -> DataFrame:
    """Running row offset per segment, ordered by ``seg_cols``.

    ``df`` has one row per segment (partition or file split), so the
    un-partitioned window runs over a bounded, small input.
    """
    w = Window.orderBy(*seg_cols).rowsBetween(Window.unboundedPreceding, -1)
    return df.select(*seg_cols, F.coalesce(F.sum(count_col).over(w), F.lit(0)).alias("_off"))


def with_position(df: DataFrame, order: Sequence[Column | str],
                  name: str = "position") -> DataFrame:
    """``df`` sorted by ``order`` plus its 0-based ordinal ``name``.

    ``order`` must be a total order (unique keys) for the ordinal to be
    well defined.
    """
    cols = df.columns
    numbered = df.orderBy(*order).withColumn("_rid", F.monotonically_increasing_id())
    path = scratch_path(df.sparkSession, "positions")
    numbered.write.parquet(path)
    sorted_ = df.sparkSession.read.schema(numbered.schema).parquet(path)
    part = F.shiftright(F.col("_rid"), _LOCAL_BITS)
    local = F.col("_rid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1))
    counts = sorted_.groupBy(part.alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    offsets = _segments_offsets(counts, ["_p"], "_c")
    return (sorted_.withColumn("_p", part)
            .join(F.broadcast(offsets), "_p")
            .select(*cols, (F.col("_off") + local).alias(name)))


def file_order_key(path: Column) -> list[Column]:
    """Sort columns of a file: folder, part number, name.

    Part files carry their index in the name; it is compared as a number, so
    ``part-100000`` comes after ``part-99999``.
    """
    number = F.regexp_extract(path, r"part-(\d+)[^/]*$", 1)
    return [F.regexp_extract(path, r"^(.*)/[^/]*$", 1).alias("_folder"),
            F.coalesce(number.try_cast("bigint"), F.lit(-1).cast("bigint")).alias("_part"),
            path.alias("_file")]


def file_order_position(lines: DataFrame, name: str = "position") -> DataFrame:
    """Lines of a text scan with their 0-based position in file order.

    Files are ordered by folder, part number and name, lines inside a file by
    split start and then by their order inside the split.  A first scan counts
    the lines of each split and finds its first row number, a second one reads
    the lines; both cut the files alike, so nothing is sorted or shuffled but
    one row per split.
    """
    rows = lines.select(
        F.col("value"),
        *file_order_key(F.col("_metadata.file_path")),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    )
    split = ["_folder", "_part", "_file", "_block"]
    splits = rows.groupBy(*split).agg(F.count(F.lit(1)).alias("_c"), F.min("_row").alias("_first"))
    before = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    # one row per split of the files: a small input for one window
    offsets = splits.select("_file", "_block", (
        F.coalesce(F.sum("_c").over(before), F.lit(0)) - F.col("_first")).alias("_off"))
    return (rows.join(F.broadcast(offsets), ["_file", "_block"])
            .select("value", (F.col("_off") + F.col("_row")).alias(name)))
