"""Grouped averages, conditional averages and the best group.

Values travel as partial sums ``(s, n)`` - rating sum and row count - so a
plan may pre-aggregate anywhere below a join and re-aggregate above it;
the average is ``sum(s) / sum(n)``, the same quotient a single pass gives.
Spark runs every ``groupBy`` as a map-side partial aggregate followed by a
final one, so a key holding many rows collapses before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_partial(ratings: DataFrame, keep: Sequence[str], value: str = "rating") -> DataFrame:
    """One rating per row as a partial sum: ``keep..., s, n``."""
    return ratings.select(*keep, F.col(value).cast("double").alias("s"),
                          F.lit(1).cast("long").alias("n"))


def pre_aggregate(partials: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Combine partial sums per ``keys`` (used before a shuffle join)."""
    return partials.groupBy(*keys).agg(F.sum("s").alias("s"), F.sum("n").alias("n"))


def avg_count_by(partials: DataFrame, keys: Sequence[str] | str,
                 avg_name: str = "avg_rating", count_name: str = "n") -> DataFrame:
    """Average and row count per group (AGG-1, AGG-2)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return partials.groupBy(*keys).agg(
        (F.sum("s") / F.sum("n")).alias(avg_name),
        F.sum("n").cast("long").alias(count_name),
    )


def conditional_avgs(
    partials: DataFrame,
    keys: Sequence[str] | str,
    label_col: str,
    labels: Sequence[str],
    names: Sequence[str],
    missing: float | None = None,
    count_names: Sequence[str] | None = None,
) -> DataFrame:
    """One average column per label, in a single pass over the group.

    Rows whose label is none of ``labels`` are not summed, but still make the
    group exist (its averages are then all ``missing``).  ``missing`` None
    leaves NULL for a label without rows.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    aggs: list[Column] = []
    for label, name in zip(labels, names):
        hit = F.col(label_col) == F.lit(label)
        aggs.append(F.sum(F.when(hit, F.col("s"))).alias(f"_s_{name}"))
        aggs.append(F.sum(F.when(hit, F.col("n"))).alias(f"_n_{name}"))
    grouped = partials.groupBy(*keys).agg(*aggs)
    out = [F.col(k) for k in keys]
    for i, name in enumerate(names):
        avg = F.col(f"_s_{name}") / F.col(f"_n_{name}")
        out.append((F.coalesce(avg, F.lit(float(missing))) if missing is not None else avg)
                   .alias(name))
        if count_names:
            out.append(F.coalesce(F.col(f"_n_{name}"), F.lit(0)).cast("long")
                       .alias(count_names[i]))
    return grouped.select(*out)


def best_group(
    stats: DataFrame,
    key: str,
    min_count: int = 5,
    avg_col: str = "avg_rating",
    count_col: str = "n",
) -> DataFrame:
    """The group with the highest average among those with ``min_count`` rows.

    Ties keep the lowest key.  A NaN or -Infinity average never wins (Spark
    would sort NaN above every number, hence the explicit filter).  No row
    when no group qualifies.  ``orderBy().limit(1)`` plans as a distributed
    top-1 (each task keeps its best row), not as a global sort.
    """
    avg = F.col(avg_col)
    return (stats.where((F.col(count_col) >= min_count) & ~F.isnan(avg)
                        & (avg > F.lit(float("-inf"))))
            .orderBy(avg.desc(), F.col(key).asc())
            .limit(1))
