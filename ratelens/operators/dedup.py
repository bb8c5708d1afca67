"""Build-side de-duplication: the last valid row of each key wins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(
    df: DataFrame,
    key: str | Sequence[str],
    order: Column | str,
    values: Sequence[str],
) -> DataFrame:
    """One row per key: the values of the row with the greatest ``order``.

    ``max_by`` combines before the shuffle, so each map task sends one
    candidate per key and a key that holds a large share of the rows does not
    pile up in one reducer.  Packed values have no fixed width, so both sides
    aggregate by sorting (spilling), not by hash.
    """
    keys = [key] if isinstance(key, str) else list(key)
    order_col = F.col(order) if isinstance(order, str) else order
    packed = F.struct(*[F.col(v) for v in values])
    return (
        df.groupBy(*keys)
        .agg(F.max_by(packed, order_col).alias("_last"))
        .select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])
    )
