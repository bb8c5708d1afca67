"""Group labels used by the reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reports' rules:
# age buckets with exclusive upper bounds 18, 35 and 50 (negative ages fall
# in the first bucket), labelled 0-18, 18-35, 35-50 and 50+;
# the two counted genders are the characters M and F;
# the label of a rating whose item has no title is UnknownMovie(<id>).
AGE_BOUNDS = (18, 35, 50)
AGE_LABELS = ("0-18", "18-35", "35-50", "50+")
MALE = "M"
FEMALE = "F"
UNKNOWN_PREFIX = "UnknownMovie("
UNKNOWN_SUFFIX = ")"
MISSING_TEXT = "NA"


def bucket_label(
    c: Column | str,
    bounds: Sequence[int] = AGE_BOUNDS,
    labels: Sequence[str] = AGE_LABELS,
) -> Column:
    """Label of the first bucket whose exclusive upper bound exceeds ``c``."""
    if len(labels) != len(bounds) + 1:
        raise ValueError("need exactly one more label than bounds")
    col = F.col(c) if isinstance(c, str) else c
    expr = None
    for bound, label in zip(bounds, labels):
        expr = (F.when(col < bound, label) if expr is None
                else expr.when(col < bound, label))
    return expr.otherwise(labels[-1]) if expr is not None else F.lit(labels[0])


def unknown_label(id_col: Column | str, prefix: str = UNKNOWN_PREFIX,
                  suffix: str = UNKNOWN_SUFFIX) -> Column:
    """``UnknownMovie(<id>)`` for an id without a dimension row."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.concat(F.lit(prefix), col.cast("string"), F.lit(suffix))
