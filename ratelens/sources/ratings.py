"""Ratings facts from text lines ``user, item, rating, timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions import field, jtrim, parse_double, parse_int, split_fields
from ratelens.sources.text_lines import parse_once

def parse_ratings(
    lines: DataFrame,
    min_fields: int = 4,
    require_user: bool = False,
    value_col: str = "value",
    id_type: str = "int",
) -> DataFrame:
    """Valid rating rows of ``lines``; malformed lines are dropped silently.

    A line is kept when, after trimming, it is not blank, it has at least
    ``min_fields`` comma fields (trailing empty fields do not count), the
    second field is an int and the third a double.  With ``require_user`` the
    first field must be an int as well; otherwise ``user_id`` is NULL where it
    is not one.  The timestamp is never read.  Lines of other files lying in
    the same directory (dimension rows) fail these rules and fall out.

    Returns ``user_id, movie_id, rating double``; the ids are 32-bit ints, or
    64-bit with ``id_type="long"`` for wide keys.  The rules are plain
    column expressions, so the filter runs inside the scan's codegen stage.
    """
    line = jtrim(F.col(value_col))
    parts = split_fields(line)
    fields = [
        parse_int(field(parts, 0), id_type).alias("user_id"),
        parse_int(field(parts, 1), id_type).alias("movie_id"),
        parse_double(field(parts, 2)).alias("rating"),
        F.size(parts).alias("_n"),
        (line == F.lit("")).alias("_blank"),
    ]
    keep = (~F.col("_blank")) & (F.col("_n") >= min_fields) \
        & F.col("movie_id").isNotNull() & F.col("rating").isNotNull()
    if require_user:
        keep = keep & F.col("user_id").isNotNull()
    return parse_once(lines, fields, keep).select("user_id", "movie_id", "rating")
