"""Item (movie) and user dimensions from text lines.

Item line: ``id, title, genres`` - the title may itself contain commas, the
genres are a pipe list after the last comma.  User line:
``id, gender, age, occupation, zip`` (only the first three are read).
For a repeated id the last valid line wins.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.functions import field, first_char, jtrim, parse_int, split_fields
from ratelens.operators.dedup import last_wins
from ratelens.sources.text_lines import line_position, parse_once



def _between_first_and_last_comma(line: Column) -> Column:
    """Text strictly between the first and the last comma (1-based positions)."""
    first = F.instr(line, ",")
    last = F.length(line) - F.instr(F.reverse(line), ",") + 1
    return line.substr(first + 1, last - first - 1)


MOVIE_FIELDS = ("title_full", "title_short", "genres")


def parse_movies(lines: DataFrame, dedup: bool = True, value_col: str = "value",
                 fields: Sequence[str] = MOVIE_FIELDS, id_type: str = "int") -> DataFrame:
    """Movies dimension: ``movie_id`` and ``fields`` (default all three of
    ``title_full, title_short, genres``).

    A line is valid with at least two commas and an int before the first.
    ``title_full`` lies between the first and the last comma, ``title_short``
    between the first and the second; ``genres`` is the raw text after the
    last comma (split it with ``operators.explode_tokens``).  Asking only for
    the fields a report reads keeps the others out of the de-duplication
    shuffle (fields packed into the last-wins aggregate are not pruned).
    """
    unknown = set(fields) - set(MOVIE_FIELDS)
    if unknown or not fields:
        raise ValueError(f"fields must be a non-empty subset of {MOVIE_FIELDS}")
    line = jtrim(F.col(value_col))
    raw = F.split(line, ",")  # keeps trailing empty fields: counts commas
    rows = parse_once(lines, [
        line.alias("line"),
        (F.size(raw) >= 3).alias("two_commas"),
        parse_int(F.substring_index(line, ",", 1), id_type).alias("movie_id"),
        line_position(lines).alias("_pos"),
    ], (F.col("line") != "") & F.col("two_commas") & F.col("movie_id").isNotNull())
    exprs = {
        "title_full": jtrim(_between_first_and_last_comma(F.col("line"))),
        "title_short": jtrim(field(F.split("line", ","), 1)),
        "genres": jtrim(F.substring_index("line", ",", -1)),
    }
    movies = rows.select("movie_id", *[exprs[f].alias(f) for f in fields], "_pos")
    if dedup:
        return last_wins(movies, "movie_id", "_pos", list(fields))
    return movies.drop("_pos")


def parse_users(
    lines: DataFrame,
    with_gender: bool = True,
    with_age: bool = False,
    dedup: bool = True,
    value_col: str = "value",
    id_type: str = "int",
) -> DataFrame:
    """Users dimension: ``user_id`` plus ``gender`` and/or ``age``.

    Validity depends on what is read: the gender needs at least two fields
    and a non-empty second field (its first character is the gender); the age
    needs at least three fields and an int third field.  The same line can be
    valid for one report and invalid for the other.
    """
    if not (with_gender or with_age):
        raise ValueError("read at least one of gender and age")
    line = jtrim(F.col(value_col))
    parts = split_fields(line)
    cols = [parse_int(field(parts, 0), id_type).alias("user_id")]
    keep = (F.col("_line") != "") & F.col("user_id").isNotNull() \
        & (F.col("_n") >= (3 if with_age else 2))
    values = []
    if with_gender:
        cols.append(first_char(field(parts, 1)).alias("gender"))
        keep = keep & F.col("gender").isNotNull()
        values.append("gender")
    if with_age:
        cols.append(parse_int(field(parts, 2)).alias("age"))
        keep = keep & F.col("age").isNotNull()
        values.append("age")
    users = parse_once(lines, [
        *cols, F.size(parts).alias("_n"), line.alias("_line"),
        line_position(lines).alias("_pos"),
    ], keep)
    if dedup:
        return last_wins(users, "user_id", "_pos", values)
    return users.select("user_id", *values)


def parse_keyed(lines: DataFrame, value_index: int, value_name: str,
                dedup: bool = True, value_col: str = "value",
                id_type: str = "int") -> DataFrame:
    """Generic ``id, ...`` dimension: int id in field 0, trimmed text of field
    ``value_index`` as ``value_name``; the last valid line of an id wins."""
    line = jtrim(F.col(value_col))
    parts = split_fields(line)
    rows = parse_once(lines, [
        parse_int(field(parts, 0), id_type).alias("key_id"),
        jtrim(field(parts, value_index)).alias(value_name),
        F.size(parts).alias("_n"), line.alias("_line"),
        line_position(lines).alias("_pos"),
    ], (F.col("_line") != "") & F.col("key_id").isNotNull() & (F.col("_n") > value_index))
    if dedup:
        return last_wins(rows, "key_id", "_pos", [value_name])
    return rows.select("key_id", value_name)
