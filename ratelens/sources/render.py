"""Test-table rows rendered as report input lines, with faults injected.

The text ingest is exercised on data Spark derives from the given tables:
each row becomes one line; a fault class chosen from the row id decides
which malformation (if any) the line gets.  Every row is rendered; the
class only selects the kind of line.  The expected survivors follow from
the same class rule, not from parsing.

Rating lines from ``events`` (class = event_id % 11):

  0 ``u, m, r, t``                    valid
  1 ``u, m.0, r, t``                  item id not an int
  2 ``u, m, vr, t``                   rating not a number
  3 ``u, m, r``                       three fields
  4 blank (spaces and a tab)
  5 ``uu, m, r, t``                   user id not an int
  6 ``<TAB> u ,<TAB>m , r , t , extra``  padding and an extra field
  7 ``u,m,r,,``                       trailing empty fields (three remain)
  8 ``u, +m, rd, t``                  signed id, rating with a type suffix
  9 ``u, m + 2^31, r, t``             item id overflows an int
  10 ``u, m<U+007F>, r, t``           a control character that is no space
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the fault layout above.
RATING_FAULT_CLASSES = 11
ID_RANGE = 1_000_003
MOVIE_COMMA_TITLE_EVERY = 3
MOVIE_NO_GENRES_EVERY = 7
MOVIE_BAD_ID_EVERY = 11
MOVIE_EMPTY_TITLE_EVERY = 19
MOVIE_EMPTY_GENRES_EVERY = 23
MOVIE_TWICE_EVERY = 17
USER_TWICE_EVERY = 17
USER_BAD_AGE_EVERY = 4
USER_TWO_FIELDS_EVERY = 5
USER_BAD_ID_EVERY = 13
INT_OVERFLOW = 2147483648


def _s(c: Column | str) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def _join(*parts: Column | str) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])


def rating_lines_from_events(events: DataFrame) -> DataFrame:
    """``event_id, value`` lines: user = user_id, item = event_id, rating = value.

    Both ids are taken modulo ``ID_RANGE``, so they fit an int at any scale and
    only fault class 9 overflows.
    """
    m = F.pmod(F.col("event_id"), F.lit(ID_RANGE))
    u, over = _s(F.pmod(F.col("user_id"), F.lit(ID_RANGE))), _s(m + F.lit(INT_OVERFLOW))
    m, r = _s(m), _s("value")
    t = _s(F.unix_seconds(F.col("ts").cast("timestamp")))
    cls = F.pmod(F.col("event_id"), F.lit(RATING_FAULT_CLASSES))
    line = (
        F.when(cls == 1, _join(u, ", ", m, ".0, ", r, ", ", t))
        .when(cls == 2, _join(u, ", ", m, ", v", r, ", ", t))
        .when(cls == 3, _join(u, ", ", m, ", ", r))
        .when(cls == 4, F.lit("  \t "))
        .when(cls == 5, _join("u", u, ", ", m, ", ", r, ", ", t))
        .when(cls == 6, _join("\t ", u, " ,\t", m, " , ", r, " , ", t, " , extra"))
        .when(cls == 7, _join(u, ",", m, ",", r, ",,"))
        .when(cls == 8, _join(u, ", +", m, ", ", r, "d, ", t))
        .when(cls == 9, _join(u, ", ", over, ", ", r, ", ", t))
        .when(cls == 10, _join(u, ", ", m, "\x7f, ", r, ", ", t))
        .otherwise(_join(u, ", ", m, ", ", r, ", ", t))
    )
    return events.select("event_id", line.alias("value"))


def movie_lines_from_part(part: DataFrame) -> DataFrame:
    """``p_partkey, seq, value``: ``id, title, genres`` lines from ``part``.

    Every 3rd title gets ``, <brand>`` (a comma inside the title), every 7th
    line lacks the genre field, every 11th id gets a letter prefix, every 19th
    title is empty, every 23rd genre list is empty, and every 17th id has an
    older line before its last one (``seq`` 0 and 1).
    """
    pk = F.col("p_partkey")

    def every(n: int) -> Column:
        return F.pmod(pk, F.lit(n)) == 0

    no_genres = every(MOVIE_NO_GENRES_EVERY)
    ident = F.when(every(MOVIE_BAD_ID_EVERY), _join("m", _s(pk))).otherwise(_s(pk))
    title = F.when(every(MOVIE_COMMA_TITLE_EVERY), _join(F.col("p_name"), ", ", F.col("p_brand"))) \
        .when(every(MOVIE_EMPTY_TITLE_EVERY) & ~no_genres, F.lit("")).otherwise(F.col("p_name"))
    genres = F.when(every(MOVIE_EMPTY_GENRES_EVERY), F.lit("")).otherwise(
        F.concat(F.col("p_type"), F.lit("|"), F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))))
    line = F.when(no_genres, _join(ident, ", ", title)) \
        .otherwise(_join(ident, ", ", title, ", ", genres))
    older = F.when(every(MOVIE_TWICE_EVERY), _join(ident, ", older title, older"))
    return _two_lines(part, "p_partkey", older, line)


def _two_lines(df: DataFrame, key: str, older: Column, line: Column) -> DataFrame:
    """``key, seq, value``: an older line where there is one, then the line."""
    return df.select(key, F.posexplode(F.array(older, line)).alias("seq", "value")) \
        .where(F.col("value").isNotNull())


def user_lines_from_customer(customer: DataFrame) -> DataFrame:
    """``c_custkey, seq, value``: ``id, segment, age, nation, zip`` lines.

    The gender is the first letter of the segment word.  Every 4th age is
    not a number, every 5th line has two fields only, every 13th id gets a
    letter prefix, and every 17th id has an older line (gender Z, age 1).
    """
    ck = F.col("c_custkey")
    age = _s(F.floor(F.col("c_acctbal") / 100).cast("int"))
    bad_age = F.pmod(ck, F.lit(USER_BAD_AGE_EVERY)) == 0
    two_fields = F.pmod(ck, F.lit(USER_TWO_FIELDS_EVERY)) == 0
    bad_id = F.pmod(ck, F.lit(USER_BAD_ID_EVERY)) == 0
    ident = F.when(bad_id, _join("c", _s(ck))).otherwise(_s(ck))
    age_txt = F.when(bad_age, _join("abc", age)).otherwise(age)
    line = F.when(two_fields, _join(ident, ", ", F.col("c_mktsegment"))).otherwise(
        _join(ident, ", ", F.col("c_mktsegment"), ", ", age_txt, ", ",
              _s("c_nationkey"), ", ", F.lpad(_s(ck), 5, "0")))
    older = F.when(F.pmod(ck, F.lit(USER_TWICE_EVERY)) == 0, _join(ident, ", Z, 1, 0, 0"))
    return _two_lines(customer, "c_custkey", older, line)


def rating_lines_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """``orderkey, partkey, quantity/2, linenumber`` lines (all valid)."""
    line = _join(_s("l_orderkey"), ", ", _s("l_partkey"), ", ",
                 _s(F.col("l_quantity") / 2.0), ", ", _s("l_linenumber"))
    return lineitem.select("l_linenumber", line.alias("value"))


def rating_lines_with_users(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """``custkey, partkey, quantity/2, linenumber`` lines: each line item rated
    by its order's customer (all valid)."""
    rated = lineitem.join(orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"),
                          "l_orderkey")
    line = _join(_s("o_custkey"), ", ", _s("l_partkey"), ", ",
                 _s(F.col("l_quantity") / 2.0), ", ", _s("l_linenumber"))
    return rated.select(line.alias("value"))


def dimension_lines_from_events(events: DataFrame) -> DataFrame:
    """``user_id, event_type, event_id`` lines: one user appears many times."""
    line = _join(_s("user_id"), ", ", F.col("event_type"), ", ", _s("event_id"))
    return events.select("event_id", line.alias("value"))
