"""Equivalent SQL of the registered queries (DuckDB dialect).

Used only to check results: tables ``lineitem orders part customer events``
are views over the same parquet files.  Doubles are compared exactly, which
holds because every rating is a half (sums are exact in binary).  For the
text cases the survivors follow from the fault class of each row (see
``ratelens.sources.render``), not from parsing.
"""

from __future__ import annotations

_R1_STATS = """
agg AS (
  SELECT {item} AS movie_id, avg(l_quantity / 2) AS avg_rating,
         CAST(count(*) AS BIGINT) AS n
  FROM lineitem GROUP BY 1),
stats AS (
  SELECT a.movie_id,
         coalesce(t.title, 'UnknownMovie(' || CAST(a.movie_id AS VARCHAR) || ')') AS title,
         a.avg_rating, a.n
  FROM agg a LEFT JOIN ({titles}) t ON a.movie_id = t.id),
best AS (
  SELECT * FROM (
    SELECT * FROM stats
    WHERE n >= 5 AND NOT isnan(avg_rating) AND avg_rating > CAST('-inf' AS DOUBLE)
    ORDER BY avg_rating DESC, movie_id ASC LIMIT 1)
  WHERE title <> '')
"""

# Items are parts, or orders (few ratings of one customer each).
_PARTS = {"item": "l_partkey", "titles": "SELECT p_partkey AS id, p_name AS title FROM part"}
_ORDERS = {"item": "l_orderkey",
           "titles": "SELECT o_orderkey AS id, o_orderpriority AS title FROM orders"}

_GENRE_STATS = """
g AS (
  SELECT movie_id, trim(tok) AS genre FROM (
    SELECT p_partkey AS movie_id,
           unnest(string_split(p_type || '|' || replace(p_name, ' ', '|'), '|')) AS tok
    FROM part)),
gs AS (
  SELECT g.genre, avg(l.l_quantity / 2) AS avg_rating, CAST(count(*) AS BIGINT) AS n
  FROM lineitem l JOIN g ON l.l_partkey = g.movie_id
  WHERE g.genre <> '' GROUP BY g.genre)
"""

_GENDER_STATS = """
r AS (
  SELECT l.{item} AS movie_id, l.l_quantity / 2 AS rating,
         substr(c.c_mktsegment, 1, 1) AS gender
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
a AS (
  SELECT movie_id,
         coalesce(avg(rating) FILTER (WHERE gender = 'M'), CAST(0 AS DOUBLE)) AS male_avg,
         coalesce(avg(rating) FILTER (WHERE gender = 'F'), CAST(0 AS DOUBLE)) AS female_avg,
         count(*) FILTER (WHERE gender = 'M') AS male_n,
         count(*) FILTER (WHERE gender = 'F') AS female_n
  FROM r GROUP BY movie_id),
gs AS (
  SELECT a.movie_id, t.title, a.male_avg, a.female_avg, a.male_n, a.female_n
  FROM a JOIN ({titles}) t ON a.movie_id = t.id
  WHERE t.title <> '')
"""

_AGE_GROUP = """CASE WHEN {a} < 18 THEN '0-18' WHEN {a} < 35 THEN '18-35'
                WHEN {a} < 50 THEN '35-50' ELSE '50+' END"""

_AGE_STATS = """
r AS (
  SELECT l.{item} AS movie_id, l.l_quantity / 2 AS rating,
         {group} AS age_group
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey),
a AS (
  SELECT movie_id,
         avg(rating) FILTER (WHERE age_group = '0-18') AS age_0_18,
         avg(rating) FILTER (WHERE age_group = '18-35') AS age_18_35,
         avg(rating) FILTER (WHERE age_group = '35-50') AS age_35_50,
         avg(rating) FILTER (WHERE age_group = '50+') AS age_50_plus
  FROM r GROUP BY movie_id),
ages AS (
  SELECT a.movie_id, t.title, a.age_0_18, a.age_18_35, a.age_35_50, a.age_50_plus
  FROM a JOIN ({titles}) t ON a.movie_id = t.id
  WHERE t.title <> '')
""".replace("{group}", _AGE_GROUP.format(a="CAST(floor(c.c_acctbal / 100) AS INTEGER)"))
_AGE_SEL = _AGE_STATS.format(**_ORDERS)
_AGE_ALL = _AGE_STATS.format(**_PARTS)


def _fmt(x: str) -> str:
    return f"printf('%.2f', {x})"


def _age_cell(label: str, col: str) -> str:
    return f"chr(9) || '{label}: ' || coalesce({_fmt(col)}, 'NA')"


_GENDER_LINES = f"""
        SELECT title || chr(9) || 'Male: ' || {_fmt('male_avg')} || ', Female: '
                 || {_fmt('female_avg')} AS line,
               CAST(row_number() OVER (ORDER BY movie_id) - 1 AS BIGINT) AS position
        FROM gs"""

_AGE_LINES = f"""
        SELECT title || {_age_cell('0-18', 'age_0_18')} || {_age_cell('18-35', 'age_18_35')}
                 || {_age_cell('35-50', 'age_35_50')} || {_age_cell('50+', 'age_50_plus')}
                 AS line,
               CAST(row_number() OVER (ORDER BY movie_id) - 1 AS BIGINT) AS position
        FROM ages"""


# Text reports: the item and user lines carry the fault classes of render.py.
_TEXT_MOVIE_ROWS = """
  SELECT p_partkey AS movie_id,
         CASE WHEN p_partkey % 3 = 0 THEN
                CASE WHEN p_partkey % 7 = 0 THEN p_name ELSE p_name || ', ' || p_brand END
              WHEN p_partkey % 19 = 0 THEN '' ELSE p_name END AS title_full,
         CASE WHEN p_partkey % 3 <> 0 AND p_partkey % 19 = 0 THEN '' ELSE p_name END
           AS title_short,
         CASE WHEN p_partkey % 7 = 0 THEN p_brand WHEN p_partkey % 23 = 0 THEN ''
              ELSE p_type || '|' || replace(p_name, ' ', '|') END AS genres
  FROM part
  WHERE p_partkey % 11 <> 0 AND (p_partkey % 7 <> 0 OR p_partkey % 3 = 0)
  UNION ALL
  -- the last line of the id is no valid one, so the older line stays
  SELECT p_partkey, 'older title', 'older title', 'older' FROM part
  WHERE p_partkey % 17 = 0 AND p_partkey % 11 <> 0 AND p_partkey % 7 = 0 AND p_partkey % 3 <> 0"""

_TEXT_MOVIES = f"""
tm AS ({_TEXT_MOVIE_ROWS})
"""

_TEXT_RATED = """
tr AS (
  SELECT o.o_custkey AS user_id, l.l_partkey AS movie_id, l.l_quantity / 2 AS rating
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
"""

_TEXT_R3 = """
g AS (
  SELECT r.movie_id, r.rating, substr(c.c_mktsegment, 1, 1) AS gender
  FROM tr r JOIN customer c ON r.user_id = c.c_custkey
  WHERE c.c_custkey % 13 <> 0),
a AS (
  SELECT movie_id,
         coalesce(avg(rating) FILTER (WHERE gender = 'M'), CAST(0 AS DOUBLE)) AS male_avg,
         coalesce(avg(rating) FILTER (WHERE gender = 'F'), CAST(0 AS DOUBLE)) AS female_avg
  FROM g GROUP BY movie_id)
SELECT a.movie_id, tm.title_short AS title, a.male_avg, a.female_avg
FROM a JOIN tm ON a.movie_id = tm.movie_id WHERE tm.title_short <> ''
"""

_TEXT_USER_AGES = """
  SELECT c_custkey AS user_id,
         CASE WHEN c_custkey % 5 = 0 OR c_custkey % 4 = 0 THEN 1  -- the older line
              ELSE CAST(floor(c_acctbal / 100) AS INTEGER) END AS age
  FROM customer
  WHERE c_custkey % 13 <> 0
    AND ((c_custkey % 5 <> 0 AND c_custkey % 4 <> 0) OR c_custkey % 17 = 0)"""

_TEXT_R4 = f"""
tu AS ({_TEXT_USER_AGES}),""" + """
g AS (
  SELECT r.movie_id, r.rating, {group} AS age_group
  FROM tr r JOIN tu c ON r.user_id = c.user_id),
a AS (
  SELECT movie_id,
         avg(rating) FILTER (WHERE age_group = '0-18') AS age_0_18,
         avg(rating) FILTER (WHERE age_group = '18-35') AS age_18_35,
         avg(rating) FILTER (WHERE age_group = '35-50') AS age_35_50,
         avg(rating) FILTER (WHERE age_group = '50+') AS age_50_plus
  FROM g GROUP BY movie_id)
SELECT a.movie_id, tm.title_short AS title,
       a.age_0_18, a.age_18_35, a.age_35_50, a.age_50_plus
FROM a JOIN tm ON a.movie_id = tm.movie_id WHERE tm.title_short <> ''
""".replace("{group}", _AGE_GROUP.format(a="c.age"))


_TEXT_GENRES = _TEXT_MOVIES + """,
g AS (
  SELECT movie_id, trim(tok) AS genre FROM (
    SELECT movie_id, unnest(string_split(genres, '|')) AS tok FROM tm WHERE genres <> '')),
gs AS (
  SELECT g.genre, avg(l.l_quantity / 2) AS avg_rating, CAST(count(*) AS BIGINT) AS n
  FROM lineitem l JOIN g ON l.l_partkey = g.movie_id
  WHERE g.genre <> '' GROUP BY g.genre)"""

_GENRE_LINES = f"""
        SELECT genre || chr(9) || 'Avg: ' || {_fmt('avg_rating')} || ', Count: '
                 || CAST(n AS VARCHAR) AS line,
               CAST(row_number() OVER (ORDER BY genre) - 1 AS BIGINT) AS position
        FROM gs"""

_GENRE_FILES = "WITH " + _TEXT_GENRES + _GENRE_LINES

_MOVIE_FILES = "WITH " + _TEXT_MOVIES + f""",
        agg AS (
          SELECT l_partkey AS movie_id, avg(l_quantity / 2) AS avg_rating,
                 CAST(count(*) AS BIGINT) AS n
          FROM lineitem GROUP BY l_partkey),
        stats AS (
          SELECT a.movie_id,
                 coalesce(tm.title_full, 'UnknownMovie(' || CAST(a.movie_id AS VARCHAR) || ')')
                   AS title, a.avg_rating, a.n
          FROM agg a LEFT JOIN tm ON a.movie_id = tm.movie_id),
        best AS (
          SELECT * FROM (
            SELECT * FROM stats
            WHERE n >= 5 AND NOT isnan(avg_rating) AND avg_rating > CAST('-inf' AS DOUBLE)
            ORDER BY avg_rating DESC, movie_id ASC LIMIT 1)
          WHERE title <> ''),
        lines AS (
          SELECT 0 AS section, movie_id,
                 title || chr(9) || 'Average rating: ' || {_fmt('avg_rating')}
                   || ' (Total ratings: ' || CAST(n AS VARCHAR) || ')' AS line
          FROM stats
          UNION ALL
          SELECT 1 AS section, movie_id,
                 title || ' is the highest rated movie with an average rating of '
                   || {_fmt('avg_rating')} || ' among movies with at least 5 ratings.'
          FROM best)
        SELECT line, CAST(row_number() OVER (ORDER BY section, movie_id) - 1 AS BIGINT)
                 AS position
        FROM lines"""


ORACLE_SQL: dict[str, str] = {
    "movie_avg_count": "WITH " + _R1_STATS.format(**_PARTS) + "SELECT * FROM stats",
    "top_movie_min5": "WITH " + _R1_STATS.format(**_ORDERS) + "SELECT * FROM best",
    "top_movie_min5_all": "WITH " + _R1_STATS.format(**_PARTS) + "SELECT * FROM best",
    "genre_membership": """
        SELECT movie_id, genre FROM (
          SELECT p_partkey AS movie_id,
                 trim(unnest(string_split(p_type || '|' || replace(p_name, ' ', '|'), '|')))
                   AS genre
          FROM part)
        WHERE genre <> ''""",
    "genre_avg": "WITH " + _GENRE_STATS + "SELECT * FROM gs",
    "gender_avg": "WITH " + _GENDER_STATS.format(**_PARTS)
                  + "SELECT movie_id, title, male_avg, female_avg FROM gs",
    "gender_other_only": "WITH " + _GENDER_STATS.format(**_ORDERS)
                         + "SELECT movie_id, title, male_avg, female_avg FROM gs "
                           "WHERE male_n = 0 AND female_n = 0",
    "age_bucket_counts": f"""
        SELECT {_AGE_GROUP.format(a='a')} AS age_group, CAST(count(*) AS BIGINT) AS n
        FROM (SELECT CAST(floor(c_acctbal / 100) AS INTEGER) AS a FROM customer)
        GROUP BY 1""",
    "age_group_avg": "WITH " + _AGE_SEL + "SELECT * FROM ages",
    "age_group_avg_all": "WITH " + _AGE_ALL + "SELECT * FROM ages",
    # Text cases: fault class = event_id % 10 (every row is rendered and parsed).
    "parse_ratings": """
        SELECT CASE WHEN event_id % 11 = 5 THEN NULL
                    ELSE CAST(user_id % 1000003 AS INTEGER) END AS user_id,
               CAST(event_id % 1000003 AS INTEGER) AS movie_id, value AS rating
        FROM events WHERE event_id % 11 IN (0, 5, 6, 8)""",
    "parse_ratings_min3": """
        SELECT CAST(user_id % 1000003 AS INTEGER) AS user_id,
               CAST(event_id % 1000003 AS INTEGER) AS movie_id, value AS rating
        FROM events WHERE event_id % 11 IN (0, 3, 6, 7, 8)""",
    "parse_movies": _TEXT_MOVIE_ROWS,
    "parse_users": _TEXT_USER_AGES,
    "parse_users_gender": """
        SELECT c_custkey AS user_id, substr(c_mktsegment, 1, 1) AS gender
        FROM customer WHERE c_custkey % 13 <> 0""",
    "dim_last_wins": """
        SELECT user_id, arg_max(event_type, event_id) AS event_type
        FROM events GROUP BY user_id""",
    "dim_last_wins_text": """
        SELECT user_id, arg_max(event_type, event_id) AS event_type
        FROM events GROUP BY user_id""",
    "scan_ratings_dir": """
        SELECT l_orderkey AS user_id, l_partkey AS movie_id, l_quantity / 2 AS rating
        FROM lineitem""",
    "mixed_dir_reject": """
        SELECT l_orderkey AS user_id, l_partkey AS movie_id, l_quantity / 2 AS rating
        FROM lineitem""",
    "text_sink_roundtrip": f"""
        SELECT CAST(event_id AS VARCHAR) || chr(9) || event_type || chr(9) || {_fmt('value')}
                 AS line,
               CAST(row_number() OVER (ORDER BY event_id) - 1 AS BIGINT) AS position
        FROM events""",
    "movie_report_lines": "WITH " + _R1_STATS.format(**_PARTS) + f""",
        lines AS (
          SELECT 0 AS section, movie_id,
                 title || chr(9) || 'Average rating: ' || {_fmt('avg_rating')}
                   || ' (Total ratings: ' || CAST(n AS VARCHAR) || ')' AS line
          FROM stats
          UNION ALL
          SELECT 1 AS section, movie_id,
                 title || ' is the highest rated movie with an average rating of '
                   || {_fmt('avg_rating')} || ' among movies with at least 5 ratings.'
          FROM best)
        SELECT line, CAST(row_number() OVER (ORDER BY section, movie_id) - 1 AS BIGINT)
                 AS position
        FROM lines""",
    "genre_report_lines": "WITH " + _GENRE_STATS + f"""
        SELECT genre || chr(9) || 'Avg: ' || {_fmt('avg_rating')} || ', Count: '
                 || CAST(n AS VARCHAR) AS line,
               CAST(row_number() OVER (ORDER BY genre) - 1 AS BIGINT) AS position
        FROM gs""",
    "gender_report_lines": "WITH " + _GENDER_STATS.format(**_ORDERS) + _GENDER_LINES,
    "gender_report_lines_all": "WITH " + _GENDER_STATS.format(**_PARTS) + _GENDER_LINES,
    "age_report_lines": "WITH " + _AGE_SEL + _AGE_LINES,
    "age_report_lines_all": "WITH " + _AGE_ALL + _AGE_LINES,
    "stream_item_stats": """
        SELECT l_partkey AS movie_id, avg(l_quantity / 2) AS avg_rating,
               CAST(count(*) AS BIGINT) AS n
        FROM lineitem GROUP BY l_partkey""",
    "movie_avg_count_text": "WITH " + _TEXT_MOVIES + """,
        agg AS (
          SELECT l_partkey AS movie_id, avg(l_quantity / 2) AS avg_rating,
                 CAST(count(*) AS BIGINT) AS n
          FROM lineitem GROUP BY l_partkey)
        SELECT a.movie_id,
               coalesce(tm.title_full, 'UnknownMovie(' || CAST(a.movie_id AS VARCHAR) || ')')
                 AS title,
               a.avg_rating, a.n
        FROM agg a LEFT JOIN tm ON a.movie_id = tm.movie_id""",
    "genre_avg_text": "WITH " + _TEXT_GENRES + " SELECT * FROM gs",
    "gender_avg_text": "WITH " + _TEXT_MOVIES + "," + _TEXT_RATED + "," + _TEXT_R3,
    "age_group_avg_text": "WITH " + _TEXT_MOVIES + "," + _TEXT_RATED + "," + _TEXT_R4,
    "movie_report_files": _MOVIE_FILES,
    "genre_report_files": _GENRE_FILES,
    "genre_report_overwrite": _GENRE_FILES,
    "gender_report_files": "WITH " + _TEXT_MOVIES + "," + _TEXT_RATED + ", gs AS (WITH "
                           + _TEXT_R3 + ")" + _GENDER_LINES,
    "movie_report_single_file": _MOVIE_FILES,
    "age_report_files": "WITH " + _TEXT_MOVIES + "," + _TEXT_RATED + ", ages AS (WITH "
                        + _TEXT_R4 + ")" + _AGE_LINES,
}
