"""Registered queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole tables (or text Spark renders from them) and runs
the library's operators; see ``ratelens.plans.oracle`` for the equivalent
SQL of each.  Text inputs are rendered from the tables into a folder below
the session's checkpoint folder, once per session, and read back by every
call; the sink cases write fresh output each time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.functions import fmt2
from ratelens.operators import explode_tokens, file_order_position, last_wins, with_position
from ratelens.plans.reports import (
    age_lines,
    age_stats,
    age_stats_from_rated,
    best_movie,
    gender_lines,
    gender_stats,
    gender_stats_from_rated,
    genre_lines,
    genre_stats,
    movie_lines,
    movie_stats,
    user_age_groups,
)
from ratelens.plans import runner
from ratelens.plans.sinks import write_lines
from ratelens.session import scratch_path, session_key
from ratelens.sources import (
    parse_keyed,
    parse_movies,
    parse_ratings,
    parse_users,
    read_lines,
)
from ratelens.sources import render
from ratelens.sources import tables as T
from ratelens.streaming import current_item_stats, start_item_stats

Query = Callable[[SparkSession, str], DataFrame]
# Dimension lines are written in this order: of a repeated id the last wins.
MOVIE_ORDER = ["p_partkey", "seq"]
USER_ORDER = ["c_custkey", "seq"]


# ------------------------------------------------------------- parquet reports

def movie_avg_count(spark: SparkSession, sf: str) -> DataFrame:
    """R1 typed: every item's average and count, titles (or labels)."""
    return movie_stats(T.item_ratings(spark, sf), T.movies(spark, sf))


def top_movie_min5(spark: SparkSession, sf: str) -> DataFrame:
    """R1 best item with at least 5 ratings, orders as items (most have fewer)."""
    return best_movie(movie_stats(T.item_ratings(spark, sf, by_order=True),
                                  T.movies(spark, sf, by_order=True)))


def top_movie_min5_all(spark: SparkSession, sf: str) -> DataFrame:
    """R1 best item over all ratings."""
    return best_movie(movie_stats(T.item_ratings(spark, sf), T.movies(spark, sf)))


def genre_membership(spark: SparkSession, sf: str) -> DataFrame:
    """One row per (item, genre token)."""
    m = T.movies(spark, sf).select("movie_id", "genres")
    return explode_tokens(m, "genres", "genre")


def genre_avg(spark: SparkSession, sf: str) -> DataFrame:
    """R2 typed: average and count per genre."""
    return genre_stats(T.item_ratings(spark, sf), T.movies(spark, sf))


def _gender(spark: SparkSession, sf: str, by_order: bool, with_counts: bool) -> DataFrame:
    users = T.users(spark, sf).select("user_id", "gender")
    rated = T.rated_with_user(spark, sf, users, "gender", by_order=by_order)
    return gender_stats_from_rated(rated, T.movies(spark, sf, by_order=by_order),
                                   with_counts=with_counts)


def gender_avg(spark: SparkSession, sf: str) -> DataFrame:
    """R3 typed: male and female average per item."""
    return _gender(spark, sf, by_order=False, with_counts=False)


def gender_other_only(spark: SparkSession, sf: str) -> DataFrame:
    """R3 items (orders) whose known raters are all neither M nor F (both 0.0)."""
    s = _gender(spark, sf, by_order=True, with_counts=True)
    return (s.where((F.col("male_n") == 0) & (F.col("female_n") == 0))
            .select("movie_id", "title", "male_avg", "female_avg"))


def age_bucket_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Users per age bucket."""
    groups = user_age_groups(T.users(spark, sf))
    return groups.groupBy("age_group").agg(F.count(F.lit(1)).alias("n"))


def _age(spark: SparkSession, sf: str, by_order: bool) -> DataFrame:
    groups = user_age_groups(T.users(spark, sf))
    rated = T.rated_with_user(spark, sf, groups, "age_group", by_order=by_order)
    return age_stats_from_rated(rated, T.movies(spark, sf, by_order=by_order))


def age_group_avg(spark: SparkSession, sf: str) -> DataFrame:
    """R4 typed, orders as items (empty buckets are NULL)."""
    return _age(spark, sf, by_order=True)


def age_group_avg_all(spark: SparkSession, sf: str) -> DataFrame:
    """R4 typed over all ratings."""
    return _age(spark, sf, by_order=False)


# ------------------------------------------------------------- text ingest

def _write_text(df: DataFrame, path: str, order: Sequence[str] = ()) -> str:
    if order:
        write_lines(df, path, order, line_col="value")
    else:
        df.select("value").write.mode("errorifexists").text(path)
    return path


def _spread(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table round-robin over the cores, as a file of one row group is read
    by a single task."""
    return T.table(spark, sf, name).repartition(spark.sparkContext.defaultParallelism)


_RENDERED: dict[tuple, str] = {}


def _rendered(spark: SparkSession, sf: str, name: str, build: Callable[[str], None]) -> str:
    """Folder with the text input ``name`` rendered from the tables of ``sf``.

    The input is written once per session and state of the tables' files, and
    then reused; each query still parses and computes over all of it.
    """
    key = (session_key(spark), sf, name, _state(spark, sf))
    path = _RENDERED.get(key)
    if path is None:
        path = scratch_path(spark, name)
        build(path)
        _RENDERED[key] = path
    return path


def _state(spark: SparkSession, sf: str) -> tuple:
    """Names, sizes and times of the table files, so changed tables are seen."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(sf)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime())
                        for f in fs.listStatus(root)))


def _event_rating_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = _rendered(spark, sf, "event-ratings", lambda p: _write_text(
        render.rating_lines_from_events(_spread(spark, sf, "events")), p))
    return read_lines(spark, path)


def parse_ratings_q(spark: SparkSession, sf: str) -> DataFrame:
    """Rating lines, four fields required, user id not read."""
    return parse_ratings(_event_rating_lines(spark, sf), min_fields=4, require_user=False)


def parse_ratings_min3(spark: SparkSession, sf: str) -> DataFrame:
    """Rating lines, three fields and an int user id required."""
    return parse_ratings(_event_rating_lines(spark, sf), min_fields=3, require_user=True)


def parse_movies_q(spark: SparkSession, sf: str) -> DataFrame:
    """Item lines with commas in titles, missing genre fields and bad ids."""
    path = _rendered(spark, sf, "part-movies", lambda p: _write_text(
        render.movie_lines_from_part(T.table(spark, sf, "part")), p, MOVIE_ORDER))
    return parse_movies(read_lines(spark, path), id_type="long")


def _customer_user_lines(spark: SparkSession, sf: str) -> DataFrame:
    path = _rendered(spark, sf, "customer-users", lambda p: _write_text(
        render.user_lines_from_customer(T.table(spark, sf, "customer")), p, USER_ORDER))
    return read_lines(spark, path)


def parse_users_q(spark: SparkSession, sf: str) -> DataFrame:
    """User lines read for the age: bad ages and short lines drop."""
    return parse_users(_customer_user_lines(spark, sf), with_gender=False, with_age=True,
                       id_type="long")


def parse_users_gender(spark: SparkSession, sf: str) -> DataFrame:
    """User lines read for the gender: the same lines, other survivors."""
    return parse_users(_customer_user_lines(spark, sf), with_gender=True, with_age=False,
                       id_type="long")


def dim_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """Per user the event type of the latest event (last row wins)."""
    ev = T.table(spark, sf, "events")
    return last_wins(ev, "user_id", "event_id", ["event_type"])


def dim_last_wins_text(spark: SparkSession, sf: str) -> DataFrame:
    """Same, as a text dimension: the last line of a user id wins."""
    path = scratch_path(spark, "event-dimension")
    _write_text(render.dimension_lines_from_events(T.table(spark, sf, "events")), path,
                ["event_id"])
    dim = parse_keyed(read_lines(spark, path), 1, "event_type", id_type="long")
    return dim.select(F.col("key_id").alias("user_id"), "event_type")


def _lineitem_rating_dir(spark: SparkSession, sf: str, with_dimensions: bool) -> str:
    def build(root: str) -> None:
        lines = render.rating_lines_from_lineitem(_spread(spark, sf, "lineitem"))
        _write_text(lines.where(F.col("l_linenumber") <= 3), f"{root}/ratings_1")
        _write_text(lines.where(F.col("l_linenumber") > 3), f"{root}/ratings_2")
        if with_dimensions:
            _write_text(render.movie_lines_from_part(T.table(spark, sf, "part")),
                        f"{root}/movies", MOVIE_ORDER)
            _write_text(render.user_lines_from_customer(T.table(spark, sf, "customer")),
                        f"{root}/users", USER_ORDER)

    return _rendered(spark, sf, "mixed-dir" if with_dimensions else "rating-dir", build)


def scan_ratings_dir(spark: SparkSession, sf: str) -> DataFrame:
    """Two rating files in one directory read as one bag (UNION ALL)."""
    root = _lineitem_rating_dir(spark, sf, with_dimensions=False)
    return parse_ratings(read_lines(spark, root, recursive=True), min_fields=3,
                         require_user=True, id_type="long")


def mixed_dir_reject(spark: SparkSession, sf: str) -> DataFrame:
    """Ratings, item and user files in one directory: only ratings survive."""
    root = _lineitem_rating_dir(spark, sf, with_dimensions=True)
    return parse_ratings(read_lines(spark, root, recursive=True), min_fields=3,
                         require_user=True, id_type="long")


def _report_text_dir(spark: SparkSession, sf: str) -> str:
    """Rating, item and user files in one directory, as the reports read them."""
    def build(root: str) -> None:
        _write_text(render.rating_lines_with_users(_spread(spark, sf, "lineitem"),
                                                   T.table(spark, sf, "orders")),
                    f"{root}/ratings")
        _write_text(render.movie_lines_from_part(T.table(spark, sf, "part")),
                    f"{root}/movies", MOVIE_ORDER)
        _write_text(render.user_lines_from_customer(T.table(spark, sf, "customer")),
                    f"{root}/users", USER_ORDER)

    return _rendered(spark, sf, "report-text", build)


def _text_inputs(spark: SparkSession, sf: str):
    root = _report_text_dir(spark, sf)
    return (read_lines(spark, root, recursive=True),
            read_lines(spark, f"{root}/movies"), read_lines(spark, f"{root}/users"))


def movie_avg_count_text(spark: SparkSession, sf: str) -> DataFrame:
    """R1 typed from text files (ratings, items and users in one directory)."""
    lines, movie_text, _ = _text_inputs(spark, sf)
    return movie_stats(parse_ratings(lines, min_fields=4, id_type="long"),
                       parse_movies(movie_text, fields=["title_full"], id_type="long"))


def genre_avg_text(spark: SparkSession, sf: str) -> DataFrame:
    """R2 typed from text files."""
    lines, movie_text, _ = _text_inputs(spark, sf)
    return genre_stats(parse_ratings(lines, min_fields=3, id_type="long"),
                       parse_movies(movie_text, fields=["genres"], id_type="long"))


def gender_avg_text(spark: SparkSession, sf: str) -> DataFrame:
    """R3 typed from text files."""
    lines, movie_text, user_text = _text_inputs(spark, sf)
    return gender_stats(parse_ratings(lines, min_fields=3, require_user=True, id_type="long"),
                        parse_users(user_text, with_gender=True, id_type="long"),
                        parse_movies(movie_text, fields=["title_short"], id_type="long"))


def age_group_avg_text(spark: SparkSession, sf: str) -> DataFrame:
    """R4 typed from text files."""
    lines, movie_text, user_text = _text_inputs(spark, sf)
    return age_stats(parse_ratings(lines, min_fields=3, require_user=True, id_type="long"),
                     parse_users(user_text, with_gender=False, with_age=True, id_type="long"),
                     parse_movies(movie_text, fields=["title_short"], id_type="long"))


def _read_report(spark: SparkSession, path: str) -> DataFrame:
    """Lines of the report's files with their position."""
    back = file_order_position(spark.read.text(path))
    return back.select(F.col("value").alias("line"), "position")


def _report(spark: SparkSession, sf: str, run: Callable, with_users: bool, **kw) -> DataFrame:
    root, out = _report_text_dir(spark, sf), scratch_path(spark, "report-out")
    dims = [f"{root}/movies", f"{root}/users"][:1 + with_users]
    if kw.get("mode") == "overwrite":  # something older is in the way
        spark.range(3).selectExpr("'old line' AS line").write.text(out)
    run(spark, root, out, *dims, id_type="long", **kw)
    return _read_report(spark, out)


def movie_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """R1 as the runner does it - text files in, ordered report files out -
    read back with each line's position in file order."""
    return _report(spark, sf, runner.run_movie_report, False)


def genre_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """R2 as the runner does it, read back with positions."""
    return _report(spark, sf, runner.run_genre_report, False)


def gender_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """R3 as the runner does it, read back with positions."""
    return _report(spark, sf, runner.run_gender_report, True)


def age_report_files(spark: SparkSession, sf: str) -> DataFrame:
    """R4 as the runner does it, read back with positions."""
    return _report(spark, sf, runner.run_age_report, True)


def movie_report_single_file(spark: SparkSession, sf: str) -> DataFrame:
    """R1 as one ordered output file."""
    return _report(spark, sf, runner.run_movie_report, False, single_file=True)


def genre_report_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    """R2 over an output that exists already."""
    return _report(spark, sf, runner.run_genre_report, False, mode="overwrite")


# ------------------------------------------------------------- sinks, lines

def text_sink_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Lines written in id order over several part files, read back with
    their position in file order."""
    ev = T.table(spark, sf, "events")
    lines = ev.select("event_id", F.concat_ws("\t", F.col("event_id").cast("string"),
                                              F.col("event_type"), fmt2("value")).alias("line"))
    path = scratch_path(spark, "sink")
    write_lines(lines, path, ["event_id"])
    return _read_report(spark, path)


def movie_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """R1 rendered: item lines by id, then the best-item line."""
    stats = movie_stats(T.item_ratings(spark, sf), T.movies(spark, sf))
    lines = movie_lines(stats, best_movie(stats))
    return with_position(lines, ["section", "movie_id"]).select("line", "position")


def genre_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """R2 rendered, ordered by genre (byte order)."""
    lines = genre_lines(genre_stats(T.item_ratings(spark, sf), T.movies(spark, sf)))
    return with_position(lines, ["genre"]).select("line", "position")


def gender_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """R3 rendered, orders as items (0.00 defaults occur)."""
    lines = gender_lines(_gender(spark, sf, by_order=True, with_counts=False))
    return with_position(lines, ["movie_id"]).select("line", "position")


def gender_report_lines_all(spark: SparkSession, sf: str) -> DataFrame:
    """R3 rendered over all ratings."""
    lines = gender_lines(_gender(spark, sf, by_order=False, with_counts=False))
    return with_position(lines, ["movie_id"]).select("line", "position")


def age_report_lines(spark: SparkSession, sf: str) -> DataFrame:
    """R4 rendered, orders as items (NA occurs)."""
    lines = age_lines(_age(spark, sf, by_order=True))
    return with_position(lines, ["movie_id"]).select("line", "position")


def age_report_lines_all(spark: SparkSession, sf: str) -> DataFrame:
    """R4 rendered over all ratings."""
    lines = age_lines(_age(spark, sf, by_order=False))
    return with_position(lines, ["movie_id"]).select("line", "position")


# ------------------------------------------------------------- streaming

def stream_item_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Per-item average and count maintained by a file stream over the
    rating files (several micro-batches of up to 8 files), read back as the
    current table."""
    root = _lineitem_rating_dir(spark, sf, with_dimensions=False)
    out = scratch_path(spark, "stream-out")
    query = start_item_stats(spark, f"{root}/*/part-*", out, scratch_path(spark, "stream-ckpt"),
                             min_fields=3, max_files_per_trigger=8, id_type="long")
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"stream failed: {query.exception()}")
    return current_item_stats(spark, out)


QUERIES: dict[str, Query] = {
    "movie_avg_count": movie_avg_count,
    "top_movie_min5": top_movie_min5,
    "top_movie_min5_all": top_movie_min5_all,
    "genre_membership": genre_membership,
    "genre_avg": genre_avg,
    "gender_avg": gender_avg,
    "gender_other_only": gender_other_only,
    "age_bucket_counts": age_bucket_counts,
    "age_group_avg": age_group_avg,
    "age_group_avg_all": age_group_avg_all,
    "parse_ratings": parse_ratings_q,
    "parse_ratings_min3": parse_ratings_min3,
    "parse_movies": parse_movies_q,
    "parse_users": parse_users_q,
    "parse_users_gender": parse_users_gender,
    "dim_last_wins": dim_last_wins,
    "dim_last_wins_text": dim_last_wins_text,
    "scan_ratings_dir": scan_ratings_dir,
    "mixed_dir_reject": mixed_dir_reject,
    "movie_avg_count_text": movie_avg_count_text,
    "genre_avg_text": genre_avg_text,
    "gender_avg_text": gender_avg_text,
    "age_group_avg_text": age_group_avg_text,
    "movie_report_files": movie_report_files,
    "genre_report_files": genre_report_files,
    "gender_report_files": gender_report_files,
    "age_report_files": age_report_files,
    "movie_report_single_file": movie_report_single_file,
    "genre_report_overwrite": genre_report_overwrite,
    "text_sink_roundtrip": text_sink_roundtrip,
    "movie_report_lines": movie_report_lines,
    "genre_report_lines": genre_report_lines,
    "gender_report_lines": gender_report_lines,
    "age_report_lines": age_report_lines,
    "gender_report_lines_all": gender_report_lines_all,
    "age_report_lines_all": age_report_lines_all,
    "stream_item_stats": stream_item_stats,
}
