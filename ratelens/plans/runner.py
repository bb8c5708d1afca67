"""End-to-end reports: text inputs in, one ordered text report out.

Each report reads every file below ``ratings_path`` (sub-folders included)
as rating lines (other files lying there fall out by the row rules), parses
the dimension file(s), computes the typed report and writes one line per
group, ordered as the report requires, through ``write_lines``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from ratelens.plans.reports import (
    MIN_RATINGS,
    age_lines,
    age_stats,
    best_movie,
    gender_lines,
    gender_stats,
    genre_lines,
    genre_stats,
    movie_lines,
    movie_stats,
)
from ratelens.plans.sinks import write_lines
from ratelens.sources import parse_movies, parse_ratings, parse_users, read_lines


def run_movie_report(spark: SparkSession, ratings_path: str, output: str, movies_path: str,
                     mode: str = "errorifexists", single_file: bool = False,
                     min_count: int = MIN_RATINGS, id_type: str = "int") -> None:
    """R1: ``title<TAB>Average rating: x (Total ratings: n)`` by item id, then
    the best-item line."""
    ratings = parse_ratings(read_lines(spark, ratings_path, recursive=True), min_fields=4,
                            id_type=id_type)
    stats = movie_stats(ratings, parse_movies(read_lines(spark, movies_path),
                                              fields=["title_full"], id_type=id_type))
    lines = movie_lines(stats, best_movie(stats, min_count), min_count)
    write_lines(lines, output, ["section", "movie_id"], mode=mode, single_file=single_file)


def run_genre_report(spark: SparkSession, ratings_path: str, output: str, movies_path: str,
                     mode: str = "errorifexists", single_file: bool = False,
                     id_type: str = "int") -> None:
    """R2: ``genre<TAB>Avg: x, Count: n`` by genre (byte order)."""
    ratings = parse_ratings(read_lines(spark, ratings_path, recursive=True), min_fields=3,
                            id_type=id_type)
    stats = genre_stats(ratings, parse_movies(read_lines(spark, movies_path), fields=["genres"],
                                               id_type=id_type))
    write_lines(genre_lines(stats), output, ["genre"], mode=mode, single_file=single_file)


def run_gender_report(spark: SparkSession, ratings_path: str, output: str, movies_path: str,
                      users_path: str, mode: str = "errorifexists",
                      single_file: bool = False, id_type: str = "int") -> None:
    """R3: ``title<TAB>Male: x, Female: y`` by item id."""
    ratings = parse_ratings(read_lines(spark, ratings_path, recursive=True), min_fields=3,
                            require_user=True, id_type=id_type)
    users = parse_users(read_lines(spark, users_path), with_gender=True, id_type=id_type)
    stats = gender_stats(ratings, users, parse_movies(read_lines(spark, movies_path),
                                                      fields=["title_short"], id_type=id_type))
    write_lines(gender_lines(stats), output, ["movie_id"], mode=mode, single_file=single_file)


def run_age_report(spark: SparkSession, ratings_path: str, output: str, movies_path: str,
                   users_path: str, mode: str = "errorifexists",
                   single_file: bool = False, id_type: str = "int") -> None:
    """R4: ``title<TAB>0-18: x<TAB>18-35: x<TAB>35-50: x<TAB>50+: x`` by item id."""
    ratings = parse_ratings(read_lines(spark, ratings_path, recursive=True), min_fields=3,
                            require_user=True, id_type=id_type)
    users = parse_users(read_lines(spark, users_path), with_gender=False, with_age=True,
                        id_type=id_type)
    stats = age_stats(ratings, users, parse_movies(read_lines(spark, movies_path),
                                                   fields=["title_short"], id_type=id_type))
    write_lines(age_lines(stats), output, ["movie_id"], mode=mode, single_file=single_file)
