"""The edge fixture: every rule the golden outputs leave untested, R1..R4."""

import os

import pytest

from ratelens.plans import (
    age_lines, age_stats, best_movie, gender_lines, gender_stats, genre_lines,
    genre_stats, movie_lines, movie_stats,
)
from ratelens.sources import parse_movies, parse_ratings, parse_users, read_lines
from tests.conftest import lines_of

T = "\t"

EDGE_R1 = [
    f"Alpha Redux (2011){T}Average rating: 3.70 (Total ratings: 5)",
    f"Beta, The Return (2002){T}Average rating: 3.50 (Total ratings: 1)",
    f"Gamma (2003){T}Average rating: 3.70 (Total ratings: 5)",
    f"Delta (2004){T}Average rating: 2.00 (Total ratings: 1)",
    f"{T}Average rating: 1.00 (Total ratings: 1)",
    f"Epsilon (2006){T}Average rating: 5.00 (Total ratings: 4)",
    f"UnknownMovie(8){T}Average rating: 3.00 (Total ratings: 1)",
    f"Kappa (2010){T}Average rating: 0.12 (Total ratings: 2)",
    f"UnknownMovie(99){T}Average rating: 4.00 (Total ratings: 1)",
    "Alpha Redux (2011) is the highest rated movie with an average rating of 3.70 "
    "among movies with at least 5 ratings.",
]
EDGE_R2 = [
    f"Action{T}Avg: 3.50, Count: 1",
    f"Drama{T}Avg: 3.70, Count: 15",
    f"Music{T}Avg: 1.00, Count: 1",
    f"Romance{T}Avg: 3.70, Count: 5",
    f"Sci-Fi{T}Avg: 4.50, Count: 6",
    f"War{T}Avg: 3.70, Count: 5",
    f"action{T}Avg: 0.12, Count: 2",
]
EDGE_R3 = [
    f"Alpha Redux (2011){T}Male: 3.67, Female: 3.75",
    f"Beta{T}Male: 0.00, Female: 0.00",
    f"Gamma (2003){T}Male: 4.00, Female: 3.00",
    f"Delta (2004){T}Male: 2.00, Female: 0.00",
    f"Epsilon (2006){T}Male: 4.00, Female: 5.00",
    f"Kappa (2010){T}Male: 0.25, Female: 0.00",
]
EDGE_R4 = [
    f"Alpha Redux (2011){T}0-18: 4.00{T}18-35: 5.00{T}35-50: 4.50{T}50+: 2.50",
    f"Beta{T}0-18: NA{T}18-35: NA{T}35-50: 3.50{T}50+: NA",
    f"Gamma (2003){T}0-18: 3.83{T}18-35: NA{T}35-50: NA{T}50+: NA",
    f"Delta (2004){T}0-18: 2.00{T}18-35: NA{T}35-50: NA{T}50+: NA",
    f"Epsilon (2006){T}0-18: 3.50{T}18-35: 5.00{T}35-50: 5.00{T}50+: NA",
    f"Kappa (2010){T}0-18: NA{T}18-35: 0.25{T}35-50: 0.00{T}50+: NA",
]


@pytest.fixture(scope="module")
def inputs(spark, edge_dir):
    lines = read_lines(spark, edge_dir)
    movie_lines_df = read_lines(spark, os.path.join(edge_dir, "movies.txt"))
    user_lines_df = read_lines(spark, os.path.join(edge_dir, "users.txt"))
    return lines, movie_lines_df, user_lines_df


def test_r1_lines(inputs):
    lines, ml, _ = inputs
    stats = movie_stats(parse_ratings(lines, min_fields=4), parse_movies(ml))
    out = movie_lines(stats, best_movie(stats))
    assert lines_of(out, order=["section", "movie_id"]) == EDGE_R1


def test_r2_lines(inputs):
    lines, ml, _ = inputs
    stats = genre_stats(parse_ratings(lines, min_fields=3), parse_movies(ml))
    assert lines_of(genre_lines(stats), order=["genre"]) == EDGE_R2


@pytest.mark.parametrize("broadcast", [None, False])
def test_r3_lines(inputs, broadcast):
    lines, ml, ul = inputs
    stats = gender_stats(parse_ratings(lines, min_fields=3, require_user=True),
                         parse_users(ul, with_gender=True), parse_movies(ml),
                         broadcast_users=broadcast, broadcast_movies=broadcast)
    assert lines_of(gender_lines(stats), order=["movie_id"]) == EDGE_R3


@pytest.mark.parametrize("broadcast", [None, False])
def test_r4_lines(inputs, broadcast):
    lines, ml, ul = inputs
    stats = age_stats(parse_ratings(lines, min_fields=3, require_user=True),
                      parse_users(ul, with_gender=False, with_age=True), parse_movies(ml),
                      broadcast_users=broadcast, broadcast_movies=broadcast)
    assert lines_of(age_lines(stats), order=["movie_id"]) == EDGE_R4
