"""The four reports, typed first; ``*_lines`` render them as text.

R1 ``movie_stats``/``best_movie``: average and count per item, titles looked
   up after the aggregation (left join, unknown items labelled), best item
   with a minimum number of ratings.
R2 ``genre_stats``: average and count per genre; a rating counts once per
   listed genre.  Ratings are summed per item first, so the join and the
   explode touch items x genres rows, not ratings x genres.
R3 ``gender_stats``: per item, average of male and of female users
   (0.0 when a side has no rating).
R4 ``age_stats``: per item, average in four age buckets (NULL when empty).

R3/R4 join the users into the ratings, aggregate per item in one pass with
conditional sums and join titles to the aggregate (one row per item).
Items with an empty title are left out of R3/R4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.functions import (
    AGE_BOUNDS,
    AGE_LABELS,
    FEMALE,
    MALE,
    MISSING_TEXT,
    bucket_label,
    fmt2,
    unknown_label,
)
from ratelens.functions.labels import UNKNOWN_PREFIX
from ratelens.functions.text import LIST_SEPARATOR_REGEX
from ratelens.operators import (
    as_partial,
    avg_count_by,
    best_group,
    conditional_avgs,
    detect_hot_keys,
    explode_tokens,
    fits_broadcast,
    lookup_join,
    pre_aggregate,
)

# The text around the numbers in each report line.
R1_AVG = "\tAverage rating: "
R1_TOTAL = " (Total ratings: "
R1_CLOSE = ")"
R1_BEST = " is the highest rated movie with an average rating of "
R1_BEST_TAIL_1 = " among movies with at least "
R1_BEST_TAIL_2 = " ratings."
R2_AVG = "\tAvg: "
R2_COUNT = ", Count: "
R3_MALE = "\tMale: "
R3_FEMALE = ", Female: "
MIN_RATINGS = 5


# ---------------------------------------------------------------- R1

def movie_stats(ratings: DataFrame, movies: DataFrame, title_col: str = "title_full",
                broadcast: bool | None = None,
                unknown_prefix: str = UNKNOWN_PREFIX) -> DataFrame:
    """``movie_id, title, avg_rating, n`` for every rated item; an item
    without a title row is labelled ``<unknown_prefix><id>)``."""
    agg = avg_count_by(as_partial(ratings, ["movie_id"]), "movie_id")
    titles = movies.select("movie_id", F.col(title_col).alias("title"))
    joined = lookup_join(agg, titles, "movie_id", "left", broadcast=broadcast, skew="none")
    return joined.select(
        "movie_id",
        F.coalesce(F.col("title"), unknown_label("movie_id", unknown_prefix)).alias("title"),
        "avg_rating", "n",
    )


def best_movie(stats: DataFrame, min_count: int = MIN_RATINGS) -> DataFrame:
    """The best item of ``movie_stats`` (0 or 1 row).

    When the winner's title is empty there is no best line at all; the next
    candidate is not promoted.
    """
    return best_group(stats, "movie_id", min_count).where(F.col("title") != "")


def movie_lines(stats: DataFrame, best: DataFrame, min_count: int = MIN_RATINGS) -> DataFrame:
    """``section, movie_id, line``: one line per item (section 0, by id),
    then the best-item line (section 1)."""
    rows = stats.select(
        F.lit(0).alias("section"), "movie_id",
        F.concat(F.col("title"), F.lit(R1_AVG), fmt2("avg_rating"), F.lit(R1_TOTAL),
                 F.col("n").cast("string"), F.lit(R1_CLOSE)).alias("line"),
    )
    summary = best.select(
        F.lit(1).alias("section"), "movie_id",
        F.concat(F.col("title"), F.lit(R1_BEST), fmt2("avg_rating"), F.lit(R1_BEST_TAIL_1),
                 F.lit(str(min_count)), F.lit(R1_BEST_TAIL_2)).alias("line"),
    )
    return rows.unionByName(summary)


# ---------------------------------------------------------------- R2

def genre_stats(ratings: DataFrame, movies: DataFrame, broadcast: bool | None = None,
                separator_regex: str = LIST_SEPARATOR_REGEX) -> DataFrame:
    """``genre, avg_rating, n``; items without a title row or with an empty
    genre list are left out."""
    per_item = pre_aggregate(as_partial(ratings, ["movie_id"]), ["movie_id"])
    genres = movies.select("movie_id", "genres").where(F.col("genres") != "")
    joined = lookup_join(per_item, genres, "movie_id", "inner", broadcast=broadcast, skew="none")
    return avg_count_by(explode_tokens(joined, "genres", "genre", separator_regex), "genre")


def genre_lines(stats: DataFrame) -> DataFrame:
    """``genre, line``."""
    return stats.select(
        "genre",
        F.concat(F.col("genre"), F.lit(R2_AVG), fmt2("avg_rating"), F.lit(R2_COUNT),
                 F.col("n").cast("string")).alias("line"),
    )


# ---------------------------------------------------------------- R3 / R4

def _rated(ratings: DataFrame, user_dim: DataFrame, attr: str,
           broadcast_users: bool | None, salt_users: bool = False) -> DataFrame:
    """``movie_id, <attr>, s, n`` partial sums of ratings by known users.

    Users that fit are broadcast into the scan stage.  Otherwise the ratings
    are shuffled once, on the user, and Spark splits the partitions of users
    that own many ratings at run time (adaptive skew join); the partial sums
    per item and attribute follow in the same stage.  ``salt_users`` spreads
    users found hot on a sample instead, at the price of reading the ratings
    once more.
    """
    b = fits_broadcast(user_dim) if broadcast_users is None else broadcast_users
    partials = as_partial(ratings, ["user_id", "movie_id"])
    hot = detect_hot_keys(ratings.select("user_id"), "user_id") if salt_users and not b else []
    rated = lookup_join(partials, user_dim, "user_id", "inner", broadcast=b, skew=hot,
                        salt_cols=["movie_id", "s"])
    return rated.drop("user_id")


def _with_titles(per_item: DataFrame, movies: DataFrame, title_col: str,
                 broadcast: bool | None) -> DataFrame:
    titles = movies.select("movie_id", F.col(title_col).alias("title"))
    out = lookup_join(per_item, titles, "movie_id", "inner", broadcast=broadcast, skew="none")
    cols = ["movie_id", "title"] + [c for c in per_item.columns if c != "movie_id"]
    return out.where(F.col("title") != "").select(*cols)


def gender_stats_from_rated(rated: DataFrame, movies: DataFrame, title_col: str = "title_short",
                            missing: float | None = 0.0, with_counts: bool = False,
                            broadcast_movies: bool | None = None) -> DataFrame:
    """R3 from ``movie_id, gender, s, n`` partial sums."""
    per_item = conditional_avgs(
        rated, "movie_id", "gender", [MALE, FEMALE], ["male_avg", "female_avg"], missing,
        count_names=["male_n", "female_n"] if with_counts else None)
    return _with_titles(per_item, movies, title_col, broadcast_movies)


def gender_stats(ratings: DataFrame, users: DataFrame, movies: DataFrame,
                 title_col: str = "title_short", missing: float | None = 0.0,
                 with_counts: bool = False, broadcast_users: bool | None = None,
                 broadcast_movies: bool | None = None, salt_users: bool = False) -> DataFrame:
    """``movie_id, title, male_avg, female_avg`` (+ ``male_n, female_n``).

    A user whose gender is neither M nor F adds to no average, but an item
    rated only by such users still gets a row (both averages ``missing``).
    """
    rated = _rated(ratings, users.select("user_id", "gender"), "gender", broadcast_users,
                   salt_users)
    return gender_stats_from_rated(rated, movies, title_col, missing, with_counts,
                                   broadcast_movies)


def age_columns(labels: Sequence[str] = AGE_LABELS) -> list[str]:
    """Column names for bucket labels: 0-18 -> age_0_18, 50+ -> age_50_plus."""
    return ["age_" + lab.replace("-", "_").replace("+", "_plus") for lab in labels]


def age_stats_from_rated(rated: DataFrame, movies: DataFrame, title_col: str = "title_short",
                         labels: Sequence[str] = AGE_LABELS,
                         broadcast_movies: bool | None = None) -> DataFrame:
    """R4 from ``movie_id, age_group, s, n`` partial sums."""
    per_item = conditional_avgs(rated, "movie_id", "age_group", list(labels),
                                age_columns(labels), None)
    return _with_titles(per_item, movies, title_col, broadcast_movies)


def user_age_groups(users: DataFrame, bounds: Sequence[int] = AGE_BOUNDS,
                    labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    """``user_id, age_group``: the bucket is computed once per user."""
    return users.select("user_id", bucket_label("age", bounds, labels).alias("age_group"))


def age_stats(ratings: DataFrame, users: DataFrame, movies: DataFrame,
              title_col: str = "title_short", bounds: Sequence[int] = AGE_BOUNDS,
              labels: Sequence[str] = AGE_LABELS, broadcast_users: bool | None = None,
              broadcast_movies: bool | None = None, salt_users: bool = False) -> DataFrame:
    """``movie_id, title, age_0_18, age_18_35, age_35_50, age_50_plus``."""
    rated = _rated(ratings, user_age_groups(users, bounds, labels), "age_group",
                   broadcast_users, salt_users)
    return age_stats_from_rated(rated, movies, title_col, labels, broadcast_movies)


def gender_lines(stats: DataFrame) -> DataFrame:
    """``movie_id, line``."""
    return stats.select(
        "movie_id",
        F.concat(F.col("title"), F.lit(R3_MALE), fmt2("male_avg"), F.lit(R3_FEMALE),
                 fmt2("female_avg")).alias("line"),
    )


def age_lines(stats: DataFrame, labels: Sequence[str] = AGE_LABELS) -> DataFrame:
    """``movie_id, line``; an empty bucket prints NA."""
    parts = [F.col("title")]
    for label, name in zip(labels, age_columns(labels)):
        parts += [F.lit(f"\t{label}: "), F.coalesce(fmt2(name), F.lit(MISSING_TEXT))]
    return stats.select("movie_id", F.concat(*parts).alias("line"))
