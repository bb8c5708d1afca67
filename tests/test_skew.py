"""Reports over a fact where one user owns a third of all ratings."""

import pytest
from pyspark.sql import functions as F

from ratelens.plans import age_stats, gender_stats


@pytest.fixture(scope="module")
def skewed_inputs(spark):
    n = 9000
    base = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise((F.col("id") % 97 + 2).cast("int"))
        .alias("user_id"),
        (F.col("id") % 41).cast("int").alias("movie_id"),
        ((F.col("id") % 10) / 2.0).alias("rating"))
    users = spark.range(1, 100).select(
        F.col("id").cast("int").alias("user_id"),
        F.when(F.col("id") % 3 == 0, "M").when(F.col("id") % 3 == 1, "F").otherwise("X")
        .alias("gender"),
        (F.col("id") % 70).cast("int").alias("age"))
    movies = spark.range(0, 41).select(
        F.col("id").cast("int").alias("movie_id"),
        F.concat(F.lit("t"), F.col("id").cast("string")).alias("title_short"))
    return base, users, movies


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("salt", [False, True])
@pytest.mark.parametrize("report", [gender_stats, age_stats])
def test_shuffle_paths_equal_broadcast_path(spark, skewed_inputs, report, salt):
    ratings, users, movies = skewed_inputs
    expected = rows(report(ratings, users, movies, broadcast_users=True, broadcast_movies=True))
    spark.conf.set("ratelens.skew.hotKeyRows", "500")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = rows(report(ratings, users, movies, broadcast_users=False,
                          broadcast_movies=False, salt_users=salt))
    finally:
        spark.conf.unset("ratelens.skew.hotKeyRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert got == expected and len(got) == 41
