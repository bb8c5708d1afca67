"""Single-purpose cases the golden outputs do not cover."""

import math

import pytest

from ratelens.operators import best_group
from ratelens.plans import (
    best_movie, gender_lines, gender_stats, movie_lines, movie_stats, write_lines,
)
from ratelens.sources import parse_movies, parse_ratings, parse_users
from tests.conftest import lines_of


def text_df(spark, lines):
    return spark.createDataFrame([(s,) for s in lines], "value string")


def ratings(spark, rows):
    return spark.createDataFrame(rows, "user_id int, movie_id int, rating double")


def movies(spark, rows):
    return spark.createDataFrame(
        [(i, t, t, g) for i, t, g in rows],
        "movie_id int, title_full string, title_short string, genres string")


def test_nan_average_never_wins(spark):
    r = ratings(spark, [(1, 1, float("nan"))] * 5 + [(1, 2, 1.0)] * 5)
    stats = movie_stats(r, movies(spark, [(1, "A", "x"), (2, "B", "x")]))
    got = best_movie(stats).collect()
    assert [(x.movie_id, x.title) for x in got] == [(2, "B")]
    nan_row = stats.where("movie_id = 1").first()
    assert math.isnan(nan_row.avg_rating)


def test_minus_infinity_never_wins(spark):
    r = ratings(spark, [(1, 1, float("-inf"))] * 5)
    assert best_movie(movie_stats(r, movies(spark, [(1, "A", "x")]))).count() == 0


def test_no_group_with_enough_ratings_gives_no_best(spark):
    r = ratings(spark, [(1, 1, 4.0)] * 4)
    stats = movie_stats(r, movies(spark, [(1, "A", "x")]))
    assert best_movie(stats).count() == 0
    assert lines_of(movie_lines(stats, best_movie(stats)), order=["section", "movie_id"]) == [
        "A\tAverage rating: 4.00 (Total ratings: 4)"]


def test_best_with_empty_title_prints_no_line(spark):
    r = ratings(spark, [(1, 1, 5.0)] * 5 + [(1, 2, 4.0)] * 5)
    stats = movie_stats(r, movies(spark, [(1, "", "x"), (2, "B", "x")]))
    assert best_movie(stats).count() == 0  # the runner-up is not promoted


def test_tie_keeps_lowest_id(spark):
    r = ratings(spark, [(1, 9, 4.0)] * 5 + [(1, 3, 4.0)] * 6 + [(1, 5, 3.0)] * 7)
    stats = movie_stats(r, movies(spark, []))
    assert [x.movie_id for x in best_group(stats, "movie_id").collect()] == [3]


def test_empty_gender_field_drops_user_row(spark):
    users = parse_users(text_df(spark, ["1, , 20", "2,  \t, 30", "3, F, 40"]))
    assert sorted((u.user_id, u.gender) for u in users.collect()) == [(3, "F")]


def test_title_with_pipe_kept_whole(spark):
    m = parse_movies(text_df(spark, ["1, A|B (2000), Drama"]))
    r = parse_ratings(text_df(spark, ["1, 1, 4.0, 1", "2, 1, 2.0, 1"]), min_fields=3,
                      require_user=True)
    u = parse_users(text_df(spark, ["1, M, 20", "2, F, 30"]))
    got = lines_of(gender_lines(gender_stats(r, u, m)))
    assert got == ["A|B (2000)\tMale: 4.00, Female: 2.00"]


def test_last_valid_line_wins(spark, tmp_path):
    p = tmp_path / "movies.txt"
    p.write_text("1, First, Drama\n1, Second, Comedy\n1, bad\nx1, Third, War\n")
    from ratelens.sources import read_lines
    m = parse_movies(read_lines(spark, str(p))).collect()
    assert [(x.movie_id, x.title_full, x.genres) for x in m] == [(1, "Second", "Comedy")]


def test_existing_output_directory_raises(spark, tmp_path):
    df = text_df(spark, ["b", "a"]).withColumnRenamed("value", "line")
    out = str(tmp_path / "out")
    write_lines(df, out, ["line"])
    with pytest.raises(Exception):
        write_lines(df, out, ["line"])
    write_lines(df, out, ["line"], mode="overwrite", single_file=True)
    files = sorted(p for p in (tmp_path / "out").iterdir() if p.name.startswith("part-"))
    assert len(files) == 1 and files[0].read_text() == "a\nb\n"


def test_single_file_joins_the_ordered_parts(spark, tmp_path):
    df = spark.range(3000).selectExpr("format_string('%04d', (id * 7) % 3000) AS line").repartition(9)
    write_lines(df, str(tmp_path / "o"), ["line"], single_file=True)
    parts = [p for p in (tmp_path / "o").iterdir() if p.name.startswith("part-")]
    assert len(parts) == 1
    assert parts[0].read_text().splitlines() == [f"{i:04d}" for i in range(3000)]


def test_part_files_are_ordered_by_number(spark, tmp_path):
    from ratelens.operators import file_order_position
    for i, name in enumerate(("part-99999-x", "part-100000-x", "part-100001-x")):
        (tmp_path / f"{name}.txt").write_text(f"line {i}\n")
    rows = file_order_position(spark.read.text(str(tmp_path))).collect()
    assert sorted((r["position"], r["value"]) for r in rows) == [
        (0, "line 0"), (1, "line 1"), (2, "line 2")]


def test_wide_ids_need_the_long_type(spark):
    from ratelens.sources import parse_ratings, parse_users
    lines = text_df(spark, [f"{2**31 + 5}, {2**40}, 3.5, 0", "1, 2, 4.0, 0", "1, 2\x7f, 4.0, 0",
                            "\x7f1, 2, 4.0, 0"])
    narrow = parse_ratings(lines, require_user=True).collect()
    wide = parse_ratings(lines, require_user=True, id_type="long").collect()
    assert [tuple(r) for r in narrow] == [(1, 2, 4.0)]
    assert sorted(tuple(r) for r in wide) == [(1, 2, 4.0), (2**31 + 5, 2**40, 3.5)]
    assert parse_users(text_df(spark, [f"{2**33}, M, 20"]), id_type="long").count() == 1
    with pytest.raises(ValueError):
        parse_ratings(lines, id_type="short")


def test_a_missing_dimension_file_is_an_error(spark, tmp_path):
    from pyspark.errors import AnalysisException

    from ratelens.plans.runner import run_movie_report
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "a.txt").write_text("1, 2, 3.0, 4\n")
    with pytest.raises(AnalysisException):
        run_movie_report(spark, str(tmp_path / "r"), str(tmp_path / "o"), str(tmp_path / "none.txt"))


def test_hot_keys_are_bounded_by_their_share(spark):
    from ratelens.operators import hot_keys
    df = spark.range(1000).selectExpr("CASE WHEN id < 500 THEN 0 ELSE id END AS k")
    assert hot_keys(df, "k", 1, 100) == [(0, 500)]  # every other key holds 1/1000 only
    assert len(hot_keys(df, "k", 1, 1000)) == 501


def test_equal_keys_are_spread_over_ranges(spark, tmp_path):
    from pyspark.sql import functions as F
    df = spark.range(4000).select((F.col("id") >= 10).cast("int").alias("k"),
                                  F.format_string("%04d", "id").alias("line"))
    out = tmp_path / "spread"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_lines(df, str(out), ["k"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    parts = sorted(p for p in out.iterdir() if p.name.startswith("part-"))
    lines = [ln for p in parts for ln in p.read_text().splitlines()]
    assert len(parts) > 2 and lines == [f"{i:04d}" for i in range(4000)]


def test_gender_other_only_row_survives(spark):
    r = ratings(spark, [(5, 1, 3.0)])
    u = spark.createDataFrame([(5, "X")], "user_id int, gender string")
    out = gender_stats(r, u, movies(spark, [(1, "A", "x")]), with_counts=True).collect()
    assert [(x.male_avg, x.female_avg, x.male_n, x.female_n) for x in out] == [(0.0, 0.0, 0, 0)]


def test_custom_age_buckets(spark):
    from ratelens.plans import age_stats
    r = ratings(spark, [(1, 1, 2.0), (2, 1, 4.0), (3, 1, 5.0)])
    u = spark.createDataFrame([(1, 10), (2, 40), (3, 70)], "user_id int, age int")
    out = age_stats(r, u, movies(spark, [(1, "A", "x")]), bounds=(30, 60),
                    labels=("young", "mid", "old"))
    assert out.columns == ["movie_id", "title", "age_young", "age_mid", "age_old"]
    assert [tuple(x) for x in out.collect()] == [(1, "A", 2.0, 4.0, 5.0)]


def test_a_file_rewritten_in_place_is_measured_anew(spark, tmp_path):
    from ratelens.operators import measure
    from ratelens.sources import read_lines
    d = tmp_path / "dim"
    d.mkdir()
    (d / "a.txt").write_text("1, x, y\n")
    assert measure(read_lines(spark, str(d)))[0] == 1
    (d / "a.txt").write_text("2, x, y\n" * 1000)
    assert measure(read_lines(spark, str(d)))[0] == 1000


def test_single_file_respects_an_existing_output_and_joins_gzip(spark, tmp_path):
    import gzip
    df = spark.range(500).selectExpr("format_string('%03d', id) AS line").repartition(5)
    out = str(tmp_path / "g")
    write_lines(df, out, ["line"], single_file=True, compression="gzip")
    [part] = [p for p in (tmp_path / "g").iterdir() if p.name.startswith("part-")]
    assert gzip.decompress(part.read_bytes()).decode().split() == [f"{i:03d}" for i in range(500)]
    with pytest.raises(FileExistsError):
        write_lines(df, out, ["line"], single_file=True)
