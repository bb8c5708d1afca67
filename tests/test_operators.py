"""Operators: join strategies agree, skew salting, order, dedup, explode."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from ratelens.operators import (
    explode_tokens, file_order_position, fits_broadcast, hot_keys, last_wins,
    lookup_join, measure, salted_join, with_position,
)


@pytest.fixture(scope="module")
def skewed(spark):
    # key 7 owns a third of the fact rows; key 99 has no dimension row
    rows = [(7, i, float(i % 5)) for i in range(3000)]
    rows += [(k % 50, i, 1.0) for k, i in zip(range(6000), range(6000))]
    rows += [(99, 1, 2.0)] * 10
    fact = spark.createDataFrame(rows, "k long, item long, v double")
    dim = spark.createDataFrame([(k, f"name{k}") for k in range(50)],
                                "k long, name string")
    return fact, dim


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_plain_join(spark, skewed, how):
    fact, dim = skewed
    plain = fact.join(dim, "k", how).select("k", "item", "v", "name")
    hot = hot_keys(fact, "k", 500, 10)
    assert hot[0] == (7, 3120)
    salted = salted_join(fact, dim, "k", how, hot, 200, ["item"]).select("k", "item", "v", "name")
    assert rows_of(salted) == rows_of(plain)


def test_sampled_hot_key_detection(spark):
    fact = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"))
    hot = hot_keys(fact, "k", 50_000, 10, fraction=0.02)
    assert [k for k, _ in hot] == [-1] and 55_000 < hot[0][1] < 78_000


def test_salt_spreads_hot_key(spark, skewed):
    fact, dim = skewed
    hot = [(7, 3000)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle join
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(fact.where("k = 7"), dim, "k", "inner", hot, 200, ["item"])
        per_task = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in per_task) < 3000  # not all in one task


@pytest.mark.parametrize("broadcast", [True, False, None])
def test_lookup_join_strategies_agree(spark, skewed, broadcast):
    fact, dim = skewed
    spark.conf.set("ratelens.skew.hotKeyRows", "500")
    try:
        got = lookup_join(fact, dim, "k", "left", broadcast=broadcast)
    finally:
        spark.conf.unset("ratelens.skew.hotKeyRows")
    assert rows_of(got.select("k", "item", "v", "name")) == \
        rows_of(fact.join(dim, "k", "left").select("k", "item", "v", "name"))


def test_lookup_join_rejects_other_join_types(spark, skewed):
    fact, dim = skewed
    with pytest.raises(ValueError):
        lookup_join(fact, dim, "k", "full")


def test_measure_and_fits(spark):
    df = spark.createDataFrame([("abcd", 1), ("ef", 2)], "s string, i long")
    rows, size = measure(df)
    assert rows == 2 and size == 2 * (16 + 16) + 6
    assert fits_broadcast(df, 1000) and not fits_broadcast(df, 10) and not fits_broadcast(df, 0)


def test_last_wins_takes_greatest_order(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "z")],
                               "k int, pos int, v string")
    got = sorted(tuple(r) for r in last_wins(df, "k", "pos", ["v"]).collect())
    assert got == [(1, "c"), (2, "z")]


def test_explode_tokens_trims_and_drops_empty(spark):
    df = spark.createDataFrame([(1, "Drama|Drama| |War"), (2, "")], "id int, g string")
    got = sorted(tuple(r) for r in explode_tokens(df, "g", "genre").collect())
    assert got == [(1, "Drama"), (1, "Drama"), (1, "War")]


def test_with_position_is_global_rank(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    got = with_position(df, ["k"]).collect()
    assert all(r["k"] == r["position"] for r in got) and len(got) == 5000


def test_file_order_position(spark, tmp_path):
    df = spark.range(0, 3000).select(F.format_string("%05d", "id").alias("line"))
    out = str(tmp_path / "lines")
    df.orderBy("line").repartitionByRange(5, "line").write.text(out)
    got = file_order_position(spark.read.text(out)).collect()
    assert sorted((int(r["value"]), r["position"]) for r in got) == [(i, i) for i in range(3000)]


@pytest.fixture()
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_file_order_position_across_splits(spark, tmp_path, tiny_splits):
    p = tmp_path / "big.txt"
    p.write_text("".join(f"{i:06d}\n" for i in range(20000)))
    lines = spark.read.text(str(p))
    assert lines.rdd.getNumPartitions() > 10
    got = file_order_position(lines).collect()
    assert sorted((int(r["value"]), r["position"]) for r in got) == [(i, i) for i in range(20000)]


def test_last_line_wins_across_splits(spark, tmp_path, tiny_splits):
    from ratelens.sources import parse_keyed, read_lines
    p = tmp_path / "dim.txt"
    # every id appears in many splits; the last occurrence has value "v<last line>"
    p.write_text("".join(f"{i % 7}, v{i}\n" for i in range(6000)))
    lines = read_lines(spark, str(p))
    assert lines.rdd.getNumPartitions() > 5
    got = sorted(tuple(r) for r in parse_keyed(lines, 1, "v").collect())
    assert got == sorted((k, f"v{max(i for i in range(6000) if i % 7 == k)}") for k in range(7))
