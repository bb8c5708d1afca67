"""Plan shape: what the physical plans must keep as data grows."""

import contextlib
import io
import os

import pytest

from __spark_entry__ import queries
from tests.conftest import SF_SMALL

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_SMALL), reason="test tables absent")


@pytest.fixture(autouse=True)
def full_metadata(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")  # no "..." in filters
    yield
    spark.conf.unset("spark.sql.maxMetadataStringLength")


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_r1_aggregates_before_the_title_join_and_prunes_columns(spark):
    p = plan(queries()["movie_avg_count"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_partkey:bigint,l_quantity:double>" in p
    assert "BroadcastHashJoin" in p and "LeftOuter" in p and "SortMergeJoin" not in p
    assert p.count("Exchange hashpartitioning") == 1  # only the partial aggregates move
    assert "partial_sum" in p
    # the join consumes the final aggregate (it sits above it in the tree)
    assert p.index("BroadcastHashJoin") < p.index("HashAggregate(keys=[movie_id")


def test_r3_star_join_only_shuffles_partial_aggregates(spark):
    p = plan(queries()["gender_avg"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in p
    assert p.count("Exchange hashpartitioning") == 1


def test_whole_tables_are_read(spark):
    for name in ("top_movie_min5", "age_group_avg", "gender_other_only", "genre_avg"):
        p = plan(queries()[name](spark, SF_SMALL))
        pushed = [ln for ln in p.splitlines() if "PushedFilters" in ln]
        assert pushed
        for ln in pushed:
            filters = ln.split("PushedFilters: [", 1)[1].split("]", 1)[0]
            # only what the joins and the empty-title rule need
            left = [f for f in filters.split(", ") if f and not f.startswith(
                ("IsNotNull", "Not(EqualTo(p_name,", "Not(EqualTo(o_orderpriority,"))]
            assert all(f in (")", "))") for f in left), ln


def test_large_users_cost_one_shuffle_of_the_ratings(spark):
    from ratelens.plans import gender_stats
    ratings = spark.range(1000).selectExpr("id % 50 AS user_id", "id % 7 AS movie_id",
                                           "id / 2 AS rating")
    users = spark.range(50).selectExpr("id AS user_id", "'M' AS gender")
    movies = spark.range(7).selectExpr("id AS movie_id", "'t' AS title_short")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(gender_stats(ratings, users, movies, broadcast_users=False,
                              broadcast_movies=True))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert p.count("Exchange hashpartitioning(user_id") == 2  # ratings and users, once each
    assert p.count("Exchange hashpartitioning") == 3          # and the partial sums per item
    assert "Scan ExistingRDD" not in p                        # no checkpoint in between


def test_r2_explodes_after_the_per_item_aggregate(spark):
    p = plan(queries()["genre_avg"](spark, SF_SMALL))
    generate = p.index("Generate")
    inner_aggs = [i for i in range(len(p)) if p.startswith("HashAggregate", i)]
    assert len(inner_aggs) == 4
    assert inner_aggs[1] < generate < inner_aggs[2]  # genre aggs above, item aggs below


def test_large_dimensions_use_shuffle_joins(spark):
    spark.conf.set("ratelens.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(queries()["gender_avg"](spark, SF_SMALL))
    finally:
        spark.conf.unset("ratelens.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "BroadcastExchange" not in p


def test_text_parse_runs_once_per_line(spark):
    p = plan(queries()["parse_ratings"](spark, SF_SMALL))
    filter_line = next(ln for ln in p.splitlines() if "Filter" in ln)
    # the filter reads parsed columns; the parse is not inlined into it
    assert "split(" not in filter_line and "try_cast" not in filter_line
    assert "rand(" in p
    assert "regexp_replace" not in p  # character-set trims only


def test_best_item_is_a_per_task_top1(spark):
    p = plan(queries()["top_movie_min5"](spark, SF_SMALL))
    assert "TakeOrderedAndProject(limit=1" in p
    assert "rangepartitioning" not in p  # no global sort
    assert p.count("Exchange hashpartitioning") == 1


def test_table_reports_look_for_no_hot_orders(spark, monkeypatch):
    """An order has a bounded number of lines: beyond the broadcast limit the
    joins by order run without a count of their keys."""
    from ratelens.operators import joins
    from ratelens.plans import catalog

    def fail(*args, **kwargs):
        raise AssertionError("hot keys were counted")

    want = sorted(tuple(r) for r in catalog.QUERIES["gender_avg"](spark, SF_SMALL).collect())
    monkeypatch.setattr(joins, "detect_hot_keys", fail)
    spark.conf.set("ratelens.broadcast.maxBytes", "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = catalog.QUERIES["gender_avg"](spark, SF_SMALL).collect()
    finally:
        spark.conf.unset("ratelens.broadcast.maxBytes")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sorted(tuple(r) for r in got) == want and want
