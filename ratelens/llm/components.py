"""Connected components of links, wholly as Spark joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links`` (columns ``a``, ``b``);
    ``root`` is the smallest node of its component.

    Alternating large-star and small-star steps: each hangs neighbours on the
    smallest node around, so a component becomes a star in about
    log(diameter) rounds.  A node of any degree is only ever aggregated by a
    partial minimum or joined to one row.
    """
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                        .where("u > v").distinct(), "components")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == seen or not state[0]:
            break
        seen = state
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u")
        edges = materialize(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(small.select("u", F.col("m").alias("v")))
            .where("u > v").distinct(), "components")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
