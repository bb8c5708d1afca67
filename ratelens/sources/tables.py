"""Adapters: the star-schema parquet test tables in the reports' shape.

ratings   lineitem (+ orders for the user): user = o_custkey,
          item = l_partkey, rating = l_quantity / 2
movies    part: title = p_name, genres = p_type | the words of p_name
users     customer: gender = first letter of c_mktsegment (M, F; the other
          segments are neither), age = floor(c_acctbal / 100)
orders as items: item = l_orderkey, title = o_orderpriority; an order has one
          to seven ratings of one customer, so averages are missing for most
          groups and many items have few ratings

Only the needed columns are selected and filters are written directly on
the scans, so they reach parquet as ``PushedFilters``/``ReadSchema``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.operators.joins import fits_broadcast, lookup_join

# Fixed value of the mapping: a rating is half the quantity.
RATING_DIVISOR = 2.0

# An order has at most seven lines, so no order key of lineitem is ever hot.
LINES_PER_ORDER = 7


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _item(by_order: bool) -> Column:
    return F.col("l_orderkey" if by_order else "l_partkey").alias("movie_id")


def item_ratings(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """``movie_id, rating`` for reports that never read the user (R1, R2)."""
    return table(spark, sf_dir, "lineitem").select(
        _item(by_order), (F.col("l_quantity") / RATING_DIVISOR).alias("rating"))


def user_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, movie_id, rating``: lineitem joined to its order's customer."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    facts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", _item(False), (F.col("l_quantity") / RATING_DIVISOR).alias("rating"))
    return lookup_join(facts, orders, "l_orderkey", "inner",
                       key_rows=LINES_PER_ORDER).drop("l_orderkey")


def movies(spark: SparkSession, sf_dir: str, by_order: bool = False) -> DataFrame:
    """``movie_id, title_full, title_short, genres`` from ``part`` (or the
    orders, without genres)."""
    if by_order:
        title = F.col("o_orderpriority")
        return table(spark, sf_dir, "orders").select(
            F.col("o_orderkey").alias("movie_id"), title.alias("title_full"),
            title.alias("title_short"), F.lit("").alias("genres"))
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("movie_id"),
        F.col("p_name").alias("title_full"),
        F.col("p_name").alias("title_short"),
        F.concat(F.col("p_type"), F.lit("|"),
                 F.replace(F.col("p_name"), F.lit(" "), F.lit("|"))).alias("genres"),
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_id, gender, age`` from ``customer``."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("user_id"),
        F.substring(F.col("c_mktsegment"), 1, 1).alias("gender"),
        F.floor(F.col("c_acctbal") / 100).cast("int").alias("age"),
    )


def order_users(spark: SparkSession, sf_dir: str, user_dim: DataFrame,
                attr: str) -> DataFrame:
    """``l_orderkey, <attr>``: each order with its customer's attribute.

    Joining the user dimension into ``orders`` (a quarter of lineitem's
    rows) instead of into the ratings saves one fact-sized shuffle when the
    dimensions are too big to broadcast: lineitem then shuffles once, on the
    order key.  Orders of unknown customers drop here (inner join).  A customer
    with very many orders is left to AQE, which splits the partition it finds
    too large: the result is dealt out anew by the order key, so nothing needs
    a customer's orders together, and finding hot customers first would read
    ``orders`` once more.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("user_id"))
    return lookup_join(orders, user_dim.select("user_id", attr), "user_id", "inner",
                       skew="none").drop("user_id")


def rated_with_user(spark: SparkSession, sf_dir: str, user_dim: DataFrame, attr: str,
                    by_order: bool = False) -> DataFrame:
    """``movie_id, <attr>, s, n`` partial sums of ratings by known users."""
    facts = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", _item(by_order), (F.col("l_quantity") / RATING_DIVISOR).alias("s"),
        F.lit(1).cast("long").alias("n"))
    ou = order_users(spark, sf_dir, user_dim, attr)
    # (orders JOIN users) has at most one row per order (user ids are unique),
    # so the orders bound its size without computing the join.
    small = fits_broadcast(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"))
    return lookup_join(facts, ou, "l_orderkey", "inner", broadcast=small,
                       key_rows=LINES_PER_ORDER).drop("l_orderkey")
