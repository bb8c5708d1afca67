"""Dimension lookups: size-checked broadcast, else a skew-safe shuffle join.

The reports join a large fact (ratings) to dimensions (items, users).  A
dimension is broadcast only after an explicit measurement shows it fits
(``fits_broadcast``); otherwise both sides are shuffled on the key.  In the
shuffle case a key that holds a large share of the fact rows would land in a
single task, so the fact's hot keys are found first (a count per key on a
fixed-seed sample sized so a key at the threshold shows about a thousand
sampled rows; each also holds a least share of all rows, which bounds the list),
their rows are spread over ``ceil(rows / hot_key_rows)`` salt values, and the
dimension rows of just those keys are replicated once per salt value.  Cold
keys join unchanged.  The salt is a hash of row contents, so a re-executed
task puts every row in the same place again.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tunables (session conf keys and their defaults).
BROADCAST_MAX_BYTES_KEY = "ratelens.broadcast.maxBytes"
BROADCAST_MAX_BYTES = 64 * 1024 * 1024
HOT_KEY_ROWS_KEY = "ratelens.skew.hotKeyRows"
HOT_KEY_ROWS = 2_000_000
MAX_HOT_KEYS_KEY = "ratelens.skew.maxHotKeys"
MAX_HOT_KEYS = 100_000
EXPANSION = 4  # files may grow by this in memory

_FIXED_WIDTH = 8     # bytes per fixed-width field in an unsafe row
_ROW_OVERHEAD = 16   # header, null bits, hash-table pointer


def _conf_int(df: DataFrame, key: str, default: int) -> int:
    value = df.sparkSession.conf.get(key, None)
    return int(value) if value is not None else default


def measure(df: DataFrame) -> tuple[int, int]:
    """``(rows, approximate bytes)`` of ``df`` in one distributed aggregate.

    Variable-length columns are measured exactly (octet length); fixed-width
    columns count 8 bytes.  Only a two-number row reaches the driver.  The
    size only steers the join strategy, never results.
    """
    var_cols = [f.name for f in df.schema.fields
                if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    n_fixed = len(df.schema.fields) - len(var_cols)
    var_bytes = [F.coalesce(F.octet_length(F.col(c)), F.lit(0)).cast("long") for c in var_cols]
    total_var = F.sum(sum(var_bytes[1:], var_bytes[0])) if var_bytes else F.lit(0)
    row = df.agg(F.count(F.lit(1)).alias("n"), total_var.alias("v")).first()
    rows = int(row["n"])
    var = int(row["v"] or 0)
    return rows, rows * (_ROW_OVERHEAD + _FIXED_WIDTH * (n_fixed + len(var_cols))) + var


def estimate(df: DataFrame) -> int | None:
    """Catalyst's size estimate of ``df`` in bytes (free: from file sizes and
    plan statistics), or ``None`` where the plan can't be reached."""
    plan = getattr(df, "_jdf", None)  # absent on Spark Connect
    if plan is None:
        return None
    return int(str(plan.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(df: DataFrame) -> int:
    """Largest dimension size (bytes) that may be broadcast; <= 0 disables."""
    return _conf_int(df, BROADCAST_MAX_BYTES_KEY, BROADCAST_MAX_BYTES)


def fits_broadcast(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when ``df`` is within the broadcast limit.

    The free estimate decides where it is clear even if the files expand by
    ``EXPANSION`` in memory; only otherwise is the dimension measured (nothing
    is remembered, so a changed file is seen).
    """
    limit = max_bytes if max_bytes is not None else broadcast_limit(df)
    if limit <= 0:
        return False
    guess = estimate(df)
    if guess is not None and guess * EXPANSION <= limit:
        return True
    _, size = measure(df)
    return size <= limit


def detect_hot_keys(fact: DataFrame, key: str) -> list[tuple]:
    """``hot_keys`` with the session's thresholds."""
    return hot_keys(fact, key, _conf_int(fact, HOT_KEY_ROWS_KEY, HOT_KEY_ROWS),
                    _conf_int(fact, MAX_HOT_KEYS_KEY, MAX_HOT_KEYS))


SAMPLED_ROWS_AT_THRESHOLD = 1000
SAMPLE_SEED = 17


def hot_keys(fact: DataFrame, key: str, min_rows: int, max_keys: int,
             fraction: float | None = None) -> list[tuple]:
    """Keys of ``fact`` with (an estimated) ``min_rows`` rows or more, largest first.

    The count runs on a fixed-seed sample of ``fraction`` of the rows
    (default: enough that a key at the threshold expects about a thousand
    sampled rows; 1.0 - exact - for small thresholds), so finding hot keys
    does not shuffle every key of a large fact.  The estimate only decides
    which keys are salted; every row is joined whatever it says.  A hot key
    also holds at least ``1 / max_keys`` of all rows, so there are at most
    ``max_keys`` of them and the list is bounded without a cut; smaller keys
    cannot outweigh a partition by much.
    """
    if fraction is None:
        fraction = min(1.0, SAMPLED_ROWS_AT_THRESHOLD / max(min_rows, 1))
    src = fact if fraction >= 1.0 else fact.sample(fraction=fraction, seed=SAMPLE_SEED)
    counts = src.groupBy(key).agg(
        (F.count(F.lit(1)) / F.lit(fraction)).cast("long").alias("_rows"))
    least = max(min_rows, src.count() / fraction / max_keys)
    top = counts.where(F.col("_rows") >= least).orderBy(F.desc("_rows"), F.asc(key))
    return [(r[key], int(r["_rows"])) for r in top.collect()]


def salted_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str,
    hot: Sequence[tuple],
    rows_per_salt: int,
    salt_cols: Sequence[str] | None = None,
) -> DataFrame:
    """Shuffle join where the listed hot keys are spread over salt values."""
    spark = fact.sparkSession
    key_type = fact.schema[key].dataType
    buckets = [(k, max(1, math.ceil(n / rows_per_salt))) for k, n in hot]
    hot_df = spark.createDataFrame(
        buckets, T.StructType([T.StructField(key, key_type),
                               T.StructField("_buckets", T.IntegerType())]))
    # hot_df has at most MAX_HOT_KEYS rows (bounded above): safe to broadcast.
    cols = list(salt_cols) if salt_cols else [c for c in fact.columns if c != key]
    salted_fact = fact.join(F.broadcast(hot_df), key, "left").withColumn(
        "_salt",
        F.when(F.col("_buckets").isNull(), F.lit(0))
        .otherwise(F.pmod(F.xxhash64(*cols), F.col("_buckets").cast("long")).cast("int")),
    ).drop("_buckets")
    salted_dim = dim.join(F.broadcast(hot_df), key, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_buckets").isNull(), F.array(F.lit(0)))
            .otherwise(F.sequence(F.lit(0), F.col("_buckets") - 1))
        ),
    ).drop("_buckets")
    return salted_fact.join(salted_dim, [key, "_salt"], how).drop("_salt")


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "inner",
    broadcast: bool | None = None,
    skew: str | Sequence[tuple] = "detect",
    salt_cols: Sequence[str] | None = None,
    key_rows: int | None = None,
) -> DataFrame:
    """Join ``fact`` (left side) to ``dim`` on ``key``; ``how`` is inner or left.

    ``broadcast``: True/False forces the strategy, None measures ``dim``.
    ``skew``: ``detect`` looks for hot fact keys before a shuffle join,
    ``none`` skips that (for joins whose fact keys are unique, such as an
    aggregate joined to its titles), or a precomputed hot-key list (found on
    a cheaper input, e.g. the rows before a pre-aggregation).
    ``key_rows``: the most fact rows that any key can have, where the data
    model bounds them; a bound below the hot-key threshold settles that no key
    is hot, so nothing is counted.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be 'inner' or 'left'")
    if broadcast is None:
        broadcast = fits_broadcast(dim)
    if broadcast:
        return fact.join(F.broadcast(dim), key, how)
    if key_rows is not None and key_rows < _conf_int(fact, HOT_KEY_ROWS_KEY, HOT_KEY_ROWS):
        skew = "none"
    if isinstance(skew, str):
        if skew == "detect":
            hot = detect_hot_keys(fact, key)
        elif skew == "none":
            hot = []
        else:
            raise ValueError("skew must be 'detect', 'none' or a hot-key list")
    else:
        hot = list(skew)
    if hot:
        rows_per_salt = _conf_int(fact, HOT_KEY_ROWS_KEY, HOT_KEY_ROWS)
        return salted_join(fact, dim, key, how, hot, rows_per_salt, salt_cols)
    return fact.join(dim, key, how)
