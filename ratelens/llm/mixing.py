"""Mixing sources to target weights by Sainte-Laguë apportionment.

1. Targets.  Every source has a weight; the weights share all words.  A
   target stops at ``cap`` times its source's size and the excess goes to the
   other sources by weight, until none is above (water filling: one tiny
   aggregate per step over one row per source).
2. Quotas.  Documents are dealt over shards by a hash of their id, about
   ``shard_tokens`` words each, so a hot source is cut into as many cells as
   it needs.  A cell (source, shard) is cut into equal blocks of about
   ``block_tokens`` words.  In every shard, blocks are the seats and go to the
   sources by highest quotients ``v / (2 j + 1)``, where ``v`` is the part of a
   source's target that lies in the shard, in blocks.
3. Selection.  A cell is one stream of words in seeded order.  All blocks are taken ``quota div blocks`` times and a
   seeded choice of them once more.  A document takes the words that its part
   of the stream has in the chosen blocks.

Nothing depends on the layout of the input: reruns give the same mix.

Defined results for odd rows: a null text has size 0 and takes nothing; a
null source is one source, ordered last; repeated rows are separate
documents; an empty table gives an empty mix; columns that the mix makes
replace input columns of the same name, all others pass through.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratelens.operators.ordering import with_position

from .common import materialize, word_array

WEIGHTS = (5, 2, 1)

#: Primes above any block count of a cell: multiplying by one permutes the
#: block numbers of a cell.
_PRIMES = (2147483647, 2147483629, 2147483587, 2147483579)

_KEYS = ["_src", "_nosrc", "_shard"]


def source_targets(sources: DataFrame, weights: Sequence[int], cap: int) -> DataFrame:
    """``_src, _nosrc, source_size`` plus ``target``; one row per source."""
    ranked = with_position(sources, [F.col("_nosrc").asc(), F.col("_src").asc()], "_rank")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]),
                   F.pmod("_rank", F.lit(len(weights))).cast("int"))
    ranked = ranked.withColumn("_w", weight)
    limit = F.col("source_size") * F.lit(float(cap))
    total, all_w = ranked.agg(F.sum("source_size"), F.sum("_w")).first()
    level = float(total or 0) / all_w if all_w else 0.0
    n_capped = 0
    while True:
        above = F.col("_w") * F.lit(level) > limit
        n, used, left = ranked.agg(F.count(F.when(above, 1)), F.sum(F.when(above, limit)),
                                   F.sum(F.when(~above, F.col("_w")))).first()
        if n == n_capped or not left:
            break
        n_capped, level = n, (total - used) / left
    return ranked.select("_src", "_nosrc", "source_size",
                         F.least(limit, F.col("_w") * F.lit(level)).alias("target"))


def shard_quotas(cells: DataFrame) -> DataFrame:
    """Seats per cell by highest quotients inside each shard.

    ``cells`` has ``_KEYS`` and ``_v`` (blocks wanted).  Of ``n`` seats and
    ``k`` sources with total ``V``, the divisors ``V / (n - k/2)`` and
    ``V / (n + k/2)`` enclose the right one, so only about two seats per
    source lie between them; these alone are ranked.
    """
    shard = Window.partitionBy("_shard")
    k, seats, v = F.col("_k"), F.col("_n"), F.col("_v")
    bounds = (cells
              .withColumn("_k", F.count(F.lit(1)).over(shard))
              .withColumn("_all", F.sum("_v").over(shard))
              .withColumn("_n", F.round("_all").cast("long"))
              .withColumn("_sure", F.when(seats > k, F.greatest(
                  F.lit(0), F.floor(v * (seats - k / 2) / F.col("_all") - 0.5).cast("long")))
                  .otherwise(F.lit(0).cast("long")))
              .withColumn("_most", F.when(F.col("_all") > 0, F.floor(
                  v * (seats + k / 2) / F.col("_all") + 1.5).cast("long"))
                  .otherwise(F.lit(0).cast("long")))
              .withColumn("_open", seats - F.sum("_sure").over(shard)))
    order = Window.partitionBy("_shard").orderBy(F.desc("_q"), "_nosrc", "_src")
    won = (bounds.where(F.col("_most") > F.col("_sure"))
           .select(*_KEYS, "_v", "_open",
                   F.explode(F.sequence(F.col("_sure"), F.col("_most") - 1)).alias("_j"))
           .withColumn("_q", v / (2 * F.col("_j") + 1))
           .withColumn("_place", F.row_number().over(order))
           .where(F.col("_place") <= F.col("_open"))
           .groupBy(*_KEYS).agg(F.count(F.lit(1)).alias("_won")))
    return (bounds.select(*_KEYS, "_sure").join(won, _KEYS, "left")
            .select(*_KEYS, (F.col("_sure") + F.coalesce("_won", F.lit(0))).alias("_seats")))


def _taken(seed: int) -> Column:
    """Words of the document at ``_start`` in the blocks its cell takes."""
    size, start, blocks, cell = F.col("size"), F.col("_start"), F.col("_blocks"), F.col("_cell")
    more = F.pmod(F.col("_seats"), blocks)
    pick = F.pmod(F.xxhash64(F.lit(seed), "_src", "_nosrc", "_shard"), F.lit(1 << 30))
    step = F.get(F.array(*[F.lit(p) for p in _PRIMES]),
                 F.pmod(pick, F.lit(len(_PRIMES))).cast("int"))

    def first_word(j: Column) -> Column:
        return _div(j * cell, blocks)

    def block_of(word: Column) -> Column:
        return _div((word + 1) * blocks - 1, cell)

    def words(j: Column) -> Column:
        chosen = F.pmod(j * F.pmod(step, blocks) + pick, blocks) < more
        inside = F.least(start + size, first_word(j + 1)) - F.greatest(start, first_word(j))
        return F.when(chosen, inside).otherwise(F.lit(0).cast("long"))

    extra = F.aggregate(
        F.sequence(block_of(start), block_of(start + size - 1)),
        F.lit(0).cast("long"), lambda a, j: a + words(j))
    return F.when((size == 0) | F.col("_seats").isNull(), F.lit(0).cast("long")).otherwise(
        _div(F.col("_seats"), blocks) * size + extra)


def _div(a: Column, b: Column) -> Column:
    """Whole-number division of longs that aren't negative."""
    return F.call_function("div", a, b)


def mix(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", source: str = "source",
        weights: Sequence[int] = WEIGHTS, cap: int = 3, block_tokens: int = 16,
        shard_tokens: int = 1 << 20, seed: int = 17, row: str | None = None) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` (and ``source``) per row.

    Only ids, sources and sizes leave the scan of the texts.  ``row`` names a
    column that tells rows apart and is returned with them.
    """
    carry = [row] if row else []
    sized = materialize(docs.select(
        F.col(doc_id).alias("doc_id"), F.col(source).alias("source"),
        F.size(word_array(F.col(text))).cast("long").alias("size"), *carry), "mix-sizes")
    sized = sized.withColumn("_src", F.coalesce("source", F.lit(""))) \
                 .withColumn("_nosrc", F.col("source").isNull())
    sources = materialize(sized.groupBy("_src", "_nosrc")
                          .agg(F.sum("size").alias("source_size")), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    n_shards = max(1, math.ceil(total / shard_tokens))
    targets = materialize(source_targets(sources, weights, cap), "mix-targets")

    place = F.xxhash64(F.lit(seed), "doc_id", "size")
    sized = sized.withColumn("_place", place).withColumn(
        "_shard", F.pmod(F.shiftrightunsigned("_place", 7), F.lit(n_shards)))
    cells = (sized.groupBy(*_KEYS).agg(F.sum("size").alias("_cell"))
             .join(targets, ["_src", "_nosrc"])
             .where("_cell > 0")
             .withColumn("_blocks", F.greatest(F.lit(1), F.round(F.col("_cell") / block_tokens))
                         .cast("long"))
             # the cell's part of the target, in blocks of the cell
             .withColumn("_v", F.col("target") * F.col("_blocks") / F.col("source_size")))
    cells = materialize(cells, "mix-cells")
    quotas = cells.join(shard_quotas(cells.select(*_KEYS, "_v")), _KEYS).withColumn(
        "_seats", F.least("_seats", cap * F.col("_blocks"))).drop("source_size", "target")
    stream = Window.partitionBy(*_KEYS).orderBy("_place", "doc_id", "size", *carry)
    return (sized.withColumn("_start", F.sum("size").over(stream.rowsBetween(
                Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
            .join(quotas, _KEYS, "left").join(targets, ["_src", "_nosrc"])
            .select("doc_id", "size", "source_size", "target",
                    _taken(seed).alias("taken"), "source", *carry))


def copies(size: Column, taken: Column, doc_id: Column, seed: int = 17) -> Column:
    """How often a whole document enters the mix: ``taken / size``, its
    fraction settled by a seeded draw on the id."""
    share = F.when(size > 0, taken / size).otherwise(F.lit(0.0))
    draw = F.pmod(F.xxhash64(F.lit(seed + 1), doc_id), F.lit(1 << 20)) / float(1 << 20)
    return (F.floor(share) + F.when(draw < share - F.floor(share), 1).otherwise(0)).cast("int")
