"""Links between nodes that share tiles, without all pairs of a tile.

A tile is a key that several nodes have.  Every node is first checked against
the smallest node it meets (one pair per node).  The verified links make
components, and only tiles that still hold several components are opened, in
chunks of bounded size, for pairs across components.  So a large group costs
pairs in proportion to its size, and no component is left split.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize
from .components import components

#: ``(row, others) -> mask`` of the other rows that may link with the row.
Test = Callable[[int, np.ndarray], np.ndarray]


def shared_tiles(keyed: DataFrame) -> DataFrame:
    """``key, node, hub`` of the tiles in ``node, key`` that nodes share.

    The smallest node of a key comes from a partial aggregate; the join back
    has one row per key on one side, so a hot key can be split.
    """
    shared = (keyed.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
              .where("hub < last").select("key", "hub"))
    return materialize(keyed.join(shared, "key").distinct(), "tile-members")


def mixed_tiles(members: DataFrame, roots: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``key, node, root`` of all members, and ``key, size`` of the tiles that
    hold several components."""
    rows = (members.join(roots.select("node", "root"), "node", "left")
            .select("key", "node", F.coalesce("root", "node").alias("root")))
    mixed = (rows.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"),
                                     F.count(F.lit(1)).alias("size")).where("lo < hi")
             .select("key", "size"))
    return rows, mixed


def open_rows(members: DataFrame, roots: DataFrame) -> DataFrame:
    """``key, node, root, size`` of the tiles that hold several components."""
    rows, mixed = mixed_tiles(members, roots)
    return rows.join(mixed, "key")


def open_tiles(members: DataFrame, roots: DataFrame, payload: DataFrame,
               test: Callable[[pa.Table], Test], chunk: int) -> DataFrame:
    """Pairs ``a < b`` across components that share a tile and pass ``test``,
    which sees the payload of a pair of chunks at a time."""
    opened = (open_rows(members, roots).withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int"))
              .drop("size").withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int"))
              # a chunk meets every chunk: the row goes to all its chunk pairs
              .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
              .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
              .drop("other").join(payload, "node"))

    def pairs(t: pa.Table) -> pa.Table:
        ids, root, own = (t.column(c).to_numpy() for c in ("node", "root", "own"))
        across = t.column("i")[0].as_py() != t.column("j")[0].as_py()
        may = test(t)
        a_out, b_out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in range(len(ids)):
            ok = (root != root[r]) & (ids > ids[r])
            if across:
                ok &= own != own[r]
            at = np.flatnonzero(ok)
            if len(at):
                at = at[may(r, at)]
                a_out.append(np.full(len(at), ids[r]))
                b_out.append(ids[at])
        return pa.table({"a": np.concatenate(a_out), "b": np.concatenate(b_out)})

    return opened.groupBy("key", "i", "j").applyInArrow(pairs, "a long, b long").distinct()


def join_tiles(rows: DataFrame, payload: DataFrame, test: Callable[[str, str], Column],
               chunk: int) -> DataFrame:
    """The same by a join, for a test that Spark can express: ``rows`` are those of
    ``open_rows`` for the tiles to open, ``test`` gets the prefixes of the two
    sides' payload columns.  Suits many small tiles; a large one is spread over
    its pairs of chunks."""
    opened = (rows.withColumn("chunks", F.ceil(F.col("size") / chunk).cast("int")).join(payload, "node")
              .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")))
    last = F.col("chunks") - 1
    left = opened.withColumn("i", F.col("own")).withColumn("j", F.explode(F.sequence("own", last)))
    right = opened.withColumn("j", F.col("own")).withColumn(
        "i", F.explode(F.sequence(F.lit(0), F.col("own"))))
    keep = ["node", "root", *[c for c in payload.columns if c != "node"]]
    left, right = (df.select("key", "i", "j", *[F.col(c).alias(p + c) for c in keep])
                   for df, p in ((left, "l_"), (right, "r_")))
    return (left.join(right, ["key", "i", "j"])
            .where((F.col("l_root") != F.col("r_root")) & test("l_", "r_")
                   # inside one chunk each pair would meet twice
                   & ((F.col("i") < F.col("j")) | (F.col("l_node") < F.col("r_node"))))
            .select(F.least("l_node", "r_node").alias("a"), F.greatest("l_node", "r_node").alias("b"))
            .distinct())


def _met_again(members: DataFrame, roots: DataFrame) -> DataFrame:
    """One pair ``a < b`` for each node of a tile with several components: with
    the first node of the first component, or the last one of the last."""
    rows, _ = mixed_tiles(members, roots)
    place = F.struct("root", "node")
    sides = (rows.groupBy("key").agg(F.min(place).alias("lo"), F.max(place).alias("hi"))
             .where("lo.root < hi.root"))
    other = F.when(F.col("root") == F.col("lo.root"), F.col("hi.node")).otherwise(F.col("lo.node"))
    return (rows.join(sides, "key").groupBy("node").agg(F.min(other).alias("other"))
            .select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct())


def linked(members: DataFrame, verify: Callable[[DataFrame], DataFrame],
           across: Callable[[DataFrame], DataFrame], extra: DataFrame | None = None,
           rounds: int = 0) -> DataFrame:
    """``node, root`` of all nodes with links.  ``across`` gives the pairs of
    opened tiles for the roots so far; ``extra`` are further candidates.  In up
    to ``rounds`` rounds the nodes of tiles that hold several components meet a
    node of another one, so that fewer tiles have to be opened."""
    first = (members.where("node > hub").groupBy("node").agg(F.min("hub").alias("a"))
             .select("a", F.col("node").alias("b")))
    seen = materialize(first if extra is None else first.unionByName(extra).distinct(), "tile-first")
    links = verify(seen)
    roots = components(links)
    for _ in range(rounds):
        more = materialize(_met_again(members, roots).join(seen, ["a", "b"], "left_anti"), "tile-again")
        if not more.head(1):
            break
        found = verify(more)
        seen = seen.unionByName(more)
        if not found.head(1):
            break
        links = _stars(roots).unionByName(found)
        roots = components(links)
    more = materialize(across(roots).join(seen, ["a", "b"], "left_anti"), "tile-more")
    if not more.head(1):
        return roots
    return components((_stars(roots) if rounds else links).unionByName(verify(more)))


def _stars(roots: DataFrame) -> DataFrame:
    """Links that hold the components found so far together."""
    return roots.where("node != root").select(F.col("root").alias("a"), F.col("node").alias("b"))
