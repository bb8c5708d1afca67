"""Approximate nearest neighbours by inner product: a forest of random-projection
trees searched through one shared priority queue, then exact reranking.

* Vectors are made distinct first; a class keeps its ``k + 1`` smallest ids,
  which is all that any answer can need of it.
* Inner product becomes nearness: vectors get one more component that fills
  their length up to the longest, queries get a zero there.
* The trees are fitted on a bounded, hash-drawn sample (two sampled points give
  a direction, the median the split); every vector is indexed in every tree.
* A query walks all trees at once: one queue holds the open nodes of the whole
  forest by the squared distance their splits put between the query and the
  node's cell, and the nearest leaves are taken in that order.
* The number of leaves per query is measured, not guessed: the smallest that
  finds ``recall`` of the true neighbours of a bounded set of sample queries,
  whose brute-force answers are computed over all rows.
* Leaves lie in buckets of bounded size, which meet the queries that take any
  of their leaves.  Candidates are scored exactly in double precision, and a
  bucket returns the best of each query.

Defined results for odd rows: vectors that are null, empty, zero or hold null
or non-finite components take no part; vectors of other lengths are searched
apart; repeated rows with one id are one row; ties go to the smaller id; fewer
candidates than ``k`` give fewer rows; an empty table gives an empty result;
only the columns named are read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize

RESULT = "query_id long, rank int, vec_id long, score double"


@dataclass(frozen=True)
class Settings:
    k: int = 20
    trees: int = 6
    leaf: int = 256            # vectors per leaf aimed at
    sample: int = 16_384       # vectors the trees are fitted on
    probes: int = 256          # queries that measure the recall
    recall: float = 0.95
    chunk: int = 65_536        # vectors in one bucket of leaves
    queries: int = 32_768      # queries of one bucket in one task
    seed: int = 5


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``id, v`` of the vectors that take part, one row per id and vector."""
    v = F.col(vec_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (vectors.where(F.col(id_col).isNotNull() & v.isNotNull())
            .where(fine & F.exists(v, lambda x: x != 0))
            .select(F.col(id_col).cast("long").alias("id"), v.alias("v")))


def _first(ids: Column, by: list[str], n: int, name: str = "_n") -> Column:
    """Place by ``ids`` within ``by``; filtered below ``n`` before the shuffle."""
    return F.row_number().over(Window.partitionBy(*by).orderBy(ids)).alias(name)


def classes_of(rows: DataFrame, k: int) -> DataFrame:
    """Distinct vectors: ``c`` (smallest id), ``v``, ``ids`` (k + 1 smallest)."""
    ranked = rows.distinct().withColumn("_n", _first(F.col("id"), ["v"], k)).where(F.col("_n") <= k + 1)
    return (ranked.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids"))
            .select(F.get("ids", F.lit(0)).alias("c"), "v", "ids"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


class Forest:
    """Splits of all trees, as one matrix of directions; node ``2 i + 1`` and
    ``2 i + 2`` below node ``i``, leaves numbered from 0 in every tree."""

    def __init__(self, points: np.ndarray, n: int, longest: float, s: Settings):
        self.longest = longest
        self.trees = s.trees
        most = max(0, int(np.log2(max(1, len(points) // 8))))
        self.depth = min(most, max(0, round(float(np.log2(max(1.0, n / s.leaf))))))
        rng = np.random.default_rng(s.seed)
        x = self.lift(points)
        inner = (1 << self.depth) - 1
        self.w = np.zeros((s.trees, inner, x.shape[1]), np.float32)
        self.b = np.zeros((s.trees, inner), np.float32)
        for t in range(s.trees):
            at = np.zeros(len(x), dtype=np.int64)
            for node in range(inner):
                own = np.flatnonzero(at == node)
                i, j = rng.choice(own, 2, replace=False) if len(own) > 1 else (0, 0)
                w = x[i] - x[j]
                if not w.any():
                    w = rng.normal(size=x.shape[1])
                w = w / np.linalg.norm(w)
                p = x[own] @ w
                self.w[t, node] = w
                self.b[t, node] = np.median(p) if len(own) else 0.0
                at[own] = 2 * node + 1 + (p > self.b[t, node])

    @property
    def leaves(self) -> int:
        return 1 << self.depth

    def lift(self, x: np.ndarray) -> np.ndarray:
        rest = self.longest ** 2 - (x * x).sum(axis=1)
        return np.column_stack([x, np.sqrt(np.maximum(rest, 0.0))])

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Cell ``tree * leaves + leaf`` of every vector in every tree."""
        x = self.lift(x).astype(np.float32)
        out = np.empty((len(x), self.trees), dtype=np.int64)
        for t in range(self.trees):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                p = np.einsum("ij,ij->i", x, self.w[t, node])
                node = 2 * node + 1 + (p > self.b[t, node])
            out[:, t] = t * self.leaves + node - ((1 << self.depth) - 1)
        return out

    def nearest_cells(self, queries: np.ndarray, most: int) -> list[list[int]]:
        """The first ``most`` cells of every query, from one queue for all trees."""
        q = np.column_stack([queries, np.zeros(len(queries))]).astype(np.float32)
        inner = (1 << self.depth) - 1
        margins = np.einsum("ij,tnj->itn", q, self.w, optimize=True) - self.b
        out = []
        for m in margins:
            heap = [(0.0, t, 0) for t in range(self.trees)]
            taken: list[int] = []
            while heap and len(taken) < most:
                cost, t, node = heapq.heappop(heap)
                while node < inner:  # down the near side, the far side waits
                    d = float(m[t, node])
                    near, far = (2, 1) if d > 0 else (1, 2)
                    heapq.heappush(heap, (cost + d * d, t, 2 * node + far))
                    node = 2 * node + near
                taken.append(t * self.leaves + node - inner)
            out.append(taken)
        return out


def _top(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` largest scores of a row, ties included."""
    if len(scores) <= k:
        return np.arange(len(scores))
    return np.flatnonzero(scores >= np.partition(scores, -k)[-k])


def _true_neighbours(index: DataFrame, probes: np.ndarray, ids: np.ndarray, dim: int, k: int) -> DataFrame:
    """``p, c`` the brute-force neighbours of the probes over all vectors."""
    shared = index.sparkSession.sparkContext.broadcast((probes, ids))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, own = shared.value
        for b in batches:
            c = b.column("c").to_numpy()
            scores = q @ _matrix(b.column("v"), dim).T
            scores[own[:, None] == c[None, :]] = -np.inf
            rows = [_top(x, k) for x in scores]
            p = np.repeat(np.arange(len(q)), [len(r) for r in rows])
            at = np.concatenate(rows)
            yield pa.record_batch({"p": pa.array(p), "c": pa.array(c[at]),
                                   "score": pa.array(scores[p, at])})

    found = index.select("c", "v").mapInArrow(lean(scan), "p long, c long, score double")
    place = F.row_number().over(Window.partitionBy("p").orderBy(F.desc("score"), "c"))
    return found.where(F.col("score") > float("-inf")).withColumn("_n", place).where(F.col("_n") <= k)


def leaves_needed(index: DataFrame, forest: Forest, probes: pa.Table, dim: int, s: Settings) -> int:
    """Fewest leaves per query that reach the recall on the probes."""
    q, ids = _matrix(probes.column("v").combine_chunks(), dim), probes.column("c").to_numpy()
    truth = _true_neighbours(index, q, ids, dim, s.k).join(
        index.select("c", "cells"), "c").select("p", "cells").collect()  # probes x k rows
    everything = forest.trees * forest.leaves
    if not truth:
        return everything
    place = [{c: i for i, c in enumerate(cells)} for cells in forest.nearest_cells(q, everything)]
    first = sorted(min(place[r["p"]][c] for c in r["cells"]) for r in truth)
    return min(everything, first[min(len(first) - 1, int(np.ceil(s.recall * len(first))) - 1)] + 1)


def _buckets(sizes: dict[int, int], forest: Forest, most: int) -> tuple[np.ndarray, np.ndarray]:
    """First bucket and number of buckets of every cell.

    A bucket takes neighbouring leaves of one tree up to about ``most``
    vectors, so it meets no vector twice; a larger leaf has several.
    """
    n = forest.trees * forest.leaves
    first, count = np.zeros(n, np.int64), np.ones(n, np.int64)
    bucket, held = 0, 0
    for cell in range(n):
        size = sizes.get(cell, 0)
        if held and (held + size > most or cell % forest.leaves == 0):
            bucket, held = bucket + 1, 0
        first[cell], count[cell] = bucket, max(1, -(-size // most))
        bucket, held = bucket + count[cell] - 1, held + size
    return first, count


class _Best:
    """The ``k`` best candidates of every query, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.least = np.full(n, -np.inf)
        self.rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, q: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        at, col = np.nonzero(scores >= self.least[q][:, None])
        self.rows.append((q[at], ids[col], scores[at, col]))
        self.held += len(at)
        if self.held > 500_000:
            self.settle()

    def settle(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        empty = np.zeros(0, np.int64)
        q, c, s = (np.concatenate([e, *x]) for e, x in zip(
            (empty, empty, np.zeros(0)), zip(*self.rows) if self.rows else ((), (), ())))
        order = np.lexsort((c, -s, q))
        q, c, s = q[order], c[order], s[order]
        starts = np.searchsorted(q, np.arange(len(self.least)))
        place = np.arange(len(q)) - starts[q]
        last = place == self.k - 1
        self.least[q[last]] = s[last]
        keep = place < self.k
        self.rows = [(q[keep], c[keep], s[keep])]
        self.held = 0
        return self.rows[0]


def _candidates(cells: DataFrame, queries: DataFrame, forest: Forest, sizes: dict[int, int],
                most: int, dim: int, s: Settings) -> DataFrame:
    """``q, c, score``: the best of every query in each bucket of its leaves."""
    first, count = _buckets(sizes, forest, s.chunk)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                rows, buckets, lists = [], [], []
                for i, taken in enumerate(forest.nearest_cells(_matrix(part.column("v"), dim), most)):
                    own: dict[int, list[int]] = {}
                    for cell in taken:
                        for k in range(first[cell], first[cell] + count[cell]):
                            own.setdefault(k, []).append(cell)
                    rows += [i] * len(own)
                    buckets += own.keys()
                    lists += own.values()
                i = pa.array(rows, pa.int64())
                yield pa.record_batch({
                    "bucket": pa.array(buckets, pa.int64()), "q": part.column("c").take(i),
                    "taken": pa.array(lists, pa.list_(pa.int64())),
                    "x": part.column("v").take(i).cast(pa.list_(pa.float64()))})

    asked = materialize(queries.select("c", "v").mapInArrow(
        lean(walk), "bucket long, q long, taken array<long>, x array<double>"), "ann-asked")
    # many queries of one bucket are spread over copies of it
    parts = F.coalesce(F.get(F.lit(_parts(asked, int((first + count).max()), s)),
                             F.col("bucket").cast("int")), F.lit(1))
    asked = asked.withColumn("part", F.pmod(F.xxhash64("q"), parts).cast("int"))
    bucket = F.get(F.lit(first.tolist()), F.col("cell").cast("int")) + F.pmod(
        F.xxhash64("c"), F.get(F.lit(count.tolist()), F.col("cell").cast("int")))
    stored = cells.withColumn("bucket", bucket).withColumn(
        "part", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1)))

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        left, right = left.combine_chunks(), right.combine_chunks()
        q = right.column("q").to_numpy()
        best = _Best(len(q), s.k + 1)
        if left.num_rows and len(q):
            order = np.argsort(left.column("cell").to_numpy(), kind="stable")
            cell, c = left.column("cell").to_numpy()[order], left.column("c").to_numpy()[order]
            v, x = _matrix(left.column("v").chunk(0), dim)[order], _matrix(right.column("x").chunk(0), dim)
            lists = right.column("taken").chunk(0)
            owner = np.repeat(np.arange(len(q)), np.diff(lists.offsets.to_numpy()))
            wanted = lists.flatten().to_numpy()
            by = np.argsort(wanted, kind="stable")
            wanted, owner = wanted[by], owner[by]
            for k in np.unique(cell):
                a, b = np.searchsorted(cell, (k, k + 1))
                rows = owner[np.searchsorted(wanted, k):np.searchsorted(wanted, k + 1)]
                for at in range(0, len(rows), 1024):
                    own = rows[at:at + 1024]
                    best.add(own, c[a:b], x[own] @ v[a:b].T)
        at, c_, s_ = best.settle()
        return pa.table({"q": q[at], "c": c_, "score": s_})

    return (stored.groupBy("bucket", "part").cogroup(asked.groupBy("bucket", "part"))
            .applyInArrow(score, "q long, c long, score double"))


def _parts(asked: DataFrame, n: int, s: Settings) -> list[int]:
    """Copies of every bucket, by its number of queries (one row per bucket)."""
    out = [1] * n
    for r in asked.groupBy("bucket").count().collect():
        out[r["bucket"]] = -(-r["count"] // s.queries)
    return out


def _search(rows: DataFrame, dim: int, is_query: Column, s: Settings) -> DataFrame:
    """Neighbours among the vectors of one length."""
    classes = materialize(classes_of(rows, s.k), "ann-classes")
    n, longest = classes.agg(F.count(F.lit(1)), F.max(F.sqrt(F.aggregate(
        "v", F.lit(0.0), lambda a, x: a + x.cast("double") * x)))).first()
    asked = materialize(rows.where(is_query).select("id", "v").distinct()
                        .join(classes.select("c", "v"), "v").select("id", "c"), "ann-queries")
    queries = classes.join(asked.select("c").distinct(), "c", "left_semi")
    order = F.xxhash64(F.lit(s.seed), "c")
    drawn = classes.select("c", "v").orderBy(order, "c").limit(s.sample).toArrow()
    forest = Forest(_matrix(drawn.column("v").combine_chunks(), dim), n, longest, s)
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = forest.cells(_matrix(b.column("v"), dim))
            yield pa.RecordBatch.from_arrays(
                [b.column("c"), b.column("v"), pa.array(list(cells), pa.list_(pa.int64()))],
                names=["c", "v", "cells"])

    kind = classes.schema["v"].dataType.simpleString()
    index = materialize(classes.select("c", "v").mapInArrow(
        lean(place), f"c long, v {kind}, cells array<long>"), "ann-index")
    probes = queries.select("c", "v").orderBy(order, "c").limit(s.probes).toArrow()
    if not probes.num_rows:
        return rows.sparkSession.createDataFrame([], RESULT)
    most = leaves_needed(index, forest, probes, dim, s)
    cells = index.select("c", "v", F.explode("cells").alias("cell"))
    sizes = {r["cell"]: r["count"] for r in cells.groupBy("cell").count().collect()}  # one per leaf
    found = _candidates(cells, queries, forest, sizes, most, dim, s)
    best = Window.partitionBy("q").orderBy(F.desc("score"), "c")
    top = (found.groupBy("q", "c").agg(F.max("score").alias("score"))
           .withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= s.k + 1))
    exact = (top.select("q", "c").join(classes.select("c", F.col("v").alias("vc"), "ids"), "c")
             .join(queries.select(F.col("c").alias("q"), F.col("v").alias("vq")), "q")
             .select("q", "ids", F.aggregate(
                 F.zip_with("vq", "vc", lambda a, b: a.cast("double") * b.cast("double")),
                 F.lit(0.0), lambda a, x: a + x).alias("score")))
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asked.select(F.col("id").alias("query_id"), F.col("c").alias("q")).join(exact, "q")
            .select("query_id", "score", F.explode("ids").alias("vec_id"))
            .where("vec_id != query_id")
            .withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= s.k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id",
            vec_col: str = "embedding", s: Settings = Settings()) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the rows where ``is_query`` (over ``id``)."""
    rows = materialize(usable(vectors, id_col, vec_col), "ann-vectors")
    sizes = [r[0] for r in rows.select(F.size("v")).distinct().collect()]  # one per vector length
    parts = [_search(rows.where(F.size("v") == d), d, is_query, s) for d in sorted(sizes)]
    empty = vectors.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, parts, empty) if len(parts) != 1 else parts[0]
