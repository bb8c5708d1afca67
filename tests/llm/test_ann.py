import numpy as np
import pytest

from ratelens.llm import ann, queries


def brute(rows, k):
    """``query -> [(rank, id, score)]`` over usable vectors of equal length."""
    good = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[i] = np.array(v, dtype=np.float64)
    out = {}
    for q in good:
        if q % 20 == 0:
            near = sorted((-float(v @ good[q]), i) for i, v in good.items() if i != q and len(v) == len(good[q]))
            out[q] = [(r, i, -s) for r, (s, i) in enumerate(near[:k], 1)]
    return out


def answer(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return {q: sorted(v) for q, v in out.items()}


def test_odd_vectors_ties_and_copies(spark):
    same = [0.5, 0.25, -1.0]
    rows = [(0, same), (20, [1.0, 0.0, 0.0]), (21, same), (22, same), (23, None), (24, []), (25, [0.0, 0.0, 0.0]),
            (26, [1.0, None, 2.0]), (27, [float("nan"), 1.0, 1.0]), (28, [float("inf"), 1.0, 1.0]), (40, [3.0, 4.0]),
            (41, [1.0, 1.0]), (60, [0.0, 0.0, 0.0]), (21, same), (None, same)]
    rows += [(100 + i, same) for i in range(60)] + [(200 + i, [float(i % 7), 1.0, -2.0]) for i in range(50)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = answer(ann.nearest(df, queries.F.col("id") % 20 == 0, s=ann.Settings(recall=1.0)))
    want = brute(rows, 20)
    assert got.keys() == want.keys()
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]], q
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]])


@pytest.mark.parametrize("chunk, queries_", [(65536, 32768), (100, 7)])
def test_recall_on_clusters(spark, chunk, queries_):
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(30, 24))
    points = (centres[rng.integers(30, size=3000)] * rng.uniform(0.5, 2, (3000, 1))
              + 0.3 * rng.normal(size=(3000, 24))).astype(np.float32)
    rows = [(i, p.tolist()) for i, p in enumerate(points)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got = answer(ann.nearest(df, queries.F.col("id") % 20 == 0, s=ann.Settings(leaf=64, chunk=chunk, queries=queries_, probes=64)))
    want = brute(rows, 20)
    hits = sum(len({x[1] for x in want[q]} & {x[1] for x in got[q]}) for q in want)
    assert hits / (20 * len(want)) >= 0.9
    for q, found in got.items():
        assert [x[0] for x in found] == list(range(1, 21))
        assert all(abs(float(points[q].astype(float) @ points[i].astype(float)) - s) < 1e-9 for _, i, s in found)


def test_query_recall(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got, want = answer(queries.op4_nearest_vectors(spark, sf_dir)), brute(rows, 20)
    hits = sum(len({x[1] for x in want[q]} & {x[1] for x in got[q]}) for q in want)
    assert hits / sum(map(len, want.values())) >= 0.9


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(df, queries.F.col("id") % 20 == 0).count() == 0
