import math
from fractions import Fraction

import numpy as np
import pytest

from ratelens.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, label int, component string"


def plain(rows):
    """Whole numbers of the rows that take part, the fit list, and its moments, exactly."""
    own = [(i, [math.floor(64 * c) + 1_000_000 for c in v]) for i, v in rows
           if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in own})
    sums = [sum(c) for c in zip(*fit)]
    centred = np.array([[float(Fraction(len(fit) * c - t, len(fit))) for c, t in zip(x, sums)] for x in fit])
    return own, len(fit), sums, centred.T @ centred / len(fit)


def compare(got, rows, most=16):
    own, n, sums, v = plain(rows)
    values = np.linalg.eigvalsh(v)[::-1]
    k = min(most, int((values > values[0] * len(v) * 1e-12).sum()))
    assert len(got) == len(own) * k
    by_row = {}
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(values[r["component"] - 1] / values.sum(), rel=1e-9)
        by_row.setdefault(r["vec_id"], {})[r["component"]] = (r["whitened"], int(r["deviation"]))
    unit = {}
    for i, x in own:
        centred = np.array([float(Fraction(n * c - t, n)) for c, t in zip(x, sums)])
        assert {d for _, d in by_row[i].values()} == {sum((n * c - t) ** 2 for c, t in zip(x, sums))}
        unit.setdefault("c", []).append(centred)
        unit.setdefault("w", []).append([by_row[i][j][0] for j in range(1, k + 1)])
    c, w = np.array(unit["c"]), np.array(unit["w"])
    _, vectors = np.linalg.eigh(v)
    expect = c @ vectors[:, ::-1][:, :k] / np.sqrt(values[:k])
    sign = np.sign((expect * w).sum(axis=0))
    assert np.allclose(w, expect * sign, atol=1e-7)


def test_rows_equal_the_dense_solution(spark):
    rng = np.random.default_rng(5)
    base = rng.standard_normal((300, 20)) * np.linspace(0.3, 4, 20)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[3][1]) for i in range(40)]  # copies count once
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 18), (2002, [float("nan")] * 20),
             (2003, [float("inf")] + [0.0] * 19), (2004, [])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], SCHEMA)
    compare(whitening.whiten(df).collect(), rows)


def test_given_vectors(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], [float(c) for c in r["embedding"]]) for r in df.collect()]
    compare(queries.op12_whitening(spark, sf_dir).collect(), rows)


def test_odd_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert whitening.whiten(empty).count() == 0
    same = spark.createDataFrame([(1, [1.0, 2.0], 0, None), (2, [1.0, 2.0], 0, None)], SCHEMA)
    assert whitening.whiten(same).count() == 0  # no variance, so no component
    few = [(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0]), (None, [5.0, 1.0, 0.0])]
    ragged = few + [(4, [1.0]), (5, [1e300, 0.0, 0.0])]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, None) for i, v in ragged], SCHEMA)).collect()
    compare(got, few)


def test_large_numbers_stay_exact(spark):
    rows = [(i, [1e9 * i, 3e8 * i * i, -2e7 * i]) for i in range(40)]
    got = whitening.whiten(spark.createDataFrame([(i, v, 0, None) for i, v in rows], SCHEMA)).collect()
    _, n, sums, _ = plain(rows)
    for r in got:
        x = [math.floor(64 * c) + 1_000_000 for c in rows[r["vec_id"]][1]]
        assert int(r["deviation"]) == sum((n * c - t) ** 2 for c, t in zip(x, sums))


@pytest.mark.parametrize("name", ["random", "rank", "decay", "ties", "gap", "one"])
def test_feast_finds_the_leading_pairs(name):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((400, 48))
    a = {"random": x.T @ x, "rank": x[:9].T @ x[:9], "decay": (x * np.logspace(0, -6, 48)).T @ (x * np.logspace(0, -6, 48)),
         "ties": np.diag([5.0] * 10 + [5 - 1e-9] * 5 + [1.0] * 33), "gap": np.diag([1e9] + [1.0] * 30),
         "one": np.array([[3.0]])}[name]
    e, v = whitening.leading(a, whitening.Whitening())
    want = np.linalg.eigvalsh(a)[::-1][:len(e)]
    assert len(e) == (9 if name == "rank" else min(16, len(a)))
    assert np.abs(e - want).max() <= 1e-13 * want[0]
    assert np.abs(a @ v.T - v.T * e).max() <= 1e-13 * want[0]
    assert np.abs(v @ v.T - np.eye(len(e))).max() <= 1e-13


def test_inertia_counts_eigenvalues():
    rng = np.random.default_rng(4)
    for n in (1, 2, 3, 30):
        a = rng.standard_normal((n, n))
        a += a.T
        shifts = rng.standard_normal(50) * 4
        want = (np.linalg.eigvalsh(a)[None, :] > shifts[:, None]).sum(axis=1)
        assert (whitening.inertia(*whitening.tridiagonal(a), shifts) == want).all()
