import re
from collections import defaultdict

import pytest

from ratelens.llm import mixing


def words(t):
    return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Plain water filling: cap, reshare the excess by weight, again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        left = total - sum(cap * sizes[s] for s in capped)
        out = {s: cap * sizes[s] if s in capped else left * w[s] / sum(w[x] for x in free)
               for s in names}
        over = [s for s in free if out[s] > cap * sizes[s]]
        if not over:
            return out
        capped |= set(over)


def check(rows, tolerance):
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= tolerance + 0.02 * want[s], s
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]


def test_whole_table(spark, documents):
    rows = mixing.mix(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(len(rows)))
    text = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert all(r["size"] == words(text[r["doc_id"]]) for r in rows)
    check(rows, 16)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixing.mix(documents.repartition(7)).collect()))


def test_hot_and_tiny_sources_over_shards(spark):
    docs = [(i, "w " * (i % 50 + 1), "hot" if i % 3 else f"s{i % 7}") for i in range(600)]
    docs += [(1000, "a b c", "tiny"), (1001, "x " * 5000, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    check(mixing.mix(df, shard_tokens=2000, block_tokens=4).collect(), 16 * 4)


def test_edge_rows(edge_docs, no_docs):
    rows = mixing.mix(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    check(rows, 32)
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    assert mixing.mix(no_docs).count() == 0


def test_seats_follow_the_highest_quotients(spark):
    values = {"a": 53.0, "b": 24.0, "c": 23.0, "d": 0.4}
    cells = spark.createDataFrame([(s, False, 0, v) for s, v in values.items()],
                                  "_src string, _nosrc boolean, _shard int, _v double")
    got = {r["_src"]: r["_seats"] for r in mixing.shard_quotas(cells).collect()}
    seats = dict.fromkeys(values, 0)
    for _ in range(round(sum(values.values()))):
        best = max(values, key=lambda s: values[s] / (2 * seats[s] + 1))
        seats[best] += 1
    assert got == seats
