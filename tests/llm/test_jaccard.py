import random

import pytest

from ratelens.llm import jaccard
from tests.llm.brute import jaccard_groups


def make(seed, n):
    """Bases of many sizes with edited copies, exact copies and odd texts."""
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    texts = []
    for _ in range(n):
        base = [rng.choice(vocab) for _ in range(rng.choice((1, 2, 3, 5, 8, 11, 14, 20, 30, 60, 150)))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 6)):
            copy = list(base)
            for _ in range(rng.choice((0, 1, 1, 2, 4, 9))):
                at = rng.randrange(len(copy))
                kind = rng.random()
                if kind < 0.4:
                    copy[at] = rng.choice(vocab)
                elif kind < 0.7:
                    copy.insert(at, rng.choice(vocab))
                elif len(copy) > 1:
                    del copy[at]
            texts.append(" ".join(copy).upper() if rng.random() < 0.1 else "\n".join(copy))
    return [(i, t) for i, t in enumerate(texts + [None, "", " \t", "a b", "A  B", texts[0]])]


@pytest.mark.parametrize("seed, join", [
    (1, jaccard.Join()), (2, jaccard.Join(words=5, num=80)), (3, jaccard.Join(chunk=3)),
    (4, jaccard.Join(words=2, num=70, chunk=5, broadcast_ids=0))])
def test_groups_equal_all_pairs(spark, seed, join):
    docs = make(seed, 40)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.groups(
        spark.createDataFrame(docs, "doc_id long, text string"), join).collect()}
    assert got == jaccard_groups(docs, join.words, join.num, join.den)


def test_chain_of_near_copies_is_one_group(spark):
    words = [f"w{i}" for i in range(200)]  # each text differs from the next in one word
    docs = [(100 - i, " ".join([f"x{j}" for j in range(i)] + words[i:])) for i in range(20)]
    rows = jaccard.groups(spark.createDataFrame(docs, "doc_id long, text string"), jaccard.Join(chunk=2))
    got = {r["doc_id"]: r["component_id"] for r in rows.collect()}
    assert got == {i: c for i, (_, c) in jaccard_groups(docs, 3, 90, 100).items()}
    assert len(set(got.values())) == 1


def test_edge_rows(edge_docs, no_docs):
    rows = jaccard.groups(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in rows}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (7, 1, 7)} <= got
    assert any(d is None and c is None and n == 10 for d, n, c in got)
    assert jaccard.groups(no_docs).count() == 0


def test_rare_sets_meet_their_band(spark):
    # every set is declared rare: the fall-back alone must find all links
    docs = make(9, 12)
    whole = jaccard.tile_keys

    def none(u, join, bands):
        _, band, _ = whole(u, join, bands)
        return whole(u[:0], join, bands)[0], band, band >= 0

    join = jaccard.Join()
    big = [(i, t) for i, t in docs if len((t or "").split()) > 20]
    jaccard.tile_keys = none
    try:
        got = {r["doc_id"]: r["component_id"] for r in jaccard.groups(
            spark.createDataFrame(big, "doc_id long, text string"), join).collect()}
    finally:
        jaccard.tile_keys = whole
    assert got == {i: c for i, (_, c) in jaccard_groups(big, 3, 90, 100).items()}


def test_components_of_long_paths(spark):
    from ratelens.llm.components import components
    links = [(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)] + [(200 + i, 200) for i in range(1, 30)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(links, "a long, b long").repartition(5)).collect()}
    want = {i: 0 for i in range(61)} | {100: 100, 101: 100} | {200 + i: 200 for i in range(30)}
    assert got == want
