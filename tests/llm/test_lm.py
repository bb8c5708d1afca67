import math
import zlib
from collections import Counter

import numpy as np
import pyarrow.compute as pc
import pytest

from ratelens.llm import langid, lm, queries
from tests.llm.brute import words


def base_scores(docs, held):
    tokens = {i: words(t) + [None] for i, t in docs}
    c = Counter(w for i, t in docs if not held[i] for w in tokens[i])
    n, v = sum(c.values()), len(c)
    return {i: (len(x), sum(c[w] > 0 for w in x), n,
                sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in x)) for i, x in tokens.items()}


def test_counts_and_base_equal_brute_force(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i, _ in docs}
    want = base_scores(docs, held)
    rows = queries.op2_lm_score(spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(held)
    for r in rows:
        n, known, train, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (
            n, known, train, held[r["doc_id"]])
        assert r["base_score"] == pytest.approx(base)
    out = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)


def test_probabilities_sum_to_one():
    s = lm.Settings(words=2, endings=2, others=2, bits=8)
    rng = np.random.default_rng(0)
    mass, types = np.array([9, 4, 30, 11, 7, 0]), np.array([1, 1, 8, 5, 3, 0])
    model = lm.Classes(((1, 1), (2, 2)), (3, 4), int(mass.sum()), int(types.sum()), mass, types)
    # in every class: its words' shares and one slot for unseen words
    for m, v in zip(mass, types):
        counts = np.ones(v)
        if v:
            counts[0] = m - v + 1
        assert sum((c + 0.5) / (m + 0.5 * (v + 1)) for c in [*counts, 0]) == pytest.approx(1)
    w = rng.normal(size=(256, s.classes)).astype(np.float32)
    x = lm.features(rng.integers(0, 99, 50).astype(np.uint64), rng.integers(0, 6, 50), np.array([0, 20]), 8)
    p = lm._softmax(lm._logits(w, np.zeros(s.classes, np.float32), x))
    assert np.allclose(p.sum(axis=1), 1, atol=1e-5) and model.total == 61


def test_context_helps(spark):
    # after "a" always "b" or "c", after "x" always "y" or "z"
    rng = np.random.default_rng(1)
    docs = []
    for i in range(400):
        first, then = (("a", "bc"), ("x", "yz"))[i % 2]
        docs.append((i, " ".join(f"{first} {then[rng.integers(2)]}{rng.integers(30)}" for _ in range(60)), i % 5 == 1))
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")
    rows = lm.score(df, lm.Settings(shares=(1,), block_bytes=4000)).where("held_out").collect()
    assert len(rows) == 80 and all(r["score"] > r["base_score"] for r in rows)


def test_edge_rows(edge_docs, no_docs):
    df = edge_docs.withColumn("held_out", langid.held_out("doc_id", 5))
    rows = lm.score(df).collect()
    assert len(rows) == edge_docs.count()
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (1, 2, 3)} == {1}
    assert lm.score(no_docs.selectExpr("doc_id", "text", "true AS held_out")).count() == 0
    unlearned = lm.score(edge_docs.selectExpr("doc_id", "text", "true AS held_out")).collect()
    assert all(r["train_tokens"] == 0 and r["base_score"] == 0 and math.isfinite(r["score"]) for r in unlearned)


def test_word_numbers_survive_packing():
    x = np.array([0, 1, 255, 256, 70000, 2**32 - 1], dtype=np.uint32)
    assert (lm._numbers(lm._planes(x), np.uint32) == x).all()


def test_context_tells_words_of_one_class_apart(spark):
    # one ending, so one class: only the word before says which of 40 words comes next
    names = [f"{chr(97 + i % 26)}{i}zz" for i in range(40)]
    docs = [(i, " ".join(names[(i * 7 + j) % 40] for j in range(200)), i % 5 == 1) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean")
    s = lm.Settings(words=1, endings=1, others=1, shares=(1,), block_bytes=4000, part_keys=500)
    rows = lm.score(df, s).where("held_out").collect()
    assert len(rows) == 12 and all(r["score"] > 0.25 * r["base_score"] for r in rows)


@pytest.mark.parametrize("part_keys", [2_000_000, 40])
def test_neighbours_are_counted_over_all_blocks(spark, part_keys):
    rng = np.random.default_rng(3)
    docs = [(i, " ".join(f"w{rng.integers(9)}" for _ in range(30)), i % 4 == 1) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string, held_out boolean").repartition(3)
    s = lm.Settings(block_bytes=400, part_keys=part_keys)
    blocks = lm.tokenize(df, s.block_bytes).persist()
    model = lm.Classes.of(lm.word_counts(blocks), s)
    sent = lm.block_counts(blocks, model, s).toArrow()
    want = Counter()
    for _, text, held in docs:
        if not held:
            want.update(zip([0, *words(text)], [*words(text), 1]))
    texts = {i: text for i, text, _ in docs}
    rows = blocks.collect()
    assert len(rows) > 10
    for row in rows:
        row = {k: np.asarray(v) if isinstance(v, list) else v for k, v in row.asDict().items()}
        _, place = lm._neighbours(row, model, s)
        own = sent.filter(pc.equal(sent.column("block"), row["block"]))
        got = lm._in_order(own, words=False)[place][:len(place) // 2].tolist()
        own = [pair for i in row["doc_id"] for pair in zip([0, *words(texts[i])], [*words(texts[i]), 1])]
        assert got == [want[pair] for pair in own]


def test_blended_shares_sum_to_one():
    counts, prior = np.array([5.0, 0, 12, 1]), np.array([0.1, 0.4, 0.3, 0.2])
    for n in (counts, counts * 0):
        total = np.full(4, n.sum())
        assert lm.blend(n, total, prior, (3.0, 0.7)).sum() == pytest.approx(1)
