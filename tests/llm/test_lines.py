import os
import random
import subprocess
import sys
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from ratelens.llm import lines
from ratelens.llm.common import materialize, mix64
from ratelens.llm.filters import bloom_filter
from ratelens.llm.tokens import word_keys
from tests.llm.brute import levenshtein, line_removals


def simhash(words):
    words = [w for w in words if len(w) >= 5] or words
    counts = [0] * 64
    for h in mix64(word_keys(pa.array(words))).tolist():
        for k in range(64):
            counts[k] += h >> k & 1
    return sum((2 * c > len(words)) << k for k, c in enumerate(counts))


def normal(line):
    return " ".join(lines.normal_lines([line])[0])


def make(seed):
    rng = random.Random(seed)
    vocab = [f"term{i}" for i in range(300)]
    pool = [[rng.choice(vocab) for _ in range(rng.choice((4, 7, 8, 12, 40)))] for _ in range(30)]
    docs = []
    for i in range(40):
        out = []
        for _ in range(rng.randint(0, 6)):
            own = list(rng.choice(pool))
            if rng.random() < 0.5:
                own[rng.randrange(len(own))] = rng.choice(vocab)
            out.append(rng.choice((" ", "  ")).join(own) + rng.choice(("", ".", "!")))
        docs.append((i * 3 % 40, "\n".join(out)))
    return docs


@pytest.mark.parametrize("s", [
    lines.Settings(), lines.Settings(chunk=2, tile=2, part_keys=50, broadcast_lines=0)])
def test_removals_equal_all_pairs(spark, s):
    docs = make(1)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = line_removals(docs, normal, s)
    assert want and {(r["doc_id"], r["line"]) for r in lines.removals(df, s).collect()} == want
    text = dict(docs)
    for r in lines.dedup_lines(df, s).collect():
        kept = [x for n, x in enumerate(text[r["doc_id"]].split("\n")) if (r["doc_id"], n) not in want]
        assert r["text"] == "\n".join(kept)
        assert r["n_removed"] == r["n_lines"] - len(kept)


def test_edge_rows(edge_docs, no_docs):
    clash = edge_docs.withColumnRenamed("score", "n_lines")
    rows = {(r["doc_id"], r["text"]): r for r in lines.dedup_lines(clash).collect()}
    assert clash.count() == lines.dedup_lines(clash).count()
    assert (1, None) in rows and rows[(1, None)]["n_lines"] == 0
    assert (4, "one two") in rows  # short lines stay
    assert lines.dedup_lines(no_docs).count() == 0


def test_a_hot_line_is_kept_once(spark):
    line = "the very same license line stands in each and every file of this corpus"
    docs = [(i, f"own opening words number {i} " + "abcdefgh"[i % 8] * 3 + f"\n{line}") for i in range(300)]
    out = lines.dedup_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted(r["doc_id"] for r in out if line in r["text"]) == [0]


def test_normal_lines():
    assert normal("  Hello,   WORLD! (2024) --- x9 ") == "hello world 0000 x0"
    assert normal("\t") == "" and normal("Über 'Straße'") == "Über straße"
    assert lines.normal_lines(["a b", "", "- c"]) == [["a", "b"], [], ["c"]]


def test_word_edits():
    rng = random.Random(5)
    for _ in range(400):
        x = [rng.choice("abc") for _ in range(rng.randint(0, 12))]
        y = [rng.choice("abc") for _ in range(rng.randint(0, 12))] if rng.random() < 0.5 else x[1:] + ["b"]
        for most in (0, 2, 20):
            assert lines.word_edits(x, y, most) == min(levenshtein(x, y), most + 1)


def test_candidates_are_complete_for_the_edit_similarity(spark):
    # near copies of all lengths: words replaced, left out and put in, words in common use
    rng = random.Random(7)
    vocab = [f"common{i}" for i in range(12)] + [f"rare{i}" for i in range(4000)]
    docs = []
    for i in range(50):
        own = [rng.choice(vocab[:12] if rng.random() < 0.5 else vocab) for _ in range(rng.randint(7, 45))]
        near = list(own)
        for _ in range(int(len(own) * 0.15)):
            at = rng.randrange(len(near))
            near[at:at + rng.randint(0, 1)] = rng.choice(([], ["new"], [rng.choice(vocab)]))
        docs.append((i, " ".join(own) + "\n" + " ".join(near)))
    docs.append((900, "same " * 30 + "\n" + "same " * 27))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = line_removals(docs, normal, lines.Settings())
    assert len(want) > 30
    for s in (lines.Settings(), lines.Settings(sample_docs=10, ranked_words=5, ranked_pairs=3, tile=2)):
        assert {(r["doc_id"], r["line"]) for r in lines.removals(df, s).collect()} == want


def test_large_tiles_are_refined_without_a_loss(spark):
    # lines around a few common phrases: every tile holds many lines that do not link
    rng = random.Random(3)
    phrase = [[f"p{i}w{j}" for j in range(6)] for i in range(3)]
    docs = []
    for i in range(90):
        own = [f"x{rng.randrange(60)}" for _ in range(rng.randint(6, 10))]
        text = own[:4] + rng.choice(phrase) + own[4:]
        other = list(text)
        other[rng.randrange(len(other))] = f"y{i}"
        docs.append((i, "\n".join(" ".join(x) for x in (text, other)[:rng.randint(1, 2)])))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = line_removals(docs, normal, lines.Settings())
    got = {(r["doc_id"], r["line"]) for r in lines.removals(df, lines.Settings(tile=3)).collect()}
    assert len(want) > 20 and got == want


def test_simhash_blocks_meet_by_pigeonhole():
    s = lines.Settings()
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 200, dtype=np.uint64)
    keys = lines.block_keys(base, s)
    for bits in range(s.blocks - s.agree + 1):
        near = base.copy()
        for row in range(len(near)):
            for k in rng.choice(64, bits, replace=False):
                near[row] ^= np.uint64(1 << int(k))
        assert (lines.block_keys(near, s) == keys).any(axis=1).all()
    assert not (lines.block_keys(~base, s) == keys).any()


def test_simhash_of_lines():
    rng = random.Random(4)
    texts = [[f"word{rng.randrange(50)}" if rng.random() < 0.7 else "ab" for _ in range(rng.randint(1, 30))]
             for _ in range(40)]
    h, n = lines.word_hashes(pa.array([" ".join(t) for t in texts]))
    words = [w for t in texts for w in t]
    # digits count as equal in lines, so hash the words as they are compared
    plain = [[w for w in lines.normal_lines([" ".join(t)])[0]] for t in texts]
    got = lines._simhash(mix64(h), np.cumsum(n) - n, n, np.array([len(w) >= 5 for w in words]))
    assert got.tolist() == [simhash(t) for t in plain]


def test_workers_need_no_copy_of_the_package(tmp_path):
    script = """
import sys
sys.path.insert(0, sys.argv[1])
from ratelens.session import build_session
from ratelens.llm import lines
spark = build_session("local[2]", 2)
text = "one two three four five six seven eight nine"
df = spark.createDataFrame([(1, text), (2, text + " ten"), (3, "x")], "doc_id long, text string")
print("removed", [r["n_removed"] for r in lines.dedup_lines(df).orderBy("doc_id").collect()])
"""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script, root], cwd=tmp_path, env=env, text=True,
                         capture_output=True, timeout=300)
    assert "removed [0, 1, 0]" in out.stdout, out.stderr[-2000:]


def test_short_and_unspaced_lines_go_once_repeated(spark):
    short = "Released under the MIT License.\n\u4f60\u597d\u4e16\u754c\u4f60\u597d\u4e16\u754c\ntwo words\n\u4f60\u597d"
    near = "Released under the BSD License.\nLicensed under the new Apache License, Version"
    other = "Licensed under the old Apache License, Version"
    docs = [(1, short), (2, short), (3, near), (4, other)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    # one of five words is too much, one of seven is not
    assert {(r["doc_id"], r["line"]) for r in lines.removals(df).collect()} == {(2, 0), (2, 1), (4, 0)}


def test_alike_equals_the_edit_distance():
    rng = random.Random(6)
    s = lines.Settings(similar=0.7)
    for _ in range(2000):
        x = [rng.randrange(4) for _ in range(rng.randint(1, 16))]
        y = list(x)
        for _ in range(rng.randint(0, 6)):
            at = rng.randrange(len(y) + 1)
            y[at:at + rng.randint(0, 1)] = [rng.randrange(4)] * rng.randint(0, 2)
        want = levenshtein(x, y) <= int(s.edits(max(len(x), len(y))))
        assert lines.alike(np.array(x, np.uint64), np.array(y, np.uint64), s) == want


def test_the_order_comes_from_all_documents(spark):
    docs = [(i, " ".join([f"{'abcdefgh'[i % 8] * 3}{'abcdefgh'[i // 8]}"] * 8)) for i in range(64)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ranks = lines.Ranks(*lines.rank_arrays(df, lines.Settings(sample_docs=1)))
    h = word_keys(pa.array([t.split()[0] for _, t in docs]))
    assert (ranks.of_words(h) >= 1 + int(1.5 * 3)).all()  # each stands there eight times
    assert (ranks.of_pairs(lines._pair_hashes(np.repeat(h, 2), np.arange(0, 128, 2))) >= 1 + int(1.5 * np.log2(7))).all()


class TaskFunctions:
    """Stands for a DataFrame; holds the functions that tasks would run."""

    def __init__(self, spark):
        self.found, self.sparkSession = [], spark

    def select(self, *cols):
        return self

    groupBy = select

    def mapInArrow(self, run, schema):
        self.found.append(run)
        return self

    applyInArrow = mapInArrow

    def collect(self):
        return []


def test_counting_pairs_needs_one_table_in_a_worker(spark):
    docs, s = TaskFunctions(spark), lines.Settings(run_bytes=1 << 16)
    lines.rank_arrays(docs, s)
    texts = pa.array(["one two three four five six seven\n" * 40] * 100)
    tracemalloc.start()
    out = list(docs.found[0](iter([pa.record_batch({"text": texts})])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out and peak < 6 * s.ranked_pairs
    # bits of words are unpacked in small steps
    h = mix64(np.arange(1 << 17, dtype=np.uint64))
    first = np.arange(0, 1 << 17, 128)
    tracemalloc.start()
    lines._simhash(h, first, np.full(len(first), 128), np.ones(len(h), bool))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 15 << 20


def test_pairs_of_small_tiles_are_complete(spark):
    rng = random.Random(5)
    s = lines.Settings()
    rows = [(rng.choice((-3, -1, 0, 2, 9, 11)) * 10 ** 17 + rng.randrange(8), rng.randrange(-30, 30),
             rng.choice((8, 14, 15, 21)), rng.getrandbits(3), rng.getrandbits(2)) for _ in range(600)]
    want = set()
    for x in rows:
        for y in rows:
            most = int(s.edits(max(x[2], y[2])))
            gap, apart = abs(x[2] - y[2]), (x[3] ^ y[3]).bit_count() + (x[4] ^ y[4]).bit_count()
            if x[0] == y[0] and x[1] < y[1] and gap <= most and apart <= 2 * most - gap:
                want.add((x[1], y[1]))
    df = spark.createDataFrame(rows, "key long, node long, n int, b1 long, b2 long")
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "7")  # tiles go on from batch to batch
    try:
        assert {(r["a"], r["b"]) for r in lines.near_pairs(df, s).collect()} == want
    finally:
        spark.conf.set(name, before)


def test_written_steps_leave_no_shuffle_files(spark):
    def files():
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {found.apply(i).getName() for i in range(found.size())}

    before = files()
    df = materialize(spark.range(5000).selectExpr("id % 700 AS hash").groupBy("hash").count(), "files")
    bloom_filter(df.select("hash"))
    end = time.time() + 20  # Spark deletes them beside the driver's work
    while time.time() < end and len(left := [
            x for x in files() - before if x.startswith("shuffle_") and x.endswith(".data")]) > 1:
        time.sleep(0.2)
    assert len(left) <= 1  # of the count's single row
