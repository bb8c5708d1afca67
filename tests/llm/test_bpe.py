import random

import pytest
import tiktoken
from pyspark.sql import functions as F

from ratelens.llm import bpe, queries

TEXTS = [None, "", " ", "a  b \n c\t\td   ", "don't 'll  x's we're 12 345 6.7", "x" * 700 + " " + "ab" * 900,
         "日本語 текст <|endoftext|>    x", " " * 600 + "y", "a\n b\r\n  c", "!" * 3000, "  a \x85b \xa0c",
         "Éa naïve ŒUVRE ﬁ Ǆ", "word, word. Ünd? so!? end... a,b .c x,' y.' Z;", "tab\tnew\nline   x", "😀😀 a😀", " lead", "trail "]


@pytest.fixture(scope="module")
def known():
    t = queries.tokenizer()
    return t, tiktoken.Encoding("own", pat_str=t.pattern, mergeable_ranks=t.ranks(), special_tokens={})


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(1)
    more = ["".join(rng.choice("ab éß\n'1., \t") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    rows = [(i, t, "x") for i, t in enumerate(TEXTS + more + more[:5])]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string")


@pytest.mark.parametrize("table_bytes", [256 << 20, 0])  # broadcast table, and joined blocks
def test_ids_equal_tiktoken(texts, known, table_bytes):
    t, enc = known
    rows = bpe.encode(texts, t, table_bytes=table_bytes, block_docs=8).collect()
    assert len(rows) == texts.count()
    for r in rows:
        assert r["ids"] == enc.encode_ordinary(r["text"] or ""), r["text"]


def test_decoding_returns_the_bytes(texts, known):
    t, _ = known
    rows = bpe.encode(texts, t).withColumn("back", bpe.decode(F.col("ids"), t.ranks())).collect()
    assert all(bytes(r["back"]) == (r["text"] or "").encode() for r in rows)


def test_heap_equals_fold(spark, known):
    t, enc = known
    words = ["ab" * 40, "aaaaaaaaaaaaa", "the" * 30, "xyzzy"]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    fold = {r["word"]: r["ids"] for r in df.select(
        "word", bpe.fold_merges(F.encode("word", "UTF-8"), t.ranks()).alias("ids")).collect()}
    for w in words:
        assert bpe.heap_merges(w.encode(), t.ranks()) == fold[w] == enc._core_bpe.encode_ordinary(w)


def test_digest_query(spark, edge_docs, no_docs, known):
    import hashlib
    t, enc = known
    rows = queries.token_digests(edge_docs, t, ["doc_id", "text"]).collect()
    for r in rows:
        ids = enc.encode_ordinary(r["text"] or "")
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert queries.token_digests(no_docs, t, ["doc_id"]).count() == 0
