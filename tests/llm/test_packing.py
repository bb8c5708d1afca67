import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ratelens.llm import packing, queries

with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
    MODEL = f.read()
TOKENIZER = Tokenizer.from_str(MODEL)
TOKENIZER.encode_special_tokens = True
WORDS = packing._WordIds(MODEL)

ODD = [
    (1, None), (1, ""), (2, " \t\n"),
    (3, "H̱ Å İstanbul ΣΣ it's we'll x y z ẞ <|endoftext|> a\x0bb\x1cc\x85d"),
    (None, "hello world"), (4, "x" * 5000), (5, "a b c " * 9000), (5, "a b c " * 9000),
    (6, "̈́ ́x ̖̀y 'S 'LL don'T"), (7, "你好世界" * 700),
]


def whole(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def packed(df, s):
    """Sequences of the packing, after a check of every id and place."""
    want, got, sequences = defaultdict(list), defaultdict(list), defaultdict(list)
    for r in df.select("doc_id", "text").collect():
        want[r["doc_id"]].append(whole(r["text"]))
    for r in packing.pack(df, MODEL, s).collect():
        ids = np.frombuffer(r["ids"], "<u4").tolist()
        assert len(ids) == r["length"] > 0
        got[r["doc_id"]].append((r["start"], r["doc_tokens"], ids))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(want) == set(got)
    for doc, texts in want.items():
        assert sorted((i, x) for t in texts for i, x in enumerate(t)) == \
            sorted((start + i, x) for start, _, ids in got[doc] for i, x in enumerate(ids))
        assert {len(t) for t in texts} == {n for _, n, _ in got[doc]}
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= s.capacity
    return sequences


@pytest.mark.parametrize("s", [
    packing.Packing(), packing.Packing(group_tokens=300, run_bytes=10, least_cut=1),
    packing.Packing(capacity=7, group_pieces=4)])
def test_every_id_lies_in_one_piece(spark, s):
    packed(spark.createDataFrame(ODD, "doc_id long, text string").repartition(3), s)


def test_documents_leave_little_padding(documents):
    s = packing.Packing()
    sequences = packed(documents, s)
    tokens = sum(n for own in sequences.values() for _, n in own)
    assert len(sequences) <= tokens / (s.capacity - s.least_cut) + 1


def test_odd_rows(spark, edge_docs, no_docs):
    assert packing.pack(no_docs, MODEL).count() == 0
    clash = edge_docs.withColumnRenamed("score", "start").withColumnRenamed("source", "ids")
    rows = packing.pack(clash, MODEL).collect()
    assert sum(r["length"] for r in rows) == sum(len(whole(r["text"])) for r in edge_docs.collect())


def test_query_digest_is_crc32_of_ids(spark, sf_dir):
    import zlib

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    ids = {r["doc_id"]: whole(r["text"]) for r in docs.collect()}
    for r in queries.op11_packing(spark, sf_dir).collect():
        own = np.array(ids[r["doc_id"]][r["start"]:r["start"] + r["length"]], "<u4")
        assert r["ids_crc32"] == zlib.crc32(own.tobytes()) and r["doc_tokens"] == len(ids[r["doc_id"]])


_ODD_TEXT = st.text(st.sampled_from("aAzZéÉÀİıẞßĦ'stld.,;:!?()<>|=#\u0331\u0301\u0338\u0307 \u00a0\n\x1c\x8505你ΣςǅK−"), max_size=24)


@settings(max_examples=400, deadline=None)
@given(st.lists(_ODD_TEXT | st.text(max_size=12), max_size=5))
def test_ids_are_those_of_the_whole_text(texts):
    import pyarrow as pa

    ids, counts = packing.text_ids(pa.array(texts, pa.string()), WORDS, 1)
    assert ids.tolist() == [i for t in texts for i in whole(t)]
    assert counts.tolist() == [len(whole(t)) for t in texts]


def plain_first_fit(sizes, capacity):
    bins = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        for b in bins:
            if sum(sizes[x] for x in b) + sizes[i] <= capacity:
                b.append(i)
                break
        else:
            bins.append([i])
    return bins


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 99), max_size=60), st.integers(1, 30))
def test_first_fit_decreasing_and_closed_gaps(sizes, least_cut):
    bins = packing.first_fit_decreasing(sizes, 100)
    assert bins == plain_first_fit(sizes, 100)
    closed = packing.close_gaps(bins, sizes, 100, least_cut)
    parts = defaultdict(list)
    for b in closed:
        assert 0 < sum(n for _, _, n in b) <= 100
        for i, start, n in b:
            parts[i].append((start, n))
    for i, size in enumerate(sizes):
        at = 0
        for start, n in sorted(parts[i]):
            assert start == at and n > 0
            at += n
        assert at == size
    gaps = sorted(100 - sum(n for _, _, n in b) for b in closed)
    wide = [g for g in gaps if g >= least_cut]
    if wide:  # the emptiest bin left does not fit into the others' gaps
        assert sum(wide[:-1]) < 100 - wide[-1]


def test_large_pieces_are_cut_to_fill_sequences():
    rng = random.Random(1)
    sizes = [rng.randint(1100, 1900) for _ in range(500)]
    closed = packing.close_gaps(packing.first_fit_decreasing(sizes, 2048), sizes, 2048, 16)
    assert len(closed) <= sum(sizes) / (2048 - 16) + 1
