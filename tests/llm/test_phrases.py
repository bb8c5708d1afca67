import random
import re
from collections import Counter

import numpy as np
import pytest

from ratelens.llm import phrases


def brute(docs, s):
    """Collocations by counting every n-gram in one dictionary."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, s.longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= s.least}
    rows = {}
    for (lang, w), a in candidates.items():
        if any(100 * b >= s.inside * a and lang == other and len(v) > len(w)
               and any(v[i:i + len(w)] == w for i in range(len(v))) for (other, v), b in candidates.items()):
            continue
        score, k, l, r = min((s.scale * a // (f[lang, w[:k]] + f[lang, w[k:]]), k,
                              f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        rows.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), l, r))
    return {(lang, rank, p.decode(), -a, l, r, n[lang], -score) for lang, v in rows.items()
            for rank, (score, a, p, l, r) in enumerate(sorted(v)[:s.top], 1)}


def make(seed, many=120):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(40)] + ["été", "你好", "x y", "CafÉ", "a\x00b"]
    fixed = [["new", "york", "city", "hall"], ["out", "of", "order"], ["same"] * 5]
    docs = []
    for i in range(many):
        out = []
        for _ in range(rng.randint(0, 30)):
            out += rng.choice(fixed) if rng.random() < 0.2 else [rng.choice(vocab)]
            out.append(rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\x0b", "?!"]))
        text = " ".join(out)
        docs.append((text.upper() if i % 7 == 0 else text, rng.choice(["en", "de", "", None, "und"])))
    return docs + [(None, "en"), ("", None), ("...", "de"), (" \t", "xx")]


@pytest.mark.parametrize("s", [
    phrases.Mining(least=5),
    phrases.Mining(least=4, top=7, part_mass=300, task_entries=50, run_bytes=200, filter_bits=1 << 20)])
def test_equal_to_counting_everything(spark, s):
    docs = make(s.least)
    df = spark.createDataFrame(docs, "text string, lang string").repartition(5)
    got = [tuple(r) for r in phrases.collocations(df, s).collect()]
    want = brute(docs, s)
    assert len(want) > 15 and set(got) == want and len(got) == len(want)


def test_a_full_filter_changes_nothing(spark, monkeypatch):
    docs = make(9, 60)
    s = phrases.Mining(least=3)
    monkeypatch.setattr(phrases, "bloom_filter", lambda hashes, bits: np.full(1 << 17, 255, np.uint8))
    got = {tuple(r) for r in phrases.collocations(spark.createDataFrame(docs, "text string, lang string"), s).collect()}
    assert got == brute(docs, s)


def test_merged_summaries_keep_what_is_frequent():
    rng = np.random.default_rng(3)
    for least in (5, 20):
        stream = np.concatenate([rng.integers(0, 4000, 6000), np.repeat(np.arange(9000, 9020), least)])
        rng.shuffle(stream)
        total = phrases.Summary(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        capacity = len(stream) // least
        for part in np.array_split(stream, 30):
            keys, counts = np.unique(part.astype(np.uint64), return_counts=True)
            total.merge(keys, counts, capacity)
        keys, counts = np.unique(stream, return_counts=True)
        true = dict(zip(keys.tolist(), counts.tolist()))
        assert len(total.keys) <= capacity and total.short < least
        assert all(c <= true[k] <= c + total.short for k, c in zip(total.keys.tolist(), total.counts.tolist()))
        assert {k for k, c in true.items() if c >= least} <= set(total.at_least(least).tolist())


def test_scores_are_exact_beyond_64_bits(spark, monkeypatch):
    big = 3 << 60
    counts = [("en", 0, None, big), ("en", 1, "a", big - 1), ("en", 1, "b", big - 2), ("en", 2, "a b", big - 7)]
    df = spark.createDataFrame(counts, "lang string, words int, gram string, f long")
    monkeypatch.setattr(phrases, "gram_counts", lambda docs, s: df)
    row = phrases.collocations(df).first()
    assert row["score"] == 2_000_000 * (big - 7) // (2 * big - 3) and row["n"] == big


def test_odd_rows(spark, edge_docs, no_docs):
    assert phrases.collocations(no_docs).count() == 0
    clash = edge_docs.withColumnRenamed("score", "rank").withColumnRenamed("source", "phrase")
    rows = {(r["lang"], r["phrase"]): r for r in phrases.collocations(clash).collect()}
    assert rows["en", "delta alpha beta gamma"]["a"] == 1999 and rows["en", "alpha beta gamma delta"]["n"] == 8006
