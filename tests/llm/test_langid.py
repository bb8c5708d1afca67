import random

import pytest
from pyspark.sql import functions as F

from ratelens.llm import langid, queries

SMALL = langid.Settings(bits=12, shards=2, rounds=2, min_rows=400)


@pytest.fixture(scope="module")
def tongues(spark):
    rng = random.Random(3)
    parts = {"aa": ("ka", "lo", "mi", "tu"), "bb": ("ßer", "sch", "ung", "che"), "cc": ("ção", "nho", "lhe", "que")}
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(parts))
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randint(1, 4))) for _ in range(30))
        rows.append((i, text, lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy_and_calibration(tongues):
    df = tongues.withColumn("held_out", langid.held_out("doc_id"))
    model = langid.train(df.where(~F.col("held_out")), SMALL)
    assert model.languages == ("aa", "bb", "cc") and model.temperature > 0
    rows = langid.identify(df, model).where("held_out").collect()
    assert len(rows) > 50
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_only_the_text_decides(tongues):
    model = langid.train(tongues, SMALL)
    a = langid.identify(tongues, model).select("doc_id", "lang_pred", "score")
    b = langid.identify(tongues.withColumn("lang", F.lit("zz")).withColumn("doc_id", -F.col("doc_id")), model)
    left = sorted((r["doc_id"], r["lang_pred"], r["score"]) for r in a.collect())
    right = sorted((-r["doc_id"], r["lang_pred"], r["score"]) for r in b.collect())
    assert left == right


def test_edge_rows(tongues, edge_docs, no_docs):
    model = langid.train(tongues, SMALL)
    rows = langid.identify(edge_docs, model).collect()
    assert len(rows) == edge_docs.count() and rows[0].asDict().keys() >= {"lang_pred", "score", "source"}
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert (r["score"] == 0) == (not letters)
    assert langid.identify(no_docs, model).count() == 0
    nothing = langid.train(no_docs.select("doc_id", "text", "lang"), SMALL)
    assert {r["lang_pred"] for r in langid.identify(edge_docs, nothing).collect()} == {"und"}


def test_long_texts_are_read_piece_by_piece():
    text = "abc déf " * 700
    whole = [list(map(int, g[:0])) for g in []]
    sums = []
    for chars in (1 << 20, 100, 7):
        count = {}
        for rows, starts, grams in langid.gram_batches([text, "x"], 10, chars):
            ends = list(starts[1:]) + [len(grams[0])]
            for row, a, b in zip(rows, starts, ends):
                for g in grams:
                    for v in g[a:b].tolist():
                        if v < 1 << 10:
                            count[row, v] = count.get((row, v), 0) + 1
        sums.append(count)
    assert whole == [] and sums[0] == sums[1] == sums[2]


def test_query_rows(spark, sf_dir):
    rows = queries.op3_language_id(spark, sf_dir).collect()
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(lang)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.9
