import corpus_pipeline
from pyspark.sql import functions as F

from ratelens.llm import jaccard, queries
from tests.llm.brute import jaccard_groups


def test_stage_names_follow_the_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "line_dedup", "ngram_jaccard", "mix_sources", "byte_bpe"]


def test_near_duplicates_keep_one_of_each_group(spark, documents, sf_dir):
    docs = documents.where("doc_id < 120")
    kept = corpus_pipeline.near_duplicates(spark, docs, sf_dir)
    want = jaccard_groups([(r["doc_id"], r["text"]) for r in docs.collect()], 5, 80, 100)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, (_, c) in want.items() if c == i)
    assert kept.columns == documents.columns


def test_language_stage_drops_what_has_none(spark, documents, sf_dir):
    odd = spark.createDataFrame([(9001, None, None, "s", None), (9002, "123 ...", "en", "s", 7)], documents.schema)
    out = corpus_pipeline.language_id(spark, documents.unionByName(odd), sf_dir)
    ids = {r["doc_id"] for r in out.select("doc_id").collect()}
    assert not ids & {9001, 9002} and len(ids) >= 0.99 * documents.count()


def test_mix_repeats_whole_documents(spark, documents, sf_dir):
    out = corpus_pipeline.mix_sources(spark, documents, sf_dir)
    assert out.columns == documents.columns
    times = {r["doc_id"]: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert max(times.values()) <= 3
    assert out.join(documents, documents.columns, "left_anti").count() == 0


def test_mix_counts_rows_without_an_id_and_rows_that_share_one(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(None, f"words of row {i} " * 30, "en", "ab"[i % 2], i) for i in range(200)]
    rows += [(7, f"other words {i} " * (1 + 40 * (i % 2)), "en", "c", i) for i in range(100)]
    docs = spark.createDataFrame(rows, schema).repartition(3)
    out = corpus_pipeline.mix_sources(spark, docs, sf_dir)
    assert out.columns == docs.columns
    times = {}
    for r in out.collect():
        times[r["source"], r["n_chars"]] = times.get((r["source"], r["n_chars"]), 0) + 1
    assert max(times.values()) <= 3 and sum(s == "c" for s, _ in times) > 10
    assert sum(s == "a" for s, _ in times) == 100  # weighs most, so every row of it is in
    # the words taken of a source come near its target
    words = {s: sum(n * len(rows[c if s != "c" else 200 + c][1].split()) for (x, c), n in times.items() if x == s)
             for s in "abc"}
    total = sum(len(r[1].split()) for r in rows)
    assert abs(words["a"] / total - 5 / 8) < 0.15 and abs(words["b"] / total - 2 / 8) < 0.15


def test_whole_run(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out.columns)
    rows = out.collect()
    assert 0 < len(rows) and all(r["n_tokens"] > 0 for r in rows)


def test_stages_accept_an_empty_table(spark, documents, sf_dir):
    empty = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, sf_dir).count() == 0


def test_stages_take_odd_rows(spark, edge_docs, documents, sf_dir):
    docs = documents.where("doc_id < 60").unionByName(edge_docs, allowMissingColumns=True)
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir)
        assert name == "byte_bpe" or rows.columns == docs.columns
        got = rows.collect()
        assert got and len(got) <= 3 * docs.count()
        if name in ("line_dedup", "ngram_jaccard"):  # a text without words is like no other
            assert sum(r["text"] is None for r in got) == 1 and sum(r["text"] == "" for r in got) == 1


def test_registered(spark):
    import __spark_entry__ as entry
    numbers = {int(n[2:].split("_")[0]) for n in entry.queries() if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in entry.queries()
    assert jaccard.Join().num == 90 and F is not None and queries.QUERIES
