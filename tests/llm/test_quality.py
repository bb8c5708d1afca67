import re
from collections import Counter

from ratelens.llm import oracle, quality, queries
from tests.oracle_compare import compare, duck


def brute(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    wins = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count = Counter(wins)
    at = {p for i, w in enumerate(wins) if count[w] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)),
            len(lines) - len(set(lines)), len(at))


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def test_measures_match_brute_force(spark, edge_docs):
    more = ["a b c a b c", "a a a a", "x y z\nx y z\n\nx y z", "p q r s p q r", "é# ü|\x0b1 2",
            " ".join(str(i % 40) for i in range(3000)), "a b c d e f a b x c d e", "\U0001F600 x"]
    docs = edge_docs.unionByName(
        spark.createDataFrame([(100 + i, t) for i, t in enumerate(more)], "doc_id long, text string"),
        allowMissingColumns=True)
    for r in quality.measure(docs).collect():
        assert tuple(r[n] for n in NAMES) == brute(r["text"]), r["text"]


def test_many_repeats_take_the_ordered_path(spark):
    text = " ".join(f"w{i}" for i in range(200)) + " " + " ".join(f"w{i}" for i in range(200))
    row = quality.measure(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row["n_repeat_words"] == brute(text)[4] == 400


def test_policies_and_ablations(spark, edge_docs, no_docs):
    docs = spark.createDataFrame(
        [(1, "word " * 60), (2, " ".join(f"w{i}x" for i in range(60))),
         (3, " ".join(f"w{i}x##" for i in range(60))), (4, "few")], "doc_id long, text string")
    entries = quality.ledger(docs)
    kept = {r["doc_id"]: r["kept"] for r in quality.apply_policy(entries, "v1").collect()}
    assert kept == {1: False, 2: True, 3: False, 4: False}
    rows = {r["rule"]: (r["n_failed"], r["n_only"]) for r in quality.ablations(entries, "v1").collect()}
    assert rows["symbols"] == (1, 1) and rows["too_few_words"] == (1, 1)
    assert rows["repeated_windows"] == (1, 1) and len(rows) == 6
    assert all(r["n_failed"] == 0 for r in quality.ablations(quality.ledger(no_docs), "v1").collect())
    clash = quality.ledger(edge_docs.withColumnRenamed("score", "n_words"))
    assert clash.columns.count("n_words") == 1 and clash.count() == edge_docs.count()


def test_query_matches_sql(spark, sf_dir):
    ok, why = compare(queries.op5_quality_rules(spark, sf_dir), duck(sf_dir),
                      oracle.ORACLE_SQL["op5_quality_rules"])
    assert ok, why


def test_plan_has_no_python(spark, documents, sf_dir):
    plans = [df._jdf.queryExecution().executedPlan().toString()
             for df in (quality.ledger(documents), queries.op5_quality_rules(spark, sf_dir))]
    assert all("Python" not in p and "Arrow" not in p for p in plans)
    assert "Exchange" not in plans[0]  # building the ledger shuffles nothing
