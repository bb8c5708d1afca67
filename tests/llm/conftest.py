import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string"

#: Odd documents: nulls in every column, empty and blank texts, repeated rows,
#: a long text, and a column whose name clashes with results.
EDGE = [
    (1, None, "en", "a", None, "x"),
    (2, "", None, "a", 0, None),
    (3, " \t\n ", "en", None, 4, "x"),
    (4, "one two", "en", "b", 7, "x"),
    (5, "one two", "en", "b", 7, "x"),
    (5, "one two", "en", "b", 7, "x"),
    (6, "alpha beta gamma delta " * 2000, "en", None, None, None),
    (7, "!!! *** ###", None, None, 11, "x"),
    (None, "a row without an id but with some words in its text", "de", "b", 3, "x"),
]


@pytest.fixture(scope="session")
def edge_docs(spark):
    return spark.createDataFrame(EDGE, SCHEMA)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sf_dir():
    import os
    return os.environ.get("RATELENS_TEST_SF", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
