"""The corpus pipeline: five stages over the documents table.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the
columns of ``documents`` (the last: the encoded documents).  ``run`` writes
every stage's result as Parquet to the shared folder and hands the reread
table to the next, so a lost executor never reaches back over a stage.  A
stage starts by deleting the working tables of the stages before it, whose
results have been written by then.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import jaccard, langid, lines, mixing, queries
from ratelens.llm.common import clear_stored, materialize, numbered_rows, read_table, small_side
from ratelens.session import scratch_path

#: Below this score a language prediction counts as a rejection.
LEAST_LANGUAGE_SCORE = 0.3

#: Ids or row numbers (up to 16 bytes) that a join may broadcast (counted first).
BROADCAST_IDS = 4_000_000

#: Rows of a batch between Spark and Python; whole documents are large rows.
BATCH_ROWS = "1000"
#: Text that a task works on at once: executors have run the other stages before.
RUN_BYTES = 2 << 20
#: A larger table of encoded words reaches the texts by joined blocks, not by the driver.
TABLE_BYTES = 16 << 20

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _begin(spark: SparkSession) -> None:
    clear_stored(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is undetermined or too uncertain go."""
    _begin(spark)
    learn = docs.where(~langid.held_out("doc_id")).select("doc_id", "text", "lang")
    tagged = langid.identify(docs, langid.train(learn))
    keep = (F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return tagged.where(keep).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go from the texts; a document without any line left goes."""
    _begin(spark)
    cleaned = lines.dedup_lines(docs, lines.Settings(run_bytes=RUN_BYTES)).where(
        (F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_lines")))
    return cleaned.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 80 % of its five-word n-grams."""
    _begin(spark)
    groups = jaccard.groups(docs.select("doc_id", "text"), jaccard.Join(words=5, num=80))
    gone = materialize(groups.where(F.col("component_id") != F.col("doc_id"))
                       .select("doc_id").distinct(), "pipeline-gone")
    return docs.join(small_side(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: left out, once, or repeated.

    Rows are counted one by one, whether they share a doc_id or have none; rows
    that share both doc_id and text draw alike.  A document without words weighs
    nothing, so the mix never takes it.
    """
    _begin(spark)
    rows = numbered_rows(docs, "_row", "pipeline-rows").withColumn(
        "_row", F.struct("_row.*", F.xxhash64("doc_id", "text").alias("draw")))
    mix = mixing.mix(rows.select("doc_id", "source", "text", "_row"), row="_row")
    times = materialize(mix.select("_row", mixing.copies(
        F.col("size"), F.col("taken"), F.col("_row.draw")).alias("_times"))
        .where("_times > 0"), "pipeline-times")
    kept = rows.join(small_side(times, BROADCAST_IDS), "_row")
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), "_times"))).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    _begin(spark)
    return queries.token_digests(docs, queries.tokenizer(), ["doc_id", "lang", "source"],
                                 RUN_BYTES, TABLE_BYTES)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("ngram_jaccard", near_duplicates),
    ("mix_sources", mix_sources),
    ("byte_bpe", encode),
]

#: No SQL: the classifier, the edit-similarity join and the tokenizer have none.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        kept = stage(spark, docs, sf_dir)
        kept.write.parquet(path)
        docs = spark.read.schema(kept.schema).parquet(path)
    return docs
