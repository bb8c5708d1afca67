"""Registered queries of the training-data operators.

Each query applies its operator, with production parameters, to its whole
table and derives the digest columns of its contract from the result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (ann, bpe, html_text, jaccard, langid, lines, lm, mixing, packing, phrases, quality,
               warc, whitening)
from .common import materialize, read_table


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read_table(spark, sf_dir, "documents", "doc_id", "source", "text"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return lm.score(docs.withColumn("held_out", langid.held_out("doc_id", 5)))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text", "lang").withColumn(
        "held_out", langid.held_out("doc_id"))
    model = langid.train(docs.where(~F.col("held_out")).select("doc_id", "text", "lang"))
    return langid.identify(docs, model, carry=["doc_id", "held_out"])


def op4_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return ann.nearest(vectors, F.col("id") % 20 == 0)


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    entries = materialize(quality.ledger(docs).drop("text"), "quality-ledger")
    # what each rule costs by itself: the documents that fail no other one
    alone = quality.ablations(entries, "v2").where("n_only > 0").select(
        F.expr("shiftleft(1L, bit)").alias("fail_bits"), F.col("rule").alias("sole_rule"),
        F.col("n_only").alias("sole_rule_docs"))
    base = F.lit(quality.POLICIES["base"]).cast("long")
    return quality.apply_policy(entries, "v2").join(
        F.broadcast(alone), "fail_bits", "left").select(  # a row per rule at most
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"), "kept", "fail_bits",
        "sole_rule", "sole_rule_docs")


def tokenizer() -> bpe.Tokenizer:
    import public_tokenizers

    return bpe.Tokenizer(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                         public_tokenizers.PATTERN)


def op6_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    # the table has no capture time: one second per page after a fixed date
    captured = F.timestamp_seconds(F.lit(1704067200) + F.pmod(
        F.coalesce("page_id", F.lit(0)), F.lit(86400 * 3650)))
    index = warc.archive_and_index(pages.withColumn("captured_at", captured))
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "url_key", "captured_at")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages", "page_id", "url", "html")
    return html_text.extract_text(pages, carry=["page_id", "url"])


def op8_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(read_table(spark, sf_dir, "documents", "doc_id", "text"), jaccard.Join())


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return token_digests(docs, tokenizer(), ["doc_id"])


def token_digests(docs: DataFrame, t: bpe.Tokenizer, carry: list[str],
                  run_bytes: int = 6 << 20, table_bytes: int = 256 << 20) -> DataFrame:
    """Digests of the ids of every text, and of what the ids decode to."""
    pieces = bpe.token_bytes(t.ranks())
    text_of = bpe.BytesOf(pieces)
    name_of = bpe.BytesOf([b"%d," % i for i in range(len(pieces))])

    def digest(ids: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
        ids_sha = [hashlib.sha256(x[:-1]).hexdigest() for x in name_of.join(ids, offsets)]
        text_sha = [hashlib.sha256(x).hexdigest() for x in text_of.join(ids, offsets)]
        return {"n_tokens": pa.array(np.diff(offsets).astype(np.int64)),
                "ids_sha256": pa.array(ids_sha, pa.string()),
                "decoded_sha256": pa.array(text_sha, pa.string())}

    return bpe.encode(docs, t, carry=carry, run_bytes=run_bytes,
                      table_bytes=table_bytes, reduce=digest,
                      out="n_tokens long, ids_sha256 string, decoded_sha256 string")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents", "doc_id", "text")
    return lines.dedup_lines(docs).select(
        "doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("n_chars"),
        F.sha2("text", 256).alias("text_sha256"))


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        model = f.read()
    pieces = packing.pack(read_table(spark, sf_dir, "documents", "doc_id", "text"), model)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read_table(spark, sf_dir, "embeddings", "vec_id", "embedding"))
    # exact in the operator at any size; the contract's column holds it below 2^63
    return out.withColumn("deviation", F.expr("try_cast(deviation AS bigint)"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read_table(spark, sf_dir, "documents", "text", "lang"))


QUERIES = {
    "op1_mix_sources": op1_mix_sources,
    "op2_lm_score": op2_lm_score,
    "op3_language_id": op3_language_id,
    "op4_nearest_vectors": op4_nearest_vectors,
    "op5_quality_rules": op5_quality_rules,
    "op6_warc_index": op6_warc_index,
    "op7_html_text": op7_html_text,
    "op8_ngram_jaccard": op8_ngram_jaccard,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_line_dedup": op10_line_dedup,
    "op11_packing": op11_packing,
    "op12_whitening": op12_whitening,
    "op13_phrases": op13_phrases,
}
