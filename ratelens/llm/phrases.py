"""Phrase collocations by two passes: frequent n-grams by Misra-Gries
summaries, then their exact counts.

Texts are cut into pieces at punctuation and line breaks, pieces into words.
The first pass counts hashes of all n-grams of one to ``longest`` words and
deals them to hash partitions.  Each partition merges the tasks' summaries into
one of bounded size: its capacity exceeds the partition's occurrences divided by
``least``, so the Misra-Gries bound says that every n-gram that occurs ``least``
times survives, however the occurrences are spread over tasks.  Equal hashes
only add up, so they never lose an n-gram either.  The survivors become a
Bloom filter of bounded size, and the second pass counts the n-grams that it
lets through exactly, by their words.  A false positive costs a row, no result
depends on it.

A candidate's score is that of its weakest cut in two.  Candidates that nearly
always stand inside a longer one are dropped.

Defined results for odd rows: a null text is empty; a null lang is ``und``
(and one with rows whose lang is ``und``); repeated rows count again; only
``text`` and ``lang`` are read, so other columns, whatever their names, change
nothing; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, materialize, mix64
from .filters import MOST_BITS, bloom_filter, packed_parts, part_edges, passes, unpacked, unpacked_keys
from .tokens import slices, word_keys

UNKNOWN_LANG = "und"

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_SPACE = pa.scalar(" ", pa.large_string())
_HASH_BITS = 48


@dataclass(frozen=True)
class Mining:
    least: int = 30              # occurrences of a candidate
    longest: int = 4             # words
    top: int = 2000              # candidates returned of a language
    inside: int = 80             # per cent of its occurrences in a longer candidate
    scale: int = 2_000_000
    part_mass: int = 2_000_000   # about so many occurrences of n-grams a hash partition
    task_entries: int = 1_500_000  # hashes that a task holds before it hands them on
    run_bytes: int = 3 << 20
    filter_bits: int = MOST_BITS


def piece_words(texts: pa.Array) -> tuple[np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Words of the texts in order: a number per word, the distinct words by
    number, the piece of each word (numbered over all texts), and its text."""
    texts = pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[ends[0]:ends[-1]] if raw is not None else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    kind = _KIND[data]
    word = kind == 0
    opens = np.zeros(len(data) + 1, bool)
    opens[ends] = True  # a text's first byte
    starts = word.copy()
    starts[1:] &= ~word[:-1] | opens[1:-1]
    last = word.copy()
    last[:-1] &= ~word[1:] | opens[1:-1]
    at, size = np.flatnonzero(starts), np.flatnonzero(last) + 1
    size = size - at
    text = np.searchsorted(ends, at, side="right") - 1
    piece = np.cumsum(kind == 2)[at] + text if len(at) else np.zeros(0, np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    words = pa.LargeStringArray.from_buffers(
        len(at), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[word])))
    enc = words.dictionary_encode()
    return enc.indices.to_numpy(), enc.dictionary, piece, text


def _lang_keys(langs: pa.Array) -> np.ndarray:
    return word_keys(langs) * _B + _A


def _gram_hashes(codes: np.ndarray, names: pa.Array, piece: np.ndarray, lang: np.ndarray,
                 longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For 1 to ``longest`` words: a hash of the n-gram that begins at each word
    (with its language) and whether the n-gram is within one piece."""
    own = word_keys(names)[codes]
    h, inside = mix64(own + lang), np.ones(len(codes), bool)
    yield h >> np.uint64(64 - _HASH_BITS), inside
    for n in range(2, longest + 1):
        if len(h) < n:
            return
        h = mix64(h[:-1] * _A + own[n - 1:])
        inside = piece[:-(n - 1)] == piece[n - 1:]
        yield h >> np.uint64(64 - _HASH_BITS), inside


def _sum_equal(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, counts
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


@dataclass
class Summary:
    """A Misra-Gries summary: counters by key, and by how much at most a
    counter lies below the true count (the whole of it for keys that are gone)."""

    keys: np.ndarray
    counts: np.ndarray
    short: int = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray, capacity: int) -> None:
        """Add exact counts; beyond ``capacity`` keys, all counters lose as much
        as the first one too many has."""
        keys, counts = _sum_equal(np.concatenate([self.keys, keys]), np.concatenate([self.counts, counts]))
        if len(keys) > capacity:
            off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
            stay = counts > off
            keys, counts = keys[stay], counts[stay] - off
            self.short += off
        self.keys, self.counts = keys, counts

    def at_least(self, least: int) -> np.ndarray:
        """Keys that may occur ``least`` times; none that does is missing."""
        return self.keys[self.counts + self.short >= least]


def frequent_hashes(docs: DataFrame, s: Mining = Mining()) -> DataFrame:
    """``hash`` of every n-gram that occurs ``s.least`` times (and of some others)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # about six bytes a word; only the sizes of the groups depend on it
    parts = max(1, -(-size * s.longest // 6 // s.part_mass))
    edges = part_edges(parts, _HASH_BITS)

    def emit(kept: list) -> pa.RecordBatch:
        keys, counts = _sum_equal(*(np.concatenate(x) for x in zip(*kept)))
        return packed_parts(keys, edges, counts)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, held = [], 0
        for b in batches:
            at = 0
            for texts in slices(b.column("text"), s.run_bytes):
                langs = _lang_keys(b.column("lang").slice(at, len(texts)))
                at += len(texts)
                codes, names, piece, text = piece_words(texts)
                keys = np.concatenate([h[ok] for h, ok in _gram_hashes(
                    codes, names, piece, langs[text], s.longest)])
                if len(keys):
                    keys.sort()
                    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
                    kept.append((keys[first], np.diff(np.append(first, len(keys)))))
                    held += len(first)
                if held > s.task_entries:
                    yield emit(kept)
                    kept, held = [], 0
        if kept:
            yield emit(kept)

    def survivors(t: pa.Table) -> pa.Table:
        counts = [unpacked(x).astype(np.int64) for x in t.column("v0").to_pylist()]
        capacity = int(sum(int(c.sum()) for c in counts)) // s.least
        total = Summary(np.zeros(0, np.uint64), np.zeros(0, np.int64))
        wait: list[tuple[np.ndarray, np.ndarray]] = []
        held = 0
        for blob, c in zip(t.column("keys"), counts):
            wait.append((unpacked_keys(blob.as_py()), c))
            held += len(c)
            if held >= max(s.part_mass // 4, 2 * capacity):
                total.merge(*(np.concatenate(x) for x in zip(*wait)), capacity)
                wait, held = [], 0
        if wait:
            total.merge(*(np.concatenate(x) for x in zip(*wait)), capacity)
        return pa.table({"hash": pa.array(total.at_least(s.least).view(np.int64))})

    return (docs.select("text", F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"))
            .mapInArrow(lean(count), "part int, keys binary, v0 binary")
            .groupBy("part").applyInArrow(survivors, "hash long"))


def _dense(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers from 0 for equal values, an index of each value, and its count."""
    _, first, number, counts = np.unique(x, return_index=True, return_inverse=True, return_counts=True)
    return number, first, counts


def gram_counts(docs: DataFrame, s: Mining = Mining()) -> DataFrame:
    """``lang, words, gram, f`` of every n-gram that occurs ``s.least`` times in
    a language, and per language a row of 0 words with the count of all words."""
    found = materialize(frequent_hashes(docs, s), "phrase-survivors")
    shared = docs.sparkSession.sparkContext.broadcast(bloom_filter(found, s.filter_bits))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = 0
            for texts in slices(b.column("text"), s.run_bytes):
                own_langs = b.column("lang").slice(at, len(texts))
                at += len(texts)
                lang = own_langs.dictionary_encode()
                code, names, piece, text = piece_words(texts)
                of_lang = lang.indices.to_numpy()[text].astype(np.int64)
                # every number stands for a language and the words so far
                number, first, _ = _dense(of_lang * len(names) + code)
                yield _gram_rows(0, lang.dictionary, None, np.bincount(of_lang, minlength=len(lang.dictionary)))
                may = base = size = None
                for n, (h, inside) in enumerate(_gram_hashes(
                        code, names, piece, _lang_keys(own_langs)[text], s.longest), 1):
                    if n == 1:
                        base, size = number, len(first)
                        may = passes(shared.value, h)
                    else:
                        may = may[:-1] & may[1:] & inside  # else a part of it is not frequent
                        at_ = np.flatnonzero(may)
                        may[at_] = passes(shared.value, h[at_])
                        number = number[:-1]
                    at_ = np.flatnonzero(may)
                    pair = number[at_] if n == 1 else number[at_] * size + base[at_ + n - 1]
                    dense, first, counts = _dense(pair)
                    number = np.zeros(len(may), np.int64)
                    number[at_] = dense
                    if not len(first):
                        break
                    begin = at_[first]
                    words = [names.take(pa.array(code[begin + k])) for k in range(n)]
                    gram = words[0] if n == 1 else pc.binary_join_element_wise(*words, _SPACE)
                    yield _gram_rows(n, lang.dictionary.take(pa.array(of_lang[begin])), gram, counts)

    return (docs.select("text", F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"))
            .mapInArrow(lean(count), "lang string, words int, gram string, f long")
            .groupBy("lang", "words", "gram").agg(F.sum("f").alias("f"))
            .where((F.col("words") == 0) | (F.col("f") >= s.least)))


def _gram_rows(words: int, langs: pa.Array, grams: pa.Array | None, counts: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch({
        "lang": langs.cast(pa.string()), "words": pa.array(np.full(len(langs), words, np.int32)),
        "gram": pa.nulls(len(langs), pa.string()) if grams is None else grams.cast(pa.string()),
        "f": pa.array(counts.astype(np.int64))})


def _big(x: Column | str) -> Column:
    return F.col(x).cast("decimal(25,0)") if isinstance(x, str) else x.cast("decimal(25,0)")


def collocations(docs: DataFrame, s: Mining = Mining()) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first phrases of each language."""
    grams = materialize(gram_counts(docs, s), "phrase-counts")
    totals = grams.where("words = 0").select("lang", F.col("f").alias("n"))
    parts = grams.where("words > 0").select("lang", "gram", "f")
    own = F.split("phrase", " ")
    candidates = grams.where("words > 1").select("lang", F.col("gram").alias("phrase"), "words",
                                                 F.col("f").alias("a"))

    def words(start: Column, many: Column) -> Column:
        return F.array_join(F.slice(own, start, many), " ")

    cuts = (candidates.withColumn("k", F.explode(F.expr("sequence(1, words - 1)")))
            .withColumn("left", words(F.lit(1), F.col("k")))
            .withColumn("right", words(F.col("k") + 1, F.col("words") - F.col("k")))
            .join(parts.select("lang", F.col("gram").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(parts.select("lang", F.col("gram").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .withColumn("_num", _big("a") * F.lit(s.scale).cast("decimal(10,0)"))
            .withColumn("_den", _big("l") + _big("r"))
            .withColumn("score", F.expr("_num div _den")))
    weakest = cuts.groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "k", "l", "r", "a")).alias("cut"))
    # the parts of two words and more of a longer candidate
    within = (candidates.where("words > 2")
              .withColumn("m", F.explode(F.expr("sequence(2, words - 1)")))
              .withColumn("i", F.explode(F.expr("sequence(1, words - m + 1)")))
              .select("lang", words(F.col("i"), F.col("m")).alias("phrase"), "a")
              .groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    kept = (weakest.join(within, ["lang", "phrase"], "left")
            .where(F.col("longer").isNull()
                   | (_big("longer") * 100 < _big("cut.a") * s.inside))
            .select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.score"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= s.top)
            .join(totals, "lang")
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
