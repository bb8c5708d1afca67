"""Language identification: multinomial logistic regression on hashed
TF-IDF character n-grams, trained by follow-the-regularised-leader (FTRL)
with elastic-net penalties and calibrated with one temperature.

* Document frequencies are counted over every learnable text.
* The classifier is fitted on a bounded, hash-drawn sample of labelled rows,
  at most about ``max_docs`` in all and spread evenly over the languages;
  one sixth of it only sets the temperature.  Training runs in rounds: the
  sample lies in shards, every task runs FTRL over its shard from the shared
  state, and the states are averaged.
* Prediction reads every whole text (long ones piece by piece) and nothing
  but the text.

Defined results for odd rows: a null text, or one without a letter, is
``und`` with score 0; so is every text if there is nothing to learn from;
equal scores go to the language that is smaller by code point; repeated
rows get equal answers; an empty table gives an empty result; columns that
clash with the results are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, materialize
from .vectors import blob_batch, sum_blobs

UNDETERMINED = "und"
_ORDERS = 3  # n-grams of 1 to 3 characters
_STEP = np.uint32(0x9E3779B1)
_FINAL = np.uint32(0x85EBCA6B)


@dataclass(frozen=True)
class Settings:
    """Size and fit of the model (all bounds of the classifier's sample)."""

    bits: int = 16            # 2^bits hashed n-gram features
    max_docs: int = 6_000     # labelled rows the classifier is fitted on
    shards: int = 6
    rounds: int = 5
    min_rows: int = 4_000     # rows seen in a round at least; small samples are passed over again
    batch: int = 8
    alpha: float = 1.0        # FTRL learning rate
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-3
    gain: float = 30.0        # scale of the relative term frequencies
    seed: int = 11


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    weights: np.ndarray       # (2^bits + 1, languages), IDF folded in
    bias: np.ndarray
    temperature: float
    bits: int


def gram_batches(texts: list[str], bits: int, chars: int) -> Iterator[tuple]:
    """``(rows, starts, grams)`` for runs of at most about ``chars`` characters.

    ``grams`` lists one array per order: the feature of the n-gram that starts
    at each character.  Positions without a whole n-gram get the extra feature
    ``2^bits``.  ``starts`` cuts the arrays into pieces, ``rows`` names the
    text of every piece (a long text has several).
    """
    overlap = _ORDERS - 1
    pieces: list[tuple[int, str, int]] = []
    size = 0
    for row, text in enumerate(texts):
        low = f" {text.lower()} "
        at = 0
        while True:
            part = low[at:at + chars + overlap]
            last = at + chars >= len(low) - overlap
            part = low[at:] if last else part
            pieces.append((row, part, -1 if last else chars))
            size += len(part)
            if size >= chars:
                yield _grams(pieces, bits)
                pieces, size = [], 0
            if last:
                break
            at += chars
    if pieces:
        yield _grams(pieces, bits)


def _grams(pieces: list[tuple[int, str, int]], bits: int) -> tuple:
    codes = np.frombuffer("".join(p[1] for p in pieces).encode("utf-32-le", "surrogatepass"),
                          dtype=np.uint32)
    sizes = np.array([len(p[1]) for p in pieces])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    whole = np.array([p[2] < 0 for p in pieces])
    dead = np.uint32(1 << bits)
    shift = np.uint32(32 - bits)
    out = []
    h = codes * _STEP
    for n in range(1, _ORDERS + 1):
        if n > 1:
            h = h.copy()
            h[:-(n - 1)] = (h[:-(n - 1)] ^ (codes[n - 1:] + np.uint32(n))) * _STEP
        g = (h ^ (h >> np.uint32(15))) * _FINAL >> shift
        for back in range(1, n):  # the last n - 1 starts of a text
            at = ends[whole] - back
            g[at[at >= starts[whole]]] = dead
        for i in np.flatnonzero(~whole):  # starts that the next piece repeats
            g[starts[i] + pieces[i][2]:ends[i]] = dead
        out.append(g)
    return np.array([p[0] for p in pieces]), starts, out


def _strings(column: pa.Array) -> list[str]:
    return [x if x is not None else "" for x in column.to_pylist()]


def document_frequencies(texts: DataFrame, bits: int) -> tuple[np.ndarray, int]:
    """Texts that hold each feature, and the number of texts (all of them)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((1 << bits) + 1, dtype=np.int64)
        n = 0
        for b in batches:
            for text in _strings(b.column(0)):
                seen = np.zeros((1 << bits) + 1, dtype=bool)
                for _, _, grams in gram_batches([text], bits, 1 << 20):
                    for g in grams:
                        seen[g] = True
                total += seen
                n += 1
        total[-1] = n
        yield blob_batch(TaskContext.get().partitionId(), total)

    total = sum_blobs(texts.mapInArrow(lean(count), "part long, blob binary"), "int64")
    if total is None:
        return np.zeros(1 << bits, dtype=np.int64), 0
    return total[:-1], int(total[-1])


def _sample(learn: DataFrame, languages: list[tuple[str, int]], s: Settings) -> DataFrame:
    """Hash-drawn rows ``label, u, text``, about ``max_docs`` over all languages."""
    each = s.max_docs / len(languages)
    u = F.pmod(F.xxhash64(F.lit(s.seed), "doc_id"), F.lit(1 << 30)) / float(1 << 30)
    table = learn.sparkSession.createDataFrame(
        [(lang, i, min(1.0, each / n)) for i, (lang, n) in enumerate(languages)],
        "lang string, label int, share double")
    return (learn.withColumn("_u", u).join(F.broadcast(table), "lang")
            .where(F.col("_u") < F.col("share"))
            .select("label", F.xxhash64("doc_id", F.lit(s.seed + 1)).alias("u"), "text"))


def _features(sample: DataFrame, bits: int) -> DataFrame:
    """Term frequencies of the sample, relative to the n-grams of the text."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, values = [], []
            for text in _strings(b.column("text")):
                n = np.zeros((1 << bits) + 1, dtype=np.int64)
                for _, _, grams in gram_batches([text], bits, 1 << 20):
                    for g in grams:
                        n += np.bincount(g, minlength=len(n))
                at = np.flatnonzero(n[:-1])
                ids.append(at.astype(np.int32))
                values.append((n[at] / max(1, n[:-1].sum())).astype(np.float32))
            yield pa.record_batch({
                "label": b.column("label").cast(pa.int32()), "u": b.column("u"),
                "ids": pa.array(ids, pa.list_(pa.int32())),
                "values": pa.array(values, pa.list_(pa.float32()))})

    return sample.mapInArrow(lean(extract), "label int, u long, ids array<int>, values array<float>")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and row starts of a list column."""
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False), np.diff(c.offsets.to_numpy())


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def _weights(z: np.ndarray, n: np.ndarray, s: Settings) -> np.ndarray:
    """FTRL weights in closed form from the state."""
    return np.where(np.abs(z) <= s.l1, 0.0,
                    -(z - np.sign(z) * s.l1) / ((s.beta + np.sqrt(n)) / s.alpha + s.l2))


def _ftrl(table: pa.Table, idf: np.ndarray, z: np.ndarray, n: np.ndarray, s: Settings) -> None:
    """One pass of FTRL over a shard, in place; the last feature is the bias."""
    table = table.sort_by("u")
    labels = table.column("label").to_numpy()
    ids, sizes = _lists(table.column("ids"))
    values = _lists(table.column("values"))[0] * idf[ids] * s.gain
    ends = np.cumsum(sizes)
    for lo in range(0, len(labels), s.batch):
        hi = min(lo + s.batch, len(labels))
        a, b = ends[lo] - sizes[lo], ends[hi - 1]
        rows = np.repeat(np.arange(hi - lo), sizes[lo:hi])
        used, at = np.unique(ids[a:b], return_inverse=True)
        used = np.append(used, len(z) - 1)
        at = np.append(at, np.full(hi - lo, len(used) - 1))
        rows = np.append(rows, np.arange(hi - lo))
        x = np.append(values[a:b], np.ones(hi - lo))
        w = _weights(z[used], n[used], s)
        logits = np.zeros((hi - lo, z.shape[1]))
        for c in range(z.shape[1]):
            logits[:, c] = np.bincount(rows, x * w[at, c], hi - lo)
        err = _softmax(logits)
        err[np.arange(hi - lo), labels[lo:hi]] -= 1.0
        err /= hi - lo
        for c in range(z.shape[1]):
            g = np.bincount(at, x * err[rows, c], len(used))
            grown = n[used, c] + g * g
            z[used, c] += g - (np.sqrt(grown) - np.sqrt(n[used, c])) / s.alpha * w[:, c]
            n[used, c] = grown


def _logits(table: pa.Table, idf: np.ndarray, w: np.ndarray, s: Settings) -> np.ndarray:
    ids, sizes = _lists(table.column("ids"))
    x = _lists(table.column("values"))[0] * idf[ids] * s.gain
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return np.stack([np.bincount(rows, x * w[ids, c], len(sizes)) + w[-1, c]
                     for c in range(w.shape[1])], axis=1)


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature of least log loss on held-back rows (golden section)."""
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = _softmax(logits / np.exp(t))[np.arange(len(labels)), labels]
        return -float(np.log(np.maximum(p, 1e-12)).mean())

    lo, hi, g = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = hi - g * (hi - lo), lo + g * (hi - lo)
        lo, hi = (lo, b) if loss(a) < loss(b) else (a, hi)
    return float(np.exp((lo + hi) / 2))


def train(learn: DataFrame, s: Settings = Settings()) -> Model:
    """Fit on ``doc_id, text, lang``; rows without text or lang are ignored."""
    learn = learn.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    counts = learn.groupBy("lang").count().collect()  # one row per language
    languages = sorted(((r["lang"], r["count"]) for r in counts),
                       key=lambda x: x[0].encode("utf-8", "surrogatepass"))
    width = len(languages)
    if not width:
        return Model((), np.zeros(((1 << s.bits) + 1, 0), np.float32), np.zeros(0), 1.0, s.bits)
    df, n_docs = document_frequencies(learn.select("text"), s.bits)
    idf = np.log((1.0 + n_docs) / (1.0 + df))
    sc = learn.sparkSession.sparkContext
    rows = materialize(_features(_sample(learn, languages, s), s.bits), "langid-sample")
    fit = rows.where(F.pmod("u", F.lit(6)) != 0).withColumn(
        "shard", F.pmod(F.shiftright("u", 8), F.lit(s.shards)))
    passes = max(1, round(s.min_rows / max(100, fit.count())))
    z, n = np.zeros(((1 << s.bits) + 1, width)), np.zeros(((1 << s.bits) + 1, width))
    for _ in range(s.rounds):
        state = sc.broadcast((idf, z.astype(np.float32), n.astype(np.float32)))

        def step(table: pa.Table) -> pa.Table:
            idf_, z_, n_ = state.value
            z_, n_ = z_.astype(np.float64), n_.astype(np.float64)
            for _ in range(passes):
                _ftrl(table, idf_, z_, n_, s)
            return pa.table({"blob": pa.array([np.stack([z_, n_]).astype(np.float32).tobytes()],
                                               pa.binary())})

        blobs = fit.groupBy("shard").applyInArrow(step, "blob binary").collect()  # s.shards rows
        if not blobs:
            break
        z, n = np.mean([np.frombuffer(r["blob"], np.float32).reshape(2, *z.shape)
                        for r in blobs], axis=0, dtype=np.float64)
        state.destroy()
    w = _weights(z, n, s)
    held = rows.where(F.pmod("u", F.lit(6)) == 0).toArrow()  # a sixth of the bounded sample
    t = temperature(_logits(held, idf, w, s), held.column("label").to_numpy()) \
        if held.num_rows else 1.0
    folded = np.zeros((len(w), width), dtype=np.float32)
    folded[:-1] = w[:-1] * (idf * s.gain)[:, None]
    return Model(tuple(x for x, _ in languages), folded, w[-1], t, s.bits)


def _predict(texts: list[str], model: tuple) -> tuple[list[str], np.ndarray]:
    languages, weights, bias, heat, bits = model
    width = len(languages)
    sums, n = np.zeros((len(texts), width)), np.zeros(len(texts))
    for rows, starts, grams in gram_batches(texts, bits, max(1 << 12, (1 << 19) // width)):
        for g in grams:
            np.add.at(sums, rows, np.add.reduceat(weights[g], starts, axis=0))
            np.add.at(n, rows, np.add.reduceat(g < (1 << bits), starts, dtype=np.int64))
    p = _softmax((sums / np.maximum(n, 1)[:, None] + bias) / heat)
    best = p.argmax(axis=1)
    return [languages[i] for i in best], p[np.arange(len(texts)), best]


def identify(docs: DataFrame, model: Model, text: str = "text",
             carry: list[str] | None = None) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to ``docs`` (or to its ``carry`` columns)."""
    carry = [c for c in (docs.columns if carry is None else carry)
             if c not in ("lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.weights, model.bias, model.temperature, model.bits))
    source = docs.select(*carry, F.col(text).alias("_text"))
    fields = [docs.schema[c] for c in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = _strings(b.column("_text"))
            at = [i for i, t in enumerate(texts) if any(map(str.isalpha, t))]
            langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            if at and m[0]:
                found, p = _predict([texts[i] for i in at], m)
                for i, lang in zip(at, found):
                    langs[i] = lang
                scores[at] = p
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in carry] + [pa.array(langs, pa.string()), pa.array(scores)],
                names=[*carry, "lang_pred", "score"])

    return source.mapInArrow(lean(run), T.StructType([
        *fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(doc_id: str, folds: int = 3) -> Column:
    """Rows that take no part in learning: crc32(doc_id as text) mod folds is 1."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 1,
                      F.lit(False))
