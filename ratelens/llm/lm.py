"""Language-model scores from a hashed maximum-entropy model.

The probability of a token is class-factored: a softmax over word classes,
conditioned on hashed n-gram and skip features of the preceding tokens, times
the word's share of its class.  The most frequent words are classes of their
own, frequent word endings are classes, and the other endings share the rest
by hash, so the class of any word, seen or not, follows from the word.  Every
class keeps one slot for unseen words, so the probabilities sum to one.

Both factors are the priors of what the training texts have after the preceding
word: its classes there, and the words of the class there, by counts of all
pairs of neighbours.  So what is learned grows with the corpus, and context
tells words of one class apart.

How it runs:

1. Texts are tokenised once, into blocks of a few MB that hold word numbers
   and the block's own word list, and written to the shared folder.
2. Counts of all words come from the blocks' word lists (one partial sum per
   block and word is shuffled, never one row per token).
3. Training is distributed gradient descent: in every round the tasks run
   minibatch updates over their blocks from the shared weights, and the
   weights are averaged by tokens (a tree of Spark groups).  Every training
   token is used once.
4. The words of every block and its pairs of neighbours go to hash ranges, packed,
   a row per block and range; each range adds them up and hands every block its
   counts back, in its order.
5. Texts are scored beside the counts of their block in sparse numpy batches.

Words are identified by 64-bit hashes (52 bits of the word, 12 of its ending).  Defined results for odd rows: a null
text has only its end token; repeated rows are scored alike; a table without
training rows gives base score 0; an empty table gives an empty result; only
the columns named are read, so other columns never clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, mix64
from .filters import packed, packed_parts, part_edges, unpacked, unpacked_keys
from .tokens import slices, word_column, word_keys
from .vectors import blob_batch, sum_blobs

_END = np.uint64(0x5EED0E4D)       # hash of the end token; no word, as words hash strings
_START = np.uint64(0x5EED57A7)
_BLOCK = ("block long, doc_id array<long>, held array<boolean>, n array<int>, codes binary, "
          "words binary, hash array<long>, tf array<int>")
_SEQUENCE = 14  # bits of a block's number in its partition
_ENDING = 52  # a word's hash: 12 bits of its ending above 52 bits of the word
_MIDDLE = 20  # bits of a hash that a block of texts is scored without
_KEY_BITS = 40  # by which pairs of neighbours are counted


@dataclass(frozen=True)
class Settings:
    """Sizes of the model; none depends on the data."""

    words: int = 20          # classes that are one frequent word each
    endings: int = 22        # classes that are one frequent ending each
    others: int = 6          # classes that share all other endings
    bits: int = 13           # 2^bits hashed context features (at most 16)
    batch: int = 8192
    rate: float = 0.2
    shares: tuple[int, ...] = (1, 3, 6)  # tenths of the blocks in each round
    block_bytes: int = 6 << 20
    part_keys: int = 2_000_000  # about so many in a hash range
    # what the priors weigh against n counts: a * n^b
    class_prior: tuple[float, float] = (3.0, 0.7)
    word_prior: tuple[float, float] = (1.0, 0.8)

    @property
    def classes(self) -> int:
        return self.words + self.endings + self.others


def tokenize(docs: DataFrame, block_bytes: int) -> DataFrame:
    """Blocks of ``doc_id, held_out, text``; ``tf`` counts training texts only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = block = TaskContext.get().partitionId() << _SEQUENCE
        pack = zstandard.ZstdCompressor(level=1)
        for b in batches:
            at = 0
            for texts in slices(b.column("text"), block_bytes):
                part = b.slice(at, len(texts))
                at += len(texts)
                held = part.column("held_out").to_numpy(zero_copy_only=False).astype(bool)
                numbers, names, words = word_column(texts)
                ends = np.cumsum(words + 1) - 1
                codes = np.full(len(numbers) + len(words), len(names), dtype=np.uint32)
                inner = np.ones(len(codes), dtype=bool)
                inner[ends] = False
                codes[inner] = numbers
                train = np.repeat(~held, words + 1)
                ending = word_keys(pc.utf8_slice_codeunits(pc.utf8_reverse(names), 0, 2))
                hashes = np.append(word_keys(names) >> np.uint64(64 - _ENDING)
                                   | ending << np.uint64(_ENDING), _END)
                tf = np.bincount(codes[train], minlength=len(hashes)).astype(np.int32)
                if block - first >> _SEQUENCE:
                    raise OverflowError("more blocks in a partition than block numbers")
                yield pa.record_batch({
                    "block": pa.array([block], pa.int64()),
                    "doc_id": _one(part.column("doc_id").cast(pa.int64())),
                    "held": _one(pa.array(held)),
                    "n": _one(pa.array((words + 1).astype(np.int32))),
                    "codes": pa.array([pack.compress(_planes(codes))], pa.binary()),
                    "words": pa.array([pack.compress(_planes(hashes.astype(np.uint32))
                                                     + _planes(_endings(hashes)))], pa.binary()),
                    "hash": _one(pa.array(hashes.view(np.int64))), "tf": _one(pa.array(tf))})
                block += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(lean(run), _BLOCK)


def _endings(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(_ENDING)).astype(np.uint16)


def _planes(x: np.ndarray) -> bytes:
    """Bytes by significance, which compress better than whole numbers."""
    return x.view(np.uint8).reshape(len(x), -1).T.tobytes()


def _numbers(raw: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw, np.uint8).reshape(width, -1).T.copy().view(kind).ravel()


def _one(values: pa.Array) -> pa.Array:
    """A list column with one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def word_counts(blocks: DataFrame) -> DataFrame:
    """``hash, c`` of the words of the training texts."""
    return (blocks.select(F.inline(F.arrays_zip("hash", "tf"))).where("tf > 0")
            .groupBy("hash").agg(F.sum("tf").alias("c")))


def _low(hash_: Column) -> Column:
    return hash_.bitwiseAND(F.lit(0xFFFFFFFF))


def _ending(hash_: Column) -> Column:
    return F.shiftrightunsigned(hash_, _ENDING)


@dataclass(frozen=True)
class Classes:
    """Words and endings with a class of their own; sizes of all classes."""

    words: tuple[tuple[int, int], ...]  # low hash and ending of each
    endings: tuple[int, ...]
    total: int                 # N: training tokens
    distinct: int              # V: distinct training tokens
    mass: np.ndarray           # training tokens per class
    types: np.ndarray          # distinct training tokens per class

    @staticmethod
    def of(counts: DataFrame, s: Settings) -> Classes:
        named = counts.select(_low(F.col("hash")).alias("low"), _ending(F.col("hash")).alias("ending"), "c")
        top = tuple((r["low"], r["ending"]) for r in
                    named.orderBy(F.desc("c"), "low", "ending").limit(s.words).collect())
        in_top = F.lit(False)
        for low, e in top:
            in_top = in_top | ((F.col("low") == low) & (F.col("ending") == e))
        ends = tuple(r["ending"] for r in named.where(~in_top).groupBy("ending")
                     .agg(F.sum("c").alias("m")).orderBy(F.desc("m"), "ending")
                     .limit(s.endings).collect())
        sums = (named.withColumn("k", class_column(top, ends, s)).groupBy("k")
                .agg(F.sum("c").alias("m"), F.count(F.lit(1)).alias("v")).collect())
        mass, types = np.zeros(s.classes, np.int64), np.zeros(s.classes, np.int64)
        for r in sums:
            mass[r["k"]], types[r["k"]] = r["m"], r["v"]
        return Classes(top, ends, int(mass.sum()), int(types.sum()), mass, types)

    def number(self, low: np.ndarray, endings: np.ndarray, s: Settings) -> np.ndarray:
        """Class of every word of a block's list."""
        k = s.words + s.endings + endings.astype(np.int64) % s.others
        for i, e in enumerate(self.endings):
            k[endings == e] = s.words + i
        for i, (h, e) in enumerate(self.words):
            k[(low == h) & (endings == e)] = i
        return k


def class_column(words: tuple, endings: tuple, s: Settings) -> Column:
    """The same classes over the columns ``low`` and ``ending``."""
    k = F.pmod(F.col("ending"), F.lit(s.others)) + (s.words + s.endings)
    for i, e in enumerate(endings):
        k = F.when(F.col("ending") == e, s.words + i).otherwise(k)
    for i, (h, e) in enumerate(words):
        k = F.when((F.col("low") == h) & (F.col("ending") == e), i).otherwise(k)
    return k


def _after(x: np.ndarray, starts: np.ndarray, first) -> np.ndarray:
    """The preceding element of every position; ``first`` at a text's start."""
    y = np.empty_like(x)
    y[1:] = x[:-1]
    y[starts] = first
    return y


def features(hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray, bits: int) -> np.ndarray:
    """Hashed context features of every token: previous word, previous two
    words, skipped word, and the classes of the three words before."""
    p1 = _after(hashes, starts, _START)
    p2 = _after(p1, starts, _START)
    c1 = _after(classes.astype(np.uint64) + np.uint64(2), starts, np.uint64(1))
    c2 = _after(c1, starts, np.uint64(1))
    c3 = _after(c2, starts, np.uint64(1))
    keys = (p1, p2 + np.uint64(0x9E3779B97F4A7C15),
            p1 * np.uint64(0xD6E8FEB86659FD93) + p2,
            ((c1 << np.uint64(20)) + (c2 << np.uint64(10)) + c3) * np.uint64(0xA24BAED4963EE407))
    return np.stack([(mix64(k) >> np.uint64(64 - bits)).astype(np.uint16) for k in keys], axis=1)


def _words(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: the word number of every token, and low hash and ending of every word."""
    unpack = zstandard.ZstdDecompressor().decompress
    codes = _numbers(unpack(row["codes"]), np.uint32)
    words = unpack(row["words"])
    cut = len(words) // 6 * 4
    return codes, _numbers(words[:cut], np.uint32), _numbers(words[cut:], np.uint16)


def _block_tokens(row: dict, model: Classes, s: Settings) -> tuple:
    codes, low, endings = _words(row)
    k = model.number(low, endings, s)
    n = np.asarray(row["n"])
    starts = np.cumsum(n) - n
    y = k[codes]
    own = mix64(low.astype(np.uint64) + np.uint64(7))
    return codes, k, n, starts, y, features(own[codes], y, starts, s.bits)


def _softmax(logits: np.ndarray) -> np.ndarray:
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def _logits(w: np.ndarray, bias: np.ndarray, x: np.ndarray) -> np.ndarray:
    out = w[x[:, 0]] + bias
    for j in range(1, x.shape[1]):
        out += w[x[:, j]]
    return out


def descend(w: np.ndarray, bias: np.ndarray, acc: np.ndarray, x: np.ndarray, y: np.ndarray,
            s: Settings) -> None:
    """Minibatch gradient steps with a rate per feature row (in place)."""
    g = np.empty_like(w)
    for lo in range(0, len(y), s.batch):
        xb, yb = x[lo:lo + s.batch], y[lo:lo + s.batch]
        err = _softmax(_logits(w, bias, xb))
        err[np.arange(len(yb)), yb] -= 1.0
        flat = xb.T.ravel()
        # one weighted count per class sums the gradients of all feature rows
        for c, e in enumerate(np.ascontiguousarray(err.T, dtype=np.float64)):
            g[:, c] = np.bincount(flat, np.tile(e, xb.shape[1]), len(w))
        acc += np.einsum("ij,ij->i", g, g) / g.shape[1]
        w -= g * (s.rate / np.sqrt(acc + 1.0))[:, None]


def _row(batch: pa.RecordBatch, i: int) -> dict:
    """One block as numpy arrays."""
    out = {}
    for name in batch.schema.names:
        v = batch.column(name)[i]
        out[name] = v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) \
            else v.as_py()
    return out


def train(blocks: DataFrame, model: Classes, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights ``(2^bits, classes)`` and the fixed bias per class."""
    bias = np.log((model.mass + 0.5) / (model.total + 0.5 * s.classes)).astype(np.float32)
    shape = (1 << s.bits, s.classes)
    w, acc = np.zeros(shape, np.float32), np.zeros(shape[0], np.float32)
    if not model.total:
        return w, bias
    sc = blocks.sparkSession.sparkContext
    tasks = max(1, sc.defaultParallelism)
    of_round = F.pmod(F.xxhash64("block"), F.lit(sum(s.shares)))
    lo = 0
    for share in s.shares:
        # as many parts as cores: each sends one copy of the weights
        rows = blocks.drop("hash", "tf").where((of_round >= lo) & (of_round < lo + share)).coalesce(tasks)
        lo += share
        state = sc.broadcast((w, acc))

        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w_, acc_ = (v.copy() for v in state.value)
            n = 0
            for b in batches:
                for i in range(b.num_rows):
                    row = _row(b, i)
                    _, _, sizes, _, y, x = _block_tokens(row, model, s)
                    used = np.flatnonzero(np.repeat(~row["held"], sizes))
                    np.random.default_rng(row["block"] & 0xFFFFFFFF).shuffle(used)
                    descend(w_, bias, acc_, x[used], y[used], s)
                    n += len(used)
            if n:
                yield blob_batch(TaskContext.get().partitionId(), np.concatenate(
                    [w_.ravel() * np.float32(n), acc_ * np.float32(n), [np.float32(n)]],
                    dtype=np.float32))

        total = sum_blobs(rows.mapInArrow(lean(step), "part long, blob binary"), "float32", tasks)
        if total is not None:
            mean = (total[:-1] / total[-1]).astype(np.float32)
            w, acc = mean[:w.size].reshape(shape), mean[w.size:]
        state.destroy()
    return w, bias


def _neighbours(row: dict, model: Classes, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of a block, sorted, and which of them each token has: first the
    pairs of the preceding word and the word of all tokens, then those of the
    preceding word and the class."""
    codes, low, endings = _words(row)
    n = np.asarray(row["n"])
    word = mix64(low.astype(np.uint64) | endings.astype(np.uint64) << np.uint64(32))
    class_ = mix64(model.number(low, endings, s).astype(np.uint64) + np.uint64(1))
    before = _after(word[codes], np.cumsum(n) - n, _START) * np.uint64(0x9E3779B97F4A7C15)
    keys = np.concatenate([mix64(before + x[codes]) for x in (word, class_)])
    keys, place = np.unique(keys >> np.uint64(64 - _KEY_BITS), return_inverse=True)
    return keys, place


def _word_order(low: np.ndarray, endings: np.ndarray) -> np.ndarray:
    """The order in which a block's words are sent: by evenly spread bits of their hashes."""
    return np.argsort(low.astype(np.uint64) << np.uint64(64 - _ENDING) | endings.astype(np.uint64),
                      kind="stable")


def _ordered_bits(hash_: np.ndarray) -> np.ndarray:
    """The same hashes with the bits that order them first."""
    middle = hash_ >> np.uint64(32) & np.uint64((1 << _MIDDLE) - 1)
    return hash_ << np.uint64(32) | hash_ >> np.uint64(_ENDING) << np.uint64(_MIDDLE) | middle


def block_counts(blocks: DataFrame, model: Classes, s: Settings) -> DataFrame:
    """``block, part, counts``: what the training texts have of each block's words
    (parts from -1 down) and of its neighbours' keys (from 0 up), packed, in the
    order of the parts and of the keys."""
    words, tokens = blocks.agg(
        F.coalesce(F.sum(F.size("hash")), F.lit(0)),
        F.coalesce(F.sum(F.aggregate("n", F.lit(0).cast("long"), lambda a, x: a + x)), F.lit(0))).first()
    # words that the order can't tell apart share a range
    of_words = part_edges(max(1, words // s.part_keys), 64 - _MIDDLE) << np.uint64(_MIDDLE)
    # a block has about as many distinct keys as tokens
    of_keys = part_edges(max(1, tokens // s.part_keys), _KEY_BITS)

    def rows(block: int, first: int, step: int, parts: pa.RecordBatch) -> pa.RecordBatch:
        part = first + step * parts.column("part").to_numpy()
        return pa.record_batch({
            "block": pa.array(np.full(len(part), block)), "part": pa.array(part.astype(np.int32)),
            "keys": parts.column("keys"), "tf": parts.column("v0")})

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                row = _row(b, i)
                order = _word_order(*_words(row)[1:])
                yield rows(row["block"], -1, -1, packed_parts(
                    _ordered_bits(row["hash"].view(np.uint64)[order]), of_words, row["tf"][order]))
                keys, place = _neighbours(row, model, s)
                train = np.repeat(~row["held"].astype(bool), row["n"])
                yield rows(row["block"], 0, 1, packed_parts(
                    keys, of_keys, np.bincount(place, np.tile(train, 2), len(keys))))

    def add(t: pa.Table) -> pa.Table:
        keys = [unpacked_keys(x) for x in t.column("keys").to_pylist()]
        cuts = np.cumsum([len(x) for x in keys])[:-1]
        place = np.unique(np.concatenate(keys), return_inverse=True)[1]
        total = np.bincount(place, np.concatenate([unpacked(x) for x in t.column("tf").to_pylist()]))[place]
        return pa.table({"block": t.column("block"), "part": t.column("part"),
                         "counts": pa.array([packed(x) for x in np.split(total, cuts)], pa.binary())})

    return (blocks.select("block", "held", "n", "codes", "words", "hash", "tf")
            .mapInArrow(lean(send), "block long, part int, keys binary, tf binary")
            .groupBy("part").applyInArrow(add, "block long, part int, counts binary"))


def _in_order(sent: pa.Table, words: bool) -> np.ndarray:
    """What a block's rows of ``block_counts`` hold for its words, or for its neighbours' keys."""
    part = sent.column("part").to_numpy()
    own = np.flatnonzero((part < 0) == words)
    counts = sent.column("counts").take(pa.array(own[np.argsort(np.abs(part[own]))]))
    return np.concatenate([unpacked(x) for x in counts.to_pylist()]).astype(np.float64)


def blend(count: np.ndarray, total: np.ndarray, share: np.ndarray, prior: tuple[float, float]) -> np.ndarray:
    """Share of what was counted ``count`` times of ``total``, smoothed by its share in the prior."""
    weight = prior[0] * np.maximum(total, 1.0) ** prior[1]
    return (count + weight * share) / (total + weight)


def score(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``
    for every row of ``doc_id, held_out, text``; learns where not held out."""
    blocks = materialize(tokenize(docs, s.block_bytes), "lm-blocks", large_rows=True)
    counts = materialize(word_counts(blocks), "lm-counts")
    model = Classes.of(counts, s)
    w, bias = train(blocks, model, s)
    shared = docs.sparkSession.sparkContext.broadcast((w, bias))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        w_, bias_ = shared.value
        out = []
        for batch in left.to_batches():
            for i in range(batch.num_rows):
                out.append(_score_block(_row(batch, i), right, w_, bias_, model, s))
        return pa.concat_tables(out)

    sent = block_counts(blocks, model, s)
    texts = blocks.drop("hash", "tf").withColumnRenamed("block", "_block")
    return texts.groupBy("_block").cogroup(sent.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
             "base_score double, score double")


def _score_block(row: dict, sent: pa.Table, w: np.ndarray, bias: np.ndarray, model: Classes,
                 s: Settings) -> pa.Table:
    codes, k, n, starts, y, x = _block_tokens(row, model, s)
    c = np.empty(len(k))
    c[_word_order(*_words(row)[1:])] = _in_order(sent, words=True)
    base = np.log10(c + 0.5) - np.log10(model.total + 0.5 * (model.distinct + 1))
    inside = (c + 0.5) / (model.mass + 0.5 * (model.types + 1))[k]
    of_word, of_class = _in_order(sent, words=False)[_neighbours(row, model, s)[1]].reshape(2, -1)
    # a text's first token follows its start, of which there are as many as ends
    before = _after(c[codes], starts, c[-1])
    p = np.empty(len(codes))
    for lo in range(0, len(codes), s.batch):
        own = _softmax(_logits(w, bias, x[lo:lo + s.batch]))
        p[lo:lo + s.batch] = own[np.arange(len(own)), y[lo:lo + s.batch]]
    p = blend(of_class, before, np.maximum(p, 1e-30), s.class_prior)
    logp = np.log10(p) + np.log10(blend(of_word, of_class, inside[codes], s.word_prior))
    rows = len(n)
    return pa.table({
        "doc_id": pa.array(row["doc_id"]) if row["doc_id"].dtype == np.int64
        else pa.array(row["doc_id"], pa.int64(), from_pandas=True),
        "held_out": pa.array(row["held"].astype(bool)),
        "n_tokens": pa.array(n.astype(np.int64)),
        "n_known": pa.array(np.add.reduceat((c > 0)[codes].astype(np.int64), starts)),
        "train_tokens": pa.array(np.full(rows, model.total, np.int64)),
        "base_score": pa.array(np.add.reduceat(base[codes], starts)),
        "score": pa.array(np.add.reduceat(logp, starts)),
    })
