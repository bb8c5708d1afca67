"""Byte-level BPE: encoding by ranked merges folded in Spark, and decoding.

The merges run once per distinct word (a match of the split pattern) of the
corpus, as Spark higher-order functions: the word's bytes become ids, and a
fold merges the adjacent pair of lowest rank until none is left.  The rank
map is a literal in the plan, bounded by the tokenizer: a two-level perfect
hash (two flat arrays), so a lookup is two array accesses.  Words that are
tokens themselves take their rank from the table of ranks.  Words above
``LONG_WORD`` bytes, for which a fold over arrays would be quadratic, are
merged with a heap instead (same rule, same result).

Texts then look their words up.  The table of encoded words is broadcast if
its measured size is within ``table_bytes``; if not, texts are grouped in
blocks and every block gets the rows of its own words by a join.  Decoding
concatenates the tokens' bytes natively.

Defined results for odd rows: a null text is empty and gives no ids; a lone
special-token string is ordinary text; repeated rows are encoded alike; an
empty table gives an empty result; columns that clash with the results are
replaced, all others pass through.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, let, materialize
from .tokens import slices, word_keys

LONG_WORD = 256
_BITS = 16  # ids fit 16 bits
_ODD_SPACES = r" [\s\p{Z}\x{85}]"  # a space before other white space
_LETTERS = r"^[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]+$"
_MARKED = rf"^(?P<word> ?{_LETTERS[1:-1]})(?P<marks>[.,;:!?]+)$"  # letters, then marks


@dataclass(frozen=True)
class Tokenizer:
    """Ranks of a tiktoken file and the pattern that splits texts."""

    path: str
    pattern: str

    def ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as f:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def _pairs(ranks: dict[bytes, int]) -> dict[int, int]:
    """``left id << 16 | right id`` -> rank of the merged token."""
    out = {}
    for token, rank in ranks.items():
        for i in range(1, len(token)):
            a, b = ranks.get(token[:i]), ranks.get(token[i:])
            if a is not None and b is not None:
                out[a << _BITS | b] = rank
    return out


class _RankMap:
    """Perfect hash of the pair ranks as two literal arrays."""

    def __init__(self, pairs: dict[int, int]):
        self.buckets = max(1, len(pairs) // 2) | 1
        self.slots = max(2, int(len(pairs) * 1.35)) | 1
        self.p1, self.p2 = 131071, 99991
        rows: list[list[int]] = [[] for _ in range(self.buckets)]
        for k in pairs:
            rows[k % self.buckets].append(k)
        self.shift, self.table = [0] * self.buckets, [-1] * self.slots
        for b in sorted(range(self.buckets), key=lambda x: -len(rows[x])):
            if not rows[b]:
                break
            d = 0
            while True:
                at = [self._slot(k, d) for k in rows[b]]
                if len(set(at)) == len(at) and all(self.table[x] < 0 for x in at):
                    break
                d += 1
            self.shift[b] = d
            for x, k in zip(at, rows[b]):
                self.table[x] = k << _BITS | pairs[k]

    def _slot(self, k, d):
        return (k % self.p1 + d * (k % self.p2 + 1)) % self.slots

    def ranks_of(self, keys: Column) -> Column:
        """Rank of every pair in an array of keys; null where none merges."""
        shift, table = literal_array(self.shift), literal_array(self.table)

        def look(k: Column) -> Column:
            d = F.transform(k, lambda x: F.get(shift, (x % self.buckets).cast("int")))
            e = F.zip_with(k, d, lambda x, y: F.get(table, self._slot(x, y).cast("int")))
            return F.zip_with(k, e, lambda x, y: F.when(
                F.shiftright(y, _BITS) == x, y.bitwiseAND(F.lit((1 << _BITS) - 1))))

        return let(keys, look)


def literal_array(values: list, kind: str = "bigint") -> Column:
    """A constant array; folded into one literal by the optimizer."""
    return F.from_json(F.lit(json.dumps(values, separators=(",", ":"))), f"array<{kind}>")


def fold_merges(word: Column, ranks: dict[bytes, int]) -> Column:
    """Ids of a binary column: the ranked merges as a fold over its bytes."""
    rank_map = _RankMap(_pairs(ranks))
    of_byte = literal_array([ranks[bytes([i])] for i in range(256)])
    ids = let(F.decode(word, "ISO-8859-1"), lambda w: F.transform(  # a character per byte
        F.sequence(F.lit(1), F.length(w)),
        lambda i: F.get(of_byte, F.ascii(F.substring(w, i, F.lit(1))))))

    def step(s: Column, _: Column) -> Column:
        p = s["p"]

        def merge(r: Column) -> Column:
            first = F.coalesce(F.array_position(r, F.array_min(r)), F.lit(0)).cast("int")
            return let(first, lambda j: F.when(j > 0, F.struct(
                F.concat(F.slice(p, F.lit(1), j - 1), F.array(F.get(r, j - 1)),
                         F.slice(p, j + 2, F.size(p))).alias("p"),
                F.lit(False).alias("done"))).otherwise(
                    F.struct(p.alias("p"), F.lit(True).alias("done"))))

        keys = F.transform(F.sequence(F.lit(0), F.size(p) - 2),
                           lambda i: F.get(p, i) * (1 << _BITS) + F.get(p, i + 1))
        return F.when(s["done"] | (F.size(p) < 2), s).otherwise(let(rank_map.ranks_of(keys), merge))

    fold = F.aggregate(F.sequence(F.lit(1), F.greatest(F.octet_length(word) - 1, F.lit(1))),
                       F.struct(ids.alias("p"), F.lit(False).alias("done")),
                       step, lambda s: s["p"])
    return F.when(F.octet_length(word) == 0, F.array().cast("array<bigint>")).otherwise(fold)


def heap_merges(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """The same merges for one long word, in n log n steps."""
    ends = list(range(1, len(word) + 1))
    alive, prev = [True] * len(word), list(range(-1, len(word) - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(a: int) -> None:
        b = ends[a]
        if b < len(word):
            rank = ranks.get(word[a:ends[b]])
            if rank is not None:
                heapq.heappush(heap, (rank, a, ends[b]))

    for a in range(len(word) - 1):
        offer(a)
    while heap:
        _, a, end = heapq.heappop(heap)
        if not alive[a] or ends[a] >= len(word) or ends[ends[a]] != end:
            continue
        alive[ends[a]], ends[a] = False, end
        if end < len(word):
            prev[end] = a
        offer(a)
        if prev[a] >= 0:
            offer(prev[a])
    out, a = [], 0
    while a < len(word):
        out.append(ranks[word[a:ends[a]]])
        a = ends[a]
    return out


def _expand(first: np.ndarray, size: np.ndarray, flat: np.ndarray) -> np.ndarray:
    """Runs ``flat[first : first + size]``, one after the other."""
    out = []
    for lo in range(0, len(size), 1 << 18):  # keeps the index arrays small
        n = size[lo:lo + (1 << 18)]
        ends = np.cumsum(n, dtype=np.int64)
        at = np.repeat(first[lo:lo + (1 << 18)] - (ends - n), n)
        at += np.arange(len(at))
        out.append(flat[at])
    return np.concatenate(out) if out else flat[:0]


class BytesOf:
    """Byte strings of ids, joined without a Python object per id."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(x) for x in strings], dtype=np.int64)
        self.first = np.cumsum(self.size) - self.size
        self.flat = np.frombuffer(b"".join(strings), dtype=np.uint8)

    def join(self, ids: np.ndarray, offsets: np.ndarray) -> list[memoryview]:
        """The joined strings of every run ``ids[offsets[i]:offsets[i + 1]]``."""
        size = self.size[ids]
        data = memoryview(_expand(self.first[ids], size, self.flat))
        cuts = np.concatenate([[0], np.cumsum(size)])[offsets].tolist()
        return [data[a:b] for a, b in zip(cuts, cuts[1:])]


class _Segments:
    """Words of a run of texts, and each text as numbers of ``words``.

    Texts are first cut into segments, a space with what follows up to the
    next one, and only distinct segments are split by the pattern.  The
    pattern never matches across such a cut, unless more white space follows
    the space; texts with that are split as a whole.  Segments of letters
    alone are words as they are (checked where Unicode versions agree), and
    those of letters and marks are two, if the pattern cuts there.
    """

    def __init__(self, texts: pa.Array, pattern: str):
        self._split = regex.compile(pattern).findall
        marks_apart = [self._split(x) for x in (" ab,", "é?!", " ß...")] == [
            [" ab", ","], ["é", "?!"], [" ß", "..."]]
        self._texts = pc.fill_null(texts.cast(pa.large_string()), "")
        self._odd = np.flatnonzero(pc.match_substring_regex(self._texts, _ODD_SPACES)
                                   .to_numpy(zero_copy_only=False))
        plain = self._texts
        if len(self._odd):
            mask = np.zeros(len(texts), dtype=bool)
            mask[self._odd] = True
            plain = pc.if_else(pa.array(mask), pa.scalar("", pa.large_string()), plain)
        lists = pc.split_pattern(plain, " ")
        enc = lists.flatten().dictionary_encode()
        code = enc.indices.to_numpy().astype(np.int64) * 2
        self._starts = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        code[self._starts[:-1]] += 1  # a text's first segment has no space
        there = np.zeros(2 * len(enc.dictionary) + 2, dtype=bool)
        there[code] = True
        self._codes = (np.cumsum(there, dtype=np.int32) - 1)[code]
        kinds = np.flatnonzero(there)
        names = enc.dictionary.take(pa.array(kinds >> 1))
        wide = pa.large_string()
        segments = pc.if_else(pa.array((kinds & 1).astype(bool)), names,
                              pc.binary_join_element_wise(pa.scalar(" ", wide), names,
                                                          pa.scalar("", wide)))
        plain_word = pc.match_substring_regex(names, _LETTERS).to_numpy(zero_copy_only=False)
        words = segments.filter(pa.array(plain_word))
        cut = pc.extract_regex(segments, _MARKED)
        marked = pc.is_valid(cut).to_numpy(zero_copy_only=False) & ~plain_word & marks_apart
        cut = cut.filter(pa.array(marked))
        stems, marks = (pc.struct_field(cut, [i]).dictionary_encode() for i in range(2))
        index: dict[str, int] = {}
        flat: list[int] = []
        self._size = np.ones(len(kinds), dtype=np.int32)
        self._size[marked] = 2
        rest = ~plain_word & ~marked
        sizes = []
        n, split = len(words), self._split
        others = n + len(stems.dictionary) + len(marks.dictionary)
        for piece in segments.filter(pa.array(rest)).to_pylist():
            found = split(piece)
            sizes.append(len(found))
            for w in found:
                flat.append(index.setdefault(w, others + len(index)))
        self._whole = {}
        for i in self._odd.tolist():
            self._whole[i] = [index.setdefault(w, others + len(index))
                              for w in split(self._texts[i].as_py())]
        self._size[rest] = sizes
        first = np.cumsum(self._size, dtype=np.int64) - self._size
        self._flat = np.empty(int(self._size.sum()), dtype=np.int32)
        self._flat[first[plain_word]] = np.arange(n)
        self._flat[first[marked]] = n + stems.indices.to_numpy()
        self._flat[first[marked] + 1] = n + len(stems.dictionary) + marks.indices.to_numpy()
        self._flat[np.repeat(rest, self._size)] = flat
        self._first = first
        wide = pa.large_string()
        self.words = pa.concat_arrays([words, stems.dictionary.cast(wide), marks.dictionary.cast(wide),
                                       pa.array(list(index), wide)])

    def _numbers(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, and their offsets."""
        codes, counts = self._codes, np.diff(self._starts)
        size, first, flat = self._size, self._first, self._flat
        if self._whole:  # texts split as a whole are segments of their own
            parts = np.split(codes, self._starts[1:-1])
            more = [np.array(x, dtype=np.int32) for x in self._whole.values()]
            for k, i in enumerate(self._whole):
                parts[i] = np.array([len(size) + k], dtype=np.int32)
            lengths = np.array([len(x) for x in more], dtype=np.int32)
            first = np.concatenate([first, len(flat) + np.cumsum(lengths) - lengths])
            size, flat = np.concatenate([size, lengths]), np.concatenate([flat, *more])
            codes, counts = np.concatenate(parts), np.array([len(p) for p in parts])
        per_text = np.concatenate([[0], np.cumsum(size[codes], dtype=np.int64)])
        return (_expand(first[codes], size[codes], flat),
                per_text[np.concatenate([[0], np.cumsum(counts)])])

    def ids(self, first: np.ndarray, size: np.ndarray, ids: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and their offsets; ``first`` and ``size`` place
        every word's ids."""
        numbers, cuts = self._numbers()
        n = size[numbers]
        ends = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
        return _expand(first[numbers], n, ids), ends[cuts]


def words_of(texts: DataFrame, pattern: str, run_bytes: int = 6 << 20) -> DataFrame:
    """Distinct words ``word`` of the only column of ``texts``."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Array] = []
        for b in batches:
            for run in slices(b.column(0), run_bytes):
                held.append(_Segments(run, pattern).words)
                if sum(map(len, held)) > 1_000_000:
                    yield _distinct(held)
                    held = []
        if held:
            yield _distinct(held)

    return texts.mapInArrow(lean(find), "word string").distinct()


def _distinct(parts: list[pa.Array]) -> pa.RecordBatch:
    return pa.record_batch({"word": pc.unique(pa.concat_arrays(parts)).cast(pa.string())})


def encode_words(words: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``word, ids`` for a table of distinct words."""
    ranks = tokenizer.ranks()
    spark = words.sparkSession
    shared = spark.sparkContext.broadcast(ranks)  # bounded by the tokenizer
    tokens = spark.createDataFrame([(bytearray(k), v) for k, v in ranks.items()],
                                   "bytes binary, rank int")
    raw = words.withColumn("bytes", F.encode("word", "UTF-8"))
    known = raw.join(F.broadcast(tokens), "bytes", "left")
    usual = known.where((F.octet_length("bytes") <= LONG_WORD) | F.col("rank").isNotNull())
    folded = usual.select("word", F.when(F.col("rank").isNotNull(), F.array("rank")).otherwise(
        fold_merges(F.col("bytes"), ranks).cast("array<int>")).alias("ids"))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = [heap_merges(w.encode(), shared.value) for w in b.column("word").to_pylist()]
            yield pa.record_batch({"word": b.column("word").cast(pa.string()),
                                   "ids": pa.array(ids, pa.list_(pa.int32()))})

    long = (raw.where(F.octet_length("bytes") > LONG_WORD)
            .join(F.broadcast(tokens), "bytes", "left_anti").select("word")
            .mapInArrow(lean(merge), "word string, ids array<int>"))
    return folded.unionByName(long)


def _word_table(encoded: DataFrame) -> dict[str, bytes] | None:
    """Compact word table: steps of the sorted hashes, numbers of ids, ids;
    ``None`` if two words share a hash."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("ids")
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int32)
            ids = lists.flatten().to_numpy().astype(np.uint16)
            yield pa.record_batch({k: pa.array([_squeeze(v)], pa.binary()) for k, v in (
                ("h", word_keys(b.column("word"))), ("n", sizes), ("ids", ids))})

    rows = (encoded.select("word", "ids")
            .mapInArrow(lean(pack), "h binary, n binary, ids binary").collect())  # size checked
    h, n, ids = (np.concatenate([np.zeros(0, t), *(_unsqueeze(r[k], t) for r in rows)])
                 for k, t in (("h", np.uint64), ("n", np.int32), ("ids", np.uint16)))
    del rows
    order = np.argsort(h)
    first = (np.cumsum(n, dtype=np.int64) - n)[order]
    h, n = h[order], n[order]
    if (h[1:] == h[:-1]).any():
        return None
    ids = _expand(first, n, ids)
    return {"h": _squeeze(np.diff(h, prepend=np.uint64(0))), "n": _squeeze(n), "ids": _squeeze(ids)}


def _squeeze(x: np.ndarray) -> bytes:
    """Compressed bytes, by significance."""
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T.tobytes())


def _unsqueeze(packed: bytes, kind: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def _open_table(packed: dict[str, bytes]) -> tuple[np.ndarray, ...]:
    h = np.cumsum(_unsqueeze(packed["h"], np.uint64), dtype=np.uint64)
    n = _unsqueeze(packed["n"], np.int32)
    return (h, (np.cumsum(n, dtype=np.int64) - n).astype(np.uint32), n,
            _unsqueeze(packed["ids"], np.uint16))


def _spans(words: pa.Array, table: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h, first, n, ids = table
    at = np.searchsorted(h, word_keys(words))
    return first[at], n[at], ids


Reduce = Callable[[np.ndarray, np.ndarray], dict[str, pa.Array]]


@contextmanager
def _short_plans(spark: SparkSession) -> Iterator[None]:
    """Keep the literal rank map out of the plan descriptions that the driver
    holds and logs; the plan has no shuffle, so it needs no adaptive updates."""
    short = {"spark.sql.maxPlanStringLength": "10000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k, None) for k in short}
    try:
        for k, v in short.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _ids_column(ids: np.ndarray, offsets: np.ndarray) -> dict[str, pa.Array]:
    return {"ids": pa.ListArray.from_arrays(offsets.astype(np.int32), ids.astype(np.int32))}


def encode(docs: DataFrame, tokenizer: Tokenizer, text: str = "text",
           carry: list[str] | None = None, table_bytes: int = 256 << 20,
           block_docs: int = 2048, run_bytes: int = 6 << 20, reduce: Reduce = _ids_column,
           out: str = "ids array<int>") -> DataFrame:
    """Add ``ids array<int>`` to ``docs`` (or to its ``carry`` columns).

    A task works on ``run_bytes`` of text at once.
    ``reduce(ids, offsets)`` may turn a batch's ids into other columns
    ``out`` in the task that made them, when the ids themselves needn't leave it.
    """
    spark = docs.sparkSession
    added = T.StructType.fromDDL(out)
    carry = [c for c in (docs.columns if carry is None else carry) if c not in added.names]
    source = docs.select(*carry, F.col(text).alias("_text"))
    words = materialize(words_of(docs.select(F.col(text)), tokenizer.pattern, run_bytes), "bpe-words")
    with _short_plans(spark):
        encoded = materialize(encode_words(words, tokenizer), "bpe-encoded")
    size = encoded.agg(F.sum(12 + 2 * F.size("ids"))).first()[0] or 0
    schema = T.StructType([*(docs.schema[c] for c in carry), *added])
    table = _word_table(encoded) if size <= table_bytes else None
    if table is None:
        return _encode_blocks(source, encoded, tokenizer.pattern, carry, schema, block_docs, reduce)
    shared = spark.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = None
        for b in batches:
            at = 0
            for part in slices(b.column("_text"), run_bytes):
                table = table or _open_table(shared.value)
                seg = _Segments(part, tokenizer.pattern)
                done = reduce(*seg.ids(*_spans(seg.words, table)))
                yield _rows(b.slice(at, len(part)), carry, done)
                at += len(part)

    return source.mapInArrow(lean(run), schema)


def _rows(batch: pa.RecordBatch, carry: list[str], done: dict[str, pa.Array]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*(batch.column(c) for c in carry), *done.values()],
                                      names=[*carry, *done])


def _encode_blocks(source: DataFrame, encoded: DataFrame, pattern: str, carry: list[str],
                   schema: T.StructType, block_docs: int, reduce: Reduce) -> DataFrame:
    """Encoding without a broadcast: each block of texts is joined with the
    rows of its own words."""
    n = max(1, source.count() // block_docs)
    # equal texts spread over the blocks by the other columns
    blocks = source.withColumn("_block", F.pmod(F.xxhash64(
        *carry, F.xxhash64("_text")), F.lit(n)))

    def own(table: pa.Table) -> pa.Table:
        names = _distinct([_Segments(run, pattern).words for run in
                           slices(table.column("_text").combine_chunks())]).column("word")
        return pa.table({"_block": pa.array([table.column("_block")[0].as_py()] * len(names),
                                            pa.int64()), "word": names})

    def join(left: pa.Table, right: pa.Table) -> pa.Table:
        place = {w: i for i, w in enumerate(right.column("word").to_pylist())}
        lists = right.column("ids").combine_chunks()
        n_ids = np.diff(lists.offsets.to_numpy())
        first = np.cumsum(n_ids) - n_ids
        flat = lists.flatten().to_numpy()
        out, at = [], 0
        batch = left.combine_chunks().to_batches()[0]
        for part in slices(batch.column("_text")):
            seg = _Segments(part, pattern)
            w = np.array([place[x] for x in seg.words.to_pylist()], dtype=np.int64)
            out.append(_rows(batch.slice(at, len(part)), carry,
                             reduce(*seg.ids(first[w], n_ids[w], flat))))
            at += len(part)
        return pa.Table.from_batches(out)

    needed = blocks.groupBy("_block").applyInArrow(own, "_block long, word string")
    rows = needed.join(encoded, "word").select("_block", "word", "ids")
    return blocks.groupBy("_block").cogroup(rows.groupBy("_block")).applyInArrow(join, schema)


def token_bytes(ranks: dict[bytes, int]) -> list[bytes]:
    """Binary piece of every id."""
    pieces = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        pieces[rank] = token
    return pieces


def decode(ids: Column, ranks: dict[bytes, int]) -> Column:
    """Bytes of an id array: the tokens' binary pieces, concatenated."""
    pieces = literal_array([x.hex() for x in token_bytes(ranks)], "string")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))
