"""Fuzzy line deduplication.

Lines are normalised (A-Z lower-cased, digits equal, punctuation around words
dropped, words joined by one space); a line of fewer than ``min_words`` words
is never removed (two characters of a script written without spaces count as a
word there).  Equal lines are one class.  Two classes of ``near_words`` words
and more link if their edit similarity ``1 - edits / longer length``, in words,
reaches ``similar``.  (Below seven words no edit is allowed at 0.85.)

Candidates come in two stages.  First every line has a SimHash, and lines that
agree on ``agree`` of its ``blocks`` blocks (by pigeonhole all within ``blocks -
agree`` bits) meet the smallest line of their block tile.  Then the candidates
are made complete for the edit similarity: the word pairs of a line are put in
one order, rare ones first.  An edit takes two word pairs from a line at most
(an insertion one), so the first word pair that two linked lines share is among
the first ``lost + 1`` of either, and these are the line's keys; the second one
is among the first ``lost + 2``.  Tiles of up to
``tile`` lines give all their pairs at once; in larger ones, lines meet the
smallest line, and tiles that still hold several groups of linked lines are opened
by two shared word pairs.  A pair is verified if lengths and parity bitmaps of
words leave room for a link: first one of each line, then those that are left
between groups of linked lines.  The order comes
from counts of all words and word pairs of all documents, added up by hash in
tables of a fixed size; no result depends on it.

All keys of a line are hashes, most of which no other line has.  Tasks send
them packed to hash ranges, which tell those that occur twice, and those that
occur more than ``tile`` times; Bloom filters of bounded size then keep the rest
from being shuffled with their lines, and small tiles from large ones.

Of every connected group of lines the occurrence with the smallest (doc_id,
line number) stays, all others are removed from their documents.

Texts of lines are read again for candidates alone; words are compared by 64-bit
hashes.

Defined results for odd rows: a null text stays null; rows that share a
doc_id are one document, whose lines are kept or removed alike; rows with a
null doc_id pass unchanged; a text that loses all its lines becomes empty;
line breaks of kept lines stay as they are; an empty table gives an empty
result; other columns pass through, and columns that clash with the results
are replaced.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import files_go, lean, let, materialize, mix64, release, remove_stored
from .filters import bloom_filter, packed, packed_parts, part_edges, passes, unpacked, unpacked_keys
from .tiles import join_tiles, linked, open_rows, shared_tiles
from .tokens import slices, word_column, word_keys

_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_GRAM_BITS, _LEVEL_BITS, _HASH_BITS = 49, 6, 38  # of a word pair: its rank by rarity above its hash
_KEY_BITS = 48  # by which keys are dealt
_RANK_SLICE = 1 << 14  # slots of a table of counts that a group adds up
_UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
_AROUND = r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$"
_PAYLOAD = ("n", "b1", "b2")
_PLAIN_WORD = r"^[a-z\x{DF}-\x{F6}\x{F8}-\x{24F}]+$"


@dataclass(frozen=True)
class Settings:
    min_words: int = 3
    near_words: int = 7        # words of lines that may link with unequal ones
    blocks: int = 4            # of a SimHash
    agree: int = 2             # blocks that make a key
    feature_chars: int = 5
    similar: float = 0.85
    tile: int = 64             # lines of a tile that is opened by one key
    chunk: int = 2048
    part_keys: int = 2_000_000  # about so many in a hash range
    run_bytes: int = 6 << 20   # text that a task works on at once
    broadcast_lines: int = 4_000_000  # about 16 bytes each
    sample_docs: int = 0       # kept for callers; all documents settle the order of words and pairs
    ranked_words: int = 1 << 18  # slots of the table that counts words, by hash,
    ranked_pairs: int = 1 << 22  # and of the one that counts pairs

    def edits(self, words):
        """Most edits between linked lines, the longer of so many words."""
        return np.floor(words * (1 - self.similar) + 1e-9).astype(np.int64)

    def lost(self, words):
        """Most word pairs of a line of so many words that a linked line lacks."""
        return np.maximum(2 * self.edits(words), 2 * self.edits(words + 1) - 1)


def _normal_words(names: pa.Array) -> pa.Array:
    """Distinct words as they are compared (empty if nothing is left)."""
    plain = pc.match_substring_regex(names, _PLAIN_WORD)
    odd = pc.replace_substring_regex(names.filter(pc.invert(plain)), _AROUND, "")
    odd = pc.replace_substring_regex(odd, "[1-9]", "0")
    return pc.replace_with_mask(names, pc.invert(plain), odd)


def normal_lines(lines: list[str]) -> list[list[str]]:
    """The words by which lines are compared."""
    codes, names, counts = word_column(pa.array(lines, pa.string()))
    names = _normal_words(names).to_pylist()
    words, at = [names[c] for c in codes.tolist()], np.cumsum(counts) - counts
    return [[w for w in words[a:a + n] if w] for a, n in zip(at.tolist(), counts.tolist())]


class Ranks:
    """Levels of words and word pairs, which grow with their counts (by slot: of
    those that share one, all have the level of their sum)."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray):
        self.words, self.pairs = words, pairs

    def of_words(self, hashes: np.ndarray) -> np.ndarray:
        return self.words[_slots(hashes, self.words)].astype(np.uint64)

    def of_pairs(self, hashes: np.ndarray) -> np.ndarray:
        return self.pairs[_slots(hashes, self.pairs)].astype(np.uint64)


def _slots(hashes: np.ndarray, table: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(len(table))).astype(np.int64)


def rank_arrays(docs: DataFrame, s: Settings) -> tuple[np.ndarray, ...]:
    """What ``Ranks`` is made of: plain arrays, of a fixed size.  Every task counts
    all its words and pairs; groups add slices of the tables up."""
    sizes = (s.ranked_words, s.ranked_pairs)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [np.zeros(n, np.uint32) for n in sizes]
        for b in batches:
            for texts in slices(b.column("text"), s.run_bytes):
                lists = pc.split_pattern(pc.fill_null(texts.cast(pa.large_string()), ""), "\n")
                codes, names, counts = word_column(lists.flatten())
                h = word_keys(_normal_words(names))[codes]
                line = np.repeat(np.arange(len(counts)), counts)[h != 0]
                h = h[h != 0]
                inner = np.flatnonzero(line[1:] == line[:-1])
                for table, keys in zip(tables, (h, _pair_hashes(h, inner))):
                    np.add.at(table, _slots(keys, table), np.uint32(1))  # in place: a worker holds one table
        rows = [(kind, at, packed(table[at:at + _RANK_SLICE])) for kind, table in enumerate(tables)
                for at in range(0, len(table), _RANK_SLICE) if table[at:at + _RANK_SLICE].any()]
        if rows:
            kinds, at, blobs = zip(*rows)
            yield pa.record_batch({"kind": pa.array(kinds, pa.int32()), "at": pa.array(at, pa.int32()),
                                   "counts": pa.array(blobs, pa.binary())})

    def add(t: pa.Table) -> pa.Table:
        total = sum(unpacked(x.as_py()).astype(np.float64) for x in t.column("counts"))
        level = np.where(total > 0, 1 + np.minimum(29, 1.5 * np.log2(np.maximum(1, total))), 0)
        return pa.table({"kind": t.column("kind")[:1], "at": t.column("at")[:1],
                         "levels": pa.array([level.astype(np.uint8).tobytes()], pa.binary())})

    out = tuple(np.zeros(n, np.uint8) for n in sizes)
    with files_go(docs.sparkSession):
        rows = (docs.select("text").mapInArrow(lean(count), "kind int, at int, counts binary")
                .groupBy("kind", "at").applyInArrow(add, "kind int, at int, levels binary").collect())
    for r in rows:
        level = np.frombuffer(r["levels"], np.uint8)
        out[r["kind"]][r["at"]:r["at"] + len(level)] = level
    return out


def _pair_hashes(h: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Of the pairs of neighbouring words that begin at ``inner``."""
    return mix64(h[inner] * _A + h[inner + 1]) >> np.uint64(64 - _HASH_BITS)


def _pair_keys(h: np.ndarray, level: np.ndarray, n: np.ndarray, ranks: Ranks,
               s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Keys per line, and the keys of all lines of ``n`` words: the first word
    pairs in the order of all pairs (one more than a tile needs), equal ones
    told apart by a number."""
    counts, out = [], []
    most = 1 << 64 - _GRAM_BITS
    ends = np.cumsum(n)
    for lo in range(0, len(n), most):
        own = n[lo:lo + most]
        a, b = ends[lo] - own[0], ends[lo + len(own) - 1]
        x, r = h[a:b], level[a:b]
        line = np.repeat(np.arange(len(own)), own)
        inner = np.flatnonzero(line[1:] == line[:-1])
        gram = _pair_hashes(x, inner)
        rank = (ranks.of_pairs(gram) << np.uint64(_LEVEL_BITS)) + r[inner] + r[inner + 1]
        v = line[inner].astype(np.uint64) << np.uint64(_GRAM_BITS) | rank << np.uint64(_HASH_BITS) | gram
        v.sort()
        line = (v >> np.uint64(_GRAM_BITS)).astype(np.int64)
        pairs = np.maximum(own - 1, 0)
        at = np.arange(len(v))
        new = np.concatenate([[True], v[1:] != v[:-1]])[:len(v)]
        again = at - np.maximum.accumulate(np.where(new, at, 0))
        take = at - (np.cumsum(pairs) - pairs)[line] <= s.lost(own)[line] + 1
        v = v[take] & np.uint64((1 << _GRAM_BITS) - 1)
        out.append(mix64(mix64(v) + again[take].astype(np.uint64) * _B))
        counts.append(np.bincount(line[take], minlength=len(own)))
    return (np.concatenate(counts), np.concatenate(out)) if out else (
        np.zeros(0, np.int64), np.zeros(0, np.uint64))


def block_keys(sim: np.ndarray, s: Settings) -> np.ndarray:
    """Keys of SimHashes, a row each: every choice of ``agree`` blocks."""
    edges = [64 * i // s.blocks for i in range(s.blocks + 1)]
    out = []
    for i, chosen in enumerate(itertools.combinations(range(s.blocks), s.agree)):
        mask = sum((1 << edges[c + 1]) - (1 << edges[c]) for c in chosen)
        out.append(mix64((sim & np.uint64(mask)) ^ mix64(np.full(1, i + 1, np.uint64) * _B)))
    return np.stack(out, axis=1)


def _line_rows(texts: pa.Array, ids: np.ndarray, ranks: Ranks, s: Settings) -> Iterator[dict]:
    """Per run of texts: lines that may go of each text, their numbers, two
    hashes, words, parity bitmap of words, and keys: those of the SimHash before
    those of word pairs.  Of equal lines of a run the one with the smallest
    (doc_id, line number) has keys."""
    at_text = 0
    for run in slices(texts, s.run_bytes):
        lists = pc.split_pattern(pc.fill_null(run.cast(pa.large_string()), ""), "\n")
        lines = lists.flatten()
        here, at_text = ids[at_text:at_text + len(run)], at_text + len(run)
        codes, names, words = word_column(lines)
        names = _normal_words(names)
        hashes = word_keys(names)
        sizes = pc.utf8_length(names).to_numpy()
        weight = (sizes > 0).astype(np.int64)
        wide = np.flatnonzero(pc.binary_length(names).to_numpy() != sizes)
        unspaced = pc.count_substring_regex(names.take(pa.array(wide)), _UNSPACED).to_numpy()
        weight[wide] = np.maximum(weight[wide], unspaced // 2)
        level = ranks.of_words(hashes)
        owner = np.repeat(np.arange(len(words)), words)
        keep = sizes[codes] > 0 if len(codes) else np.zeros(0, dtype=bool)
        codes, owner = codes[keep], owner[keep]
        weights = np.bincount(owner, weight[codes] if len(codes) else None, minlength=len(words))
        words = np.bincount(owner, minlength=len(words))
        long = weights >= max(1, s.min_words)
        codes = codes[long[owner]]
        n = words[long]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        at = np.flatnonzero(long)
        text = np.searchsorted(offsets, at, side="right") - 1
        line = (at - offsets[text]).astype(np.int32)
        out = {k: np.zeros(len(n), np.uint64) for k in ("h1", "h2", "b1", "b2")}
        counts, keys = np.zeros(len(n), np.int64), np.zeros(0, np.uint64)
        if len(n):
            h = hashes[codes]
            first = np.cumsum(n) - n
            place = (np.arange(len(h)) - np.repeat(first, n)).astype(np.uint64)
            out["h1"] = _line_hash(h, place, first)
            out["h2"] = mix64(np.add.reduceat(mix64((h ^ _B) + place * _B), first))
            mixed = mix64(h)
            bit = np.uint64(1) << (mixed & np.uint64(63))
            high = mixed >> np.uint64(63) > 0
            out["b1"] = np.bitwise_xor.reduceat(np.where(high, np.uint64(0), bit), first)
            out["b2"] = np.bitwise_xor.reduceat(np.where(high, bit, np.uint64(0)), first)
            order = np.lexsort((line, here[text], out["h1"]))
            own = out["h1"][order]
            once = np.zeros(len(n), dtype=bool)
            once[order[np.concatenate([[True], own[1:] != own[:-1]])]] = True
            near = once & (n >= s.near_words)
            chosen = np.repeat(near, n)
            if near.any():
                per_line, pairs = _pair_keys(h[chosen], level[codes[chosen]], n[near], ranks, s)
                few = n[near]
                sim = block_keys(_simhash(mixed[chosen], np.cumsum(few) - few, few,
                                          sizes[codes[chosen]] >= s.feature_chars), s)
                # the blocks' keys of a line, then its pairs'
                counts[near] = per_line + sim.shape[1]
                ends = np.cumsum(counts[near])
                place = np.arange(ends[-1]) - np.repeat(ends - counts[near], counts[near])
                keys = np.empty(ends[-1], np.uint64)
                keys[place < sim.shape[1]] = sim.ravel()
                keys[place >= sim.shape[1]] = pairs
        yield out | {"n": n.astype(np.int32), "line": line,
                     "doc": here[text], "counts": counts, "keys": keys}


def _line_hash(h: np.ndarray, place: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hash of each line from the hashes and places of its words."""
    return mix64(np.add.reduceat(mix64(h + place * _A), first))


def _simhash(h: np.ndarray, first: np.ndarray, n: np.ndarray, feature: np.ndarray,
             step: int = 1 << 15) -> np.ndarray:
    """Majority of every bit over the feature words of each line (all words of
    a line that has none)."""
    line = np.repeat(np.arange(len(n)), n)
    feature = feature | (np.add.reduceat(feature.astype(np.int64), first) == 0)[line]
    h, line = h[feature], line[feature]
    counts = np.zeros((len(n), 64), dtype=np.int32)
    for lo in range(0, len(h), step):
        bits = np.unpackbits(h[lo:lo + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = line[lo:lo + step]
        cut = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
        counts[own[cut]] += np.add.reduceat(bits, cut, axis=0, dtype=np.int32)
    used = np.bincount(line, minlength=len(n))
    top = (2 * counts > used[:, None]).astype(np.uint8)
    return np.packbits(top, axis=1, bitorder="little").view(np.uint64).ravel()


def line_table(docs: DataFrame, s: Settings) -> DataFrame:
    """``doc_id, line, h1, h2, n, b1, b2, keys`` of every line that may go."""
    docs = (docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
            .select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    shared = docs.sparkSession.sparkContext.broadcast(rank_arrays(docs, s))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = Ranks(*shared.value)
        for b in batches:
            ids = b.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            for r in _line_rows(b.column("text"), ids, ranks, s):
                ends = np.concatenate([[0], np.cumsum(r["counts"])]).astype(np.int32)
                yield pa.record_batch({
                    "doc_id": pa.array(r["doc"]), "line": pa.array(r["line"]),
                    "h1": pa.array(r["h1"].view(np.int64)), "h2": pa.array(r["h2"].view(np.int64)),
                    "n": pa.array(r["n"]),
                    **{k: pa.array(r[k].view(np.int64)) for k in _PAYLOAD[1:]},
                    "keys": pa.ListArray.from_arrays(pa.array(ends), pa.array(r["keys"].view(np.int64)))})

    return docs.mapInArrow(lean(run), "doc_id long, line int, h1 long, h2 long, n int, "
                                      "b1 long, b2 long, keys array<long>")


def _key_arrays(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """All keys of a batch in a row, and how many each line has."""
    keys = b.column("keys")
    return keys.flatten().to_numpy().view(np.uint64), np.diff(keys.offsets.to_numpy())


def first_places(equal: DataFrame) -> np.ndarray:
    """A Bloom filter of the places where classes stand first: what it holds back
    is certainly a copy, whose keys its class has already."""
    return bloom_filter(equal.select(F.expr("shiftleft(at.doc_id, 24) ^ at.line").alias("hash")))


def _firsts(b: pa.RecordBatch, places: np.ndarray) -> pa.RecordBatch:
    at = b.column("doc_id").to_numpy() << 24 ^ b.column("line").to_numpy().astype(np.int64)
    return b.filter(pa.array(passes(places, at.view(np.uint64))))


def repeated_keys(table: DataFrame, places: Broadcast, s: Settings) -> DataFrame:
    """``hash`` (the first ``_KEY_BITS`` bits) of all keys that occur twice, and
    whether a key may occur more than ``s.tile`` times."""
    n, many = table.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    edges = part_edges(max(1, int(n * 0.35 + many * 8) // s.part_keys), _KEY_BITS)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def parts() -> pa.RecordBatch:
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return packed_parts(keys, edges, np.minimum(counts, s.tile + 1))

        for b in batches:
            held.append(_key_arrays(_firsts(b, places.value))[0] >> np.uint64(64 - _KEY_BITS))
            if sum(map(len, held)) > s.part_keys:
                yield parts()
        if sum(map(len, held)):
            yield parts()

    def twice(t: pa.Table) -> pa.Table:
        keys = np.concatenate([unpacked_keys(x) for x in t.column("keys").to_pylist()])
        counts = np.concatenate([unpacked(x) for x in t.column("v0").to_pylist()])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        many = np.add.reduceat(counts, first)
        return pa.table({"hash": pa.array(keys[first][many > 1].view(np.int64)),
                         "large": pa.array(many[many > 1] > s.tile)})

    return (table.select("doc_id", "line", "keys").mapInArrow(lean(send), "part int, keys binary, v0 binary")
            .groupBy("part").applyInArrow(twice, "hash long, large boolean"))


def keyed_lines(table: DataFrame, equal: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame, list[Broadcast]]:
    """Of the keys that several lines may have: ``key, node`` and the payload of those
    that at most ``s.tile`` lines have, and ``key, node, block`` of the others;
    ``block`` for those of SimHashes.  Also what can go once these have been read."""
    sc = table.sparkSession.sparkContext
    places = sc.broadcast(first_places(equal))
    twice = materialize(repeated_keys(table, places, s), "line-keys-twice")
    shared = sc.broadcast(bloom_filter(twice.select("hash")))
    large = sc.broadcast(bloom_filter(twice.where("large").select("hash")))
    remove_stored(twice)

    def rows(of_large: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = len(list(itertools.combinations(range(s.blocks), s.agree)))
            for b in batches:
                b = _firsts(b, places.value)
                keys, counts = _key_arrays(b)
                ends = np.cumsum(counts)
                line = np.repeat(np.arange(len(counts)), counts)
                place = np.arange(len(keys)) - (ends - counts)[line]
                n = b.column("n").to_numpy()
                # the last word pair only serves to refine a tile
                at = np.flatnonzero(place <= blocks + s.lost(n)[line])
                hashes = keys[at] >> np.uint64(64 - _KEY_BITS)
                many = passes(large.value, hashes)
                at = at[many if of_large else passes(shared.value, hashes) & ~many]
                own = {"key": pa.array(keys[at].view(np.int64)),
                       "node": b.column("h1").take(pa.array(line[at]))}
                yield pa.record_batch(
                    own | ({"block": pa.array(place[at] < blocks)} if of_large else
                           {c: b.column(c).take(pa.array(line[at])) for c in _PAYLOAD}))

        return table.select("doc_id", "line", "h1", *_PAYLOAD, "keys").mapInArrow(
            lean(run), "key long, node long, " + ("block boolean" if of_large else "n int, b1 long, b2 long"))

    return rows(False), rows(True), [places, shared, large]


def near_pairs(small: DataFrame, s: Settings) -> DataFrame:
    """Pairs ``a < b`` of lines that share a small tile (``key, node`` and payload)
    and may link.  Tasks go through their tiles key by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last tile so far, which may go on
        for b in batches:
            if b.num_rows:
                rows = [b.column(c).to_numpy() for c in ("key", "node", *_PAYLOAD)]
                if held:
                    rows = [np.concatenate(x) for x in zip(held, rows)]
                cut = int(np.searchsorted(rows[0], rows[0][-1]))
                held = [x[cut:].copy() for x in rows]
                yield _tile_pairs(*[x[:cut] for x in rows], s)
        if held:
            yield _tile_pairs(*held, s)

    return (small.repartition("key").sortWithinPartitions("key")
            .mapInArrow(lean(run), "a long, b long").distinct())


def _tile_pairs(key: np.ndarray, node: np.ndarray, n: np.ndarray, b1: np.ndarray, b2: np.ndarray,
                s: Settings) -> pa.RecordBatch:
    """The pairs of rows of one key, in order of keys, for which ``_near`` holds."""
    b1, b2 = b1.view(np.uint64), b2.view(np.uint64)
    at, step, a, b = np.arange(len(key)), 0, [node[:0]], [node[:0]]
    while len(at):
        step += 1
        at = at[at + step < len(key)]
        at = at[key[at] == key[at + step]]
        to = at + step
        most, gap = s.edits(np.maximum(n[at], n[to])), np.abs(n[at] - n[to])
        ok = np.flatnonzero((gap <= most) & (node[at] != node[to]))
        x, y = at[ok], to[ok]
        apart = np.bitwise_count(b1[x] ^ b1[y]) + np.bitwise_count(b2[x] ^ b2[y])  # 128 at most
        near = apart <= 2 * most[ok] - gap[ok]
        a.append(np.minimum(node[x], node[y])[near])
        b.append(np.maximum(node[x], node[y])[near])
    return pa.record_batch({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})


def _apart(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    """The pairs whose lines are in different components."""
    a, b = (roots.select(F.col("node").alias(x), F.col("root").alias(f"root_{x}")) for x in "ab")
    return (pairs.join(a, "a", "left").join(b, "b", "left")
            .where(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b"))


def _near(left: str, right: str, s: Settings) -> Column:
    """Whether lengths and bitmaps of two classes leave room for a link."""

    def apart(name: str) -> Column:
        return F.bit_count(F.col(left + name).bitwiseXOR(F.col(right + name)))

    n, m = F.col(left + "n"), F.col(right + "n")
    most = F.floor(F.greatest(n, m) * F.lit(1 - s.similar) + F.lit(1e-9))
    # a replaced word changes two bits, an added or a left out one changes one
    return (F.abs(n - m) <= most) & (apart("b1") + apart("b2") <= 2 * most - F.abs(n - m))


def large_tile_keys(table: DataFrame, members: DataFrame, s: Settings) -> DataFrame:
    """``node, keys`` of (at least) the lines that lie in tiles of more than
    ``s.tile`` lines."""
    large = members.groupBy("key").count().where(F.col("count") > s.tile).select("key")
    nodes = materialize(members.join(large, "key").select(F.col("node").alias("hash")).distinct(), "line-large")
    shared = table.sparkSession.sparkContext.broadcast(bloom_filter(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(passes(shared.value, b.column("node").to_numpy().view(np.uint64))))

    return (table.where(F.size("keys") > 0).select(F.col("h1").alias("node"), "keys")
            .mapInArrow(run, "node long, keys array<long>").dropDuplicates(["node"]))


def _refined(large: DataFrame, keys: DataFrame, s: Settings) -> DataFrame:
    """``key, node`` of two word pairs: the tile's of ``large`` (``key, node``) and
    any later one of the line.  Linked lines of a tile share another pair: if
    the tile is of the first that they share, the second is among their keys."""
    blocks = len(list(itertools.combinations(range(s.blocks), s.agree)))
    own = F.slice("keys", F.lit(blocks + 1), F.size("keys"))
    later = let(F.array_position(own, F.col("key")).cast("int"),
                lambda i: F.slice(own, i + 1, F.size(own)))
    return (large.join(keys, "node").withColumn("then", F.explode(later))
            .select(F.xxhash64("key", "then").alias("key"), "node"))


def _opened(members: DataFrame, roots: DataFrame, classes: DataFrame, keys: DataFrame,
            s: Settings) -> DataFrame:
    """Pairs across components that share a tile and may link."""
    payload = classes.select("node", *_PAYLOAD)

    def test(x: str, y: str) -> Column:
        return _near(x, y, s)

    rows = materialize(open_rows(members, roots), "line-mixed")
    pairs = join_tiles(rows.where(F.col("size") <= s.tile), payload, test, s.chunk)
    large = rows.where(F.col("size") > s.tile)
    if not large.head(1):
        return pairs
    again = materialize(open_rows(shared_tiles(_refined(large.select("key", "node"), keys, s)), roots), "line-refined")
    return pairs.unionByName(join_tiles(again, payload, test, s.chunk))


def _verify(pairs: DataFrame, classes: DataFrame, docs: DataFrame, s: Settings) -> DataFrame:
    """Links among candidate pairs of classes: what ``_near`` sees, then edit
    similarity of the normalised lines."""
    a, b = (classes.select(F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in _PAYLOAD])
            for x in "ab")
    near = materialize(pairs.join(a, "a").join(b, "b").where(_near("a_", "b_", s))
                       .select("a", "b").distinct(), "line-pairs")
    release(docs.sparkSession)
    nodes = near.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    wanted = materialize(
        classes.join(nodes, "node").groupBy("doc_id").agg(
            F.collect_list(F.struct("line", "node")).alias("wanted")), "line-wanted")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("wanted")
            rows = lists.flatten()
            owner = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            line, node = rows.field("line").to_numpy(), rows.field("node")
            at = 0
            for texts in slices(b.column("text"), s.run_bytes):
                mine = np.flatnonzero((owner >= at) & (owner < at + len(texts)))
                split = pc.split_pattern(texts.cast(pa.large_string()), "\n")
                offsets = split.offsets.to_numpy() - split.offsets[0].as_py()
                first, many = offsets[owner[mine] - at], np.diff(offsets)[owner[mine] - at]
                # rows that share a doc_id may have other lines than the one that was seen
                there = line[mine] < many
                own = split.flatten().take(pa.array((first + line[mine])[there]))
                yield _of_nodes(node.take(pa.array(mine[there])), own)
                at += len(texts)

    small = (wanted.agg(F.sum(F.size("wanted"))).first()[0] or 0) <= s.broadcast_lines
    texts = materialize(
        docs.where(F.col("text").isNotNull()).select(F.col("doc_id").cast("long"), "text")
        .join(F.broadcast(wanted) if small else wanted, "doc_id")
        .mapInArrow(lean(read), "node long, own binary")
        .distinct(), "line-texts")
    both = (near.join(texts.select(F.col("node").alias("a"), F.col("own").alias("ta")), "a")
            .join(texts.select(F.col("node").alias("b"), F.col("own").alias("tb")), "b"))

    def linked_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = [alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), s)
                    for x, y in zip(t.column("ta"), t.column("tb"))]
            yield t.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return materialize(both.select("a", "b", "ta", "tb").mapInArrow(lean(linked_pairs), "a long, b long")
                       .distinct(), "line-links")


def word_hashes(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words by which lines are compared, and how many each has."""
    codes, names, counts = word_column(lines)
    h = word_keys(_normal_words(names))[codes]
    line = np.repeat(np.arange(len(counts)), counts)[h != 0]
    return np.ascontiguousarray(h[h != 0]), np.bincount(line, minlength=len(counts))


def _of_nodes(nodes: pa.Array, lines: pa.Array) -> pa.RecordBatch:
    """``node, own``: the bytes of the lines' word hashes, where these are the node's."""
    h, n = word_hashes(lines)
    ends = np.cumsum(n)
    blobs = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [
        None, pa.py_buffer(np.concatenate([[0], ends]).astype(np.int64) * 8), pa.py_buffer(h)])
    same = n > 0
    if same.any():
        place = (np.arange(len(h)) - np.repeat(ends - n, n)).astype(np.uint64)
        same[same] = _line_hash(h, place, (ends - n)[same]) == nodes.to_numpy().view(np.uint64)[same]
    return pa.record_batch({"node": nodes, "own": blobs.cast(pa.binary())}).filter(pa.array(same))


def alike(x: np.ndarray, y: np.ndarray, s: Settings) -> bool:
    """Whether two lines of word hashes reach the edit similarity."""
    n, m = len(x), len(y)
    most = int(s.edits(max(n, m)))
    if abs(n - m) > most:
        return False
    if n == m and np.count_nonzero(x != y) <= most:
        return True
    # what lies between the first and the last word that differ
    short = min(n, m)
    off = np.flatnonzero(x[:short] != y[:short])
    head = int(off[0]) if len(off) else short
    off = np.flatnonzero(x[n - short + head:][::-1] != y[m - short + head:][::-1])
    tail = int(off[0]) if len(off) else short - head
    x, y = x[head:n - tail], y[head:m - tail]
    if max(len(x), len(y)) <= most:
        return True
    return word_edits(x.tolist(), y.tolist(), most) <= most


def word_edits(x: list, y: list, most: int) -> int:
    """Least insertions, deletions and replacements of words from ``x`` to
    ``y``, or ``most + 1`` if there are more: for each number of edits, how far
    each diagonal reaches, so near lines cost little more than reading them."""
    n, m = len(x), len(y)
    if abs(n - m) > most:
        return most + 1
    reach: dict[int, int] = {}
    for d in range(most + 1):
        new: dict[int, int] = {}
        for k in range(-d, d + 1):  # diagonal: place in y less place in x
            if d == 0:
                i = 0
            else:
                i = max(reach.get(k, -2) + 1, reach.get(k - 1, -2), reach.get(k + 1, -2) + 1)
            i = min(i, n, m - k)
            if i < 0 or i + k < 0:
                continue
            while i < n and i + k < m and x[i] == y[i + k]:
                i += 1
            new[k] = i
        if new.get(m - n, -1) == n:
            return d
        reach = new
    return most + 1


def removals(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``doc_id, line`` of every line that is not the kept one of its group."""
    table = materialize(line_table(docs, s), "lines")
    place = F.struct("doc_id", "line")
    equal = materialize(
        table.groupBy("h1", "h2").agg(F.min(place).alias("at"), *[F.min(c).alias(c) for c in _PAYLOAD],
                                      F.count(F.lit(1)).alias("copies")), "line-classes")
    classes = (equal.where(F.col("n") >= s.near_words)
               .select(F.col("h1").alias("node"), *_PAYLOAD, "at.doc_id", "at.line"))
    release(docs.sparkSession)
    small, large, filters = keyed_lines(table, equal, s)
    release(docs.sparkSession)
    near = materialize(near_pairs(small, s), "line-near")
    release(docs.sparkSession)
    members = shared_tiles(large)
    del small, large
    for f in filters:
        f.destroy()
    release(docs.sparkSession)
    # from here on only places and hashes of the lines are needed
    keys = materialize(large_tile_keys(table, members, s), "line-tile-keys")
    whole, table = table, materialize(table.select("doc_id", "line", "h1", "h2"), "line-places")
    remove_stored(whole)
    release(docs.sparkSession)
    met = (members.where("block AND node > hub").groupBy("node").agg(F.min("hub").alias("a"))
           .select("a", F.col("node").alias("b")))
    met = met.unionByName(near.groupBy("b").agg(F.min("a").alias("a")))
    pairs = members.where("NOT block").drop("block")
    roots = linked(pairs, lambda found: _verify(found, classes, docs, s),
                   lambda roots: _opened(pairs, roots, classes, keys, s).unionByName(_apart(near, roots)).distinct(),
                   extra=met, rounds=1)
    release(docs.sparkSession)
    grouped = (equal.join(roots, equal["h1"] == roots["node"], "left")
               .where((F.col("copies") > 1) | F.col("root").isNotNull())
               .select("h1", "h2", "at", F.coalesce("root", "h1").alias("root"),
                       F.when(F.col("root").isNull(), F.col("h2")).alias("alone")))
    kept = grouped.groupBy("root", "alone").agg(F.min("at").alias("kept"))
    gone = (grouped.join(kept, grouped["root"].eqNullSafe(kept["root"])
                         & grouped["alone"].eqNullSafe(kept["alone"])).select("h1", "h2", "kept"))
    return (table.join(gone, ["h1", "h2"]).where(place != F.col("kept"))
            .select("doc_id", "line").distinct())


def dedup_lines(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """``docs`` with its text cleaned, plus ``n_lines`` and ``n_removed``."""
    keep = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    gone = materialize(removals(docs, s).groupBy("doc_id").agg(
        F.collect_set("line").alias("_gone")).withColumnRenamed("doc_id", "_doc"), "line-gone")
    small = (gone.agg(F.sum(F.size("_gone"))).first()[0] or 0) <= s.broadcast_lines
    rows = docs.select(*keep).join(F.broadcast(gone) if small else gone,
                                   F.col("doc_id").cast("long") == F.col("_doc"), "left")
    split = F.split("text", "\n", -1)
    left = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("_gone"))
    cleaned = F.when(F.col("_gone").isNull() | F.col("text").isNull(), F.col("text")).otherwise(
        let(split, lambda x: F.array_join(F.transform(left, lambda i: F.get(x, i)), "\n")))
    return rows.select(
        *[cleaned.alias(c) if c == "text" else F.col(c) for c in keep],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.coalesce(F.size("_gone"), F.lit(0)).cast("long").alias("n_removed"))
