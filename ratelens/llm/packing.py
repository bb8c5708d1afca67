"""Packing documents into token sequences of a fixed capacity.

Every document becomes its token ids and an end id.  Runs of a whole capacity
are sequences of their own, as first-fit decreasing would leave them; the rest
of each document is one piece.  Pieces are dealt into groups at random, and
each group is packed by itself by first-fit decreasing: the pieces, longest
first, go to the first bin with room, found by a tournament tree over the bins'
capacities.  Then bins whose gaps are too large are closed: the emptiest bin is
cut to fill the gaps of others, while these have room for all of it.  So a
group wastes less than ``least_cut`` of a sequence, and one sequence more.

Ids are those of the whole text: no token spans white space, so the distinct
words between ASCII white space are tokenised once per run of texts.

A group has about ``group_tokens`` tokens and never more than ``group_pieces``
pieces; a document of any length adds less than one capacity to its group, and
pieces, not documents, carry a unique number, so repeated rows spread as well.

Defined results for odd rows: a null or empty text has the end id alone; rows
that share a doc_id, or have none, are documents of their own; special tokens
in a text are ordinary text; only ``doc_id`` and ``text`` are read, so other
columns, whatever their names, change nothing; an empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
import os
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize
from .tokens import slices, word_column

PIECES = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids binary"
_STORED = "doc_id long, piece long, start long, length long, doc_tokens long, ids binary"


@dataclass(frozen=True)
class Packing:
    capacity: int = 2048
    end_id: int = 1
    least_cut: int = 16           # a gap below this stays as padding
    group_tokens: int = 4 << 20
    group_pieces: int = 1 << 16
    seed: int = 11
    run_bytes: int = 24 << 20     # text that a task works on at once


_MARK = r"[!-&(-/:-@\[-`{-~]"  # ASCII punctuation, without the apostrophe of contractions
_EDGE = r"[A-Za-z0-9\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]"
_MARKED = rf"^(?P<before>{_MARK}*)(?P<core>{_EDGE}(?:.*{_EDGE})?)(?P<after>{_MARK}*)$"


def _gather(ids: np.ndarray, size: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """The ids of the entries ``codes`` of a list of ``size`` ids each, in a row."""
    first = np.cumsum(size) - size
    many = size[codes]
    ends = np.cumsum(many)
    return ids[np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - many - first[codes], many)]


class _WordIds:
    """Ids of distinct words by a tokenizer (its JSON text).

    The tokenizer splits a word between a letter or digit and ASCII marks, so
    marks around a word and the word itself are looked up apart: many words
    share them.  Words of the letters a-z go to its model directly.
    """

    def __init__(self, model: str, at_once: int = 20_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.at_once = Tokenizer.from_str(model), at_once
        self.tokenizer.encode_special_tokens = True

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of them of each word."""
        # composed letters of upper and lower case differ, so only ASCII words change here
        words = pc.if_else(pc.string_is_ascii(words), pc.ascii_lower(words), words)
        cut = pc.extract_regex(words, _MARKED)
        whole = pc.is_null(cut)
        parts = [pc.struct_field(cut, [i]) for i in range(3)]
        before, core, after = (pc.if_else(whole, words if i == 1 else "", x) for i, x in enumerate(parts))
        every = pa.concat_arrays([before, core, after]).dictionary_encode()
        ids, size = self._pieces(every.dictionary)
        codes = every.indices.to_numpy().astype(np.int64).reshape(3, -1).T
        return _gather(ids, size, codes.ravel()), size[codes].sum(axis=1)

    def _pieces(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(pieces, "^[a-z]+$").to_numpy(zero_copy_only=False)
        own: list[list[int]] = [[]] * len(pieces)
        tokenize = self.tokenizer.model.tokenize
        at = np.flatnonzero(plain)
        for i, w in zip(at.tolist(), pieces.take(pa.array(at)).to_pylist()):
            own[i] = [t.id for t in tokenize(w)]
        at = np.flatnonzero(~plain)
        for lo in range(0, len(at), self.at_once):
            few = at[lo:lo + self.at_once]
            for i, e in zip(few.tolist(), self.tokenizer.encode_batch_fast(
                    pieces.take(pa.array(few)).to_pylist(), add_special_tokens=False)):
                own[i] = e.ids
        size = np.fromiter(map(len, own), np.int64, len(own))
        return np.fromiter((i for x in own for i in x), np.uint32, int(size.sum())), size


def text_ids(texts: pa.Array, words: _WordIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in a row, each with the end id, and their numbers."""
    codes, names, per_text = word_column(texts, lower=False)
    ids, size = words.of(names)
    # the end of a text as one more word
    ids, size = np.append(ids, np.uint32(end_id)), np.append(size, 1)
    codes = np.insert(codes.astype(np.int64), np.cumsum(per_text), len(names))
    out = _gather(ids, size, codes)
    ends = np.cumsum(size[codes])
    bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text + 1)])]
    return out, np.diff(bounds)


def piece_table(docs: DataFrame, model: str, s: Packing = Packing()) -> DataFrame:
    """Documents cut at multiples of the capacity.  ``ids`` has 16 bits an id
    if the vocabulary allows it, else 32; ``piece`` is unique."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = None
        made = TaskContext.get().partitionId() << 33
        for b in batches:
            words = words or _WordIds(shared.value)
            width = id_width(words.tokenizer.get_vocab_size())
            at = 0
            for texts in slices(b.column("text"), s.run_bytes):
                doc = b.column("doc_id").slice(at, len(texts))
                at += len(texts)
                ids, tokens = text_ids(texts, words, s.end_id)
                pieces = -(-tokens // s.capacity)
                of = np.repeat(np.arange(len(tokens)), pieces)
                start = (np.arange(len(of)) - (np.cumsum(pieces) - pieces)[of]) * s.capacity
                length = np.minimum(s.capacity, tokens[of] - start)
                yield pa.record_batch({
                    "doc_id": doc.take(pa.array(of)), "piece": pa.array(made + np.arange(len(of))),
                    "start": pa.array(start), "length": pa.array(length),
                    "doc_tokens": pa.array(tokens[of]), "ids": _blobs(ids.astype(width), length)})
                made += len(of)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run), _STORED)


def id_width(vocabulary: int) -> str:
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def _blobs(ids: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Consecutive runs of ``ids`` as a binary column."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]) * ids.itemsize
    blobs = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(ids)])
    return blobs.cast(pa.binary())


def _ids_of(column: pa.Array, lengths: np.ndarray) -> np.ndarray:
    """The ids of a binary column in a row, 32 bits each."""
    flat = b"".join(column.to_pylist())
    per_id = len(flat) // max(1, int(lengths.sum()))
    return np.frombuffer(flat, f"<u{per_id}" if per_id else "<u2").astype("<u4")


class Tournament:
    """Room in the bins, as a complete binary tree of maxima."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first bin with room for ``size``, which it takes."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            if room[at] < size:
                at += 1
        out = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return out


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Bins of indices of ``sizes``; equal sizes in their given order."""
    tree = Tournament(len(sizes), capacity)
    bins: list[list[int]] = []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = tree.place(sizes[i])
        if at == len(bins):
            bins.append([])
        bins[at].append(i)
    return bins


def close_gaps(bins: list[list[int]], sizes: list[int], capacity: int,
               least_cut: int) -> list[list[tuple[int, int, int]]]:
    """Bins of cuts ``(index, start, length)``: the emptiest bins are poured into
    the gaps of the others for as long as these hold one of them entirely."""
    out = [[(i, 0, sizes[i]) for i in b] for b in bins]
    gaps = [capacity - sum(sizes[i] for i in b) for b in bins]
    heap = [(-g, b) for b, g in enumerate(gaps) if g >= least_cut]
    heapq.heapify(heap)
    usable = -sum(g for g, _ in heap)
    while heap:
        gap, donor = heap[0]
        if usable < capacity:  # the others' room is less than what the donor holds
            break
        heapq.heappop(heap)
        usable += gap
        parts, out[donor] = out[donor], []
        room = 0
        for i, start, length in parts:
            while length:
                if not room:
                    room, b = heapq.heappop(heap)
                    room, usable = -room, usable + room
                take = min(room, length)
                out[b].append((i, start, take))
                start, length, room = start + take, length - take, room - take
        if room >= least_cut:
            heapq.heappush(heap, (-room, b))
            usable += room
    return [b for b in out if b]


def _sequences(s: Packing):
    """Packs the pieces of one group."""

    def pack(t: pa.Table) -> pa.Table:
        t = t.sort_by("piece").combine_chunks()
        sizes = t.column("length").to_numpy()
        bins = close_gaps(first_fit_decreasing(sizes.tolist(), s.capacity), sizes.tolist(),
                          s.capacity, s.least_cut)
        cut = np.array([(i, start, length, b) for b, own in enumerate(bins) for i, start, length in own],
                       np.int64).reshape(-1, 4)
        of, start, length, b = cut.T
        ids = _ids_of(t.column("ids"), sizes)
        ends = np.cumsum(length)
        begin = (np.cumsum(sizes) - sizes)[of] + start
        flat = ids[np.arange(ends[-1]) - np.repeat(ends - length - begin, length)]
        before = ends - length
        first = np.concatenate([[True], b[1:] != b[:-1]])
        group = t.column("group")[0].as_py()
        rows = t.take(pa.array(of))
        return pa.table({
            "doc_id": rows.column("doc_id"),
            "start": pa.array(rows.column("start").to_numpy() + start), "length": pa.array(length),
            "doc_tokens": rows.column("doc_tokens"),
            "sequence_id": pa.array((group << 17 | b) * 2),
            "offset": pa.array(before - np.maximum.accumulate(np.where(first, before, 0))),
            "ids": _blobs(flat, length)})

    return pack


def pack(docs: DataFrame, model: str, s: Packing = Packing()) -> DataFrame:
    """The pieces of all documents: ``doc_id, start, length, doc_tokens,
    sequence_id, offset`` and ``ids`` (little-endian, 32 bits each)."""
    pieces = materialize(piece_table(docs, model, s), "pack-pieces")
    rest = pieces.where(F.col("length") < s.capacity)
    tokens, many = rest.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    groups = max(1, -(-tokens // s.group_tokens), -(-2 * many // s.group_pieces))

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lengths = b.column("length").to_numpy()
            yield pa.record_batch({
                **{c: b.column(c) for c in ("doc_id", "start", "length", "doc_tokens")},
                "sequence_id": pa.array(b.column("piece").to_numpy() * 2 + 1),
                "offset": pa.array(np.zeros(len(lengths), np.int64)),
                "ids": _blobs(_ids_of(b.column("ids"), lengths), lengths)})

    full = pieces.where(F.col("length") == s.capacity).mapInArrow(lean(whole), PIECES)
    dealt = rest.withColumn("group", F.pmod(F.xxhash64("piece", F.lit(s.seed)), F.lit(groups)))
    return full.unionByName(dealt.groupBy("group").applyInArrow(_sequences(s), PIECES))
