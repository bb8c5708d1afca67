"""Exact Jaccard self-join on word n-grams, and its connected groups.

A document's set is its distinct n-grams of lower-cased words (fewer words:
the whole sequence as one).  Two documents link if
``den * |A & B| >= num * |A | B|``.

* Equal sets are one class; only its smallest document goes on.
* Sizes are cut into bands, and a band into tiles by pigeonhole keys: the
  n-grams of a set fall into parts by hash, and sets that differ in at most
  ``d`` n-grams agree in one of the first ``d + 1`` non-empty parts of either.
  So a tile holds only documents that may link, and every link shares a tile.
  Sets that may differ in one n-gram are keyed by their one-deletions; the
  rare set with too few non-empty parts meets its whole band.
* Hashed bitmap signatures: bit ``i`` is the parity of the n-grams with hash
  ``i``.  The bit count of the XOR of two signatures is at most the size of
  the symmetric difference, which bounds the overlap from above.  Pairs that
  pass are settled by exact intersection of the sorted n-gram hashes.
* Every document of a tile is first checked against the tile's smallest one.
  Then only tiles that still hold several components are opened, in chunks,
  and only pairs across components are checked.  So a large group of near
  copies costs pairs in proportion to its size, and no link between different
  texts is lost.

Words and n-grams are 64-bit hashes, sets 128-bit.  Defined results for odd
rows: a null or empty text has an empty set and links with nothing; repeated
rows are one class; rows that share a doc_id count as one document, linked by
any of them; a null doc_id takes no part and keeps a null component; an empty
table gives an empty result; only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, materialize, mix64
from .tiles import linked, open_tiles, shared_tiles
from .tokens import slices, word_column, word_keys

_SETS = ("doc_id long, n long, h1 long, h2 long, band int, rare boolean, bits binary, "
         "keys array<long>")
_M = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Join:
    """Set size and threshold; ``chunk`` bounds the documents of one task's tile."""

    words: int = 3
    num: int = 90
    den: int = 100
    chunk: int = 1024
    broadcast_ids: int = 4_000_000  # ids of 8 bytes

    def differ(self, size: int) -> int:
        """Most n-grams by which a set may differ from a larger linked one."""
        return size * (self.den - self.num) // self.num

    def overlap(self, a, b):
        """Least intersection of linked sets of these sizes."""
        return -((-self.num * (a + b)) // (self.den + self.num))

    def bands(self, most: int) -> list[int]:
        """Lower bounds of the bands of sets that may differ by two or more."""
        lo = 1
        while self.differ(lo) < 2:
            lo += 1
        out = [lo]
        while out[-1] <= most:
            out.append(max(out[-1] + 1, out[-1] * 3 // 2))
        return out


def ngram_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of every text."""
    for run in slices(texts, 4 << 20):
        codes, names, counts = word_column(run)
        h = word_keys(names)[codes]
        grams = h.copy()
        for i in range(1, words):
            grams = grams * _M
            if i < len(h):
                grams[:len(h) - i] += h[i:]
        grams = mix64(grams)
        end = np.cumsum(counts)
        for a, b in zip((end - counts).tolist(), end.tolist()):
            if b - a >= words:
                yield np.unique(grams[a:b - words + 1])
            elif b > a:  # the whole sequence as one
                x = np.array([b - a], dtype=np.uint64)
                for w in h[a:b]:
                    x = mix64(x * _M + w)
                yield x
            else:
                yield np.zeros(0, np.uint64)


def _parts(u: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Content hash of each of ``m`` parts, and the parts that hold anything."""
    part = ((u >> np.uint64(33)) * np.uint64(m) >> np.uint64(31)).astype(np.int64)
    sums = np.zeros(m, dtype=np.uint64)
    np.add.at(sums, part, mix64(u))
    return sums, np.flatnonzero(np.bincount(part, minlength=m))


def tile_keys(u: np.ndarray, join: Join, bands: list[int]) -> tuple[np.ndarray, int, bool]:
    """Keys of a set's tiles, its band, and whether a band needs all pairs."""
    n = len(u)
    keys, rare, band = [], False, -1
    if join.differ(n) == 1 or join.differ(n - 1) == 1:
        whole = mix64(u).sum(dtype=np.uint64)
        if join.differ(n) == 1:
            keys.append(mix64(np.array([whole + np.uint64(n)])))
        if join.differ(n - 1) == 1:
            keys.append(mix64(whole - mix64(u) + np.uint64(n - 1)))
    if n >= bands[0]:
        band = int(np.searchsorted(bands, n, side="right")) - 1
    for b in (band - 1, band):
        # as the larger set, also in the band below if one of that band may link
        if b < 0 or (b < band and n * join.num > (bands[b + 1] - 1) * join.den):
            continue
        top = bands[b + 1] - 1
        m = max(32, 3 * (join.differ(top) + 1) // 2)
        need = join.differ(min(n, top)) + 1
        sums, full = _parts(u, m)
        rare |= len(full) < need
        full = full[:need]
        keys.append(mix64(sums[full] + (full.astype(np.uint64) + np.uint64(b << 40)) * _M))
    return (np.concatenate(keys) if keys else np.zeros(0, np.uint64)), band, rare


def signature(u: np.ndarray, differ: int) -> bytes:
    """Parity bitmap, about eight bits per n-gram that may differ."""
    width = max(64, 1 << int(8 * differ - 1).bit_length()) if differ else 64
    at = (mix64(u + _M) & np.uint64(width - 1)).astype(np.int64)
    return np.packbits(np.bincount(at, minlength=width) & 1).tobytes()


def describe(docs: DataFrame, join: Join) -> DataFrame:
    """One row per document: set size and hash, band, signature, tile keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = join.bands(1 << 20)
        for b in batches:
            out: dict[str, list] = {k: [] for k in ("n", "h1", "h2", "band", "rare", "bits", "keys")}
            for u in ngram_sets(b.column("text"), join.words):
                while bands[-1] <= len(u):
                    bands = join.bands(2 * len(u))
                keys, band, rare = tile_keys(u, join, bands)
                for name, v in (
                        ("n", len(u)),
                        ("h1", int(mix64(u).sum(dtype=np.uint64).view(np.int64))),
                        ("h2", int(mix64(u ^ _M).sum(dtype=np.uint64).view(np.int64))),
                        ("band", band), ("rare", rare),
                        ("bits", signature(u, join.differ(len(u)))), ("keys", keys.view(np.int64))):
                    out[name].append(v)
            yield pa.record_batch({
                "doc_id": b.column("doc_id").cast(pa.int64()),
                "n": pa.array(out["n"], pa.int64()), "h1": pa.array(out["h1"], pa.int64()),
                "h2": pa.array(out["h2"], pa.int64()), "band": pa.array(out["band"], pa.int32()),
                "rare": pa.array(out["rare"], pa.bool_()), "bits": pa.array(out["bits"], pa.binary()),
                "keys": pa.array(out["keys"], pa.list_(pa.int64()))})

    return docs.select("doc_id", "text").mapInArrow(lean(run), _SETS)


def differing_bits(a: bytes, b: bytes) -> int:
    """Bit count of the XOR; a wider signature is folded to the other's width."""
    x, y = (np.unpackbits(np.frombuffer(v, np.uint8)) for v in (a, b))
    while len(x) != len(y):
        if len(x) < len(y):
            x, y = y, x
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int((x ^ y).sum())


def _verify(pairs: DataFrame, sets: DataFrame, docs: DataFrame, join: Join) -> DataFrame:
    """Links among candidate ``pairs`` (``a < b``): signatures first, then the
    exact intersection.  N-grams are read again only for texts that need it."""
    side = sets.select("doc_id", "n", "bits")
    both = (pairs.join(side.select(F.col("doc_id").alias("a"), F.col("n").alias("na"),
                                   F.col("bits").alias("sa")), "a")
            .join(side.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"),
                              F.col("bits").alias("sb")), "b"))

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            na, nb = t.column("na").to_numpy(), t.column("nb").to_numpy()
            most = na + nb - 2 * join.overlap(na, nb)
            small = np.minimum(na, nb)
            ok = join.overlap(na, nb) <= small
            for i in np.flatnonzero(ok):
                ok[i] = differing_bits(t.column("sa")[i].as_py(), t.column("sb")[i].as_py()) <= most[i]
            yield t.select(["a", "b"]).filter(pa.array(ok))

    pairs = materialize(both.select("a", "b", "na", "nb", "sa", "sb")
                        .mapInArrow(lean(bound), "a long, b long").distinct(), "join-pairs")
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "join-ids")
    small = ids.count() <= join.broadcast_ids
    texts = docs.select("doc_id", "text").join(F.broadcast(ids) if small else ids, "doc_id", "left_semi")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            grams = pa.array([u.tobytes() for u in ngram_sets(t.column("text"), join.words)], pa.binary())
            yield pa.record_batch({"doc_id": t.column("doc_id").cast(pa.int64()), "grams": grams})

    grams = materialize(texts.mapInArrow(lean(read), "doc_id long, grams binary").distinct(), "join-grams")
    both = (pairs.join(grams.select(F.col("doc_id").alias("a"), F.col("grams").alias("ga")), "a")
            .join(grams.select(F.col("doc_id").alias("b"), F.col("grams").alias("gb")), "b"))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = np.zeros(t.num_rows, dtype=bool)
            for i, (x, y) in enumerate(zip(t.column("ga"), t.column("gb"))):
                u, v = (np.frombuffer(z.as_buffer(), np.uint64) for z in (x, y))
                both_n = len(np.intersect1d(u, v, assume_unique=True))
                keep[i] = join.den * both_n >= join.num * (len(u) + len(v) - both_n)
            yield t.select(["a", "b"]).filter(pa.array(keep))

    return materialize(both.select("a", "b", "ga", "gb").mapInArrow(lean(exact), "a long, b long").distinct(),
                       "join-links")


def _by_signature(join: Join):
    """Test of a tile's rows: the bit count bounds the overlap."""

    def prepare(t: pa.Table):
        n = t.column("n").to_numpy()
        raw = t.column("bits").to_pylist()
        width = min(map(len, raw))
        bits = np.zeros((len(raw), width), dtype=np.uint8)
        for r, v in enumerate(raw):
            x = np.frombuffer(v, np.uint8)
            while len(x) > width:
                x = x[:len(x) // 2] ^ x[len(x) // 2:]
            bits[r] = x

        def may(r: int, at: np.ndarray) -> np.ndarray:
            least = join.overlap(n[r], n[at])
            differ = np.bitwise_count(bits[at] ^ bits[r]).sum(axis=1, dtype=np.int64)
            return (least <= np.minimum(n[r], n[at])) & (differ <= n[r] + n[at] - 2 * least)

        return may

    return prepare


def groups(docs: DataFrame, join: Join = Join()) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``doc_id, text``."""
    sets = materialize(describe(docs, join), "join-sets")
    classes = materialize(
        sets.where("n > 0").groupBy("h1", "h2", "n").agg(F.min("doc_id").alias("rep"))
        .where(F.col("rep").isNotNull()), "join-classes")
    reps = sets.where("n > 0").join(classes.select(F.col("rep").alias("doc_id")).distinct(),
                                    "doc_id", "left_semi")
    members = shared_tiles(reps.select(F.col("doc_id").alias("node"), F.explode("keys").alias("key")))
    rare = reps.where("rare").select(F.col("doc_id").alias("r"), F.explode(
        F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    odd = (rare.join(reps.select("doc_id", "band"), "band").where("r != doc_id")
           .select(F.least("r", "doc_id").alias("a"), F.greatest("r", "doc_id").alias("b")))
    signatures = reps.select(F.col("doc_id").alias("node"), "n", "bits")
    roots = linked(members, lambda pairs: _verify(pairs, reps, docs, join),
                   lambda roots: open_tiles(members, roots, signatures, _by_signature(join),
                                            join.chunk), odd)
    known = classes.join(roots, classes["rep"] == roots["node"], "left").select(
        "h1", "h2", "n", F.coalesce("root", "rep").alias("component_id"))
    rows = sets.select("doc_id", "n", "h1", "h2")
    return (rows.where("n > 0").join(known, ["h1", "h2", "n"], "left")
            .unionByName(rows.where("n = 0").withColumn("component_id", F.col("doc_id")))
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id")))
