"""Sets of 64-bit hashes that tasks send and share in little space."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .common import files_go, mix64

_SLICE_BITS = 20  # of a filter, put together by one group
MOST_BITS = 1 << 28  # of a filter: 32 MB


def packed(x: np.ndarray) -> bytes:
    """An integer array, its bytes by place (high ones are mostly zero)."""
    return zstandard.compress(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def unpacked(blob: bytes) -> np.ndarray:
    flat = np.frombuffer(zstandard.decompress(blob), np.uint8)
    return np.ascontiguousarray(flat.reshape(8, -1).T).view(np.uint64).ravel()


def packed_parts(keys: np.ndarray, edges: np.ndarray, *values: np.ndarray) -> pa.RecordBatch:
    """``part, keys, v0...``: sorted ``keys`` cut at ``edges`` into parts, as steps
    from one key to the next, with the values beside them."""
    cuts = np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
    some = np.flatnonzero(np.diff(cuts))
    spans = list(zip(cuts[some].tolist(), cuts[some + 1].tolist()))
    out = {"part": pa.array(some.astype(np.int32)),
           "keys": pa.array([packed(np.diff(keys[a:b], prepend=np.uint64(0))) for a, b in spans], pa.binary())}
    for i, v in enumerate(values):
        out[f"v{i}"] = pa.array([packed(v[a:b]) for a, b in spans], pa.binary())
    return pa.record_batch(out)


def unpacked_keys(blob: bytes) -> np.ndarray:
    return np.cumsum(unpacked(blob), dtype=np.uint64)


def part_edges(parts: int, bits: int) -> np.ndarray:
    """Inner bounds of ``parts`` equal ranges of hashes of so many bits."""
    return np.array([(p << bits) // parts for p in range(1, parts)], np.uint64)


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    x = mix64(hashes)
    return (x & np.uint64(bits - 1)).astype(np.int64), (x >> np.uint64(32) & np.uint64(bits - 1)).astype(np.int64)


def passes(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes a Bloom filter lets through: all that were put in, few others."""
    one, two = _slots(hashes, 8 * len(filter_))
    return (filter_[one >> 3] << (one & 7) & filter_[two >> 3] << (two & 7) & 128) > 0


def bloom_filter(hashes: DataFrame, most_bits: int = MOST_BITS) -> np.ndarray:
    """A Bloom filter of a stored column ``hash`` (of longs).

    It has at most ``most_bits`` bits, whatever the number of hashes: beyond
    that it lets more through, but never holds one back that was put in.
    Groups put slices of it together.
    """
    bits, many = 1 << _SLICE_BITS, hashes.count()
    while bits < min(64 * many, most_bits):
        bits *= 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            slots = np.unique(np.concatenate(_slots(b.column("hash").to_numpy().view(np.uint64), bits)))
            yield pa.record_batch({"slice": pa.array((slots >> _SLICE_BITS).astype(np.int32)),
                                   "slot": pa.array((slots & ((1 << _SLICE_BITS) - 1)).astype(np.int32))})

    def pack(t: pa.Table) -> pa.Table:
        own = np.zeros(1 << _SLICE_BITS, bool)
        own[t.column("slot").to_numpy()] = True
        return pa.table({"slice": t.column("slice")[:1],
                         "bits": pa.array([np.packbits(own).tobytes()], pa.binary())})

    out = np.zeros(bits // 8, np.uint8)
    step = (1 << _SLICE_BITS) // 8
    with files_go(hashes.sparkSession):
        rows = (hashes.mapInArrow(spread, "slice int, slot int").distinct()
                .groupBy("slice").applyInArrow(pack, "slice int, bits binary").collect())
    for r in rows:
        out[r["slice"] * step:(r["slice"] + 1) * step] = np.frombuffer(r["bits"], np.uint8)
    return out
