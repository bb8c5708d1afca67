"""Words of text columns as numbers, inside a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import mix64


def slices(column: pa.Array, most: int = 8 << 20) -> Iterator[pa.Array]:
    """Runs of rows of about ``most`` bytes (a longer text is a run of its own)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    lo = 0
    while lo < len(column):
        base = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, base + most, side="right")))
        # a compact copy: string kernels misread the offsets of a sliced column
        yield column.take(pa.array(np.arange(lo, hi)))
        lo = hi


def word_column(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the texts, A-Z lower-cased if wanted: a number
    per word, the distinct words by number, and the words of each text."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    enc = flat.filter(real).dictionary_encode()
    return enc.indices.to_numpy(), enc.dictionary, np.diff(before[offsets])


_COEFFICIENTS = np.random.default_rng(64).integers(0, 1 << 63, 1 << 12, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)


def word_keys(words: pa.Array) -> np.ndarray:
    """64-bit multilinear hashes of a column of words (0 for an empty one)."""
    words = words.cast(pa.large_string())
    ends = np.frombuffer(words.buffers()[1], np.int64)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    first = ends[:-1] - ends[0]
    size = np.diff(ends)
    place = np.arange(len(data)) - np.repeat(first, size)
    k = _COEFFICIENTS[place & 4095] * (place.astype(np.uint64) // np.uint64(4096) * np.uint64(2) + np.uint64(1))
    some = np.flatnonzero(size)  # an empty word has no bytes to sum
    out = np.zeros(len(words), np.uint64)
    if len(some):
        sums = np.add.reduceat((data + np.uint64(1)) * k, first[some])
        out[some] = mix64(sums ^ size[some].astype(np.uint64))
    return out
