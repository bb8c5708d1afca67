"""Numeric blobs that tasks send: summed in Spark by a tree of groups."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SCHEMA = "part long, blob binary"
_FAN = 64


def blob_batch(part: int, vector: np.ndarray) -> pa.RecordBatch:
    """One row ``part, blob``: a task's float64 or int64 vector."""
    return pa.record_batch({"part": pa.array([part], pa.int64()),
                            "blob": pa.array([vector.tobytes()], pa.binary())})


def sum_blobs(df: DataFrame, dtype: str, parts: int = _FAN ** 3) -> np.ndarray | None:
    """Sum of all vectors (equal lengths); ``None`` if there is no row.

    A tree of groups of about ``_FAN`` vectors; ``parts`` is the number of
    tasks expected, so neither a task nor the driver sees more at once.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, part = None, 0
        for b in batches:
            for p, blob in zip(b.column("part").to_pylist(), b.column("blob")):
                v = np.frombuffer(blob.as_buffer(), dtype=dtype)
                total, part = (v.copy() if total is None else total + v), p
        if total is not None:
            yield blob_batch(part, total)

    groups = [1]
    while groups[0] * _FAN < parts:
        groups.insert(0, groups[0] * _FAN)
    for width in groups:
        df = df.groupBy(F.pmod("part", F.lit(width)).alias("_g")).applyInArrow(
            lambda t: pa.Table.from_batches(list(add(iter(t.select(["part", "blob"]).to_batches()))),
                                            schema=_ARROW), _SCHEMA)
    row = df.first()
    return None if row is None else np.frombuffer(row["blob"], dtype=dtype)


_ARROW = pa.schema([("part", pa.int64()), ("blob", pa.binary())])
