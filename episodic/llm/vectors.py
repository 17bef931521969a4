"""Helpers for vector columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(c: str) -> Column:
    """Neither null nor zero, without null or non-finite components."""
    ok = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(ok & F.exists(c, lambda x: x != 0), F.lit(False))


def matrix(col) -> np.ndarray:
    """A binary column of packed doubles as rows of a matrix."""
    rows = col.to_pylist()
    return np.frombuffer(b"".join(rows), np.float64).reshape(len(rows), -1) if rows else np.empty((0, 0))


def stacked(col) -> list[np.ndarray]:
    """An array column as double vectors."""
    off = col.offsets.to_numpy()
    flat = col.values.to_numpy(zero_copy_only=False).astype(np.float64)
    return [flat[a:b] for a, b in zip(off, off[1:])]


def binary(rows) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())
