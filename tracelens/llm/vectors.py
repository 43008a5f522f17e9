"""Vectors as Arrow lists: validity in SQL, matrices in tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: str) -> Column:
    """True for a vector that is not null or empty, whose components are all
    finite and not all zero."""
    e = F.col(vector)
    return F.coalesce(e.isNotNull() & (F.size(e) > 0)
                      & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(e, lambda x: x != 0), F.lit(False))


def usable_or_zero(vector: str) -> Column:
    """True for a vector that is not null or empty and whose components are
    all finite; the zero vector is one."""
    e = F.col(vector)
    return F.coalesce(e.isNotNull() & (F.size(e) > 0)
                      & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def matrix(lists) -> np.ndarray:
    """(rows, length) doubles of a list column of equal lengths."""
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(lists), -1) if len(lists) else flat.reshape(0, 0)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of length one (scaled first, so no square over- or underflows)."""
    if not len(x):
        return x
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosine of each row of a with the same row of b, in double precision;
    the same two rows always give the same number."""
    a, b = a / np.abs(a).max(axis=1, keepdims=True), b / np.abs(b).max(axis=1, keepdims=True)
    dot = np.einsum("ij,ij->i", a, b)
    return dot / (np.sqrt(np.einsum("ij,ij->i", a, a)) * np.sqrt(np.einsum("ij,ij->i", b, b)))
