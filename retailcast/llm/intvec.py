"""Integer vectors of Arrow list columns and exact products of them (numpy)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Integers that a double holds exactly; integers of a long.
EXACT, LONG = float(2**53), float(2**63)


def matrices(column: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, floor(scale * x) as doubles) for each vector length of a list column.

    Null rows and rows with a null or non-finite component are left out. The floor of a
    double times a power of two is exact.
    """
    size = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False).astype(np.int64)
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)        # nulls become NaN
    for d in np.unique(size[size >= 0]):
        rows = np.flatnonzero(size == d)
        x = values[offsets[rows][:, None] + np.arange(d)[None, :]]
        fine = np.isfinite(x).all(axis=1)
        if fine.any():
            yield rows[fine], np.floor(scale * x[fine])


def largest(*arrays: np.ndarray) -> list[float]:
    return [float(np.abs(a).max(initial=0)) for a in arrays]


def whole(a: np.ndarray) -> np.ndarray:
    """Python integers of any size."""
    return np.array([int(x) for x in a.ravel()], dtype=object).reshape(a.shape)


def as_long(a: np.ndarray) -> np.ndarray:
    """Longs of exact numbers; raises where one does not fit."""
    if a.dtype == object and any(not -2**63 <= x < 2**63 for x in a.ravel()):
        raise OverflowError("an integer result is beyond a long")
    return a.astype(np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b``, as longs.

    Doubles are used while they hold every sum that can arise, then longs, then
    Python integers; a product beyond a long raises OverflowError.
    """
    x, y = largest(a, b)
    most = x * y * max(a.shape[-1], 1)
    if most < EXACT:
        return (a @ b.T).astype(np.int64)
    if most < LONG:
        return a.astype(np.int64) @ b.astype(np.int64).T
    return as_long(whole(a) @ whole(b).T) if len(a) and len(b) else np.zeros((len(a), len(b)), np.int64)


def row_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of ``a`` with the same rows of ``b``."""
    x, y = largest(a, b)
    most = x * y * max(a.shape[-1], 1)
    if most < EXACT:
        return np.einsum("ij,ij->i", a, b).astype(np.int64)
    if most < LONG:
        return (a.astype(np.int64) * b.astype(np.int64)).sum(axis=1)
    return as_long((whole(a) * whole(b)).sum(axis=1)) if len(a) else np.zeros(0, np.int64)
