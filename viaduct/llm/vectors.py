"""Vectors of a list column, as numpy arrays.

A vector is usable if it is not null, not empty, and holds no null, NaN or infinite component.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def vector_of(column: str) -> Column:
    """The list column in double precision; float components keep their value."""
    return F.col(column).cast("array<double>")


def usable(lists: pa.ListArray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Row numbers of the usable vectors, and these vectors."""
    flat = lists.flatten()  # without what lies under null lists
    values = flat.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)  # null components become NaN
    sizes = np.asarray(lists.value_lengths().fill_null(0), np.int64)
    ends = np.cumsum(sizes)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    rows = np.flatnonzero((sizes > 0) & (bad[ends] == bad[ends - sizes]))
    return rows, [values[ends[r] - sizes[r]:ends[r]] for r in rows]
