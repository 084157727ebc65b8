"""Vector columns: which rows are usable, and Arrow batches as numpy matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column
from pyspark.sql import functions as F


def finite(vector: Column) -> Column:
    """True for arrays that hold something, no nulls and only finite numbers; never null."""
    good = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    return F.coalesce((F.size(vector) > 0) & good, F.lit(False))


def by_size(batch: pa.RecordBatch, column: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers and double matrix of the rows of each vector length."""
    lists = batch.column(column)
    sizes = pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        flat = pa.compute.list_flatten(lists.take(pa.array(at))).to_numpy(zero_copy_only=False)
        yield at, flat.astype(np.float64).reshape(len(at), size)


def packed(column: pa.Array, kind: type, width: int) -> np.ndarray:
    """A binary column of ``width`` numbers a row as a matrix."""
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), width)


def runs(*columns: np.ndarray) -> np.ndarray:
    """Cuts (first 0, last the length) between stretches of rows equal in all columns."""
    n = len(columns[0])
    change = np.zeros(max(n - 1, 0), dtype=bool)
    for column in columns:
        change |= column[1:] != column[:-1]
    return np.concatenate([[0], np.flatnonzero(change) + 1, [n]]) if n else np.zeros(1, np.int64)
