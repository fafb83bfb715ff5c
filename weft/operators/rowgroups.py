"""Groups of rows in Arrow batches, by the marks of their keys."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def group_numbers(m1: pa.Array, m2: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Group number of each row, in the order of first rows, and the first rows."""
    a, b = m1.to_numpy(), m2.to_numpy()
    order = np.lexsort((b, a))
    new = np.ones(len(a), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    firsts = order[new]  # the sort is stable
    rank = np.empty(len(firsts), np.int64)
    by_row = np.argsort(firsts)
    rank[by_row] = np.arange(len(firsts))
    groups = np.empty(len(a), np.int64)
    groups[order] = rank[np.cumsum(new) - 1]
    return groups, pa.array(firsts[by_row])


def one_batch(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """All rows as one batch; there is at least one batch."""
    filled = pa.Table.from_batches(batches).combine_chunks().to_batches()
    return filled[0] if filled else batches[0]
