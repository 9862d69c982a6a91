"""Arrow batches in portions of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Elements that one portion holds at most, unless a single list has more.
ELEMENTS = 1 << 18
# Bytes of text in one portion of rows, unless a single row has more.
BYTES = 1 << 20


def portions(lists: pa.ListArray, most: int = ELEMENTS) -> Iterator[pa.ListArray]:
    """Consecutive slices of ``lists`` with at most ``most`` elements each, or one list; one empty slice for none.

    A batch has a number of rows, however long they are; what is worked out per element fits a portion.
    """
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(lists):
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield lists.slice(at, upto - at)
        at = upto
    if not len(lists):
        yield lists


def row_portions(batch: pa.RecordBatch, *texts: int, most: int = BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` whose columns ``texts`` have at most ``most`` bytes each, or one row; none for no row.

    A batch of long rows then never stands as Python's strings as a whole, beside its Arrow buffers.
    """
    sizes = np.zeros(batch.num_rows, np.int64)
    for i in texts:
        sizes += pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    at = 0
    while at < batch.num_rows:
        before = ends[at - 1] if at else 0
        upto = max(at + 1, int(np.searchsorted(ends, before + most, side="right")))
        yield batch.slice(at, upto - at)
        at = upto


def text_portions(texts: pa.Array, most: int = BYTES) -> Iterator[pa.Array]:
    """:func:`row_portions` of one column of texts."""
    for rows in row_portions(pa.record_batch([texts], ["text"]), 0, most=most):
        yield rows.column(0)
