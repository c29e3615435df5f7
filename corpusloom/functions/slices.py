"""Arrow arrays in parts of bounded size, so that a Python task's memory does not follow the size of its batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text, or values of lists, that a task turns into Python objects at a time; one longer row is taken alone.
SLICE_SIZE = 1 << 20


def cuts(array: pa.Array) -> Iterator[tuple[int, int]]:
    """Begin and end of consecutive parts of a string or list array."""
    nested = pa.types.is_list(array.type) or pa.types.is_large_list(array.type)
    sizes = pc.list_value_length(array) if nested else pc.binary_length(array)
    ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < len(ends):
        before = int(ends[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, before + SLICE_SIZE, side="right")))
        yield begin, end
        begin = end


def sliced(arrays: Iterable[pa.Array]) -> Iterator[pa.Array]:
    """The parts of all arrays; an empty array is passed on as it is."""
    for array in arrays:
        if not len(array):
            yield array
        for begin, end in cuts(array):
            yield array.slice(begin, end - begin)
