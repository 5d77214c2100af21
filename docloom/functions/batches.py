"""Arrow batches as short lists of Python objects: what a worker holds as objects doesn't grow with the batch."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of the rows that become objects together; a longer row is a slice of its own.
SLICE_BYTES = 1_000_000
#: What a row counts besides its text.
ROW_BYTES = 100


def _sizes(array: pa.Array) -> np.ndarray:
    """Bytes of each row of texts, or of lists of texts."""
    if not pa.types.is_list(array.type):
        return pc.fill_null(pc.binary_length(array), 0).to_numpy(zero_copy_only=False)
    counts = pc.fill_null(pc.list_value_length(array), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(counts)
    upto = np.concatenate([[0], np.cumsum(_sizes(array.flatten()) + ROW_BYTES)])
    return upto[ends] - upto[ends - counts]


def slices(batches: Iterable[tuple[pa.Array, ...]], limit: int = SLICE_BYTES) -> Iterator[tuple[list, ...]]:
    """The batches' columns (texts, or lists of texts) as lists, about `limit` bytes of rows at a time, in order."""
    for arrays in batches:
        upto = np.cumsum(sum(_sizes(a).astype(np.int64) for a in arrays) + ROW_BYTES)
        start, n = 0, len(upto)
        while start < n:
            before = int(upto[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(upto, before + limit, side="right")))
            yield tuple(a.slice(start, stop - start).to_pylist() for a in arrays)
            start = stop
