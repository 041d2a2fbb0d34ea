"""Walking over groups of rows that come sorted, a few at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa


def group_starts(rows: pa.Table, keys: list[str]) -> np.ndarray:
    """Where each run of equal keys begins."""
    changed = np.zeros(max(len(rows) - 1, 0), bool)
    for key in keys:
        values = rows[key].combine_chunks().to_numpy()
        changed |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1]).astype(np.int64) if len(rows) else np.empty(0, np.int64)


def by_group(batches: Iterator[pa.RecordBatch], keys: list[str],
             flush: Callable[[pa.Table, np.ndarray], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``flush`` of all whole groups at hand, with their starts, while batches of rows sorted by the long
    columns ``keys`` come in. Holds one batch and the group that may go on in the next."""
    held = None
    for batch in batches:
        now = pa.Table.from_batches([batch])
        held = now if held is None else pa.concat_tables([held, now])
        starts = group_starts(held, keys)
        if len(starts) > 1:
            yield flush(held.slice(0, starts[-1]), starts[:-1])
            held = held.slice(starts[-1])
    if held is not None and len(held):
        yield flush(held, group_starts(held, keys))
