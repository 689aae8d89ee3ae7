"""Groups of rows in Python, read from partitions that are sorted by the group's key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa


def sorted_groups(batches: Iterable[pa.RecordBatch], keys: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """The rows of each group; a group may go on through several batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        changed = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            changed |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(changed) + 1).tolist(), batch.num_rows]
        if rest and any(rest[-1].column(k)[0].as_py() != batch.column(k)[0].as_py() for k in keys):
            yield _joined(rest)
            rest = []
        for start, end in zip(starts, starts[1:]):
            rest.append(batch.slice(start, end - start))
            if end < batch.num_rows:
                yield _joined(rest)
                rest = []
    if rest:
        yield _joined(rest)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


def forest(adjacent: np.ndarray) -> np.ndarray:
    """The least node that each node reaches in a symmetric boolean matrix."""
    root = np.full(len(adjacent), -1)
    for start in range(len(adjacent)):
        if root[start] >= 0:
            continue
        new = np.zeros(len(adjacent), bool)
        new[start] = True
        while new.any():
            root[new] = start
            new = adjacent[new].any(0) & (root < 0)
    return root
