"""Groups of adjacent rows in sorted Arrow batches, for mapInArrow after a sort within partitions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa


def sorted_groups(batches, n_keys: int) -> Iterator[pa.RecordBatch]:
    """Yield the rows of each group; the first n_keys columns (integers) are its key.

    Rows arrive sorted by the key. Only the group that a batch leaves open is held.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [np.asarray(batch.column(i).to_numpy(zero_copy_only=False)) for i in range(n_keys)]
        change = np.zeros(batch.num_rows, dtype=bool)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        cuts = np.flatnonzero(change).tolist()
        first = tuple(int(key[0]) for key in keys)
        if held and first != last:
            yield _joined(held)
            held = []
        start = 0
        for cut in cuts:
            held.append(batch.slice(start, cut - start))
            yield _joined(held)
            held, start = [], cut
        held.append(batch.slice(start))
        last = tuple(int(key[-1]) for key in keys)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    return pa.Table.from_batches(parts).combine_chunks().to_batches()[0]


def components(linked: np.ndarray) -> np.ndarray:
    """For a symmetric boolean matrix, each row's smallest connected row."""
    labels = np.arange(len(linked))
    while True:
        best = np.where(linked, labels[None, :], len(linked)).min(axis=1, initial=len(linked))
        best = np.minimum(best, labels)
        best = best[best]
        if (best == labels).all():
            return labels
        labels = best
