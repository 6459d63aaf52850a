"""Groups of rows with the same keys, out of the sorted Arrow batches of a partition."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


def groups_of(batches, keys: list[str]):
    """One table per combination of the keys (integers); one group is held at a time."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(c).to_numpy() for c in keys], axis=1)
        cuts = np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1
        for start, end in zip([0, *cuts], [*cuts, len(values)], strict=True):
            if held and (values[start] != current).any():
                yield pa.Table.from_batches(held)
                held = []
            current = values[start]
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)
