"""Rows that stand together by a key, taken from Arrow batches one key at a time."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa


def each_tile(batches: Iterable[pa.RecordBatch], key: str = "tile") -> Iterator[pa.Table]:
    """One table per run of equal keys; a run may span batches."""
    held: list[pa.RecordBatch] = []
    own = None
    for batch in batches:
        if not batch.num_rows:
            continue
        codes = batch.column(key).dictionary_encode()
        index = codes.indices.to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(index[1:] != index[:-1]) + 1), batch.num_rows]
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            name = codes.dictionary[int(index[low])].as_py()
            if held and name != own:
                yield pa.Table.from_batches(held)
                held = []
            own = name
            held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)
