"""Components against union-find, and slices of batches against the whole."""

import numpy as np
import pyarrow as pa

from outagelens.llm import components, text_arrays


def union_find(pairs):
    above = {}

    def top(x):
        while above.setdefault(x, x) != x:
            x = above[x]
        return x

    for a, b in pairs:
        low, high = sorted((top(a), top(b)))
        above[high] = low
    return {x: top(x) for x in above}


def test_components_in_one_task_and_in_several(spark, monkeypatch):
    rng = np.random.default_rng(3)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (160, 2)) if a != b]
    pairs += [(500, 500 + k) for k in range(1, 150)] + [(900 + k, 901 + k) for k in range(40)]
    links = spark.createDataFrame([*pairs, pairs[0], (7, None), (2000, 2000)], "a long, b long")
    want = union_find(pairs)
    for per_task in (components._LINKS_PER_TASK, 100):
        monkeypatch.setattr(components, "_LINKS_PER_TASK", per_task)
        assert {r.node: r.component for r in components.components(links).collect()} == want
    assert components.components(links.limit(0)).count() == 0


def test_slices_hold_all_rows_in_order():
    texts = [None if k % 7 == 0 else "é" * (k % 5) for k in range(2 * text_arrays.SLICE_ROWS + 3)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.string())], names=["body"])
    parts = list(text_arrays.slices([batch.slice(0, 0), batch]))
    assert [p.num_rows for p in parts] == [text_arrays.SLICE_ROWS, text_arrays.SLICE_ROWS, 3]
    seen = []
    for part in parts:
        for low, high, data, offsets in text_arrays.row_groups(part.column("body")):
            seen += [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in range(high - low)]
    assert seen == [t or "" for t in texts]
