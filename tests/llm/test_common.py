"""Slices of Arrow batches."""

from itertools import accumulate

import pyarrow as pa

from zoneflow.llm.common import slices


def test_slices_are_bounded_by_rows_and_bytes():
    sizes = [1, 2, 50, 3, 0, 10, 10, 1, 1, 1, 1, 1]
    texts = ["x" * n if n else None for n in sizes]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(12)), "text": texts})
    got = list(slices(batch, 4, 20))
    assert [at for at, _ in got] == [0, *accumulate(n for _, n in got)][:-1]
    assert sum(n for _, n in got) == 12
    assert all(n == 1 or n <= 4 and sum(sizes[at:at + n]) <= 20 for at, n in got)
    assert (2, 1) in got and list(slices(batch.slice(0, 0), 4, 20)) == []
    assert list(slices(batch, 100, 10_000)) == [(0, 12)]
