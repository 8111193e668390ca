"""Batches reach the workers' Python objects in small cuts, with every row once and in order."""

import pyarrow as pa

from ludolake.llm import common, pii


def test_slices_hold_every_row_once():
    batches = [pa.RecordBatch.from_arrays([pa.array(range(n))], ["x"]) for n in (0, 1, 256, 257, 10_000)]
    cut = list(common.slices(batches))
    assert max(b.num_rows for b in cut) <= 256
    assert [x for b in cut for x in b.column(0).to_pylist()] == [x for b in batches for x in b.column(0).to_pylist()]


def test_personal_data_over_many_slices(spark, make):
    rows = [(i, f"write to p{i}@example.org now" if i % 2 else None, "en", "a", 1) for i in range(700)]
    got = {r.doc_id: r.text for r in pii.sanitised(make(rows).coalesce(1)).collect()}
    assert got == {i: "write to [EMAIL] now" if i % 2 else None for i in range(700)}
