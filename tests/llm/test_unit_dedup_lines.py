"""Repeated lines and sentences are found whole, whatever stands around them."""

import random

import numpy as np

from ludolake.llm import unit_dedup


def test_cuts_do_not_depend_on_other_lines():
    rnd, normal = random.Random(7), unit_dedup.Normal()
    words = lambda k: " ".join(f"u{rnd.randrange(10**9)}" for _ in range(k))
    for sep in ("\n", "\n\n", ". "):
        for _ in range(60):
            line = words(51)
            alone = unit_dedup.units(line + sep.strip(" \n"), normal)[0]
            digests, n, start, end = unit_dedup.units(f"{words(40)}{sep}{line}{sep}{words(40)}", normal)
            k = int(np.flatnonzero(digests == alone[0])[0])
            assert digests[k : k + len(alone)].tolist() == alone.tolist() and n[k : k + len(alone)].sum() == 51


def test_repeated_line_is_removed_whole(spark):
    rnd = random.Random(8)
    words = lambda k: " ".join(f"u{rnd.randrange(10**9)}" for _ in range(k))
    lines = [words(31) for _ in range(40)]
    rows = [(i, f"{words(25)}\n{line}\n{words(25)}") for i, line in enumerate(lines * 2)]
    got = unit_dedup.repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {(i, text.split("\n")[1], i - 40) for i, text in rows if i >= 40}
    assert {(r.id, rows[r.id][1][r.start : r.end], r.first_id) for r in got} == want
