"""Disclosing terms in a corpus whose documents are copied many times."""

import random

import pytest

from ludolake.llm import pii


@pytest.mark.parametrize("broadcast", [1 << 17, -1])
def test_copies_do_not_hide_terms(spark, make, monkeypatch, broadcast):
    monkeypatch.setattr(pii, "BROADCAST_DOCS", broadcast)
    rnd = random.Random(5)
    letters = lambda: "".join(rnd.choice("bcdfgk") for _ in range(8))
    filler = lambda k: " ".join(letters() + " and" for _ in range(k))
    once = [f"{filler(9)} zorblatt keeps me@secret.org {filler(9)}" for _ in range(4)] + [filler(60) for _ in range(40)]
    rows = [(i, once[i], "en", "s", 1) for i in range(len(once))]
    copied = [(100 * k + i, once[i], "en", "s", 1) for k in range(1, 60) for i in range(4)]

    def found(rows):
        got = pii.personal_data(make(rows).repartition(5)).collect()
        return {r.doc_id % 100: r.spans for r in got}

    want = found(rows)
    assert all("term:" in want[i] for i in range(4)) and want[10] == ""
    assert found(rows + copied) == want
