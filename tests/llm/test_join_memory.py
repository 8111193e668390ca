"""What the tasks of quality rules and near duplicates hold at once: few texts, and no order of a million rows."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from ludolake.llm import host_rules, ngram_join
from tests.conftest import plan_of
from tests.llm.conftest import ODD


def _texts(rows: int) -> list[str]:
    rng = random.Random(5)
    words = [f"{rng.getrandbits(64):x}" for _ in range(5_000)]
    return [" ".join(rng.choices(words, k=120)) for _ in range(rows)]


def _held(rows) -> tuple[int, int]:
    """How many rows come, and the most bytes of Python objects and arrays meanwhile."""
    tracemalloc.start()
    try:
        return sum(getattr(r, "num_rows", 1) for r in rows), tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


class Caught(Exception):
    pass


@pytest.mark.parametrize("step", ["sets", "measures"])
def test_tasks_hold_few_texts(spark, make, monkeypatch, step):
    def caught(self, run, schema):
        raise Caught(run)

    docs = make([])
    monkeypatch.setattr(type(docs), "mapInArrow", caught)
    with pytest.raises(Caught) as found:
        if step == "sets":
            ngram_join._sets(docs, "doc_id", "text", 5)
        else:
            host_rules.with_measures(docs, keep=["doc_id"])
    texts = pa.array(_texts(6_000))
    numbers = pa.array(range(6_000))
    columns = {"id": numbers, "t": texts, "digest": numbers} if step == "sets" else {"_text": texts, "doc_id": numbers}
    batch = pa.RecordBatch.from_pydict(columns)
    run = found.value.args[0]
    one = _held(run([batch.slice(0, 256)]))[1]
    rows, most = _held(run([batch]))
    assert rows == 6_000 and most < one + (4 << 20)


def test_unpacked_sets_hold_few_texts():
    pack = zstandard.ZstdCompressor(level=1)
    held = [pack.compress(t.encode()) for t in _texts(6_000)]
    keys = [str(i).encode() for i in range(6_000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6_000)), pa.array([116] * 6_000), pa.array(keys), pa.array(held)], ["row", "n", "key", "t"])
    one = _held(ngram_join._unseen([batch.slice(0, 256)], 5))[1]
    rows, most = _held(ngram_join._unseen([batch], 5))
    assert rows == 6_000 and most < one + (4 << 20)


def _counts(docs) -> Counter:
    words = ngram_join.WordHashes()
    sets = ngram_join.shingles([r.text.encode() for r in docs.collect()], words, 5)
    return Counter(b for items in sets for b in ngram_join._bucket(items).tolist())


def test_most_frequent_without_an_order_of_rows(spark, make, monkeypatch):
    rng = random.Random(3)
    lines = [" ".join(f"w{rng.getrandbits(30)}" for _ in range(6)) for _ in range(400)]
    rows = [(i, " ".join(lines[j] for j in sorted(rng.sample(range(400), 12), key=lambda j: j * (j % 7))), "en", "a", 1) for i in range(300)]
    docs = make(rows)
    sets = ngram_join._sets(docs, "doc_id", "text", 5)
    total = sets.agg({"n": "sum"}).first()[0]
    copies = spark.sparkContext.broadcast(None)
    plans, frame = [], type(docs)
    to_arrow = frame.toArrow
    monkeypatch.setattr(frame, "toArrow", lambda self: plans.append(plan_of(self)) or to_arrow(self))
    expected = {v: n for v, n in _counts(docs).items() if n > 1}
    everything = dict(zip(*(x.tolist() for x in ngram_join._frequent(sets, total, 5, copies))))
    assert everything == expected
    monkeypatch.setattr(ngram_join, "ORDERED", 500)
    values, numbers = ngram_join._frequent(sets, total, 5, copies)
    assert not any("TakeOrdered" in p or "Sort" in p for p in plans)
    assert (np.diff(values.astype(np.int64)) > 0).all()
    assert all(expected[v] == n for v, n in zip(values.tolist(), numbers.tolist()))
    # All above the least number; of that one about as many as still fit.
    assert 400 <= len(values) <= 600
    least = numbers.min()
    assert {v for v, n in expected.items() if n > least} <= set(values.tolist())


def test_measures_of_many_texts_are_those_of_each():
    rng = random.Random(7)
    texts = [r[1] for r in ODD] + ["a b c d e a b c d e", "\x1cz \u0085 \x0by\x0cx"]
    texts += [" ".join(rng.choices("abc", k=rng.randrange(40))) + "\n" * (i % 3) for i in range(2_000)]
    texts = [None if t is None else t.encode() for t in texts]
    ids = host_rules.WordIds()
    assert list(host_rules.measures(texts, ngram_join.WordHashes())) == [host_rules.measured(t, ids) for t in texts]


def test_verdicts_of_hosts_do_not_move_texts(spark, make, odd, monkeypatch):
    assert "Exchange hashpartitioning" not in plan_of(host_rules.passing(odd))
    few = host_rules.judged(odd, ["doc_id", "text"]).collect()
    monkeypatch.setattr(host_rules, "BROADCAST_HOSTS", 0)
    many = host_rules.judged(odd, ["doc_id", "text"]).collect()
    assert sorted(few, key=repr) == sorted(many, key=repr) and len(few) == len(ODD)
