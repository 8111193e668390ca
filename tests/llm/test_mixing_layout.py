"""The mix does not depend on how its rows are dealt over partitions, with many buckets too."""

import functools
import random

from ludolake.llm import mixing
from ludolake.llm.common import positions


def test_mix_of_any_layout(spark, make, monkeypatch):
    monkeypatch.setattr(mixing, "positions", functools.partial(positions, rows_each=10))
    rnd = random.Random(4)
    rows = [(i, " ".join(f"w{k}" for k in range(rnd.randrange(5, 400))), "en", rnd.choice(["a", "b", None]), 1) for i in range(300)]
    rows += [rows[0]] * 40 + [(None, "one two three four", "en", "a", 1)] * 40
    taken = lambda docs: sorted(map(str, mixing.mixed(docs)[1].select("id", "digest", "source", "taken").collect()))
    want = taken(make(rows).coalesce(1))
    assert taken(make(rows).repartition(7)) == want
    rnd.shuffle(rows)
    assert taken(make(rows).repartition(3)) == want
