import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolake.llm import spelling_variants as sv
from tests.compare import difference, duck

from .conftest import ODD


def plain_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len, reverse=True)
    return any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def brute(rows, least=3):
    counts = {}
    for doc_id, text, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] = counts.get(run, 0) + 1
    words = {w: n for w, n in counts.items() if n >= least and len(w) >= 5}
    near, form = {}, {}
    for w, n in words.items():
        near[w] = [o for o in words if plain_near(w, o)]
        best = min(near[w], key=lambda o: (-words[o], o), default=None)
        form[w] = best if best and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def got(docs, **options):
    return sorted(tuple(r) for r in sv.variants(docs, **options).collect())


def corpus(n_docs=40, seed=5):
    """Texts over a small alphabet, whose words have many near ones, chains of forms and ties."""
    rng = random.Random(seed)
    letters = "aeéÿnB"
    vocabulary = ["".join(rng.choice(letters) for _ in range(rng.randint(4, 7))) for _ in range(60)]
    vocabulary += ["e" * k for k in (14, 15, 16, 17, 30, 31)] + ["straßennamen" * 3, "straßennamem" * 3, "straßennamen" * 2 + "straennamen"]
    rows = []
    for i in range(n_docs):
        words = [vocabulary[int(len(vocabulary) * rng.random() ** 2)] for _ in range(80)]
        rows.append((i, " ".join(rng.choice([w, w.upper(), w + "ł中1"]) for w in words), "en", "s", 1))
    return rows


@pytest.mark.parametrize("shard", [20_000, 9, 1])
def test_equals_brute_force(make, shard):
    """In one part, in parts, and with so many words of the same counts that they are dealt into pieces."""
    rows = corpus()
    want = brute(rows)
    assert got(make(rows), shard=shard) == want
    assert any(r[1] for r in want) and any(r[1] and r[2] != r[1] for r in want)


def test_odd_rows_any_least(odd):
    assert got(odd) == brute(ODD)
    assert got(odd, least=1, shard=50) == brute(ODD, 1)


def test_no_rows_and_clashing_columns(none, odd, clashing):
    assert got(none) == []
    more = odd.select("*", *(F.lit(1).alias(c) for c in ("word", "form", "root", "counts", "part", "_word")))
    assert got(clashing) == got(more) == got(odd)


def test_damage_and_borders():
    """Letters end at ÿ; a run of five that loses one is no word."""
    assert sv.near(b"house", b"horse") and sv.near(b"house", b"houses") and sv.near(b"house", b"ouse")
    assert not sv.near(b"house", b"houses!!") and not sv.near(b"house", b"hosue")


def test_verifier_equals_near():
    rng = random.Random(1)
    words = list({bytes(rng.choice(b"ab\xe9") for _ in range(rng.choice([5, 6, 23, 24, 25, 40]))) for _ in range(150)})
    words += [words[0][:3] + b"zz" + words[0][3:], *(w[:-1] + b"q" for w in words[:40]), *(w[:2] + w[3:] for w in words[:40] if len(w) > 5)]
    words = list(dict.fromkeys(words))
    a, b = (x.ravel() for x in np.meshgrid(range(len(words)), range(len(words))))
    a, b = a[a < b], b[a < b]
    x, y = sv._Verifier(words)(a, b)
    text = [w.decode("latin-1") for w in words]
    assert set(zip(x.tolist(), y.tolist())) == {(i, j) for i, j in zip(a.tolist(), b.tolist()) if plain_near(text[i], text[j])}


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    assert difference(sv.op13_spelling_variants(spark, d), duck(d), sv.OP13_SQL) is None
