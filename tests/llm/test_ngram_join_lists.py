"""What the join makes of near copies that are not similar enough, and of texts that share by chance."""

import random

import pytest

from ludolake.llm import components, ngram_join


@pytest.fixture
def staged(monkeypatch):
    """Rows of all frames that the join writes, by name."""
    rows, plain = {}, ngram_join.stage

    def stage(df, name):
        out = plain(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "stage", stage)
    return rows


def edited(words, share, rnd):
    """The words with so many of them new, in one run: the other n-grams stay."""
    n = int(len(words) * share)
    return [f"new{rnd.randrange(10**9)}" for _ in range(n)] + words[n:]


def test_lists_of_the_same_documents_are_one(spark, staged):
    rnd = random.Random(1)
    rows = []
    for b in range(10):
        base = [f"b{b}x{k}" for k in range(400)]
        rows += [(len(rows) + c, " ".join(edited(base, share, rnd))) for c, share in enumerate((0.0, 0.05, 0.15))]
    got = {r.id: r.component_id for r in ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    # The second links with the first (0.95 / 1.05), the third with neither (0.85 / 1.15): a list for each two or three of them.
    assert got == {i: i - i % 3 if i % 3 < 2 else i for i in got}
    assert staged["postings"][1] <= 10 * 8 < staged["postings"][0]


def test_documents_that_share_too_little_leave(spark, staged):
    rnd = random.Random(2)
    common = [f"c{k}" for k in range(12)]
    rows = [(i, " ".join([f"d{i}x{k}" for k in range(300)] + common)) for i in range(40)]
    rows += [(100, " ".join(f"z{k}" for k in range(50))), (101, " ".join(f"z{k}" for k in range(49)))]
    rnd.shuffle(rows)
    got = {r.id: r.component_id for r in ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**{i: i for i in range(40)}, 100: 100, 101: 100}
    assert staged["postings"][1] <= 4


def test_components_are_not_sought_again_without_links(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(ngram_join, "connected", lambda links: calls.append(1) or components.connected(links))
    rows = [(i, " ".join(f"w{k}" for k in range(100)) + " x" * (i % 2)) for i in range(4)]
    got = ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r.component_id for r in got.collect()} == {0} and len(calls) == 1


@pytest.mark.parametrize("percent", [1, 40, 80, 100])
def test_steps_never_fall(percent):
    need = lambda n: -(-percent * n // 100)
    steps = [ngram_join.step_of(n, percent) for n in range(1, 3000)]
    assert steps == sorted(steps)
    assert all(1 <= s <= need(n) for n, s in enumerate(steps, 1))


def test_step_in_sql(spark):
    rows = spark.range(1, 500).selectExpr("id", f"{ngram_join._step('id', 80)} AS step").collect()
    assert all(r.step == ngram_join.step_of(r.id, 80) for r in rows)
