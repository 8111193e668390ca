"""Large groups of near copies, of which many are not similar enough to any other."""

import random

import pytest

from ludolake.llm import ngram_join


def components(texts, size, percent):
    """The smallest index reachable by links, from all pairs."""
    sets = []
    for text in texts:
        words = text.split()
        sets.append({tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))})
    root = list(range(len(sets)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in enumerate(sets):
        for b in range(a):
            if 100 * len(x & sets[b]) >= percent * len(x | sets[b]):
                low, high = sorted((top(a), top(b)))
                root[high] = low
    return [top(i) for i in range(len(sets))]


def edited(words, times, rnd, choice=10**9):
    out = list(words)
    for at in rnd.sample(range(len(words)), times):
        out[at] = f"new{rnd.randrange(choice)}"
    return out


def found(spark, texts, **how):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return [r.component_id for r in ngram_join.similar_sets(docs, **how).orderBy("id").collect()]


def group(rnd, count):
    """Copies of one text: with up to five edits of their own, of few words, and copies of such copies."""
    base = [f"w{k}" for k in range(rnd.randrange(60, 160))]
    out = [base]
    for _ in range(count):
        source = base if rnd.random() < 0.6 else rnd.choice(out)
        out.append(edited(source, rnd.randrange(6), rnd, rnd.choice([3, 10**9]))[: rnd.choice([None, -1, -9])])
    return [" ".join(words) for words in out]


@pytest.mark.parametrize("size, percent", [(5, 80), (3, 60)])
def test_groups_of_near_copies_equal_all_pairs(spark, size, percent):
    rnd = random.Random(size)
    texts = [t for b in range(3) for t in (t.replace("w", f"b{b}w") for t in group(rnd, 70))]
    assert found(spark, texts, size=size, percent=percent) == components(texts, size, percent)


def test_copies_that_the_tasks_are_not_told_of(spark, monkeypatch):
    texts = group(random.Random(9), 30) * 3
    monkeypatch.setattr(ngram_join, "COPIES", 0)
    assert found(spark, texts) == components(texts, 5, 80)


def test_distant_copies_do_not_meet_their_whole_group(spark, monkeypatch):
    rnd, rows, plain = random.Random(4), [], ngram_join.stage

    def stage(df, name):
        out = plain(df, name)
        rows.append((name, out.select("node").distinct().count() if name == "postings" else out.count()))
        return out

    monkeypatch.setattr(ngram_join, "stage", stage)
    base = [f"w{k}" for k in range(150)]
    texts = [" ".join(edited(base, edits, rnd)) for edits in [0] + [1] * 60 + [6] * 60]
    expected = components(texts, 5, 80)
    assert expected[:61] == [0] * 61 and expected[61:] == list(range(61, 121))
    assert found(spark, texts) == expected
    # 60 copies with six edits have some ten elements in the lists of the others, and no partner.
    every, after = [n for name, n in rows if name == "postings"]
    assert after <= 61 < every
    assert [n for name, n in rows if name == "pairs"][-1] == 0


def test_a_link_between_distant_copies_is_found(spark):
    """Two texts that both lie too far from the text they were copied from are near each other."""
    rnd = random.Random(5)
    base = [f"w{k}" for k in range(150)]
    far = edited(base, 6, rnd)
    texts = [" ".join(t) for t in [base, *(edited(base, 1, rnd) for _ in range(40)), far, edited(far, 1, rnd)]]
    got = found(spark, texts)
    assert got == components(texts, 5, 80) and got[-1] == got[-2] == 41
