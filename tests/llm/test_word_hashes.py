"""Words hashed by array operations, against words cut by Python."""

import itertools
import random

import numpy as np

from ludolake.llm import ngram_join

TEXTS = [b"", b" ", b"\t\x0b a\x0c", b"a b c d e f", b"A b\nC", "é ü x".encode(), b"x" * 300_000 + b" y", b"a a a a a a", b"one"]


def test_words_are_those_of_split():
    found, counts = ngram_join.WordHashes().of(TEXTS)
    words = [w for t in TEXTS for w in t.split()]
    assert counts.tolist() == [len(t.split()) for t in TEXTS]
    assert len(set(words)) == len(set(found.tolist())) == len(set(zip(words, found.tolist())))
    alone = np.concatenate([ngram_join.WordHashes().of([t])[0] for t in TEXTS])
    assert np.array_equal(found, alone)  # whatever texts are hashed together


def test_permuted_words_differ():
    words = [bytes(w) for w in itertools.product(b"abcd", repeat=7)]
    found, _ = ngram_join.WordHashes().of([b" ".join(words)])
    assert len(np.unique(found)) == len(words)


def test_no_texts():
    found, counts = ngram_join.WordHashes().of([])
    assert len(found) == len(counts) == 0
    assert list(ngram_join.shingles([], ngram_join.WordHashes())) == []


def test_sets_have_the_distinct_windows():
    rng = random.Random(3)
    texts = TEXTS + [b" ".join(rng.choice([b"u", b"v", b"W"]) for _ in range(rng.randint(0, 40))) for _ in range(500)]
    for text, items in zip(texts, ngram_join.shingles(texts, ngram_join.WordHashes(), 5), strict=True):
        words = text.lower().split()
        size = min(5, len(words))
        want = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()
        assert len(items) == len(want) and np.all(items[1:] > items[:-1])
