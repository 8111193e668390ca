"""Toxicity with more features than are sent to the tasks."""

import random

import pytest

from ludolake.llm import toxicity


def test_toxicity_keeps_all_features(spark, monkeypatch):
    # 40 frequent words on both sides, and a word that only toxic texts hold: less frequent, with a small z.
    rnd = random.Random(9)
    rows, labels = [], []
    for i in range(300):
        words = [f"w{chr(97 + rnd.randrange(20))}{chr(97 + rnd.randrange(2))}" for _ in range(60)]
        if i % 4 == 0:
            words[20:22] = ["zxq", "zxq"]
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    whole = toxicity.fit(docs, known)
    want = {tuple(r) for r in toxicity.scored(docs, whole).collect()}
    assert whole["others"] is None and sum(r[3] for r in want) >= 70
    word = toxicity._features("zxq")[0]
    for limit in (20, 0):
        monkeypatch.setattr(toxicity, "VOCABULARY", limit)
        model = toxicity.fit(docs, known)
        assert len(model["odds"]) <= limit and word not in model["odds"]
        assert len(model["odds"]) + model["others"].count() == len(whole["odds"])
        got = {r[0]: r for r in toxicity.scored(docs, model).collect()}
        assert {(i, r[2:]) for i, r in got.items()} == {(r[0], r[2:]) for r in want}
        assert all(got[r[0]].score == pytest.approx(r[1], abs=1e-9) for r in want)


def test_texts_without_spaces_are_scanned_whole(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(200):
        text = "".join(rnd.choice("abcdefgh") for _ in range(400))
        if i % 4 == 0:
            text = text[:300] + "zqxzqxzqxzqx" + text[300:]
        rows.append((i, text))
        labels.append((i, int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.id: r for r in toxicity.scored(docs, model).collect()}
    assert all(got[i].predicted == y for i, y in labels)
    # A passage inside one word is that word.
    assert {got[i].passages for i, y in labels if y} == {"0:1"}
    assert toxicity._units("中文字符".encode()) == ["中文字".encode(), "文字符".encode()]
    assert toxicity._units(b"(Word)") == [b"word"]
