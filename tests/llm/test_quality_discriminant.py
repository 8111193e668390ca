import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ludolake.llm import quality_discriminant as qd

D = len(qd.NAMES)


def plain_score(rows, x, pooled_weight, diagonal_weight):
    """The posterior of class 1 from determinants and linear solves, by the definition."""
    parts = []
    for k in (0, 1):
        mine = np.array([v for v, label in rows if label == k], float) / qd.SCALE
        centred = mine - mine.mean(0)
        parts.append((len(mine), mine.mean(0), centred.T @ centred))
    pooled = (parts[0][2] + parts[1][2]) / len(rows)
    logs = []
    for n, mean, scatter in parts:
        c = (1 - pooled_weight) * scatter / n + pooled_weight * pooled
        c = (1 - diagonal_weight) * c + diagonal_weight * np.diag(np.diag(c)) + qd.LEAST_VARIANCE * np.eye(D)
        d = np.array(x) / qd.SCALE - mean
        logs.append(math.log(n) - 0.5 * np.linalg.slogdet(c)[1] - 0.5 * d @ np.linalg.solve(c, d))
    return 1 / (1 + math.exp(-max(min(logs[1] - logs[0], 36), -36)))


def prose(rng):
    return " ".join(rng.choice(["the", "house", "stands", "near", "Rivers", "of", "gold,", "and", "so."]) for _ in range(rng.randint(3, 60)))


def junk(rng):
    return " ".join(rng.choice(["BUY!!", "###", "now$$$", "the", "1234"]) for _ in range(rng.randint(3, 60)))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    return [(i, junk(rng) if i % 4 == 0 else prose(rng), "en", "s", 1) for i in range(240)]


def labels_of(spark, rows):
    return spark.createDataFrame([(i, int(i % 4 > 0)) for i, *_ in rows], "doc_id long, quality int")


def test_statistics_by_hand():
    named = dict(zip(qd.NAMES, qd.statistics("Ab CD!! 12\n\nx é\nx é\n".encode())))
    text = "Ab CD!! 12\n\nx é\nx é\n".encode()

    def share(part, whole):
        return round(math.asin(math.sqrt(part / whole)) * qd.SCALE)

    assert named["log_bytes"] == round(math.log1p(len(text)) * qd.SCALE)
    assert named["log_words"] == round(math.log1p(7) * qd.SCALE)
    assert named["upper"] == share(3, 10)  # Ab CD x x, and é of two bytes twice
    assert named["digits"] == share(2, len(text))
    assert named["calls"] == share(2, len(text))
    assert named["repeated_lines"] == share(1, 3)
    assert named["top_word"] == share(2, 7)
    assert named["titled"] == share(1, 7)
    assert named["shouted"] == share(1, len(text))
    assert qd.statistics(None) == qd.statistics(b"") == qd.statistics(b" \n\t") == [0] * D
    assert dict(zip(qd.NAMES, qd.statistics(b"a a b a")))["echoes"] == share(1, 4)


@pytest.mark.parametrize("weights", [(0.0, 0.0), (0.1, 0.5), (1.0, 0.1)])
def test_model_equals_plain_discriminant(make, spark, rows, weights):
    known = qd.described(make(rows))
    x = {r.id: list(r.x) for r in known.collect()}
    data = [(x[i], int(i % 4 > 0)) for i, *_ in rows]
    taught = known.join(labels_of(spark, rows), known["id"] == F.col("doc_id")).select("x", F.col("quality").alias("label"), (F.col("id") % 4).cast("int").alias("part"))
    sums = qd._moments(taught)
    model = qd.regularised({k: sum(s[k] for s in sums) for k in (0, 1)}, *weights)
    for r in qd.scored(known, model).collect():
        assert r.score == pytest.approx(plain_score(data, x[r.id], *weights), rel=1e-6, abs=1e-9)
        assert r.predicted == int(r.score >= 0.5)


def scores(docs, labels):
    known = qd.described(docs)
    return sorted(tuple(r)[:3] for r in qd.scored(known, qd.fit(known, labels)).collect())


def test_separates_and_does_not_depend_on_layout(make, spark, rows):
    labels = labels_of(spark, rows).where("doc_id < 160")
    got = scores(make(rows), labels)
    assert got == scores(make(rows).repartition(7), labels.repartition(3))
    unseen = [(p, int(i % 4 > 0)) for i, _, p in got if i >= 160]
    assert sum(p == q for p, q in unseen) >= 0.95 * len(unseen)


def test_odd_rows_and_columns(odd, none, clashing, make, spark, rows):
    labels = labels_of(spark, rows)
    known = qd.described(make(rows))
    model = qd.fit(known, labels)

    def by(docs):
        return sorted((tuple(r) for r in qd.scored(qd.described(docs), model).collect()), key=repr)

    got = by(odd)
    assert len(got) == odd.count() and all(0 <= r[1] <= 1 for r in got)
    assert by(odd.select("*", *(F.lit(1).alias(c) for c in ("x", "id", "label", "part", "_id")))) == got
    assert by(clashing) == got and by(none) == []
    assert len({r[1] for r in got if r[0] in (2, 3, 4)}) == 1  # null, empty, blank


def test_labels_missing_or_contradicting(make, spark, rows):
    docs = make(rows[:8])

    def one(values):
        return scores(docs, spark.createDataFrame(values, "doc_id long, quality int"))

    assert {r[1] for r in one([])} == {0.5}
    assert {r[2] for r in one([(1, 1), (2, 1), (None, 0), (3, None)])} == {1}
    assert {r[2] for r in one([(1, 0), (1, 1)])} == {0}  # of two labels the lower one counts
    assert len(one([(0, 0), (1, 1)])) == 8  # one row a class


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    got = qd.op12_quality_discriminant(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").where("held_out")
    row = got.agg(F.count("*"), F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()
    assert row[0] > 50 and row[1] >= 0.95
