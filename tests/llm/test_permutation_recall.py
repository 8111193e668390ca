import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ludolake.llm import permutation_index as pi

TABLE = "/root/testdata/sf0.1/embeddings.parquet"


def recall(spark, tmp_path, ids, vectors, step=20, k=20):
    pq.write_table(pa.table({"vec_id": pa.array(ids, pa.int64()), "embedding": pa.array(list(vectors), pa.list_(pa.float64()))}), f"{tmp_path}/v.parquet")
    got = pi.nearest(spark.read.parquet(f"{tmp_path}/v.parquet"), lambda v: v % step == 0, k).toPandas()
    hits = total = 0
    for q in np.flatnonzero(ids % step == 0):
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        best = set(ids[np.lexsort((ids, -scores))[:k]].tolist())
        own = got[got.query_id == ids[q]]
        assert len(own) == k
        hits += len(best & set(own.vec_id))
        total += k
    return hits / total


@pytest.mark.skipif(not os.path.isfile(TABLE), reason="driver tables not present")
def test_recall_of_the_larger_table(spark, tmp_path):
    rows = pq.read_table(TABLE)
    ids = rows["vec_id"].to_numpy()
    assert recall(spark, tmp_path, ids, np.array(rows["embedding"].to_pylist(), float)) >= 0.9


@pytest.mark.parametrize("norms", ["unit", "log-normal", "one far outlier"])
def test_recall_of_other_shapes(spark, tmp_path, norms):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(6000, 128))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    if norms == "log-normal":
        vectors *= rng.lognormal(size=(6000, 1))
    if norms == "one far outlier":
        vectors[7] *= 1e6
    assert recall(spark, tmp_path, np.arange(6000), vectors, step=40) >= 0.9


def test_an_id_with_many_vectors_hides_no_others(spark, tmp_path):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=8)) for i in range(1, 41)] + [(41, 5 + rng.normal(size=8) / 9) for _ in range(25)] + [(0, np.ones(8))]
    pq.write_table(pa.table({"vec_id": [i for i, _ in rows], "embedding": [v.tolist() for _, v in rows]}), f"{tmp_path}/v.parquet")
    got = pi.nearest(spark.read.parquet(f"{tmp_path}/v.parquet"), lambda v: v == 0).collect()
    best = {}
    for i, v in rows:
        if i:
            best[i] = max(best.get(i, -np.inf), float(v.sum()))
    want = sorted(best, key=lambda i: (-best[i], i))[:20]
    own = [r.vec_id for r in sorted(got, key=lambda r: r["rank"])]
    assert len(own) == 20 and own[0] == 41 and len(set(own) & set(want)) >= 18


def test_ties_at_a_score_of_zero_go_to_smaller_ids(spark, tmp_path):
    rows = [(0, [1.0, 1.0, 0.0])] + [(i, [0.1 * i, -0.1 * i, 1.0]) for i in range(1, 60)]
    pq.write_table(pa.table({"vec_id": [i for i, _ in rows], "embedding": [v for _, v in rows]}), f"{tmp_path}/v.parquet")
    frame = spark.read.parquet(f"{tmp_path}/v.parquet")
    got = pi.nearest(frame, lambda v: v == 0, k=60).collect()
    assert sorted(r.vec_id for r in got) == list(range(1, 60))
    assert [r.vec_id for r in sorted(got, key=lambda r: r["rank"])] == list(range(1, 60))
