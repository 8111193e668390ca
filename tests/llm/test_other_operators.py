"""URL rules, nearest neighbours, registered queries and the pipeline."""

import os
import random

import numpy as np
import pytest

import __spark_entry__
import corpus_pipeline
from ludolake.llm import permutation_index, url_rules
from ludolake.llm.queries import ORACLE, QUERIES

from ..compare import difference, duck
from .conftest import ODD

SMALL = "/root/testdata/sf0.001"

RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("a.example.net", "/", "block"),
    ("b.a.example.net", "/x", "allow"), ("example.net", "/", "allow"), ("com", "/q", "block"), ("net", "/", "block"),
]


def verdict(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
    path = rest[cut:]
    path = path[: min((path.find(c) for c in "?#" if c in path), default=len(path))]
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    fits = [(len(h + p), len(h), h + p) for h, p, _ in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fits)[2] if fits else None


def test_url_rules(spark):
    rnd = random.Random(1)
    urls = [None, "", "nourl", "http://", "x://NET/", "http://example.net.", "http://é.Example.NET/en/É", "http://net/a\nb?c"]
    for _ in range(800):
        host = ".".join(rnd.choice(["a", "b", "example", "net", "com", "examplenet", "Net", ""]) for _ in range(rnd.randrange(1, 5)))
        urls.append(f"http://{host}" + rnd.choice(["", "/", "/en/", "/en", "/x/y", "/q?z=://net/", "?x", "#/en/"]))
    pages = spark.createDataFrame([(None if i % 50 == 0 else i // 2, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    got = url_rules.verdicts(pages, url_rules.rule_table(spark, RULES))
    rows = [((None if i % 50 == 0 else i // 2), *verdict(u)) for i, u in enumerate(urls)]
    assert sorted(((r.id, r.host, r.path, r.rule) for r in got.collect()), key=repr) == sorted(rows, key=repr)
    assert url_rules.verdicts(pages.limit(0), url_rules.rule_table(spark)).count() == 0
    none = url_rules.verdicts(pages, url_rules.rule_table(spark).where("host IS NULL"))
    assert {r.verdict for r in none.select("verdict").distinct().collect()} == {"allow"}


def test_neighbours(spark):
    rnd = np.random.default_rng(1)
    vectors = rnd.normal(size=(3000, 32)) * rnd.uniform(0.5, 2, (3000, 1))
    vectors[100:300] = vectors[99]  # one vector many times over
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vectors)]
    odd = [(5000, None), (5001, []), (5020, [0.0] * 32), (5040, [float("nan")] * 32), (5060, [None] * 32), (5080, [float("inf")] * 32), (None, rows[0][1]), (5100, [1.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    got = permutation_index.nearest(frame, lambda v: v % 20 == 0).toPandas()
    hits = 0
    for q in range(0, 3000, 20):
        own = got[got.query_id == q].sort_values("rank")
        assert list(own["rank"]) == list(range(1, 21))
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(set(np.lexsort((np.arange(3000), -scores))[:20]) & set(own.vec_id))
        assert np.allclose(own.score, scores[own.vec_id], rtol=1e-12, atol=1e-12)
        pairs = list(zip(-own.score, own.vec_id))
        assert pairs == sorted(pairs)
    assert hits >= 0.9 * 20 * 150
    assert set(got.query_id) == set(range(0, 3000, 20))
    few = permutation_index.nearest(frame.where("vec_id < 4"), lambda v: v % 2 == 0)
    assert few.groupBy("query_id").count().collect() and few.count() == 6
    assert permutation_index.nearest(frame.where("vec_id >= 5000"), lambda v: v % 5 == 0).count() == 0
    assert permutation_index.nearest(frame.limit(0), lambda v: v % 2 == 0).count() == 0


@pytest.mark.skipif(not os.path.isdir(SMALL), reason="driver tables not present")
@pytest.mark.parametrize("name", QUERIES)
def test_queries(spark, name):
    df = __spark_entry__.queries()[name](spark, SMALL)
    if name in ORACLE:
        assert difference(df, duck(SMALL), ORACLE[name]) is None
    else:
        assert df.count() > 0


def test_stages_on_odd_rows(spark, odd, clashing, none, tmp_path):
    for docs, rows in ((odd, len(ODD)), (clashing, len(ODD)), (none, 0)):
        for name, step in corpus_pipeline.STAGES[:-1]:
            out = step(spark, docs, "")
            assert out.columns == docs.columns
            assert out.count() <= 2 * rows
    assert corpus_pipeline.STAGES[-1][1](spark, odd, "").count() >= len(ODD)


def test_pipeline_keeps_each_stage(spark, tmp_path, make):
    good = "each of these plain words stands here only once for document number {} of source {}"
    rows = [(i, good.format(i, s) + "".join(f" t{i}x{k}" for k in range(40)), "en", s, 1) for s in "abc" for i in range("abc".index(s) * 100, "abc".index(s) * 100 + 20)]
    rows += [(500, rows[0][1], "en", "a", 1), (501, "too short", "en", "a", 1)]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()
    assert not {500, 501} & set(got.doc_id)
    assert len(set(got.doc_id)) > 40
