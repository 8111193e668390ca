import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from ludolake.llm import merkle_manifest as mm
from tests.compare import difference, duck

from .conftest import ODD


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def encoded(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes, fanout):
    """(top, path of every node), by the definition."""
    paths = [[] for _ in nodes]
    under = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, below = [], []
        for start in range(0, len(nodes), fanout):
            run = nodes[start : start + fanout]
            for k in range(len(run)):
                for i in under[start + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(sha(*run))
            below.append([i for k in range(len(run)) for i in under[start + k]])
        nodes, under = up, below
    return nodes[0], paths


def brute(rows, fanout=8):
    """rows (doc_id, text, lang, source, n_chars) to the rows of the manifest, texts lower-cased where 3 divides the crc."""
    langs = {}
    for doc_id, text, lang, source, n_chars in rows:
        def leaf(t):
            return sha(*map(encoded, (doc_id, source, lang, n_chars, t)))

        low = text
        if doc_id is not None and text is not None and zlib.crc32(str(doc_id).encode()) % 3 == 0:
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        langs.setdefault(lang, []).append((doc_id, leaf(text), leaf(low)))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    subs = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        subs[lang] = tree([r[1] for r in langs[lang]], fanout)
    root, uppers = tree([subs[x][0] for x in order], fanout)
    out = []
    for lang, upper in zip(order, uppers):
        top, paths = subs[lang]
        for (doc_id, leaf, low), path in zip(langs[lang], paths):
            path = path + upper
            node = low
            for before, after in path:
                node = sha(before, node, after)
            out.append((doc_id, leaf, top, root, sha(*(b + a for b, a in path)), node, node == root))
    return sorted(out, key=repr)


def lowered():
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    return {"text": F.when(touched, F.translate("text", mm._UPPER, mm._UPPER.lower())).otherwise(F.col("text"))}


def got(docs, **shape):
    out = mm.manifest(docs, mm.COLUMNS, "lang", "doc_id", lowered(), **shape).drop("path")
    return sorted((tuple(r) for r in out.collect()), key=repr)


def many(n, langs):
    return [(i, f"Text {i % 40} É", langs[i * i % len(langs)], "s", i) for i in range(n)]


def test_odd_rows(odd):
    assert got(odd) == brute(ODD)


@pytest.mark.parametrize("n", [1, 8, 65])
def test_sizes_and_depths(make, n):
    """Trees of one node up to three superblocks deep, full, over-full and short last runs."""
    rows = many(n, ["en", "en", None, "de"])
    assert got(make(rows), fanout=2, levels=2) == brute(rows, fanout=2)


def test_many_groups(make):
    """More subroots than a superblock holds."""
    rows = many(200, [f"l{i}" for i in range(60)])
    assert got(make(rows), fanout=2, levels=2) == brute(rows, fanout=2)


def test_any_partitioning(make):
    rows = many(60, ["en", "de"])
    assert got(make(rows).repartition(7), fanout=4, levels=1) == got(make(rows).coalesce(1), fanout=4, levels=1)


def test_unchanged_rows_verify_and_paths_fold(make):
    rows = mm.manifest(make(many(50, ["en", "de"])), mm.COLUMNS, "lang", "doc_id").collect()
    assert all(r.verified for r in rows) and len({r.root for r in rows}) == 1
    for r in rows:
        node = r.leaf
        for step in r.path:
            node = sha(step.before, node, step.after)
        assert node == r.root
        assert r.proof_sha256 == sha(*(s.before + s.after for s in r.path))


def test_no_rows_and_clashing_columns(none, odd, clashing):
    assert got(none) == []
    taken = odd.select("*", *(F.lit(1).alias(n) for n in ("tree", "pos", "digest", "other", "group", "index", "block", "path", "_group")))
    assert got(clashing) == got(odd) == got(taken)


def test_query_equals_sql(spark):
    d = "/root/testdata/sf0.001"
    assert difference(mm.op11_merkle_manifest(spark, d), duck(d), mm.OP11_SQL) is None
