"""A manifest that proves every row of a dataset: Merkle trees per group under one root.

A row's leaf hashes the stated columns. The leaves of a group, in the order of their
key, are hashed in runs of eight, level by level, until one node is left: the group's
subroot. The subroots, in the order of their groups, make the root the same way.

A superblock is 8^4 consecutive nodes. It is reduced by one task to its top node; the
tops are nodes of the next, much smaller tree, which is solved in the same way, so no
task holds more than a superblock of any tree. What a superblock lacks for its proofs
are the siblings above its top. These outer nodes and the leaves are cogrouped by
superblock, and one function finishes the reduction inside, joins both parts of each
proof and folds each leaf along it to a root.

Nulls hash as ``-``. A null group is a group of its own, the first one, and a null key
the first of its group. Rows with the same key are ordered by leaf; equal rows have
equal leaves, so it does not matter which comes first. No rows give no rows. Columns
beyond the stated ones are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.order import global_index
from ..session import stage
from .common import table

FANOUT = 8
#: Levels that one task reduces; a superblock has FANOUT ** LEVELS nodes.
LEVELS = 4
_NODES = "tree long, size long, pos long, digest string"


def encoded(value: Column) -> Column:
    """``-`` for NULL, else the number of UTF-8 bytes, ``:`` and the value as text."""
    text = value.cast("string")
    return F.when(value.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*map(encoded, values)), 256)


def _hash(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _climb(digests: list[str], levels: int | None, fanout: int) -> list[list[str]]:
    """All levels from ``digests`` upwards: ``levels`` of them, or until one node is left."""
    out = [digests]
    while len(out) <= levels if levels is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([_hash("".join(last[i : i + fanout])) for i in range(0, len(last), fanout)])
    return out


def _siblings(levels: list[list[str]], place: int, fanout: int) -> list[tuple[str, str]]:
    """What stands left and right of a node in its run, for each level below the top one."""
    path = []
    for nodes in levels[:-1]:
        start = place // fanout * fanout
        path.append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + fanout])))
        place //= fanout
    return path


class _Shape:
    """Fan-out and depth of superblocks, and what both say about a block of a tree."""

    def __init__(self, fanout: int, levels: int):
        self.fanout, self.levels, self.span = fanout, levels, fanout**levels

    def climb(self, block: pd.DataFrame) -> list[list[str]]:
        """The levels of one block, whose nodes may come in any order."""
        whole = int(block["size"].iloc[0]) <= self.span  # the only block of its tree
        return _climb(block["digest"].tolist(), None if whole else self.levels, self.fanout)


def _tops(nodes: DataFrame, shape: _Shape) -> DataFrame:
    """One node per superblock, as nodes of the next tree."""

    def top(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        first = block.iloc[0]
        size = -(-int(first["size"]) // shape.span)
        row = (first["tree"], size, int(first["pos"]) // shape.span, shape.climb(block)[-1][0])
        return pd.DataFrame([row], columns=["tree", "size", "pos", "digest"])

    keyed = nodes.select("tree", "size", "pos", "digest", F.expr(f"pos div {shape.span}").alias("block"))
    return keyed.groupBy("tree", "block").applyInPandas(top, _NODES)


def _paths(nodes: DataFrame, shape: _Shape) -> DataFrame:
    """(tree, pos, top, path): the siblings of every node on its way to the top of its tree."""
    tops = stage(_tops(nodes, shape), "tops")
    if (tops.agg(F.max("size")).first()[0] or 1) > 1:
        outer = _paths(tops, shape)
    else:
        outer = tops.select("tree", "pos", F.col("digest").alias("top"), F.lit(None).cast(_PATH).alias("path"))

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        levels = shape.climb(block)
        rest = _pairs(above["path"].iloc[0])
        paths = [_siblings(levels, i, shape.fanout) + rest for i in range(len(block))]
        rows = {"tree": block["tree"], "pos": block["pos"], "top": above["top"].iloc[0]}
        return pd.DataFrame({**rows, "path": [[{"before": b, "after": a} for b, a in p] for p in paths]})

    return stage(_met(nodes, outer, shape, finish, f"tree long, pos long, top string, path {_PATH}"), "paths")


_PATH = "array<struct<before: string, after: string>>"


def _pairs(path) -> list[tuple[str, str]]:
    return [(p["before"], p["after"]) for p in path] if path is not None else []


def _met(nodes: DataFrame, outer: DataFrame, shape: _Shape, finish, schema: str) -> DataFrame:
    """``finish`` on the nodes and the outer row of every superblock."""
    inner = nodes.withColumn("block", F.expr(f"pos div {shape.span}")).groupBy("tree", "block")
    above = outer.withColumnRenamed("pos", "block").groupBy("tree", "block")
    return inner.cogroup(above).applyInPandas(finish, schema)


def manifest(
    rows: DataFrame,
    columns: Sequence[str],
    group: str,
    key: str,
    changed: Mapping[str, Column] | None = None,
    fanout: int = FANOUT,
    levels: int = LEVELS,
    with_paths: bool = True,
) -> DataFrame:
    """(key, leaf, subroot, root, path, proof_sha256, folded_root, verified) of every row.

    ``path`` holds the siblings before and after the node for each level, from the
    leaf to the root (``with_paths``; some kilobytes a row); ``proof_sha256`` hashes them in that order. ``folded_root`` is
    what the path makes of the row's leaf, or of the leaf with the columns that
    ``changed`` replaces; ``verified`` says whether it is the root.
    """
    shape = _Shape(fanout, levels)
    values = [F.col(f"`{c}`") for c in columns]
    other = leaf([(changed or {}).get(c, v) for c, v in zip(columns, values)])
    # Texts are read once; from here on rows are narrow.
    leaves = stage(
        rows.select(
            F.col(f"`{group}`").alias("group"), F.col(f"`{key}`").alias("key"), leaf(values).alias("digest"),
            (other if changed else F.lit(None).cast("string")).alias("other"),
        ),
        "leaves",
    )
    order = [F.col("group").asc_nulls_first(), F.col("key").asc_nulls_first(), F.col("digest").asc()]
    numbered = global_index(leaves, order, "index")
    # A tree is named by the index of its first leaf, so trees are ordered as their groups.
    trees = stage(numbered.groupBy("group").agg(F.min("index").alias("tree"), F.count("*").alias("size")), "trees")
    trees = trees.withColumnRenamed("group", "_group")
    nodes = numbered.join(trees, F.col("group").eqNullSafe(F.col("_group")))
    nodes = stage(nodes.select("tree", "size", (F.col("index") - F.col("tree")).alias("pos"), "digest", "other", "key"), "nodes")

    # From superblocks to subroots, and from subroots to the root.
    tops = stage(_tops(nodes, shape), "tops")
    inner = _paths(tops, shape)
    subroots = inner.where("pos = 0").select("tree", F.col("top").alias("digest"))
    ranked = global_index(subroots, [F.col("tree").asc()], "pos")
    count = trees.count()
    roots = _paths(ranked.select(F.lit(0).cast("long").alias("tree"), F.lit(count).cast("long").alias("size"), "pos", "digest"), shape)
    roots = ranked.select("tree", "pos").join(roots.select("pos", F.col("top").alias("root"), F.col("path").alias("upper")), "pos").drop("pos")
    outer = inner.join(roots, "tree").select("tree", "pos", "top", "root", F.concat("path", "upper").alias("path"))

    def finish(block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("pos")
        inside = shape.climb(block)
        outside = _pairs(above["path"].iloc[0])
        root = above["root"].iloc[0]
        paths, proofs, folded = [], [], []
        for place, (own, other) in enumerate(zip(block["digest"], block["other"])):
            path = _siblings(inside, place, shape.fanout) + outside
            node = own if other is None else other
            for before, after in path:
                node = _hash(before + node + after)
            if with_paths:
                paths.append([{"before": b, "after": a} for b, a in path])
            proofs.append(_hash("".join([b + a for b, a in path])))
            folded.append(node)
        out = pd.DataFrame({"key": block["key"], "leaf": block["digest"], "subroot": above["top"].iloc[0], "root": root})
        out = out.assign(path=paths) if with_paths else out
        return out.assign(proof_sha256=proofs, folded_root=folded, verified=[f == root for f in folded])

    kind = leaves.schema["key"].dataType.simpleString()
    path = f", path {_PATH}" if with_paths else ""
    schema = f"key {kind}, leaf string, subroot string, root string{path}, proof_sha256 string, folded_root string, verified boolean"
    out = _met(nodes, outer, shape, finish, schema)
    return out.withColumnRenamed("key", key)


COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def op11_merkle_manifest(spark, sf_dir) -> DataFrame:
    """The manifest of ``documents`` by lang, held against texts some of which are lower-cased."""
    docs = table(spark, sf_dir, "documents", *COLUMNS)
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    lowered = F.when(touched, F.translate("text", _UPPER, _UPPER.lower())).otherwise(F.col("text"))
    return manifest(docs, COLUMNS, "lang", "doc_id", {"text": lowered}, with_paths=False)


_CRC = """xor(4294967295, list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda a, b: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295::BIGINT))"""


def _sql_leaf(text: str) -> str:
    values = [c if c != "text" else text for c in COLUMNS]
    return "sha256(" + " || ".join(f"CASE WHEN {v} IS NULL THEN '-' ELSE strlen({v}::VARCHAR) || ':' || {v}::VARCHAR END" for v in values) + ")"


_RUNS = "list_transform(range(0, len(h), 8), lambda i: sha256(array_to_string(h[i + 1 : i + 8], '')))"

OP11_SQL = f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, lang, {_sql_leaf("text")} AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN {_sql_leaf(f"translate(text, '{_UPPER}', '{_UPPER.lower()}')")} ELSE {_sql_leaf("text")} END AS other
  FROM documents
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p FROM leaf
), tree AS (
  SELECT lang, 0 AS lvl, list(leaf ORDER BY p) AS h FROM placed GROUP BY lang
  UNION ALL SELECT lang, lvl + 1, {_RUNS} FROM tree WHERE len(h) > 1
), sub AS (
  SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS q FROM tree WHERE len(h) = 1
), above AS (
  SELECT 0 AS lvl, list(subroot ORDER BY q) AS h FROM sub
  UNION ALL SELECT lvl + 1, {_RUNS} FROM above WHERE len(h) > 1
), steps AS (
  SELECT placed.lang, p, lvl, p // (8 ** lvl)::BIGINT AS j, h
  FROM placed JOIN tree ON placed.lang IS NOT DISTINCT FROM tree.lang WHERE len(h) > 1
  UNION ALL
  SELECT placed.lang, p, 1000 + lvl, q // (8 ** lvl)::BIGINT, h
  FROM placed JOIN sub ON placed.lang IS NOT DISTINCT FROM sub.lang, above WHERE len(h) > 1
), paths AS (
  SELECT lang, p, list(array_to_string(h[j // 8 * 8 + 1 : j], '') || '|' || array_to_string(h[j + 2 : j // 8 * 8 + 8], '') ORDER BY lvl) AS path
  FROM steps GROUP BY lang, p
), folded AS (
  SELECT placed.*, coalesce(path, []) AS path,
    coalesce(list_reduce(path, lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2)), other), other) AS folded_root
  FROM placed LEFT JOIN paths ON placed.lang IS NOT DISTINCT FROM paths.lang AND placed.p = paths.p
)
SELECT doc_id, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM folded JOIN sub ON folded.lang IS NOT DISTINCT FROM sub.lang, (SELECT h[1] AS root FROM above WHERE len(h) = 1)
"""
