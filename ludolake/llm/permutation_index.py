"""Approximate nearest neighbours by a permutation index.

A bounded sample of vectors serves as pivots. Every vector is represented by its
``near`` nearest pivots in order and posted in the inverted file of each of them.
A query walks the files of its own pivots and adds up, for each vector met, what
the shared pivots take off the footrule distance of the two truncated orders; the
share with the least distance is reranked by the exact measure.

Nearness is the inner product, so vectors get one more coordinate that brings all of
them to the length of the longest; among these the inner product orders as the angle
does. How large a share is reranked is measured, not assumed: on a bounded sample the
true neighbours are looked up in the order of the index, and the share is what holds
``HELD`` of them. A block of few rows is treated like one of many.

Vectors are dealt to blocks of bounded size, each with inverted files of its own;
blocks of queries meet every block. Only the best ``k`` of each meeting travel on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import table

PIVOTS = 192
NEAR = 32
#: Rows and queries of the sample on which the share is measured, and the part of their true neighbours it must hold.
SAMPLE = 4096
SAMPLE_QUERIES = 96
HELD = 0.95
BLOCK = 4096
QUERY_BLOCK = 2048


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) without null ids and vectors that are null, empty, zero or hold null or non-finite numbers."""
    v = F.col(vector_col).cast("array<double>")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"))
    return rows.where(F.col("id").isNotNull() & (F.size(v) > 0) & ~bad & F.exists(v, lambda x: x != 0))


def _orders(matrix: np.ndarray, pivots: np.ndarray, near: int) -> np.ndarray:
    """Of each row, its nearest pivots in order (by inner product of directions; ties by pivot)."""
    return np.argsort(-(matrix @ pivots.T), axis=1, kind="stable")[:, :near].astype(np.int16)


def _unit(matrix: np.ndarray) -> np.ndarray:
    scale = np.abs(matrix).max(axis=1, keepdims=True)
    matrix = matrix / scale
    return matrix / np.linalg.norm(matrix, axis=1, keepdims=True)


def _lengthened(matrix: np.ndarray, scale: float, longest: float, asked: bool) -> np.ndarray:
    """Unit vectors whose angles to each other order rows as the inner product with a query does."""
    matrix = matrix / scale
    rest = np.zeros(len(matrix)) if asked else np.sqrt(np.maximum(longest**2 - (matrix * matrix).sum(1), 0))
    return _unit(np.concatenate([matrix, rest[:, None]], 1))


def measured_share(sample: np.ndarray, orders: np.ndarray, asks: np.ndarray, who: np.ndarray, pivots: int, k: int) -> float:
    """The share of rows, in the order of the index, that holds ``HELD`` of the true ``k`` neighbours of the sample's queries."""
    places = []
    for i, gain in zip(who, gains(asks, orders, pivots)):
        order = np.argsort(-gain, kind="stable")
        order = order[order != i]
        scores = sample[order] @ sample[i]
        best = np.argsort(-scores, kind="stable")[:k]
        places.extend((best + 1) / max(len(order), 1))
    return float(np.quantile(places, HELD)) if places else 1.0


def gains(queries: np.ndarray, orders: np.ndarray, pivots: int):
    """For each row of query orders, what each row of ``orders`` saves of the greatest footrule distance."""
    rows, near = orders.shape
    flat = orders.ravel()
    by = np.argsort(flat, kind="stable")
    ends = np.searchsorted(flat[by], np.arange(pivots + 1))
    files = [(by[a:b] // near, (near - by[a:b] % near).astype(np.int32)) for a, b in zip(ends[:-1], ends[1:])]
    for order in queries:
        gain = np.zeros(rows, np.int32)
        for rank, pivot in enumerate(order):
            who, weight = files[pivot]
            gain[who] += np.minimum(weight, near - rank)
        yield gain


def candidates(queries: np.ndarray, orders: np.ndarray, pivots: int, share: float):
    """For each row of query orders, the rows of ``orders`` with the least footrule distance (ties: first rows)."""
    rows = len(orders)
    keep = min(rows, int(np.ceil(share * rows)) + 1)
    for gain in gains(queries, orders, pivots):
        if keep == rows:
            yield np.arange(rows)
            continue
        # Rows are in order of id, so equal distances keep the smaller ids.
        least = np.partition(gain, rows - keep)[rows - keep]
        above = np.flatnonzero(gain > least)
        yield np.concatenate([above, np.flatnonzero(gain == least)[: keep - len(above)]])


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best inner products found for each query row.

    ``is_query`` makes a condition of the id column. A query's own id is no candidate.
    Unusable vectors (see ``usable``) take no part, nor do vectors of another length
    than the pivots'. Rows that repeat an id and vector count once; of rows with one
    id and several vectors all count. No usable vectors give no rows.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col).distinct()
    none = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()  # bounded
    drawn = [tuple(r["v"]) for r in sample]
    size = max(map(len, drawn), key=[len(v) for v in drawn].count, default=0)
    drawn = [v for v in drawn if len(v) == size]
    if not drawn:
        return none
    rows = stage(rows.where(F.size("v") == size), "vectors")
    count = rows.count()
    scale = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0]
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + (x / scale) * (x / scale))
    longest = float(np.sqrt(rows.agg(F.max(square)).first()[0]))

    chosen = np.array(list(dict.fromkeys(drawn))[:PIVOTS])
    near = min(NEAR, len(chosen))
    pivots = spark.sparkContext.broadcast(_lengthened(chosen, scale, longest, False))
    drawn = np.array(drawn)
    # Pivots find their neighbours more easily than other rows do, so the last rows ask.
    who = np.arange(max(0, len(drawn) - SAMPLE_QUERIES), len(drawn))
    share = measured_share(
        drawn / scale,
        _orders(_lengthened(drawn, scale, longest, False), pivots.value, near),
        _orders(_lengthened(drawn[who], scale, longest, True), pivots.value, near),
        who, len(chosen), k,
    )
    asked = rows.where(is_query(F.col("id")))
    blocks, groups = max(1, -(-count // BLOCK)), max(1, -(-asked.count() // QUERY_BLOCK))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n))
    upto = lambda n: F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))
    # Each block of vectors is sent once per block of queries, and the other way round: a stated query set in blocks.
    base = rows.select(F.lit(False).alias("asked"), "id", "v", deal(blocks).alias("block"), F.explode(upto(groups)).alias("group"))
    ask = asked.select(F.lit(True).alias("asked"), "id", "v", F.explode(upto(blocks)).alias("block"), F.pmod(F.hash("id"), F.lit(groups)).cast("long").alias("group"))

    def meet(part: pa.Table) -> pa.Table:
        asked = part.column("asked").to_numpy()
        ids = part.column("id").to_numpy()
        flat = part.column("v").combine_chunks().flatten().to_numpy().reshape(len(ids), size)
        q, b = np.flatnonzero(asked), np.flatnonzero(~asked)
        b = b[np.argsort(ids[b], kind="stable")]
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if len(q) and len(b):
            base, own = flat[b], ids[b]
            orders = _orders(_lengthened(base, scale, longest, False), pivots.value, near)
            asks = _orders(_lengthened(flat[q], scale, longest, True), pivots.value, near)
            sizes = np.abs(base).max(1)
            single = (own[1:] != own[:-1]).all()
            for i, rows in zip(q, candidates(asks, orders, len(pivots.value), share)):
                rows = rows[own[rows] != ids[i]]
                if len(rows) < k or not single and len(np.unique(own[rows])) < k:  # rows of one id crowd the others out
                    rows = np.flatnonzero(own != ids[i])
                best = scores = base[rows] @ flat[i]
                if not single:  # the best row of each id; an id that is not among the k best of them goes
                    each, where = np.unique(own[rows], return_inverse=True)
                    best = np.full(len(each), -np.inf)
                    np.maximum.at(best, where, scores)
                if len(best) > k:
                    # The product is summed in another order here, so it may be off by this much.
                    slack = 1e-12 * size * np.abs(flat[i]).max() * sizes[rows].max()
                    cut = np.partition(best, len(best) - k)[len(best) - k]
                    rows = rows[scores >= cut - slack]
                found.append((np.full(len(rows), ids[i]), own[rows], np.array([exact(flat[i], base[r]) for r in rows])))
        a, c, s = (np.concatenate(x) for x in zip(*found))
        first = np.lexsort((-s, c, a))
        once = first[np.r_[True, (a[first][1:] != a[first][:-1]) | (c[first][1:] != c[first][:-1])]] if len(first) else first
        a, c, s = a[once], c[once], s[once]
        best = np.lexsort((c, -s, a))
        rank = np.arange(len(best)) - np.searchsorted(a[best], a[best])
        best = best[rank < k]
        return pa.table({"query_id": a[best], "vec_id": c[best], "score": s[best]})

    met = base.union(ask).groupBy("block", "group").applyInArrow(meet, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score")).withColumn("rank", F.row_number().over(order))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def exact(x: np.ndarray, y: np.ndarray) -> float:
    """The inner product in double precision, summed in order of the components."""
    total = 0.0
    for a, b in zip(x.tolist(), y.tolist()):
        total += a * b
    return total


def op9_permutation_index(spark, sf_dir) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings", "vec_id", "embedding")
    return nearest(vectors, lambda vec_id: vec_id % 20 == 0)
