"""Helpers that several corpus operators share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A word, as the contracts of the queries define it: anything between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return rows.select(*columns) if columns else rows


def texts(column: pa.Array) -> list[bytes | None]:
    """An Arrow text column as UTF-8 bytes, without decoding."""
    return column.cast(pa.binary()).to_pylist()


def slices(batches, rows: int = 256):
    """Arrow batches cut to few rows, so that a worker holds Python copies of few texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WordIds(dict):
    """64-bit ids of words, remembered up to ``limit`` words; the ids do not depend on it."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= self.limit:
            self.clear()
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_ODD = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> _SHIFT)) * _ODD
    return values ^ (values >> np.uint64(32))


def windows(ids: np.ndarray, size: int) -> np.ndarray:
    """One hash for each run of ``size`` ids, in order of position."""
    count = len(ids) - size + 1
    out = np.full(max(count, 0), np.uint64(size))
    for k in range(size):
        out = mixed(out) + ids[k : k + max(count, 0)]
    return mixed(out)


def positions(df: DataFrame, groups: list[str], order: list[Column], size: Column, rows_each: int = 20_000) -> DataFrame:
    """``df`` with ``start``: the sum of ``size`` over all earlier rows of its group.

    Rows are spread over hash buckets of about ``rows_each`` rows; only one sum per
    bucket is ranked per group, so a hot group is never gathered in one task. ``order``
    decides the buckets too: it must tell rows apart by content alone where results
    are not to depend on the layout of the partitions.
    """
    from pyspark.sql import Window

    buckets = max(1, df.count() // rows_each + 1)
    # The bucket comes from the order columns, so that equal rows stay neighbours.
    dealt = df.withColumns({"_bucket": F.pmod(F.xxhash64(*order), F.lit(buckets)), "_size": size.cast("long")})
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("")) for g in groups] + [F.col(g).isNull() for g in groups]
    dealt = dealt.withColumn("_group", F.struct(*keys) if groups else F.lit(0))
    sums = dealt.groupBy("_group", "_bucket").agg(F.sum("_size").alias("_sum"))
    before = Window.partitionBy("_group").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("_group", "_bucket", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))
    within = Window.partitionBy("_group", "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("_run", F.coalesce(F.sum("_size").over(within), F.lit(0)))
    placed = placed.join(sums, ["_group", "_bucket"])
    return placed.withColumn("start", F.col("_base") + F.col("_run")).drop("_group", "_bucket", "_size", "_base", "_run")
