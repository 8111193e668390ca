"""Global order at scale: row index, paging, percentile buckets, exact percentile, top-N.

A window without PARTITION BY puts every row into one task. Beyond a checked
row bound these operators range-partition the rows instead, note each row's
place inside its partition, and add the sizes of the earlier partitions. The
result is the same row for row.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage

# Up to this many rows are ordered in one task.
SMALL_ROWS = 100_000

# Up to this many distinct values are held in one percentile aggregate.
SMALL_VALUES = 1_000_000


def _places(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-sorted by ``order``, each row with its partition and its offset in it.

    The rows are staged, because a recomputed range partitioning could cut
    elsewhere and the places would no longer fit together. Ties are cut by the
    whole order, so a value shared by a third of the rows spans partitions.
    """
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_slot", F.monotonically_increasing_id())
        # The id holds the partition above bit 33 and the row number below.
        .withColumn("_part", F.shiftrightunsigned("_slot", 33))
        .withColumn("_offset", F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_slot")
    )
    return stage(placed, name)


def _indexed(df: DataFrame, group: str, order: Sequence[Column], name: str) -> DataFrame:
    """Add ``_index`` (from 0) and ``_total`` within ``group``, a column of few known values."""
    placed = _places(df, [F.col(group).asc(), *order], name)
    runs = placed.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_offset").alias("_first")
    )
    whole = Window.partitionBy(group)
    earlier = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        group,
        "_part",
        "_first",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"),
        F.sum("_rows").over(whole).alias("_total"),
    )
    # One row per shuffle partition and group at most, whatever the data size.
    return (
        placed.join(F.broadcast(starts), [group, "_part"])
        .withColumn("_index", F.col("_before") + F.col("_offset") - F.col("_first"))
        .drop("_part", "_offset", "_before", "_first")
    )


def global_index(
    df: DataFrame, order: Sequence[Column], output: str = "row_index", small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Number all rows from 0 in ``order``, which must be unique."""
    if at_most(df, small_rows):
        return df.withColumn(output, F.row_number().over(Window.orderBy(*order)).cast("long") - 1)
    indexed = _indexed(df.withColumn("_group", F.lit(0)), "_group", order, "index")
    return indexed.withColumnRenamed("_index", output).drop("_group", "_total")


def page_numbers(
    df: DataFrame, order: Sequence[Column], size: int = 500, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Give every row the number (from 0) of the page it falls on."""
    numbered = global_index(df, order, "_index", small_rows)
    return numbered.withColumn("page", F.expr(f"_index div {int(size)}")).drop("_index")


def page(
    df: DataFrame,
    order: Sequence[Column],
    offset: int,
    limit: int = 500,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """One page of ``df``; empty past the end.

    An offset takes every row before the page into one task, so a deep page is
    cut from the global index instead.
    """
    if offset + limit <= small_rows:
        return df.orderBy(*order).offset(offset).limit(limit)
    numbered = global_index(df, order, "_index", small_rows)
    return numbered.where(F.col("_index").between(offset, offset + limit - 1)).drop("_index")


def _bucket(index: Column, total: Column, buckets: int) -> Column:
    """NTILE: the first ``total mod buckets`` buckets hold one row more than the rest."""
    size = F.floor(total / F.lit(buckets))
    longer = F.pmod(total, F.lit(buckets))
    in_longer = longer * (size + 1)
    return (
        F.when(index < in_longer, F.floor(index / (size + 1)))
        # size is 0 only when every row falls in the first branch
        .otherwise(longer + F.floor((index - in_longer) / F.greatest(size, F.lit(1))))
        .cast("int")
        + 1
    )


def percentile_buckets(
    df: DataFrame,
    key: str,
    metrics: Mapping[str, Column],
    buckets: int = 100,
    small_rows: int = SMALL_ROWS,
) -> DataFrame:
    """Add ``NTILE(buckets)`` over each metric, ascending, ties by the unique ``key``.

    ``df`` is read several times, so pass a table or a staged frame. Metrics
    of one type are ranked together: one range shuffle of narrow (metric, value,
    key) rows and one aggregation back to the key. A NULL key is a key.
    """
    if at_most(df, small_rows):
        return df.withColumns(
            {
                name: F.ntile(buckets).over(
                    Window.orderBy(metric.asc_nulls_last(), F.col(key).asc())
                )
                for name, metric in metrics.items()
            }
        )
    # Values keep their types, so those that doubles cannot tell apart keep their order.
    numbered = list(enumerate(metrics.values()))
    types = df.select(*[m.alias(f"_{i}") for i, m in numbered]).schema
    order = [F.col("_value").asc_nulls_last(), F.col("_key").asc()]
    parts = []
    for kind in dict.fromkeys(f.dataType for f in types):
        cells = [
            F.struct(F.lit(i).alias("_metric"), m.alias("_value"))
            for i, m in numbered
            if types[i].dataType == kind
        ]
        values = df.select(F.col(key).alias("_key"), F.inline(F.array(*cells)))
        ranks = _indexed(values, "_metric", order, "buckets")
        bucket = _bucket(F.col("_index"), F.col("_total"), buckets).alias("_bucket")
        parts.append(ranks.select("_key", "_metric", bucket))
    ranked = reduce(DataFrame.unionByName, parts)
    wide = ranked.groupBy("_key").agg(
        *[
            F.max(F.when(F.col("_metric") == i, F.col("_bucket"))).alias(name)
            for i, name in enumerate(metrics)
        ]
    )
    return df.join(wide, F.col(key).eqNullSafe(F.col("_key"))).drop("_key")


def value_counts(df: DataFrame, column: str, *also: Column) -> DataFrame:
    """(_value, _rows, ...) per distinct non-NULL ``column``, staged for further use."""
    counted = (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("double").alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"), *also)
    )
    return stage(counted, "values")


def exact_percentile(
    counts: DataFrame, fraction: float, output: str, small_values: int = SMALL_VALUES
) -> DataFrame:
    """Continuous percentile of ``value_counts`` rows, as a one-row frame.

    Equal values are one row already. While more distinct values are left than fit one
    aggregate, two passes narrow them down: one estimates values that cut them into equal
    parts, the other sums the rows below each cut, which tells exactly between which cuts
    the wanted ranks lie. Only sums leave the tasks, so no value is shuffled before the
    interval is small.
    """
    counts = counts.select("_value", "_rows")
    if at_most(counts, small_values):
        return counts.agg(F.percentile("_value", F.lit(fraction), F.col("_rows")).alias(output))

    total = counts.agg(F.sum("_rows")).first()[0]
    rank = fraction * (total - 1)
    low, high = math.floor(rank), math.ceil(rank)
    inside, before, left = counts, 0, None
    while True:
        cuts = inside.agg(
            F.percentile_approx("_value", F.lit([i / _CUTS for i in range(_CUTS + 1)]), F.lit(100 * _CUTS)).alias("at"),
            F.count(F.lit(1)).alias("n"),
        ).first()
        if cuts["n"] <= max(small_values, 2) or cuts["n"] == left:
            break
        left, edges = cuts["n"], sorted(set(cuts["at"]))
        value = F.col("_value")
        sums = inside.agg(
            *[F.sum(F.when(value < e, F.col("_rows"))).alias(f"below{i}") for i, e in enumerate(edges)],
            *[F.sum(F.when(value <= e, F.col("_rows"))).alias(f"upto{i}") for i, e in enumerate(edges)],
        ).first()
        below = [before + (sums[f"below{i}"] or 0) for i in range(len(edges))]
        upto = [before + (sums[f"upto{i}"] or 0) for i in range(len(edges))]
        first = max((i for i, n in enumerate(below) if n <= low), default=None)
        last = min((i for i, n in enumerate(upto) if n > high), default=None)
        if first is not None:
            inside, before = inside.where(value >= edges[first]), below[first]
        if last is not None:
            inside = inside.where(value <= edges[last])

    # So few values that one task may put them in order.
    running = F.sum("_rows").over(Window.orderBy("_value"))
    spans = inside.withColumn("_end", running + F.lit(before))

    def at(position: int) -> Column:
        here = (F.col("_end") - F.col("_rows") <= position) & (F.lit(position) < F.col("_end"))
        return F.max(F.when(here, F.col("_value")))

    picked = spans.agg(at(low).alias("_low"), at(high).alias("_high"))
    return picked.select(
        (F.col("_low") + (F.col("_high") - F.col("_low")) * F.lit(float(rank - low))).alias(output)
    )


#: Parts into which one round of ``exact_percentile`` cuts the values that are left.
_CUTS = 32


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """First ``n`` rows in ``order``; each task keeps only its own best ``n``."""
    return df.orderBy(*order).limit(n)
