"""Data-quality checks: failing rows, failure counts and a suite over many models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Check:
    """One declared check on a column of a model."""

    model: str
    column: str
    kind: str  # not_null, unique, relationships or column_type
    severity: str = "error"  # or warn
    to_model: str | None = None
    to_column: str | None = None
    expected: T.DataType | None = None


def null_rows(df: DataFrame, column: str) -> DataFrame:
    """Rows whose ``column`` is NULL."""
    return df.where(F.col(column).isNull())


def repeated_values(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values that occur more than once, with how often."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where("n_rows > 1")
    )


def orphan_rows(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-NULL ``column`` has no match in the parent."""
    known = parent.select(F.col(parent_column).alias("_known"))
    return child.where(F.col(column).isNotNull()).join(
        known, F.col(column) == F.col("_known"), "left_anti"
    )


def orphan_counts(
    child: DataFrame, column: str, parent: DataFrame, parent_column: str
) -> DataFrame:
    """Orphan values with their row counts; the child is counted before the join,
    so a value that fills a third of it joins as one row."""
    counted = (
        child.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )
    return orphan_rows(counted, column, parent, parent_column)


def type_differs(df: DataFrame, column: str, expected: T.DataType) -> bool:
    """Whether the declared type of ``column`` is not ``expected`` (nullability aside)."""
    return df.schema[column].dataType.simpleString() != expected.simpleString()


def run_checks(models: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Run every check: (model, column, check, severity, failures, status).

    Each model is scanned once, for all of its checks. The values of a column with a
    uniqueness or relationship check are counted under the column they refer to, side by
    side with that column's own values, so one aggregation answers for uniqueness,
    references and NULLs of all models at once, without a join; it is combined before its
    one shuffle, so a value that fills a third of the rows arrives as one row a task.
    Columns that only must not be NULL send their NULLs and nothing else.
    """
    places = _places_of(checks)
    kinds = {
        models[m].schema[c].dataType.simpleString() for m, c in {(c.model, c.column) for c in checks if c.kind in _KEYED}
    }
    kind = kinds.pop() if len(kinds) == 1 else "string"
    width = 1 + max((slot for own in places.values() for _, slot in own), default=0)
    parts = [_cells(models[m], m, places, checks, kind) for m in dict.fromkeys(m for m, _ in places)]
    slots = [F.count_if(F.col("slot") == i).alias(f"n{i}") for i in range(width)]
    counted = reduce(DataFrame.unionByName, parts).groupBy("target", "v").agg(*slots)

    missing, known = F.col("v").isNull(), F.col("v").isNotNull()
    found = counted.groupBy("target").agg(
        *[F.sum(F.when(missing, F.col(f"n{i}"))).alias(f"null{i}") for i in range(width)],
        *[F.count_if(known & (F.col(f"n{i}") > 1)).alias(f"twice{i}") for i in range(width)],
        *[F.sum(F.when(known & (F.col("n0") == 0), F.col(f"n{i}"))).alias(f"orphan{i}") for i in range(width)],
    )
    fields = F.struct(*[c for c in found.columns if c != "target"])
    by_target = found.agg(F.map_from_entries(F.collect_list(F.struct("target", fields))).alias("found"))

    def failures(check: Check) -> str:
        if check.kind == "column_type":
            return f"{int(type_differs(models[check.model], check.column, check.expected))}L"
        own = places[check.model, check.column]
        wanted = None if check.kind != "relationships" else (check.to_model, check.to_column)
        target, slot = next((t, s) for t, s in own if wanted is None or _target_of(places, wanted) == t)
        word = {"not_null": "null", "unique": "twice", "relationships": "orphan"}[check.kind]
        return f"coalesce(try_element_at(found, {target}).{word}{slot}, 0L)"

    labels = ", ".join(
        f"struct('{c.model}' AS model, '{c.column}' AS column, '{c.kind}' AS check, "
        f"'{c.severity}' AS severity, {failures(c)} AS failures)"
        for c in checks
    )
    status = (
        F.when(F.col("failures") == 0, "pass")
        .when(F.col("severity") == "warn", "warn")
        .otherwise("fail")
    )
    return by_target.selectExpr(f"inline(array({labels}))").withColumn("status", status)


_KEYED = ("unique", "relationships")


def _places_of(checks: Sequence[Check]) -> dict[tuple[str, str], list[tuple[int, int]]]:
    """(model, column) to the (target, slot) pairs its values are counted under.

    A target is a column that others refer to, or that stands for itself; its own values
    have slot 0 and each column that refers to it a slot of its own.
    """
    targets: dict[tuple[str, str], list[tuple[str, str]]] = {}
    for check in checks:
        if check.kind == "relationships":
            parent = (check.to_model, check.to_column)
            members = targets.setdefault(parent, [parent])
            if (check.model, check.column) not in members[1:]:
                members.append((check.model, check.column))
    referring = {member for members in targets.values() for member in members}
    for check in checks:
        own = (check.model, check.column)
        if check.kind != "column_type" and own not in referring:
            targets.setdefault(own, [own])
    places: dict[tuple[str, str], list[tuple[int, int]]] = {}
    for number, members in enumerate(targets.values()):
        for slot, member in enumerate(members):
            places.setdefault(member, []).append((number, slot))
    return places


def _target_of(places: Mapping, parent: tuple[str, str]) -> int:
    return next(target for target, slot in places[parent] if slot == 0)


def _cells(df: DataFrame, model: str, places: Mapping, checks: Sequence[Check], kind: str) -> DataFrame:
    """(target, slot, v) of every counted value of a model, by one scan."""
    keyed = {(c.model, c.column) for c in checks if c.kind in _KEYED}
    keyed |= {(c.to_model, c.to_column) for c in checks if c.kind == "relationships"}
    values, target, slot, sparse = {}, F.lit(None).cast("int"), F.lit(None).cast("int"), []
    for (owner, column), own in places.items():
        for t, s in own if owner == model else ():
            value, name = F.col(f"`{column}`"), f"{t}.{s}"
            if (model, column) not in keyed:  # only its NULLs matter
                value = F.when(value.isNotNull(), F.lit(0))
                sparse.append(name)
            values[name] = value.cast(kind)
            here = F.col("cell") == name
            target, slot = F.when(here, t).otherwise(target), F.when(here, s).otherwise(slot)
    wide = df.select(*[value.alias(name) for name, value in values.items()])
    long = wide.unpivot([], [f"`{name}`" for name in values], "cell", "v")
    if sparse:
        long = long.where(F.col("v").isNull() | ~F.col("cell").isin(sparse))
    return long.select(target.alias("target"), slot.alias("slot"), "v")
