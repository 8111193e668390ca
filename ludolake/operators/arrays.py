"""Id arrays to bridge rows, and bridge rows back to arrays of names."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import at_most

# Largest dimension broadcast as (id, name) rows.
SMALL_DIMENSION = 200_000


def explode_bridge(
    games: DataFrame, ids: str, target: str, position: str | None = None, key: str = "id"
) -> DataFrame:
    """One ``(game_id, target)`` row per array element; NULL and empty arrays give none."""
    filled = games.where(F.size(ids) > 0)
    game_id = F.col(key).alias("game_id")
    if position:
        return filled.select(game_id, F.posexplode(ids).alias(position, target))
    return filled.select(game_id, F.explode(ids).alias(target))


def valid_bridge(bridge: DataFrame, games: DataFrame, key: str = "id") -> DataFrame:
    """Bridge rows whose game exists."""
    known = games.select(F.col(key).alias("game_id"))
    return bridge.join(known, "game_id", "left_semi")


def _dimension_rows(dimensions: Sequence[DataFrame]) -> DataFrame:
    """All dimensions stacked as (kind, dim_id, name), kind being the place in the list."""
    parts = [
        rows.where("id IS NOT NULL").selectExpr(
            f"{kind} AS kind", "cast(id AS bigint) AS dim_id", "name"
        )
        for kind, rows in enumerate(dimensions)
    ]
    return reduce(DataFrame.unionByName, parts)


def assemble_name_arrays(
    games: DataFrame,
    kinds: Mapping[str, tuple[str, DataFrame]],
    key: str = "id",
    small_dimension: int = SMALL_DIMENSION,
) -> DataFrame:
    """Add one ordered name array per kind: ``{output: (id array column, dimension)}``.

    Every kind is exploded in the same scan and collected in the same
    aggregation, so five arrays cost one shuffle on the key instead of ten.
    Elements follow the array position; an id the dimension lacks stays as a
    NULL name; a NULL or empty id array gives a NULL name array.
    """
    kind_ids = [ids for ids, _ in kinds.values()]
    none = "cast(array() AS array<struct<kind:int,position:int,dim_id:bigint>>)"
    entries = ", ".join(
        f"coalesce(transform({ids}, (x, i) -> struct({kind} AS kind, i AS position, "
        f"cast(x AS bigint) AS dim_id)), {none})"
        for kind, ids in enumerate(kind_ids)
    )
    bridge = games.select(key, F.expr(f"explode(concat({entries})) AS entry")).select(
        key, "entry.*"
    )
    # A repeated id has the greatest of its names, so that it adds no rows.
    dimension = _dimension_rows([rows for _, rows in kinds.values()])
    dimension = dimension.groupBy("kind", "dim_id").agg(F.max("name").alias("name"))
    if at_most(dimension, small_dimension):
        dimension = F.broadcast(dimension)
    named = bridge.join(dimension, ["kind", "dim_id"], "left")
    # (kind, position) is unique within a key, so the sort never compares names.
    collected = named.groupBy(key).agg(
        F.array_sort(F.collect_list(F.struct("kind", "position", "name"))).alias("_entries")
    )
    arrays = collected.selectExpr(
        key,
        *[
            f"nullif(transform(filter(_entries, e -> e.kind = {kind}), e -> e.name), "
            f"cast(array() AS array<string>)) AS {output}"
            for kind, output in enumerate(kinds)
        ],
    )
    arrays = arrays.withColumnRenamed(key, "_key")
    return games.join(arrays, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")


#: Ids are dense if they span at most so many places for each name.
_SPREAD = 8


def lookup_name_arrays(games: DataFrame, kinds: Mapping[str, tuple[str, DataFrame]]) -> DataFrame:
    """The same arrays with neither a shuffle nor a join, for dimensions of at most a few thousand rows.

    The names become constants of the plan, so no row carries them along, and each id
    array is translated in place. Names of dense ids stand in an array at the place of
    their id; those of sparse ids in short lists by the remainder of their id, so the
    time for a name does not grow with the dimension. The caller checks the size of the
    dimensions, which this collects.
    """
    dimension = _dimension_rows([rows for _, rows in kinds.values()])
    known: list[dict[int, str | None]] = [{} for _ in kinds]
    # Of a repeated id the greatest name counts.
    for row in dimension.groupBy("kind", "dim_id").agg(F.max("name").alias("name")).collect():
        known[row.kind][row.dim_id] = row.name
    translated = [
        F.when(F.size(ids) > 0, F.transform(ids, _translation(names))).alias(output)
        for names, (output, (ids, _)) in zip(known, kinds.items())
    ]
    return games.select("*", *translated)


def _translation(names: Mapping[int, str | None]):
    """What turns an id into its name, or NULL."""
    if not names:
        return lambda x: F.lit(None).cast("string")
    low, high = min(names), max(names)
    if high - low <= _SPREAD * len(names):
        at = _constant([names.get(i) for i in range(low, high + 1)], "array<string>")
        return lambda x: F.when(x.between(low, high), F.get(at, (x - low).cast("int")))
    slots: list[list] = [[] for _ in names]
    for i, name in names.items():
        slots[i % len(slots)].append({"i": i, "n": name})
    by = _constant(slots, "array<array<struct<i: bigint, n: string>>>")

    def sparse(x):
        slot = F.get(by, F.pmod(x, F.lit(len(slots))).cast("int"))
        return F.get(F.filter(slot, lambda e: e["i"] == x), F.lit(0))["n"]

    return sparse


def _constant(value, kind: str) -> Column:
    """A value of a nested type that the optimizer folds into the plan."""
    return F.from_json(F.lit(json.dumps(value)), kind)
