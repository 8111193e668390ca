"""Latest row per key, and merging an increment into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage

# An increment of up to this many keys is broadcast as (key, order) pairs.
SMALL_INCREMENT = 1_000_000


def latest_by_key(
    df: DataFrame, key: str | Sequence[str], order: str, ties: Sequence[str] = ()
) -> DataFrame:
    """Keep the row with the greatest ``order`` for each key, NULL order last.

    Catalyst turns the ``== 1`` filter into a partial group limit before the
    shuffle, so a key that holds a third of the rows sends one row per task.
    Without ``ties`` a hash of the row decides, which keeps replays stable.
    """
    keys = [key] if isinstance(key, str) else list(key)
    decide = [F.col(c).desc_nulls_last() for c in ties] or [F.xxhash64(*_hashable(df)).desc()]
    newest = Window.partitionBy(*keys).orderBy(F.col(order).desc_nulls_last(), *decide)
    return df.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def _hashable(df: DataFrame) -> list[Column]:
    """All columns; those that hold a map, which has no hash, as JSON."""
    return [
        F.to_json(F.struct(F.col(f"`{f.name}`"))) if "map<" in f.dataType.simpleString() else F.col(f"`{f.name}`")
        for f in df.schema
    ]


def upsert_latest(
    old: DataFrame,
    new: DataFrame,
    key: str,
    order: str,
    small_increment: int = SMALL_INCREMENT,
) -> DataFrame:
    """Merge ``new`` into ``old`` by key; the greatest ``order`` wins, ties go to ``new``.

    ``old`` must be a table that is unique by ``key``, such as the result of an
    earlier merge; ``new`` need not be. Columns are matched by name and missing
    ones are NULL. The increment is reduced to its latest rows once and staged.

    A small increment, which is the daily case, is broadcast: the large table
    is filtered in place and never shuffled. A larger one goes through one
    shuffle on the key. Both ways a NULL key is a key like any other.
    """
    newest = stage(latest_by_key(new, key, order), "increment")
    arriving = newest.select(
        F.col(key).alias("_key"), F.col(order).alias("_new_order"), F.lit(True).alias("_hit")
    )
    same_key = F.col(key).eqNullSafe(F.col("_key"))
    if not at_most(arriving, small_increment):
        both = old.withColumn("_side", F.lit(0)).unionByName(
            newest.withColumn("_side", F.lit(1)), allowMissingColumns=True
        )
        return latest_by_key(both, key, order, ties=["_side"]).drop("_side")

    old_wins = F.col(order).isNotNull() & (
        F.col("_new_order").isNull() | (F.col(order) > F.col("_new_order"))
    )
    survivors = (
        old.join(F.broadcast(arriving), same_key, "left")
        .where(F.col("_hit").isNull() | old_wins)
        .drop("_key", "_new_order", "_hit")
    )
    # At most one row per arriving key, so no larger than the checked increment.
    met = old.select(key, order).join(F.broadcast(arriving), same_key)
    beaten = met.where(old_wins).select("_key")
    winners = newest.join(F.broadcast(beaten), same_key, "left_anti")
    return survivors.unionByName(winners, allowMissingColumns=True)
