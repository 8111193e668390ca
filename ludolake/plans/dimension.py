"""The game dimension: scalar columns plus five arrays of names."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.arrays import assemble_name_arrays, lookup_name_arrays
from ..operators.latest import upsert_latest
from ..session import at_most
from ..sources.schemas import DOUBLE, LONG, STRING, STRINGS, columns
from .staging import NAME_ARRAYS

# Dimensions of up to this many rows together are looked up in place.
LOOKUP_ROWS = 2_000

DIM_GAMES = columns(
    game_id=LONG,
    game_name=STRING,
    game_slug=STRING,
    game_summary=STRING,
    platform_names=STRINGS,
    genre_names=STRINGS,
    game_mode_names=STRINGS,
    theme_names=STRINGS,
    perspective_names=STRINGS,
    url=STRING,
    cover=LONG,
    hypes=LONG,
    aggregated_rating=DOUBLE,
    aggregated_rating_count=LONG,
    first_release_date=LONG,
    created_at=LONG,
    updated_at=LONG,
)

_RENAMED = {"id": "game_id", "name": "game_name", "slug": "game_slug", "summary": "game_summary"}


def dim_games(
    games: DataFrame, dimensions: Mapping[str, DataFrame], lookup_rows: int = LOOKUP_ROWS
) -> DataFrame:
    """``stg_games`` with the names of its dimensions, in the order of its id arrays.

    Bridge rows come from the staged games themselves, so each has its game.
    Small dimensions, the usual case, cost no shuffle at all.
    """
    kinds = {out: (ids, dimensions[dim]) for out, (ids, dim) in NAME_ARRAYS.items()}
    used = [dimensions[dim].select("id") for _, dim in NAME_ARRAYS.values()]
    together = used[0]
    for rows in used[1:]:
        together = together.unionByName(rows)
    small = at_most(together, lookup_rows)
    named = (lookup_name_arrays if small else assemble_name_arrays)(games, kinds)
    return named.withColumnsRenamed(_RENAMED).select(*DIM_GAMES.fieldNames())


def merge_dim_games(old: DataFrame, new: DataFrame) -> DataFrame:
    """The dimension after an increment: latest ``updated_at`` per game, ties to the new row."""
    return upsert_latest(old, new, "game_id", "updated_at").select(*DIM_GAMES.fieldNames())
