"""Staging: typed, deduplicated, column-pruned copies of the landed entities, and the bridges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.arrays import explode_bridge
from ..operators.latest import latest_by_key
from ..sources import schemas
from ..sources.registry import entity

# Bridge name -> (id array of a game, id column of the bridge, dimension).
BRIDGES = {
    "stg_game_platform_bridge": ("platforms", "platform_id", "platforms"),
    "stg_game_genre_bridge": ("genres", "genre_id", "genres"),
    "stg_game_mode_bridge": ("game_modes", "game_mode_id", "game_modes"),
    "stg_game_theme_bridge": ("themes", "theme_id", "themes"),
    "stg_game_perspective_bridge": ("player_perspectives", "perspective_id", "player_perspectives"),
}

# Name array of dim_games -> (id array of a game, dimension).
NAME_ARRAYS = {
    "platform_names": ("platforms", "platforms"),
    "genre_names": ("genres", "genres"),
    "game_mode_names": ("game_modes", "game_modes"),
    "theme_names": ("themes", "themes"),
    "perspective_names": ("player_perspectives", "player_perspectives"),
}


def stg_games(raw: DataFrame) -> DataFrame:
    """Latest version of each game; a game whose latest version has no name is left out."""
    fields = schemas.GAMES.fieldNames()
    newest = latest_by_key(raw.select(*fields), "id", "updated_at")
    return newest.where(F.col("name").isNotNull()).withColumn(
        "summary", F.coalesce("summary", F.lit(""))
    )


def stg_dimension(name: str, raw: DataFrame) -> DataFrame:
    """A dimension with one row per id.

    Increments append changed rows to the same folder, so the latest one counts.
    """
    return latest_by_key(raw.select(*entity(name).schema.fieldNames()), "id", "updated_at")


def stg_popularity_types(raw: DataFrame) -> DataFrame:
    return stg_dimension("popularity_types", raw)


def bridge(name: str, games: DataFrame) -> DataFrame:
    """(game_id, <dimension>_id) rows of one bridge from the staged games."""
    ids, target, _ = BRIDGES[name]
    return explode_bridge(games, ids, target)
