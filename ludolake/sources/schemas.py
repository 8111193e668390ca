"""Explicit schemas of the landed entities, so that a sparse field is NULL and never missing."""

from __future__ import annotations

from pyspark.sql import types as T

LONG, DOUBLE, STRING = T.LongType(), T.DoubleType(), T.StringType()
LONGS, STRINGS = T.ArrayType(LONG), T.ArrayType(STRING)


def columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


# Field names and types of the public catalogue entities.
GAMES = columns(
    id=LONG,
    name=STRING,
    slug=STRING,
    summary=STRING,
    game_type=LONG,
    parent_game=LONG,
    cover=LONG,
    url=STRING,
    checksum=STRING,
    created_at=LONG,
    updated_at=LONG,
    genres=LONGS,
    platforms=LONGS,
    game_modes=LONGS,
    player_perspectives=LONGS,
    themes=LONGS,
    game_engines=LONGS,
    keywords=LONGS,
    first_release_date=LONG,
    release_dates=LONGS,
    screenshots=LONGS,
    websites=LONGS,
    hypes=LONG,
    aggregated_rating=DOUBLE,
    aggregated_rating_count=LONG,
)
PLATFORMS = columns(
    id=LONG,
    name=STRING,
    slug=STRING,
    alternative_name=STRING,
    generation=LONG,
    platform_logo=LONG,
    platform_type=LONG,
    url=STRING,
    created_at=LONG,
    updated_at=LONG,
    checksum=STRING,
)
GENRES = GAME_MODES = THEMES = PLAYER_PERSPECTIVES = columns(
    id=LONG,
    name=STRING,
    slug=STRING,
    url=STRING,
    created_at=LONG,
    updated_at=LONG,
    checksum=STRING,
)
POPULARITY_TYPES = columns(
    id=LONG,
    name=STRING,
    external_popularity_source=LONG,
    popularity_source=LONG,
    created_at=LONG,
    updated_at=LONG,
    checksum=STRING,
)
POPSCORE = columns(id=LONG, game_id=LONG, popularity_type=LONG, value=DOUBLE)
