"""The eight entities: what kind each is, its schema, key and place in the lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from . import schemas

DIMENSION = "dimension"  # full snapshot, one folder
FACT = "fact"  # incremental, one folder per date
TIME_SERIES = "time_series"  # full load per date, history kept


@dataclass(frozen=True)
class Entity:
    name: str
    kind: str
    schema: T.StructType
    key: str = "id"


# Entity names in load order, dimensions first.
ENTITIES = {
    e.name: e
    for e in [
        Entity("platforms", DIMENSION, schemas.PLATFORMS),
        Entity("genres", DIMENSION, schemas.GENRES),
        Entity("game_modes", DIMENSION, schemas.GAME_MODES),
        Entity("themes", DIMENSION, schemas.THEMES),
        Entity("player_perspectives", DIMENSION, schemas.PLAYER_PERSPECTIVES),
        Entity("games", FACT, schemas.GAMES),
        Entity("popscore", TIME_SERIES, schemas.POPSCORE),
        Entity("popularity_types", DIMENSION, schemas.POPULARITY_TYPES),
    ]
}
LOAD_ORDER = list(ENTITIES)


def entity(name: str) -> Entity:
    """The registered entity of that name."""
    if name not in ENTITIES:
        raise KeyError(f"unknown entity {name!r}; known: {', '.join(LOAD_ORDER)}")
    return ENTITIES[name]


def raw_path(root: str, name: str, dt: str | None = None) -> str:
    """Folder of an entity; with ``dt``, of its date. An unregistered name is laid out as a fact."""
    known = ENTITIES.get(name)
    if known and known.kind == DIMENSION:
        return f"{root}/raw/dimensions/{name}"
    return f"{root}/raw/{name}/dt={dt}" if dt else f"{root}/raw/{name}"
