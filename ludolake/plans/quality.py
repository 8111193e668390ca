"""The declared checks of the staging models, bridges and the game dimension."""

from __future__ import annotations

from pyspark.sql import types as T

from ..operators.quality import Check
from .staging import BRIDGES, NAME_ARRAYS

_STAGED = ["stg_games", *[f"stg_{dim}" for _, dim in NAME_ARRAYS.values()]]


def _staged(model: str) -> list[Check]:
    return [
        Check(model, "id", "not_null"),
        Check(model, "id", "unique"),
        Check(model, "name", "not_null"),
    ]


def _bridged(model: str) -> list[Check]:
    _, target, dimension = BRIDGES[model]
    parents = {"game_id": "stg_games", target: f"stg_{dimension}"}
    return [
        check
        for column, parent in parents.items()
        for check in (
            Check(model, column, "not_null"),
            Check(model, column, "relationships", to_model=parent, to_column="id"),
        )
    ]


CHECKS = [
    *[check for model in _STAGED for check in _staged(model)],
    *[check for model in BRIDGES for check in _bridged(model)],
    Check("dim_games", "game_id", "not_null"),
    Check("dim_games", "game_id", "unique"),
    Check("dim_games", "game_name", "not_null"),
    Check("dim_games", "platform_names", "column_type", expected=T.ArrayType(T.StringType())),
    Check("dim_games", "hypes", "not_null", severity="warn"),
]
