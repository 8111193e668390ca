from .build import build_all
from .dimension import dim_games, merge_dim_games
from .loads import load_all, load_entity, load_mode, load_modes
from .popularity import fct_game_popularity, stg_popscore
from .staging import BRIDGES, NAME_ARRAYS, bridge, stg_dimension, stg_games, stg_popularity_types

__all__ = [
    "BRIDGES",
    "NAME_ARRAYS",
    "bridge",
    "build_all",
    "dim_games",
    "fct_game_popularity",
    "load_all",
    "load_entity",
    "load_mode",
    "load_modes",
    "merge_dim_games",
    "stg_dimension",
    "stg_games",
    "stg_popscore",
    "stg_popularity_types",
]
