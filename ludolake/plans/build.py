"""From the landing zone to the marts."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import run_date
from ..operators.quality import Check, run_checks
from ..sources.landing import read_json_lines
from ..sources.manifest import Manifest
from ..sources.registry import entity
from ..sources.buckets import Buckets
from ..sources.snapshots import Snapshots
from .dimension import DIM_GAMES, dim_games, merge_dim_games
from .marts import all_marts
from .popularity import fct_game_popularity, stg_popscore
from .quality import CHECKS
from .staging import BRIDGES, NAME_ARRAYS, bridge, stg_dimension, stg_games


def read_raw(spark: SparkSession, root: str, name: str, dt: str | None = None) -> DataFrame:
    """Landed rows of an entity, by its manifest; of one date where it is dated."""
    files = Manifest(spark, root).files(name, dt)
    return read_json_lines(spark, files, entity(name).schema)


def read_scores(spark: SparkSession, root: str) -> DataFrame:
    """Score rows of the newest landed date, whichever it is."""
    return read_raw(spark, root, "popscore", Manifest(spark, root).latest_date("popscore"))


def staging_models(spark: SparkSession, root: str, dt: str) -> dict[str, DataFrame]:
    """The staging models and bridges of one run.

    Games are those landed on ``dt``; scores are of their newest date.
    """
    dimensions = [dim for _, dim in NAME_ARRAYS.values()] + ["popularity_types"]
    models = {f"stg_{d}": stg_dimension(d, read_raw(spark, root, d)) for d in dimensions}
    models["stg_games"] = stg_games(read_raw(spark, root, "games", dt))
    models["stg_popscore"] = stg_popscore(
        read_scores(spark, root), models["stg_popularity_types"]
    )
    return models


def materialize(tables: Snapshots, name: str, df: DataFrame, as_view: bool = False) -> DataFrame:
    """Keep a model as a written table, or only as a temporary view for development."""
    if as_view:
        df.createOrReplaceTempView(name)
        return df
    return tables.replace(name, df)


def build_all(
    spark: SparkSession,
    root: str,
    dt: str | None = None,
    as_of: datetime | None = None,
    full_refresh: bool = False,
    as_views: bool = False,
    keep_versions: int | None = None,
    every_model: bool = False,
) -> dict[str, DataFrame]:
    """Write dim_games, fct_game_popularity and the marts; return the models by name.

    ``stg_games`` is written first, since the dimension and every bridge read
    it. The dimension is kept in buckets of its key and merges the day's games into
    those they fall into, unless ``full_refresh`` starts it anew. ``as_views`` writes nothing and names the
    models as temporary views, staging models and bridges among them; ``every_model``
    writes these as tables too. ``keep_versions`` deletes older versions of the
    written tables at the end.
    """
    dt = dt or run_date()
    as_of = as_of or datetime.now(timezone.utc)
    tables = Snapshots(spark, root)
    if full_refresh and not Manifest(spark, root).files("games", dt):
        raise ValueError(f"no games landed for {dt}: a full refresh would empty the dimension")
    models = staging_models(spark, root, dt)

    built = {"stg_games": materialize(tables, "stg_games", models["stg_games"], as_views)}
    if every_model or as_views:
        models.update({name: bridge(name, built["stg_games"]) for name in BRIDGES})
        for name, model in models.items():
            if name != "stg_games":
                built[name] = materialize(tables, name, model, as_views)
    dimensions = {dim: models[f"stg_{dim}"] for _, dim in NAME_ARRAYS.values()}
    new = dim_games(built["stg_games"], dimensions)
    keyed = Buckets(spark, root)
    if as_views:
        if not full_refresh:
            new = merge_dim_games(keyed.read("dim_games", DIM_GAMES), new)
        built["dim_games"] = materialize(tables, "dim_games", new, as_view=True)
    elif full_refresh:
        built["dim_games"] = keyed.replace("dim_games", new, "game_id")
    else:
        built["dim_games"] = keyed.upsert("dim_games", new, "game_id", "updated_at")
    # The fact needs no labels, so it reads the scores without the join.
    built["fct_game_popularity"] = materialize(
        tables, "fct_game_popularity", fct_game_popularity(read_scores(spark, root)), as_views
    )
    marts = all_marts(built["dim_games"], built["fct_game_popularity"], as_of)
    for name, mart in marts.items():
        built[name] = materialize(tables, name, mart, as_views)
    if keep_versions and not as_views:
        for name in built:
            (keyed if name == "dim_games" else tables).expire(name, keep_versions)
    return built


def check_all(
    spark: SparkSession, root: str, dt: str | None = None, checks: list[Check] = CHECKS
) -> DataFrame:
    """Run the declared checks on the staged models and the written tables."""
    tables = Snapshots(spark, root)
    models = staging_models(spark, root, dt or run_date())
    models["stg_games"] = tables.read("stg_games")
    models["dim_games"] = Buckets(spark, root).read("dim_games", DIM_GAMES)
    for name in BRIDGES:
        models[name] = bridge(name, models["stg_games"])
    return run_checks(models, checks)
