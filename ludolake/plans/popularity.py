"""Popularity scores: labelled long rows, and the wide fact with percentiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import METRICS, metric_category, source_label
from ..operators.arrays import SMALL_DIMENSION
from ..operators.order import SMALL_ROWS, percentile_buckets
from ..operators.pivot import pivot_metrics
from ..session import at_most, stage


def wanted_scores(raw: DataFrame) -> DataFrame:
    """Score rows of the known popularity types, with the columns the models use."""
    return raw.where(F.col("popularity_type").isin(list(METRICS))).select(
        "id", "game_id", "popularity_type", "value"
    )


def stg_popscore(scores: DataFrame, types: DataFrame) -> DataFrame:
    """Score rows with the name, source and category of their type.

    ``types`` is broadcast if it has few rows; the few codes would make a very
    uneven shuffle. Otherwise the join is left to Catalyst's skew handling.
    """
    named = types.select(
        F.col("id").alias("popularity_type"),
        F.col("name").alias("popularity_type_name"),
        "external_popularity_source",
    )
    if at_most(named, SMALL_DIMENSION):
        named = F.broadcast(named)
    return scores.join(named, "popularity_type", "left").select(
        "id",
        "game_id",
        "popularity_type",
        "value",
        "popularity_type_name",
        "external_popularity_source",
        source_label(F.col("external_popularity_source")).alias("data_source"),
        metric_category(F.col("popularity_type")).alias("metric_category"),
    )


def fct_game_popularity(scores: DataFrame, small_rows: int = SMALL_ROWS) -> DataFrame:
    """One wide row per game with six percentile ranks; a missing metric ranks as 0."""
    wide = stage(pivot_metrics(scores), "popularity")

    def zeroed(name: str):
        return F.coalesce(F.col(name), F.lit(0.0))

    return percentile_buckets(
        wide,
        "game_id",
        {
            "positive_reviews_percentile": zeroed("steam_positive_reviews"),
            "negative_reviews_percentile": zeroed("steam_negative_reviews"),
            "total_reviews_percentile": zeroed("steam_total_reviews"),
            "engagement_percentile": F.col("igdb_total_engagement"),
            "playing_percentile": zeroed("playing"),
            "played_percentile": zeroed("played"),
        },
        small_rows=small_rows,
    )
