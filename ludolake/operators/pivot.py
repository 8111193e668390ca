"""Long popularity rows to one wide row per game."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import CATALOGUE_CODES, FLAGS, METRICS


def _list(codes: list[int]) -> str:
    return ", ".join(map(str, codes))


def pivot_metrics(scores: DataFrame) -> DataFrame:
    """One row per game: 11 metrics, engagement, source flags, counts.

    Every aggregate has a map-side partial, the distinct count included, so a
    game with a third of all rows shrinks to a few rows per task before the
    shuffle.
    """
    metrics = [
        F.expr(f"max(value) FILTER (WHERE popularity_type = {code}) AS {name}")
        for code, name in METRICS.items()
    ]
    flags = [
        F.expr(f"max(CASE WHEN popularity_type IN ({_list(codes)}) THEN 1 ELSE 0 END) AS {name}")
        for name, codes in FLAGS.items()
    ]
    wide = scores.groupBy("game_id").agg(
        *metrics, *flags, F.count_distinct("popularity_type").alias("available_metrics_count")
    )
    engagement = " + ".join(f"coalesce({METRICS[code]}, 0D)" for code in CATALOGUE_CODES)
    return wide.selectExpr(
        "game_id",
        *METRICS.values(),
        f"{engagement} AS igdb_total_engagement",
        *FLAGS,
        "available_metrics_count",
        f"{' + '.join(FLAGS)} AS cross_platform_score",
    )
