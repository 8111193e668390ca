"""The queries behind a catalogue page: totals, mart rows and search."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_date
from ..operators.grams import gram_table, grams_of, having_all
from ..operators.order import top_n
from ..session import at_most, stage

# The order each mart was ranked by, which a file read does not keep.
MART_ORDER = {
    "mart_recent_games": ["first_release_date"],
    "mart_top_hyped": ["hypes"],
    "mart_top_rated": ["weighted_rating", "aggregated_rating_count"],
    "mart_theme_trends": ["count"],
    "mart_trending_now": ["playing_percentile", "playing"],
    "mart_controversial_games": ["controversy_score", "steam_total_reviews"],
    "mart_hidden_gems": ["hidden_score", "aggregated_rating", "positive_reviews_percentile"],
    "mart_rising_stars": ["rising_score", "first_release_date", "playing_percentile"],
}


def summary_metrics(dim: DataFrame) -> DataFrame:
    """One row: number of games, and the latest update (NULL for no games)."""
    return dim.agg(
        F.count(F.lit(1)).alias("total_games"),
        F.timestamp_seconds(F.max("updated_at")).alias("last_updated"),
    )


def fetch_mart(name: str, mart: DataFrame, limit: int = 10) -> DataFrame:
    """First rows of a mart in its own ranking."""
    label = "theme" if name == "mart_theme_trends" else "game_name"
    order = [F.col(c).desc_nulls_last() for c in MART_ORDER[name]]
    # Ties as the marts break them: by game, where they have it.
    tie = "game_id" if "game_id" in mart.columns else label
    return top_n(mart, limit, *order, F.col(tie).asc_nulls_last())


def name_grams(dim: DataFrame) -> DataFrame:
    """The inverted table of game names that ``search_games`` may use; keep it as a table beside ``dim``."""
    return gram_table(dim, "game_id", "game_name")


def search_games(
    dim: DataFrame, term: str | None, limit: int = 100, grams: DataFrame | None = None
) -> DataFrame:
    """Games whose name contains ``term`` in any case, latest release first.

    ``%`` and ``_`` in the term match as wildcards. No term finds nothing. With
    ``grams``, the table of ``name_grams``, only games that have all grams of the term
    are read from ``dim``; a term of less than three letters scans all names.
    """
    card = ["game_name", "release_year", "platform_names", "genre_names", "game_summary"]
    rows = dim.withColumn("release_year", F.year(epoch_date(F.col("first_release_date"))))
    if not term:
        return rows.select(*card).limit(0)
    pattern = term.strip().replace("\\", "\\\\")  # a backslash is a character, not an escape
    wanted = grams_of(dim.sparkSession, term.strip()) if grams is not None else []
    if wanted:
        rows = _these(rows, stage(having_all(grams, "game_id", wanted), "found"))
    found = rows.where(F.col("game_name").ilike(f"%{pattern}%"))
    return top_n(
        found, limit, F.col("first_release_date").desc_nulls_last(), F.col("game_id").asc()
    ).select(*card)


def _these(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows of some games: few ids as a filter that reaches the scan, more of them by a join."""
    if at_most(keys, FEW_GAMES):
        return rows.where(F.col("game_id").isin([row.game_id for row in keys.collect()]))
    return rows.join(keys, "game_id", "left_semi")


#: So many ids are sent to the scan.
FEW_GAMES = 1_000
