"""The eight ranked marts.

``dim`` is dim_games, ``fact`` is fct_game_popularity; both are read more than
once by some marts, so pass tables. Every ranking ends with ``game_id`` so that
ties always fall the same way.

The thresholds, weights, row limits and column lists below are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import epoch_of
from ..functions.scores import bayesian_rating, guarded_ratio, inverted, weighted_score
from ..operators.order import (
    SMALL_ROWS,
    exact_percentile,
    percentile_buckets,
    top_n,
    value_counts,
)
from ..session import stage

# Columns every game card shows.
_CARD = ["first_release_date", "game_summary", "cover", "url"]


def _desc(name: str) -> Column:
    return F.col(name).desc_nulls_last()


@dataclass(frozen=True)
class Ranking:
    """The first ``n`` of ``rows`` by ``order``, to be shown with the columns of ``output``.

    ``rows`` has ``game_id`` and what the order needs. The ranking works on narrow rows;
    texts and name arrays are fetched from the dimension for the winners only.
    """

    rows: DataFrame
    n: int
    order: list[str]
    output: list[str]

    def by(self) -> list[Column]:
        return [*[_desc(c) for c in self.order], F.col("game_id").asc()]

    def winners(self, dim: DataFrame) -> DataFrame:
        """At most ``n`` rows with what the dimension does not hold, and the order."""
        held = [c for c in dim.columns if c not in ("game_id", *self.order)]
        kept = [c for c in dict.fromkeys(["game_id", *self.order, *self.output]) if c in self.rows.columns and c not in held]
        return top_n(self.rows.select(*kept), self.n, *self.by())

    def completed(self, winners: DataFrame, dim: DataFrame) -> DataFrame:
        """The mart, from its winners and a dimension that has their rows."""
        missing = [c for c in self.output if c not in winners.columns]
        complete = dim.select("game_id", *missing).join(F.broadcast(winners), "game_id")
        return top_n(complete, self.n, *self.by()).select(*self.output)

    def mart(self, dim: DataFrame) -> DataFrame:
        return self.completed(self.winners(dim), dim)


def recent_games(dim: DataFrame, as_of: datetime, n: int = 50) -> DataFrame:
    """Latest releases up to ``as_of``.

    The stored epoch is compared as it is, so the filter reaches the scan.
    """
    return _recent(dim, as_of, n).mart(dim)


def _recent(dim: DataFrame, as_of: datetime, n: int = 50) -> Ranking:
    released = dim.where(F.col("first_release_date") <= epoch_of(as_of))
    return Ranking(
        released,
        n,
        ["first_release_date"],
        [
            "game_name",
            "first_release_date",
            "platform_names",
            "genre_names",
            "game_summary",
            "cover",
            "url",
        ],
    )


def top_hyped(dim: DataFrame, as_of: datetime, n: int = 50) -> DataFrame:
    """Most anticipated games that are unreleased at ``as_of`` or have no date."""
    return _hyped(dim, as_of, n).mart(dim)


def _hyped(dim: DataFrame, as_of: datetime, n: int = 50) -> Ranking:
    release = F.col("first_release_date")
    upcoming = dim.where((F.col("hypes") > 0) & (release.isNull() | (release > epoch_of(as_of))))
    return Ranking(
        upcoming,
        n,
        ["hypes"],
        [
            "game_name",
            "hypes",
            "aggregated_rating",
            "aggregated_rating_count",
            "platform_names",
            "genre_names",
            "game_summary",
            "cover",
            "url",
        ],
    )


def rating_stats(dim: DataFrame) -> DataFrame:
    """One row: mean rating and the lower quartile of vote counts, over games with any vote.

    Both come from one pass that sums the ratings per vote count.
    """
    voted = dim.where(
        F.col("aggregated_rating").isNotNull() & (F.col("aggregated_rating_count") > 0)
    )
    counts = value_counts(
        voted, "aggregated_rating_count", F.sum("aggregated_rating").alias("ratings")
    )
    mean = counts.agg((F.sum("ratings") / F.sum("_rows")).alias("mean_rating"))
    prior = exact_percentile(counts, 0.25, "min_votes_threshold")
    return mean.crossJoin(F.broadcast(prior))


def top_rated(dim: DataFrame, n: int = 50, min_votes: int = 5) -> DataFrame:
    """Bayesian average rating of games with at least ``min_votes`` votes."""
    return _rated(dim, n, min_votes).mart(dim)


def _rated(dim: DataFrame, n: int = 50, min_votes: int = 5) -> Ranking:
    rated = dim.where(
        F.col("aggregated_rating").isNotNull() & (F.col("aggregated_rating_count") >= min_votes)
    )
    score = bayesian_rating(
        F.col("aggregated_rating"),
        F.col("aggregated_rating_count"),
        F.col("mean_rating"),
        F.col("min_votes_threshold"),
    )
    weighted = rated.crossJoin(F.broadcast(rating_stats(dim))).withColumn("weighted_rating", score)
    return Ranking(
        weighted,
        n,
        ["weighted_rating", "aggregated_rating_count"],
        [
            "game_name",
            "aggregated_rating",
            "aggregated_rating_count",
            "weighted_rating",
            "genre_names",
            "first_release_date",
            "cover",
            "url",
        ],
    )


def theme_trends(dim: DataFrame, n: int = 50) -> DataFrame:
    """Games per theme; an unknown theme counts under NULL."""
    themes = dim.select(F.explode("theme_names").alias("theme"))
    counted = themes.groupBy("theme").agg(F.count(F.lit(1)).alias("count"))
    return top_n(counted, n, _desc("count"), F.col("theme").asc_nulls_last())


def _with_game(fact: DataFrame, dim: DataFrame, *columns: str) -> DataFrame:
    """Fact rows with the dimension columns the ranking needs; rows without a game drop out."""
    return fact.join(dim.select("game_id", *columns), "game_id")


def _having(fact: DataFrame, *metrics: str) -> DataFrame:
    """Rows that have every named metric, as filters a scan can take."""
    return reduce(lambda rows, name: rows.where(F.col(name).isNotNull()), metrics, fact)


def trending_now(dim: DataFrame, fact: DataFrame, n: int = 100) -> DataFrame:
    """Games being played most, with some history of being played."""
    return _trending(dim, fact, n).mart(dim)


def _trending(dim: DataFrame, fact: DataFrame, n: int = 100) -> Ranking:
    active = _having(fact, "playing", "played").where(
        (F.col("playing_percentile") >= 50) & (F.col("played_percentile") >= 20)
    )
    return Ranking(
        _with_game(active, dim),
        n,
        ["playing_percentile", "playing"],
        [
            "game_name",
            "playing",
            "played",
            "playing_percentile",
            "played_percentile",
            "igdb_total_engagement",
            "steam_positive_reviews",
            "cross_platform_score",
            "aggregated_rating",
            "platform_names",
            "genre_names",
            *_CARD,
        ],
    )


def controversial_games(dim: DataFrame, fact: DataFrame, n: int = 100) -> DataFrame:
    """Games with many negative and many positive reviews."""
    return _controversial(dim, fact, n).mart(dim)


def _controversial(dim: DataFrame, fact: DataFrame, n: int = 100) -> Ranking:
    negative = F.col("negative_reviews_percentile")
    positive = F.col("positive_reviews_percentile")
    total = F.col("total_reviews_percentile")
    divided = (
        _having(
            fact, "steam_negative_reviews", "steam_total_reviews", "steam_positive_reviews"
        )
        .where((negative >= 40) & (positive >= 30) & (total >= 30))
        .withColumn(
            "controversy_score",
            weighted_score([(negative, 0.50), (positive, 0.30), (total, 0.20)]),
        )
    )
    return Ranking(
        _with_game(divided, dim),
        n,
        ["controversy_score", "steam_total_reviews"],
        [
            "game_name",
            "controversy_score",
            "steam_negative_reviews",
            "steam_positive_reviews",
            "steam_total_reviews",
            "negative_reviews_percentile",
            "positive_reviews_percentile",
            "total_reviews_percentile",
            "igdb_total_engagement",
            "aggregated_rating",
            "platform_names",
            "genre_names",
            *_CARD,
        ],
    )


def hidden_gems(dim: DataFrame, fact: DataFrame, n: int = 100) -> DataFrame:
    """Well-rated games that few engage with.

    Engagement and the percentiles are never NULL in the fact, so only the
    rating needs a default.
    """
    return _gems(dim, fact, n).mart(dim)


def _gems(dim: DataFrame, fact: DataFrame, n: int = 100) -> Ranking:
    positive = F.col("positive_reviews_percentile")
    engagement = F.col("engagement_percentile")
    total = F.col("total_reviews_percentile")
    rating = F.col("aggregated_rating")
    quiet = fact.where(
        (engagement <= 50) & (total <= 60) & (F.col("negative_reviews_percentile") <= 40)
    )
    gems = (
        _with_game(quiet, dim, "aggregated_rating")
        .where((positive >= 50) | (rating >= 75))
        .withColumn(
            "hidden_score",
            weighted_score(
                [
                    (positive, 0.40),
                    (F.coalesce(rating, F.lit(75.0)), 0.30),
                    (inverted(engagement), 0.20),
                    (inverted(total), 0.10),
                ]
            ),
        )
    )
    return Ranking(
        gems,
        n,
        ["hidden_score", "aggregated_rating", "positive_reviews_percentile"],
        [
            "game_name",
            "hidden_score",
            "steam_positive_reviews",
            "steam_negative_reviews",
            "steam_total_reviews",
            "positive_reviews_percentile",
            "total_reviews_percentile",
            "engagement_percentile",
            "igdb_total_engagement",
            "cross_platform_score",
            "aggregated_rating",
            "aggregated_rating_count",
            "platform_names",
            "genre_names",
            *_CARD,
        ],
    )


def rising_stars(
    dim: DataFrame, fact: DataFrame, n: int = 100, small_rows: int = SMALL_ROWS
) -> DataFrame:
    """Games gaining players.

    Twitch and velocity are ranked among all games being played, before games
    missing from the dimension drop out and before the activity threshold.
    """
    return _rising(dim, fact, n, small_rows).mart(dim)


def _rising(
    dim: DataFrame, fact: DataFrame, n: int = 100, small_rows: int = SMALL_ROWS
) -> Ranking:
    moving = _having(fact, "playing").withColumn(
        "velocity_ratio", guarded_ratio(F.col("playing"), F.col("played"))
    )
    ranked = percentile_buckets(
        moving,
        "game_id",
        {
            "twitch_percentile": F.coalesce("twitch_24hr_hours_watched", F.lit(0.0)),
            "velocity_percentile": F.col("velocity_ratio"),
        },
        small_rows=small_rows,
    )
    rising = _with_game(
        ranked.where(F.col("playing_percentile") >= 30),
        dim,
        "aggregated_rating",
        "first_release_date",
    ).withColumn(
        "rising_score",
        weighted_score(
            [
                (F.col("playing_percentile"), 0.30),
                (F.col("velocity_percentile"), 0.25),
                (F.col("engagement_percentile"), 0.05),
                (F.col("positive_reviews_percentile"), 0.15),
                (F.col("twitch_percentile"), 0.10),
                (F.coalesce("aggregated_rating", F.lit(75.0)), 0.15),
            ]
        ),
    )
    return Ranking(
        rising,
        n,
        ["rising_score", "first_release_date", "playing_percentile"],
        [
            "game_name",
            "rising_score",
            "playing_percentile",
            "velocity_percentile",
            "engagement_percentile",
            "velocity_ratio",
            "positive_reviews_percentile",
            "twitch_percentile",
            "cross_platform_score",
            "steam_positive_reviews",
            "steam_total_reviews",
            "playing",
            "played",
            "igdb_total_engagement",
            "aggregated_rating",
            "platform_names",
            "genre_names",
            *_CARD,
        ],
    )


def all_marts(dim: DataFrame, fact: DataFrame, as_of: datetime) -> dict[str, DataFrame]:
    """All eight marts by name.

    The winners of the seven rankings are found first, on narrow rows, and staged
    together. Their ids, some hundred at most, then filter the one wide scan of the
    dimension, where a table sorted by id skips most row groups.
    """
    rankings = {
        "mart_recent_games": _recent(dim, as_of),
        "mart_top_hyped": _hyped(dim, as_of),
        "mart_top_rated": _rated(dim),
        "mart_trending_now": _trending(dim, fact),
        "mart_controversial_games": _controversial(dim, fact),
        "mart_hidden_gems": _gems(dim, fact),
        "mart_rising_stars": _rising(dim, fact),
    }
    parts = {name: r.winners(dim) for name, r in rankings.items()}
    named = [rows.withColumn("_mart", F.lit(name)) for name, rows in parts.items()]
    winners = stage(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named), "winners")
    wide = games_of(dim, winners)
    marts = {
        name: r.completed(winners.where(F.col("_mart") == name).select(*parts[name].columns), wide)
        for name, r in rankings.items()
    }
    return {**marts, "mart_theme_trends": theme_trends(dim)}


def games_of(dim: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows of ``dim`` that ``winners``, the top rows of some marts, name; read once and staged."""
    ids = [row.game_id for row in winners.select("game_id").distinct().collect()]
    return stage(dim.where(F.col("game_id").isin(ids)), "shown")
