"""Popularity metric codes and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Public popularity type codes and the mart column each one fills.
METRICS = {
    1: "visits",
    2: "want_to_play",
    3: "playing",
    4: "played",
    5: "steam_24hr_peak_players",
    6: "steam_positive_reviews",
    7: "steam_negative_reviews",
    8: "steam_total_reviews",
    9: "steam_global_top_sellers",
    10: "steam_most_wishlisted",
    34: "twitch_24hr_hours_watched",
}

# Which codes count as engagement on the catalogue, Steam or Twitch.
CATALOGUE_CODES = [1, 2, 3, 4]
STEAM_CODES = [5, 6, 7, 8, 9, 10]
TWITCH_CODES = [34]

FLAGS = {
    "has_igdb_data": CATALOGUE_CODES,
    "has_steam_data": STEAM_CODES,
    "has_twitch_data": TWITCH_CODES,
}

# External source ids and their names.
SOURCES = {121: "IGDB", 1: "Steam", 6: "Twitch"}

# Category of each code.
CATEGORIES = {
    "User Engagement": [1, 2, 3, 4],
    "Steam Metrics": [5, 6, 7, 8],
    "Steam Wishlist": [9, 10],
    "Streaming": [34],
}


def _first_match(branches: list[tuple[Column, str]], default: str) -> Column:
    label = F.lit(default)
    for condition, text in reversed(branches):
        label = F.when(condition, F.lit(text)).otherwise(label)
    return label


def source_label(source_id: Column) -> Column:
    """Name of an external source; anything unlisted, NULL included, is Unknown."""
    return _first_match([(source_id == i, name) for i, name in SOURCES.items()], "Unknown")


def metric_category(code: Column) -> Column:
    """Category of a popularity type code."""
    return _first_match([(code.isin(codes), name) for name, codes in CATEGORIES.items()], "Other")
