"""The game model derived from the driver's tables.

A customer stands for a game, its orders give the ratings, dates and id arrays,
nations and regions are the dimensions, and events are popularity scores.
Money is summed in whole cents and ratings are multiples of 1/64, so that sums
do not depend on the order of the rows.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import METRICS
from ..sources import schemas

AS_OF = datetime(1997, 1, 1, tzinfo=timezone.utc)

# External source of each popularity type.
TYPE_SOURCES = {1: 121, 2: 121, 3: 121, 4: 121, 5: 1, 6: 1, 7: 1, 8: 1, 9: 1, 10: 1, 34: 6}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch(column: str) -> Column:
    """Epoch seconds of a timestamp without zone."""
    return F.expr(_seconds(column))


def _seconds(column: str) -> str:
    return f"cast(timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {column}) AS bigint)"


def _id_mask(ids: str, name: str) -> Column:
    """Small ids of a group as a bit set, which stays in generated code."""
    return F.expr(f"bit_or(shiftleft(1L, cast({ids} AS int))) AS {name}")


def _mask_ids(mask: str) -> str:
    return (
        f"CASE WHEN {mask} IS NOT NULL THEN filter(sequence(0L, 26L), "
        f"i -> (shiftright({mask}, cast(i AS int)) & 1L) = 1L) END"
    )


def raw_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg(
            F.expr("count(*) AS n_orders"),
            F.expr("sum(cast(round(o_totalprice * 100) AS bigint)) AS cents"),
            F.expr("count_if(o_orderstatus = 'O') AS n_open"),
            F.expr("min(o_orderdate) AS first_order"),
            F.expr("max(o_orderdate) AS last_order"),
            _id_mask("o_orderkey % 27", "platform_mask"),
            _id_mask("substr(o_orderpriority, 1, 1)", "genre_mask"),
            _id_mask(
                "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END", "mode_mask"
            ),
            _id_mask("year(o_orderdate) - 1995", "theme_mask"),
        )
    )
    rating = "floor(cast(cents AS double) / (n_orders * 500000) * 64) / 64"
    values = {
        "id": "c_custkey",
        "name": "c_name",
        "slug": "lower(replace(c_name, '#', '-'))",
        "summary": "nullif(c_mktsegment, 'BUILDING')",
        "game_type": "c_nationkey % 5",
        "cover": "c_nationkey",
        "url": "concat('https://example.org/games/', c_custkey)",
        "created_at": _seconds("first_order"),
        "updated_at": f"coalesce({_seconds('last_order')}, 0L)",
        "genres": _mask_ids("genre_mask"),
        "platforms": _mask_ids("platform_mask"),
        "game_modes": _mask_ids("mode_mask"),
        "player_perspectives": "CASE WHEN c_custkey % 11 = 0 THEN cast(array() AS array<bigint>) "
        "ELSE array(cast(c_nationkey % 7 AS bigint)) END",
        "themes": _mask_ids("theme_mask"),
        "first_release_date": _seconds("first_order"),
        "hypes": "nullif(n_open, 0L)",
        "aggregated_rating": f"CASE WHEN n_orders > 0 THEN least(100D, {rating}) END",
        "aggregated_rating_count": "n_orders",
    }
    customers = table(spark, sf_dir, "customer")
    joined = customers.join(orders, customers.c_custkey == orders.o_custkey, "left")
    return joined.selectExpr(
        *[
            f"cast({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
            for f in schemas.GAMES.fields
        ]
    )


def _dimension(rows: DataFrame, number: str, name: str) -> DataFrame:
    return rows.select(F.col(number).cast("long").alias("id"), F.col(name).alias("name"))


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """Ids 25 and 26 of platforms, 5 of genres and 5 and 6 of perspectives are unknown."""
    nations = _dimension(table(spark, sf_dir, "nation"), "n_nationkey", "n_name")
    regions = _dimension(table(spark, sf_dir, "region"), "r_regionkey", "r_name")
    return {
        "platforms": nations,
        "genres": regions,
        "game_modes": regions,
        "themes": nations,
        "player_perspectives": regions,
    }


def metric_code() -> Column:
    """Popularity type of an event, from the number in its properties."""
    number = F.get_json_object("props", "$.k").cast("int")
    codes = F.array(*[F.lit(code).cast("long") for code in METRICS])
    return F.element_at(codes, number % len(METRICS) + 1)


def raw_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("game_id"),
        metric_code().alias("popularity_type"),
        "value",
    )


def dated_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scores with the date of their event."""
    events = table(spark, sf_dir, "events")
    day = F.date_format(F.col("ts").cast("date"), "yyyy-MM-dd")
    return events.select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("game_id"),
        metric_code().alias("popularity_type"),
        "value",
        day.alias("dt"),
    )


def popularity_types(spark: SparkSession) -> DataFrame:
    rows = ", ".join(
        f"({code}L, '{name}', {TYPE_SOURCES[code]}L)" for code, name in METRICS.items()
    )
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(id, name, external_popularity_source)")


def events_as_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versions of a user's record: key user_id, version updated_at."""
    return table(spark, sf_dir, "events").select(
        "user_id", epoch("ts").alias("updated_at"), "event_id", "event_type", "value"
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a run log; seconds are quarters, so their sums are exact."""
    mode = F.when(F.col("event_id") % 2 == 0, "sequential").otherwise("concurrent")
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("entity_name"),
        mode.alias("mode"),
        (F.get_json_object("props", "$.k").cast("long") * 37).alias("record_count"),
        (F.floor(F.col("value") * 4) / 4).alias("elapsed_seconds"),
    )
