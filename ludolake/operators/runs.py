"""Rollups over a run log: (entity_name, mode, record_count, elapsed_seconds, ...)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PAGE_SIZE = 500


def _rate(records: Column, seconds: Column) -> Column:
    return F.when(seconds > 0, F.round(records / seconds, 2)).otherwise(F.lit(0.0))


def run_totals(runs: DataFrame) -> DataFrame:
    """Records and seconds over all runs; zeros for an empty log."""
    return runs.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.round(F.coalesce(F.sum("elapsed_seconds"), F.lit(0.0)), 2).alias("total_seconds"),
    )


def run_rates(runs: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Each run with its records per second and the number of pages it fetched."""
    records, seconds = F.col("record_count"), F.col("elapsed_seconds")
    return runs.withColumns(
        {
            "records_per_second": _rate(records, seconds),
            "api_calls": F.ceil(records / F.lit(page_size)),
        }
    )


def mode_summary(runs: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """Totals and average throughput per mode."""
    totals = (
        run_rates(runs, page_size)
        .groupBy("mode")
        .agg(
            F.sum("record_count").alias("total_records"),
            F.sum("elapsed_seconds").alias("_seconds"),
            F.sum("api_calls").alias("total_api_calls"),
        )
    )
    return totals.select(
        "mode",
        "total_records",
        F.round("_seconds", 2).alias("total_elapsed_seconds"),
        "total_api_calls",
        _rate(F.col("total_records"), F.col("_seconds")).alias("records_per_second"),
    )


def compare_modes(runs: DataFrame) -> DataFrame:
    """Sequential against concurrent seconds per entity, for entities run both ways."""

    def seconds(mode: str) -> Column:
        return F.sum(F.when(F.col("mode") == mode, F.col("elapsed_seconds")))

    return (
        runs.groupBy("entity_name")
        .agg(
            seconds("sequential").alias("sequential_elapsed"),
            seconds("concurrent").alias("concurrent_elapsed"),
            F.sum(F.when(F.col("mode") == "sequential", F.col("record_count"))).alias(
                "record_count"
            ),
        )
        .dropna(subset=["sequential_elapsed", "concurrent_elapsed"])
        .withColumn("speedup", _rate(F.col("sequential_elapsed"), F.col("concurrent_elapsed")))
    )


def speedup_summary(comparisons: DataFrame) -> DataFrame:
    """Totals, total speed-up and mean speed-up over the compared entities."""
    return comparisons.agg(
        F.sum("record_count").alias("total_records"),
        F.sum("sequential_elapsed").alias("total_sequential"),
        F.sum("concurrent_elapsed").alias("total_concurrent"),
        F.round(F.avg("speedup"), 2).alias("average_speedup"),
    ).withColumn("total_speedup", _rate(F.col("total_sequential"), F.col("total_concurrent")))
