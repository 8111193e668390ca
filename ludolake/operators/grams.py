"""Substring search by an inverted table of three-letter grams.

A text that contains a term contains all grams of the term. The table has one row for
each gram and key and is sorted by gram, so a search reads the row groups of its few
grams and no others; what all of them share are candidates, which the exact match then
verifies. A gram that a third of all texts have is many rows, never one list.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3
#: Letters of a long text that are looked at together.
_PIECE = 256


def _grams(text: Column) -> Column:
    last = F.length(text) - (GRAM - 1)
    each = F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.substr(text, i, F.lit(GRAM)))
    return F.array_distinct(F.when(last >= 1, each).otherwise(F.array().cast("array<string>")))


def gram_rows(df: DataFrame, key: str, text: str) -> DataFrame:
    """(gram, key), once each, of the lower-cased texts; NULL texts and those below three letters have none."""
    low = F.lower(text)
    starts = F.sequence(F.lit(1), F.greatest(F.length(low), F.lit(1)), F.lit(_PIECE))
    pieces = F.transform(starts, lambda at: F.substr(low, at, F.lit(_PIECE + GRAM - 1)))
    rows = df.where(F.col(text).isNotNull()).select(F.col(key), F.explode(pieces).alias("_piece"))
    return rows.select(F.explode(_grams(F.col("_piece"))).alias("gram"), key).distinct()


def gram_table(df: DataFrame, key: str, text: str) -> DataFrame:
    """``gram_rows`` in the order in which they are to be written."""
    return gram_rows(df, key, text).repartitionByRange("gram", key).sortWithinPartitions("gram", key)


def grams_of(spark: SparkSession, pattern: str) -> list[str]:
    """The grams that every match of a LIKE pattern has; none if its literal runs are too short."""
    runs = [run for run in re.split("[%_]", pattern) if len(run) >= GRAM]
    if not runs:
        return []
    found = spark.range(1).select(F.explode(F.concat(*[_grams(F.lower(F.lit(run))) for run in runs])).alias("gram"))
    return sorted({row.gram for row in found.collect()})


def having_all(table: DataFrame, key: str, grams: list[str]) -> DataFrame:
    """The keys that have every one of ``grams``."""
    hits = table.where(F.col("gram").isin(grams)).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return hits.where(F.col("_n") == len(grams)).select(key)
