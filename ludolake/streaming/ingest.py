"""Incremental ingest of newly landed files into a keyed table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..sources.landing import parsed
from ..sources.buckets import Buckets
from ..sources.snapshots import Snapshots


def ingest_available(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    tables: Snapshots | Buckets,
    table: str,
    key: str,
    order: str,
    checkpoint: str,
    max_files: int | None = None,
) -> DataFrame:
    """Merge all files that landed since the last call; return the table.

    The stream's checkpoint remembers the files it has seen. A batch is named
    in the commit it makes, so a batch repeated after a crash is skipped, and
    merging keeps the latest row per key, so re-read overlap does no harm. Tables in
    buckets rewrite only the buckets a batch meets.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        source = f"{checkpoint}#{batch_id}"
        if not tables.applied(table, source):
            tables.upsert(table, batch, key, order, source)

    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        parsed(reader.text(landing), schema)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return tables.read(table, schema)
