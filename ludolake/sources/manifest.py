"""Which files of the landing zone count, per entity and date.

Every load appends one row that names what it landed: the folder of the load, or
single files. What stands in a folder is listed by the scan that reads it, so the
log does not grow with the files. The manifest and each entry's status follow from
the rows. A load that replaces (a full refresh, or any load of a time series
date) starts its manifest anew; any other load adds to it.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import iso_timestamp
from .logs import Log
from .registry import ENTITIES, TIME_SERIES, raw_path

# Dimensions have one manifest whatever the date of the load.
NO_DATE = "none"

LOG = (
    "entity string, dt string, files array<string>, record_count long, "
    "full_refresh boolean, time_series boolean, extracted_at timestamp"
)


def current_files(loads: DataFrame) -> DataFrame:
    """(entity, dt, files, total_count, created_at, updated_at, batch_count) from the loads.

    A file listed by several loads is kept once.
    """
    restarts = F.when(F.col("full_refresh") | F.col("time_series"), F.col("seq"))
    since = F.coalesce(F.max(restarts).over(Window.partitionBy("entity", "dt")), F.lit(0))
    return (
        loads.withColumn("_since", since)
        .where("seq >= _since")
        .groupBy("entity", "dt")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("files")))).alias("files"),
            F.sum("record_count").alias("total_count"),
            F.min("extracted_at").alias("created_at"),
            F.max("extracted_at").alias("updated_at"),
        )
        .withColumn("batch_count", F.size("files").cast("long"))
    )


def file_status(loads: DataFrame, landed: DataFrame | None = None) -> DataFrame:
    """(entity, dt, file, status) of every listed file.

    ``outdated`` once a later full refresh of the entity, or a later load of
    the same time series date, has replaced it; else ``final``. With
    ``landed`` (entity, dt, file), files no load has listed are ``temp``.
    """
    refresh = F.when(F.col("full_refresh") & ~F.col("time_series"), F.col("seq"))
    same_date = F.when(F.col("time_series"), F.col("seq"))
    replaced = F.greatest(
        F.max(refresh).over(Window.partitionBy("entity")),
        F.max(same_date).over(Window.partitionBy("entity", "dt")),
    )
    # A file may be listed by more than one load; its latest listing decides.
    listed = (
        loads.withColumn("_replaced", F.coalesce(replaced, F.lit(0)))
        .select("entity", "dt", F.explode("files").alias("file"), "seq", "_replaced")
        .groupBy("entity", "dt", "file")
        .agg((F.max("seq") < F.max("_replaced")).alias("_old"))
        .select(
            "entity",
            "dt",
            "file",
            F.when(F.col("_old"), "outdated").otherwise("final").alias("status"),
        )
    )
    if landed is None:
        return listed
    unlisted = landed.join(listed, ["entity", "dt", "file"], "left_anti")
    return listed.unionByName(unlisted.withColumn("status", F.lit("temp")))


def to_json(manifests: DataFrame) -> DataFrame:
    """(entity, dt, body): each manifest as the JSON object other tools read."""
    moment = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    body = F.struct(
        "files",
        "total_count",
        F.date_format("created_at", moment).alias("created_at"),
        F.date_format("updated_at", moment).alias("updated_at"),
        "batch_count",
    )
    return manifests.select("entity", "dt", F.to_json(body).alias("body"))


def from_json(bodies: DataFrame) -> DataFrame:
    """Manifests from their JSON objects; a missing key is NULL."""
    shape = (
        "files array<string>, total_count long, created_at string, updated_at string, "
        "batch_count long"
    )
    parsed = bodies.select("entity", "dt", F.from_json("body", shape).alias("m"))
    return parsed.select(
        "entity",
        "dt",
        F.array_distinct("m.files").alias("files"),
        "m.total_count",
        iso_timestamp(F.col("m.created_at")).alias("created_at"),
        iso_timestamp(F.col("m.updated_at")).alias("updated_at"),
        "m.batch_count",
    )


class Manifest:
    def __init__(self, spark: SparkSession, root: str):
        self.root = root
        self.log = Log(spark, f"{root}/meta/manifest", LOG)

    @staticmethod
    def slot(entity: str, dt: str | None) -> str:
        """The date a load is filed under."""
        return dt if dt and "dt=" in raw_path("", entity, dt) else NO_DATE

    def record(
        self,
        entity: str,
        dt: str | None,
        files: list[str],
        count: int,
        extracted_at: datetime,
        full_refresh: bool = False,
    ) -> None:
        known = ENTITIES.get(entity)
        self.log.append(
            entity=entity,
            dt=self.slot(entity, dt),
            files=files,
            record_count=count,
            full_refresh=full_refresh,
            time_series=bool(known and known.kind == TIME_SERIES),
            extracted_at=extracted_at,
        )

    def current(self) -> DataFrame:
        return current_files(self.log.rows())

    def statuses(self, landed: DataFrame | None = None) -> DataFrame:
        return file_status(self.log.rows(), landed)

    def files(self, entity: str, dt: str | None = None) -> list[str]:
        """Folders or files to read, one name each; none when nothing is recorded.

        Their number grows with the loads since the last one that replaced, not with the data.
        """
        here = (F.col("entity") == entity) & (F.col("dt") == self.slot(entity, dt))
        rows = self.current().where(here).select(F.explode("files").alias("file")).distinct()
        return sorted(row.file for row in rows.collect())

    def expired(self) -> list[str]:
        """Folders or files that a later load has replaced."""
        rows = self.statuses().where("status = 'outdated'").select("file").distinct()
        return sorted(row.file for row in rows.collect())

    def latest_date(self, entity: str) -> str | None:
        """Newest recorded date of a dated entity."""
        dates = self.log.rows().where((F.col("entity") == entity) & (F.col("dt") != NO_DATE))
        return dates.agg(F.max("dt")).first()[0]
