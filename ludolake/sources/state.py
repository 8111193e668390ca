"""When each entity was last extracted."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import iso_timestamp
from ..operators.latest import latest_by_key
from .logs import Log

LOG = "entity string, last_run_time string, updated_at string"


def iso_utc(moment: datetime) -> str:
    """ISO-8601 text with an offset; a naive time counts as UTC."""
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=timezone.utc)
    return moment.isoformat()


def current_state(entries: DataFrame) -> DataFrame:
    """Latest entry per entity; a reset entity has no row."""
    newest = latest_by_key(entries, "entity", "seq")
    return newest.where(F.col("last_run_time").isNotNull()).drop("seq")


class RunState:
    def __init__(self, spark: SparkSession, root: str):
        self.log = Log(spark, f"{root}/meta/state", LOG)

    def save(self, entity: str, run_time: datetime, now: datetime | None = None) -> None:
        stamp = iso_utc(now or datetime.now(timezone.utc))
        self.log.append(entity=entity, last_run_time=iso_utc(run_time), updated_at=stamp)

    def save_all(self, entries: DataFrame, now: datetime | None = None) -> None:
        """Save the (entity, last_run_time) rows of a frame in one commit; the times are ISO text."""
        stamp = iso_utc(now or datetime.now(timezone.utc))
        self.log.append_rows(entries.select("entity", "last_run_time", F.lit(stamp).alias("updated_at")))

    def reset(self, entity: str, now: datetime | None = None) -> None:
        """Forget the entity, so that its next load is a full one."""
        stamp = iso_utc(now or datetime.now(timezone.utc))
        self.log.append(entity=entity, last_run_time=None, updated_at=stamp)

    def all(self) -> DataFrame:
        """(entity, last_run_time, updated_at), ISO text."""
        return current_state(self.log.rows())

    def times(self) -> DataFrame:
        """(entity, last_run) as instants."""
        return self.all().select("entity", iso_timestamp(F.col("last_run_time")).alias("last_run"))

    def get(self, entity: str) -> datetime | None:
        entries = self.log.rows().where(F.col("entity") == entity)
        text = entries.agg(F.max_by("last_run_time", "seq")).first()[0]
        try:
            moment = datetime.fromisoformat(text) if text else None
        except ValueError:  # unreadable state means a full load
            return None
        return moment.replace(tzinfo=timezone.utc) if moment and moment.tzinfo is None else moment
