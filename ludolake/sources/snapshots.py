"""Parquet tables that are replaced whole: write a new version, then point to it."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import remove, replace_text
from ..operators.latest import latest_by_key, upsert_latest
from .logs import Log

LOG = "table string, path string, source string"


class Snapshots:
    """Named Parquet tables below ``root``.

    A version is written to a folder of its own and becomes current by one row
    in the commit log. A reader, or a job that merges a table with itself, keeps
    the version it started from; a failed write leaves the old one current.

    Readers that do not know the log find the current version by a stable address:
    the file ``current/<table>`` holds its folder, seen from ``root``.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root
        self.log = Log(spark, f"{root}/meta/snapshots", LOG)

    def replace(self, table: str, df: DataFrame, source: str = "") -> DataFrame:
        path = f"{self.root}/marts/{table}/{uuid.uuid4().hex}"
        df.write.option("compression", "snappy").parquet(path)
        self.log.append(table=table, path=path, source=source)
        replace_text(self.spark, self.address(table), path[len(self.root) + 1 :])
        return self.spark.read.parquet(path)

    def upsert(self, table: str, new: DataFrame, key: str, order: str, source: str = "") -> DataFrame:
        """Merge an increment into the table as a whole, latest ``order`` per key."""
        if self.path(table) is None:
            return self.replace(table, latest_by_key(new, key, order), source)
        return self.replace(table, upsert_latest(self.read(table), new, key, order), source)

    def address(self, table: str) -> str:
        """The file that names the folder of the current version."""
        return f"{self.root}/current/{table}"

    def path(self, table: str) -> str | None:
        row = (
            self.log.rows().where(F.col("table") == table).agg(F.max_by("path", "seq")).first()
        )
        return row[0]

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version; with a ``schema``, empty when there is none yet."""
        path = self.path(table)
        if path:
            return self.spark.read.parquet(path)
        if schema is None:
            raise FileNotFoundError(f"no snapshot of {table} below {self.root}")
        return self.spark.createDataFrame([], schema)

    def expire(self, table: str, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions; return how many went.

        Keep at least two, so that jobs reading the previous version can finish.
        """
        versions = self.log.rows().where(F.col("table") == table).orderBy(F.desc("seq"))
        old = [row.path for row in versions.select("path").collect()][max(keep, 1) :]
        return sum(remove(self.spark, path) for path in old)

    def applied(self, table: str, source: str) -> bool:
        """Whether a version made from ``source`` was already committed."""
        done = (F.col("table") == table) & (F.col("source") == source)
        return not self.log.rows().where(done).isEmpty()
