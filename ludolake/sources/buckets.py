"""Keyed Parquet tables in hash buckets, of which an increment rewrites only those it meets."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import children, remove, replace_text
from ..operators.latest import latest_by_key, upsert_latest
from ..session import stage
from .logs import Log

LOG = "table string, folder string, buckets array<int>, total int, anew boolean, columns string, source string"

#: Buckets of a new table. A bucket should come to some hundred megabytes.
BUCKETS = 16
_BUCKET = "key_bucket"


class Buckets:
    """Named tables below ``root`` that are unique by a key.

    A commit writes new versions of some buckets to a folder of its own and makes them
    current by one row in the commit log; all other buckets keep their files. A reader,
    or a job that merges a table with itself, keeps the versions it started from, and a
    failed write leaves the old ones current. Rows are sorted by key within their files
    and their keys have a Bloom filter, so that reading few keys skips most row groups.

    Readers that do not know the log find the table by a stable address: the file
    ``current/<table>`` holds the folders of its buckets, seen from ``root``, one a line.
    """

    def __init__(self, spark: SparkSession, root: str, total: int = BUCKETS):
        self.spark = spark
        self.root = root
        self.total = total
        self.log = Log(spark, f"{root}/meta/buckets", LOG)

    def _commits(self, table: str) -> DataFrame:
        """The commits since the table was last written anew."""
        rows = self.log.rows().where(F.col("table") == table)
        since = rows.where("anew").agg(F.coalesce(F.max("seq"), F.lit(0)).alias("_since"))
        return rows.join(F.broadcast(since), F.col("seq") >= F.col("_since")).drop("_since")

    def _current(self, table: str) -> tuple[dict[int, str], int, T.StructType | None]:
        """Folder of each bucket that has rows, the number of buckets, and the columns; as many rows as buckets."""
        commits = self._commits(table)
        folders = commits.select("seq", "folder", "total", "columns", F.explode("buckets").alias("bucket"))
        newest = folders.groupBy("bucket").agg(F.max_by(F.struct("folder", "total", "columns", "seq"), "seq").alias("at"))
        found = sorted(newest.collect(), key=lambda row: row["at"]["seq"])
        if not found:
            return {}, self.total, None
        columns = T.StructType.fromJson(json.loads(found[-1]["at"]["columns"]))
        return {row.bucket: row["at"]["folder"] for row in found}, found[-1]["at"]["total"], columns

    def _paths(self, folders: dict[int, str]) -> list[str]:
        return [f"{self.root}/{folder}/{_BUCKET}={bucket}" for bucket, folder in sorted(folders.items())]

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame:
        """The current rows; with a ``schema``, empty when there is no such table yet."""
        folders, _, columns = self._current(table)
        if folders:
            return self.spark.read.schema(columns).parquet(*self._paths(folders))
        if schema is None:
            raise FileNotFoundError(f"no table {table} below {self.root}")
        return self.spark.createDataFrame([], schema)

    def replace(self, table: str, df: DataFrame, key: str, source: str = "") -> DataFrame:
        """Write the table anew from rows that are unique by ``key``."""
        return self._commit(table, df, key, self.total, True, source, {})

    def upsert(self, table: str, new: DataFrame, key: str, order: str, source: str = "") -> DataFrame:
        """Merge an increment, latest ``order`` per key, ties to the increment; return the table.

        Only buckets that hold a key of the increment are read and written.
        """
        folders, total, columns = self._current(table)
        newest = stage(latest_by_key(new, key, order).withColumn(_BUCKET, _bucket(key, total)), "increment")
        if not folders:
            return self._commit(table, newest.drop(_BUCKET), key, total, True, source, {})
        met = [row[0] for row in newest.select(_BUCKET).distinct().collect()]  # buckets at most
        if not met:
            return self.read(table)
        touched = {b: folders[b] for b in met if b in folders}
        merged = newest.drop(_BUCKET)
        if touched:
            old = self.spark.read.schema(columns).parquet(*self._paths(touched))
            merged = upsert_latest(old, merged, key, order)
        return self._commit(table, merged, key, total, False, source, folders)

    def _commit(
        self, table: str, df: DataFrame, key: str, total: int, anew: bool, source: str, before: dict[int, str]
    ) -> DataFrame:
        folder = f"marts/{table}/{uuid.uuid4().hex}"
        # Rows of a bucket go together, a bucket with very many in several files, so files do not add up.
        dealt = df.withColumn(_BUCKET, _bucket(key, total)).hint("rebalance", _BUCKET)
        writer = dealt.sortWithinPartitions(_BUCKET, key).write.partitionBy(_BUCKET)
        writer = writer.option("compression", "snappy").option(f"parquet.bloom.filter.enabled#{key}", "true")
        # As large as the keys of a file need, not as large as may be.
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
        writer.parquet(f"{self.root}/{folder}")
        names = children(self.spark, f"{self.root}/{folder}")
        written = sorted(int(name.split("=")[1]) for name in names if name.startswith(f"{_BUCKET}="))
        self.log.append(
            table=table, folder=folder, buckets=written, total=total, anew=anew, columns=df.schema.json(), source=source
        )
        now = {**before, **dict.fromkeys(written, folder)}
        lines = [f"{f}/{_BUCKET}={b}" for b, f in sorted(now.items())]
        replace_text(self.spark, self.address(table), "\n".join(lines))
        return self.read(table, df.schema)

    def address(self, table: str) -> str:
        """The file that names the folders of the current buckets."""
        return f"{self.root}/current/{table}"

    def applied(self, table: str, source: str) -> bool:
        """Whether a commit made from ``source`` is there already."""
        return not self.log.rows().where((F.col("table") == table) & (F.col("source") == source)).isEmpty()

    def expire(self, table: str, keep: int = 2) -> int:
        """Delete all but the newest ``keep`` versions of each bucket; return how many went.

        Versions are counted over the whole history, so that jobs reading the previous one can finish.
        """
        rows = self.log.rows().where(F.col("table") == table)
        each = rows.select("folder", "seq", F.explode("buckets").alias("bucket"))
        place = Window.partitionBy("bucket").orderBy(F.desc("seq"))
        old = each.withColumn("_n", F.row_number().over(place)).where(F.col("_n") > max(keep, 1))
        return sum(remove(self.spark, f"{self.root}/{row.folder}/{_BUCKET}={row.bucket}") for row in old.collect())


def _bucket(key: str, total: int):
    return F.pmod(F.xxhash64(key), F.lit(total)).cast("int")
