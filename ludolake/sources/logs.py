"""Small append-only tables that hold the lake's bookkeeping.

A commit is a folder of its own, named by its number and complete once Spark has
marked it so; a crash leaves the log as it was before or after. After every
``MERGE_AFTER`` commits all rows are written together once more, and readers start
from there, so the number of files they open does not grow with the number of commits.
One writer at a time is assumed, as for the loads themselves.
"""

from __future__ import annotations

import json
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import children, exists, remove

#: Commits after which the rows are merged.
MERGE_AFTER = 32


class Log:
    """Rows of ``schema`` numbered by ``seq`` in the order they were appended.

    Rows that are appended together share their number.
    """

    def __init__(self, spark: SparkSession, path: str, ddl: str):
        self.spark = spark
        self.path = path
        self.schema = T.StructType.fromDDL("seq long, " + ddl)

    def _complete(self, kind: str, after: int = 0) -> list[int]:
        """Numbers of the complete folders of a kind beyond ``after``, ascending."""
        found = sorted(int(name) for name in children(self.spark, f"{self.path}/{kind}") if name.isdigit())
        return [n for n in found if n > after and exists(self.spark, f"{self._folder(kind, n)}/_SUCCESS")]

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{kind}/{number:020d}"

    def _parts(self) -> tuple[int, list[int]]:
        """The last merge (0 for none) and the commits after it."""
        merged = max(self._complete("merged"), default=0)
        return merged, self._complete("commits", merged)

    def rows(self) -> DataFrame:
        merged, commits = self._parts()
        paths = [self._folder("merged", merged)] if merged else []
        paths += [self._folder("commits", n) for n in commits]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def append(self, **values) -> None:
        """Add one row, numbered by the time it is added, and after all earlier ones whatever the clock says."""
        text = json.dumps(values, default=datetime.isoformat)
        row = F.from_json(F.lit(text), T.StructType(self.schema.fields[1:])).alias("row")
        self.append_rows(self.spark.range(1, numPartitions=1).select(row).select("row.*"))

    def append_rows(self, rows: DataFrame) -> None:
        """Add all rows of a frame in one commit."""
        merged, commits = self._parts()
        seq = max(time.time_ns(), max([merged, *commits]) + 1)
        numbered = rows.select(
            F.lit(seq).alias("seq"), *(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields[1:])
        )
        self._write(numbered, self._folder("commits", seq))
        if len(commits) + 1 >= MERGE_AFTER:
            self._merge(seq, merged)

    def _write(self, rows: DataFrame, folder: str) -> None:
        rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(folder)

    def _merge(self, last: int, before: int) -> None:
        self._write(self.rows(), self._folder("merged", last))
        # What readers of the previous merge may still hold stays until the next one.
        for kind in ("commits", "merged"):
            for name in children(self.spark, f"{self.path}/{kind}"):
                if name.isdigit() and (int(name) <= before if kind == "commits" else int(name) < before):
                    remove(self.spark, f"{self.path}/{kind}/{name}")
