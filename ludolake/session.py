"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from .files import remove

# Settings the library relies on. A cluster adds its own sizing on top
# (executors, memory, spark.checkpoint.dir on shared storage).
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
    # A filter by many keys is checked against every row group, not only by its extremes.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    # In JSON, a key that an object has twice counts with its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Recording the call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "ludolake", master: str | None = None, settings: dict | None = None
) -> SparkSession:
    """Create (or fetch) a session with the library's defaults; ``settings`` override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **(settings or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of its own; on a cluster a
    machine-local folder would lose data with its executor, so that is an error.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="ludolake-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/ludolake/{spark.sparkContext.applicationId}"


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, grouped by application."""
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Used where a frame has several consumers or where its rows carry values
    that must not be recomputed. The copy survives the loss of any executor,
    prunes columns on read and gives the optimizer true sizes.
    """
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    copy = df.sparkSession.read.schema(df.schema).parquet(path)
    copy.staged_at = path
    return copy


def discard(*frames: DataFrame) -> None:
    """Delete what ``stage`` wrote for ``frames``; nothing that still reads them may run later."""
    for frame in frames:
        remove(frame.sparkSession, frame.staged_at)


def drop_work(spark: SparkSession) -> bool:
    """Delete everything this application staged; call when its results are out."""
    return remove(spark, _own_dir(spark))


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether ``df`` has no more than ``rows`` rows.

    A plain count: every task sends one number, and a Parquet table answers from
    its footers. (Counting behind a limit would send rows to a single task.)
    """
    return df.count() <= rows
