"""What exists below a path, on any file system Spark is configured for."""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    context = spark.sparkContext
    place = context._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(context._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; none when it does not exist."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return []
    return [status.getPath().getName() for status in files.listStatus(place)]


def remove(spark: SparkSession, path: str) -> bool:
    """Delete ``path`` and all below it; whether there was anything."""
    files, place = _place(spark, path)
    return files.delete(place, True)


def count_files(spark: SparkSession, path: str) -> int:
    """Data files below ``path``, counted by the file system; names starting with ``_`` or ``.`` do not count."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return 0
    found, n = files.listFiles(place, True), 0
    while found.hasNext():
        n += found.next().getPath().getName()[0] not in "._"
    return n


def remove_empty(spark: SparkSession, path: str) -> None:
    """Delete files without content directly below ``path``, and ``path`` itself if no data is left."""
    files, place = _place(spark, path)
    if not files.exists(place):
        return
    data = [s for s in files.listStatus(place) if s.getPath().getName()[0] not in "._"]
    for status in data:
        if status.isFile() and not status.getLen():
            files.delete(status.getPath(), False)
    if not any(s.isDirectory() or s.getLen() for s in data):
        files.delete(place, True)


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Put ``text`` into the file ``path`` at once: readers see the old content or the new."""
    context, gateway = spark.sparkContext, spark.sparkContext._jvm
    files, place = _place(spark, path)
    draft = gateway.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    out = files.create(draft, True)
    out.write(bytearray(text.encode()))
    out.close()
    rename = gateway.org.apache.hadoop.fs.Options.Rename
    options = context._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    configuration = context._jsc.hadoopConfiguration()
    gateway.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), configuration).rename(draft, place, options)


def age_of(spark: SparkSession, path: str) -> float:
    """Seconds since ``path`` was last changed, by the clock of this machine."""
    files, place = _place(spark, path)
    return time.time() - files.getFileStatus(place).getModificationTime() / 1000
