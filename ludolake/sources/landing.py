"""Reading and writing the JSON Lines landing zone."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import children, exists, remove_empty

BATCH_SIZE = 100_000
DATE = "[0-9]{4}-[0-9]{2}-[0-9]{2}"


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def read_json_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    multi_line: bool = False,
    broken: Observation | None = None,
) -> DataFrame:
    """Read JSON Lines files, dropping lines that are not JSON objects.

    Every line is parsed as it is and its fields are taken one by one, so a value that
    does not fit its field is NULL, the rest of its line stays, and the rows do not
    depend on which columns are read. A file listed twice is read once; an empty list
    gives an empty frame with the full schema. ``multi_line`` reads files that hold one
    JSON array, or one object; elements that are not objects are dropped. ``broken``
    gets ``dropped``, the number of lines or elements left out, with the first action.
    """
    paths = [paths] if isinstance(paths, str) else list(dict.fromkeys(paths))
    if not paths:
        return empty(spark, schema)
    texts = spark.read.text(paths, wholetext=multi_line)
    return parsed(texts, schema, multi_line, broken)


def parsed(
    texts: DataFrame, schema: T.StructType, multi_line: bool = False, broken: Observation | None = None
) -> DataFrame:
    """The fields of ``schema`` from JSON texts in ``value``; other columns of ``texts`` stay behind them.

    Works on streams too. Blank lines are no lines.
    """
    spark = texts.sparkSession
    if spark.conf.get(_REPEATED, None) != "true":
        spark.conf.set(_REPEATED, "true")
    others = [F.col(f"`{c}`") for c in texts.columns if c != "value"]
    text = F.ltrim("value", F.lit(" \t\r\n"))
    if multi_line:
        # Elements become values of their own, so a file may be larger than one value can be.
        elements = F.coalesce(F.from_json("value", "array<variant>"), F.array(F.try_parse_json("value")))
        rows = texts.where(text != "").select(F.explode(elements).alias("value"), *others)
        whole = F.try_variant_get("value", "$", "map<string,variant>").isNotNull()
    else:
        rows = texts.where(text != "")
        whole = text.startswith("{") & F.try_parse_json("value").isNotNull()
    if broken is not None:
        rows = rows.observe(broken, F.count_if(~whole).alias("dropped"))
    value = F.col("value") if multi_line else F.try_parse_json("value")
    return rows.where(whole).select(*(_field(value, f).alias(f.name) for f in schema.fields), *others)


# A key that an object has twice counts with its last value.
_REPEATED = "spark.sql.variant.allowDuplicateKeys"


def _field(value: Column, field: T.StructField) -> Column:
    """One field of a JSON object, NULL where what is there does not fit.

    Numbers may be written as text; nothing else is turned into a number.
    """
    path = "$['" + field.name.replace("\\", "\\\\").replace("'", "\\'") + "']"
    kind = field.dataType
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.NumericType):
        items = F.try_variant_get(value, path, "array<string>")
        return F.transform(items, lambda item: item.try_cast(kind.elementType))
    if isinstance(kind, T.NumericType):
        return F.try_variant_get(value, path, "string").try_cast(kind)
    return F.try_variant_get(value, path, kind.simpleString())


def read_entity(spark: SparkSession, base: str, schema: T.StructType) -> DataFrame:
    """All date partitions below ``base``, with ``dt`` as a string column."""
    if not exists(spark, base):
        return empty(spark, T.StructType([*schema.fields, T.StructField("dt", T.StringType())]))
    return parsed(spark.read.text(base), schema).withColumn("dt", F.col("dt").cast("string"))


def read_partition(spark: SparkSession, base: str, schema: T.StructType, dt: str) -> DataFrame:
    """One date; only its folder is listed."""
    if not exists(spark, f"{base}/dt={dt}"):
        return empty(spark, schema)
    return parsed(spark.read.text(f"{base}/dt={dt}"), schema)


def partition_of(path: Column) -> Column:
    """The date in a ``dt=YYYY-MM-DD/`` path."""
    return F.regexp_extract(path, f"dt=({DATE})/", 1)


def latest_partition(spark: SparkSession, base: str) -> str | None:
    """Newest date that has data files.

    Only the names of the dates are listed, then the newest ones until one has
    files, so the length of the history does not matter.
    """
    dates = [name[3:] for name in children(spark, base) if re.fullmatch(f"dt={DATE}", name)]
    for dt in sorted(dates, reverse=True):
        names = children(spark, f"{base}/dt={dt}")
        if any(".json" in name and name[0] not in "._" for name in names):
            return dt
    return None


def write_json_lines(df: DataFrame, path: str, batch_size: int = BATCH_SIZE) -> int:
    """Append ``df`` as JSON Lines files of at most ``batch_size`` rows; return the row count.

    File names are unique to the write. ``df`` is evaluated once, and an empty frame
    leaves no file.
    """
    count = _write(df, batch_size, "append", path)
    if not count:
        remove_empty(df.sparkSession, path)
    return count


def write_partition(df: DataFrame, base: str, dt: str, batch_size: int = BATCH_SIZE) -> int:
    """Replace the files of one date and no other; return the row count.

    The new files land in a staging folder and take the date's place when the
    job commits, so a rerun gives the same rows. An empty frame leaves the date as it was.
    """
    return _write(df.withColumn("dt", F.lit(dt)), batch_size, "overwrite", base, by_date=True)


def _write(df: DataFrame, batch_size: int, mode: str, path: str, by_date: bool = False) -> int:
    seen = Observation()
    writer = (
        df.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode(mode)
        .option("maxRecordsPerFile", batch_size)
        .option("ignoreNullFields", True)
    )
    if by_date:
        # Only dates with rows are written, so no rows replace nothing.
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy("dt")
    writer.json(path)
    return seen.get["n"]


def new_load(folder: str) -> str:
    """A folder of its own for one load into ``folder``."""
    return f"{folder}/load={uuid.uuid4().hex}"


def data_files(spark: SparkSession, path: str, schema: T.StructType) -> list[str]:
    """Files a read of ``path`` would use; names starting with ``_`` or ``.`` are not data."""
    if not exists(spark, path):
        return []
    return sorted(spark.read.schema(schema).json(path).inputFiles())
