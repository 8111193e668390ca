"""Landing the entities: full or incremental, in order, with manifest, state and run log."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timedelta, timezone
from time import perf_counter

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..files import age_of, children, count_files, remove
from ..functions.dates import epoch_of, run_date
from ..sources.landing import BATCH_SIZE, new_load, write_json_lines
from ..sources.logs import Log
from ..sources.manifest import Manifest
from ..sources.registry import LOAD_ORDER, TIME_SERIES, Entity, entity, raw_path
from ..sources.state import RunState
from .popularity import wanted_scores

# Rows this much older than the last run are read again, against clock skew.
OVERLAP = timedelta(minutes=5)

RUN_LOG = (
    "entity_name string, record_count long, file_count long, elapsed_seconds double, mode string, "
    "dropped_lines long"
)


def changed_since(rows: DataFrame, last_run: datetime, overlap: timedelta = OVERLAP) -> DataFrame:
    """Rows updated after ``last_run`` less the overlap; the comparison reaches the scan."""
    return rows.where(F.col("updated_at") > epoch_of(last_run - overlap))


def load_mode(
    spec: Entity, last_run: datetime | None, full_refresh: bool
) -> tuple[str, datetime | None]:
    """("full", None) or ("incremental", last run)."""
    if spec.kind == TIME_SERIES or full_refresh or last_run is None:
        return "full", None
    return "incremental", last_run


def load_modes(entities: DataFrame, states: DataFrame, full_refresh: bool) -> DataFrame:
    """The same decision for a table of (entity, kind): (entity, mode, since)."""
    known = states.select("entity", "last_run_time")
    since = F.when(
        (F.col("kind") != TIME_SERIES) & ~F.lit(full_refresh), F.col("last_run_time")
    )
    return entities.join(known, "entity", "left").select(
        "entity",
        F.when(since.isNotNull(), "incremental").otherwise("full").alias("mode"),
        since.alias("since"),
    )


def load_entity(
    spark: SparkSession,
    root: str,
    name: str,
    source: DataFrame,
    dt: str,
    full_refresh: bool = False,
    batch_size: int = BATCH_SIZE,
    broken: Observation | None = None,
) -> dict:
    """Land one entity from ``source`` and return its run log row.

    The rows go to a folder of this load alone. Order of commits: data, manifest,
    state. Earlier loads go out of date with the manifest row, so a load that fails
    before it changes nothing a reader sees, time series included. The state is the
    start of the load and is saved for no rows too. ``broken`` is what the reader of
    ``source`` noted about dropped lines; the run log keeps it.
    """
    spec = entity(name)
    started, clock = datetime.now(timezone.utc), perf_counter()
    states, manifest = RunState(spark, root), Manifest(spark, root)
    mode, since = load_mode(spec, states.get(name), full_refresh)
    rows = source.select(*spec.schema.fieldNames())
    if spec.kind == TIME_SERIES:
        rows = wanted_scores(rows)
    if since:
        # A few changed rows spread over many tasks would land as many tiny files.
        rows = changed_since(rows, since).hint("rebalance")

    folder = new_load(raw_path(root, name, dt))
    count = write_json_lines(rows, folder, batch_size)
    files = count_files(spark, folder) if count else 0
    if count:
        manifest.record(name, dt, [folder], count, started, full_refresh)
    states.save(name, started)

    result = {
        "entity_name": name,
        "record_count": count,
        "file_count": files,
        "elapsed_seconds": perf_counter() - clock,
        "mode": mode,
        "dropped_lines": broken.get.get("dropped", 0) if broken is not None else None,
    }
    run_log(spark, root).append(**result)
    return result


def run_log(spark: SparkSession, root: str) -> Log:
    return Log(spark, f"{root}/meta/runs", RUN_LOG)


def load_all(
    spark: SparkSession,
    root: str,
    sources: Mapping[str, DataFrame],
    dt: str | None = None,
    full_refresh: bool = False,
    batch_size: int = BATCH_SIZE,
    broken: Mapping[str, Observation] | None = None,
) -> list[dict]:
    """Land every given entity, dimensions before facts."""
    dt = dt or run_date()
    return [
        load_entity(spark, root, name, sources[name], dt, full_refresh, batch_size, (broken or {}).get(name))
        for name in LOAD_ORDER
        if name in sources
    ]


def landed_folders(spark: SparkSession, root: str, dt: str) -> DataFrame:
    """(entity, dt, file) of the folders of all loads of one date, recorded or not."""
    found = [
        (name, Manifest.slot(name, dt), f"{raw_path(root, name, dt)}/{child}")
        for name in LOAD_ORDER
        for child in children(spark, raw_path(root, name, dt))
        if child.startswith("load=")
    ]
    return spark.createDataFrame(found, "entity string, dt string, file string")


def expire_loads(spark: SparkSession, root: str, dt: str | None = None, temp_after: timedelta = timedelta(days=7)) -> int:
    """Delete the folders of loads that later ones have replaced; return how many went.

    Run it when no reader of an older state is left. With ``dt``, folders of that date
    that no load has recorded go too, once they are ``temp_after`` old.
    """
    book = Manifest(spark, root)
    gone = sum(remove(spark, path) for path in book.expired())
    if dt:
        temp = book.statuses(landed_folders(spark, root, dt)).where("status = 'temp'")
        for row in temp.select("file").collect():
            if age_of(spark, row.file) >= temp_after.total_seconds():
                gone += remove(spark, row.file)
    return gone
