"""Load, build and check from the command line.

    python -m ludolake --root LAKE --source EXPORT --date 2025-06-01

``--source`` holds one folder of JSON Lines files per entity; an entity without
a folder is left out of the run.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, Observation, SparkSession

from .files import exists
from .operators.runs import run_totals
from .plans import build_all, load_all
from .plans.build import check_all
from .plans.loads import RUN_LOG
from .session import build_session
from .sources import LOAD_ORDER, entity, read_json_lines


def exported(spark: SparkSession, source: str) -> tuple[dict[str, DataFrame], dict[str, Observation]]:
    """The entities that have a folder below ``source``, and what will be noted about their dropped lines."""
    found = [name for name in LOAD_ORDER if exists(spark, f"{source}/{name}")]
    broken = {name: Observation() for name in found}
    rows = {
        name: read_json_lines(spark, f"{source}/{name}", entity(name).schema, broken=broken[name])
        for name in found
    }
    return rows, broken


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="ludolake", description=__doc__)
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--source", help="folder of exported entities to load")
    parser.add_argument("--date", help="partition date, today in UTC if not given")
    parser.add_argument("--full-refresh", action="store_true")
    parser.add_argument("--load-only", action="store_true", help="build no tables")
    parser.add_argument("--keep-versions", type=int, help="delete older table versions")
    options = parser.parse_args(arguments)

    spark = build_session()
    if options.source:
        rows, broken = exported(spark, options.source)
        results = load_all(
            spark, options.root, rows, options.date, options.full_refresh, broken=broken
        )
        if results:
            run_totals(spark.createDataFrame(results, RUN_LOG)).show()
    if options.load_only:
        return 0
    build_all(
        spark,
        options.root,
        options.date,
        full_refresh=options.full_refresh,
        keep_versions=options.keep_versions,
    )
    report = check_all(spark, options.root, options.date).cache()
    failing = report.where("status <> 'pass'")
    failing.show(failing.count(), truncate=False)  # a row per declared check at most
    return int(not report.where("status = 'fail'").isEmpty())


if __name__ == "__main__":
    raise SystemExit(main())
