"""Run queries against DuckDB: python -m tests.check_oracle [sf_dir] [query ...]"""

import sys
import time

from ludolake.checks.oracle import ORACLE
from ludolake.checks.queries import QUERIES
from ludolake.session import build_session

from .compare import difference, duck


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        settings={
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(sf_dir)
    failed = 0
    for name in names:
        start = time.perf_counter()
        try:
            df = QUERIES[name](spark, sf_dir)
            problem = difference(df, connection, ORACLE[name]) if name in ORACLE else None
            note = f"{df.count()} rows"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:600]}", ""
        failed += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.perf_counter() - start:.2f}s {note} {problem or ''}", flush=True)
    print(f"{len(names) - failed}/{len(names)} ok")
    return int(failed > 0)


if __name__ == "__main__":
    sys.exit(main())
