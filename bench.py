"""Time the headline queries; prints one JSON line.

After the queries on the driver's tables, the models are timed on the stand-in
games repeated until there are as many as in the published timings (345,000),
with all scores spread over them; these keys start with ``games345k_``.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolake.checks import standins as st
from ludolake.checks.queries import QUERIES
from ludolake.operators.quality import run_checks
from ludolake.plans import BRIDGES, bridge, dim_games, fct_game_popularity, stg_games
from ludolake.plans.build import CHECKS
from ludolake.plans.marts import all_marts
from ludolake.session import build_session, stage

PUBLISHED_GAMES = 345_000

HEADLINE = [
    "stg_games",
    "latest_by_key",
    "upsert_latest",
    "bridge_all",
    "dim_name_arrays",
    "dim_games",
    "type_label_join",
    "metric_pivot",
    "fct_game_popularity",
    "fct_game_popularity_ranged",
    "percentile_buckets",
    "mart_recent",
    "mart_hyped",
    "mart_top_rated",
    "mart_theme_trends",
    "mart_trending",
    "mart_controversial",
    "mart_hidden_gems",
    "mart_rising",
    "summary_metrics",
    "search_names",
    "page_rows_ranged",
    "incremental_read",
    "dq_unique",
    "dq_relationships",
    "dq_suite",
    "run_metrics",
    "json_lines_roundtrip",
    "partition_replace",
    "stream_upsert",
]


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def repeated(df: DataFrame, copies: int, *keys: str) -> DataFrame:
    """``copies`` of every row, each with ids of its own."""
    rows = df.crossJoin(df.sparkSession.range(copies).toDF("_copy"))
    return rows.withColumns({k: F.col(k) * copies + F.col("_copy") for k in keys}).drop("_copy")


def published_scale(spark: SparkSession, sf_dir: str) -> dict[str, float]:
    """Seconds per model at the number of games of the published timings."""
    seconds = {}

    def timed(name: str, work):
        start = time.perf_counter()
        result = work()
        seconds[f"games345k_{name}"] = round(time.perf_counter() - start, 3)
        return result

    games = st.raw_games(spark, sf_dir)
    copies = max(1, PUBLISHED_GAMES // games.count())
    tasks = spark.sparkContext.defaultParallelism
    raw = stage(repeated(games, copies, "id").repartition(tasks), "raw")
    scores = stage(repeated(st.raw_scores(spark, sf_dir), copies, "id", "game_id"), "scores")
    dims = st.dimensions(spark, sf_dir)

    staged = timed("stg_games", lambda: stage(stg_games(raw), "games"))
    bridges = {name: bridge(name, staged) for name in BRIDGES}
    timed("bridges", lambda: [run(rows) for rows in bridges.values()])
    dim = timed("dim_games", lambda: stage(dim_games(staged, dims), "dim"))
    fact = timed("fct_game_popularity", lambda: stage(fct_game_popularity(scores), "fact"))
    timed("marts", lambda: [run(mart) for mart in all_marts(dim, fact, st.AS_OF).values()])
    models = {f"stg_{name}": rows for name, rows in dims.items()}
    models.update(bridges, stg_games=staged, dim_games=dim)
    timed("dq_suite", lambda: run_checks(models, CHECKS).collect())
    return seconds


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        app="bench",
        master=f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the session and loads its classes.
    run(QUERIES["mart_top_rated"](spark, sf_dir))

    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        run(QUERIES[name](spark, sf_dir))
        seconds[name] = round(time.perf_counter() - start, 3)
    seconds.update(published_scale(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
