import os
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ludolake.__main__ import main
from ludolake.functions import METRICS
from ludolake.operators.quality import (
    Check,
    null_rows,
    orphan_counts,
    orphan_rows,
    repeated_values,
    run_checks,
)
from ludolake.operators.runs import (
    compare_modes,
    mode_summary,
    run_rates,
    run_totals,
    speedup_summary,
)
from ludolake.plans import (
    BRIDGES,
    bridge,
    build_all,
    dim_games,
    fct_game_popularity,
    load_all,
    load_mode,
    load_modes,
    merge_dim_games,
    stg_dimension,
    stg_games,
    stg_popscore,
)
from ludolake.plans import marts, serving
from ludolake.plans.build import CHECKS, check_all, read_scores
from ludolake.plans.dimension import DIM_GAMES
from ludolake.__main__ import exported
from ludolake.sources.buckets import Buckets
from ludolake.plans.loads import changed_since, expire_loads, landed_folders, load_entity, run_log
from ludolake.plans.staging import NAME_ARRAYS
from ludolake.sources import LOAD_ORDER, Manifest, RunState, Snapshots, entity, schemas
from ludolake.streaming import ingest_available

from .conftest import plan_of

NOON = datetime(2025, 6, 1, 12, tzinfo=timezone.utc)


def frame(spark, schema: T.StructType, *records: dict):
    """Records with the rest of the schema NULL."""
    return spark.createDataFrame(
        [tuple(r.get(f.name) for f in schema.fields) for r in records], schema
    )


def games(spark, *records):
    return frame(spark, schemas.GAMES, *records)


def dims(spark, **named):
    """Five dimensions of {id: name}."""
    return {
        dim: frame(
            spark,
            entity(dim).schema,
            *[{"id": i, "name": n, "updated_at": 1} for i, n in named.get(dim, {}).items()],
        )
        for _, dim in NAME_ARRAYS.values()
    }


# --- Staging


def test_stg_games_dedups_before_dropping_nameless(spark):
    raw = games(
        spark,
        {"id": 1, "updated_at": 10, "name": "A"},
        {"id": 1, "updated_at": 20, "name": None},
        {"id": 2, "updated_at": 10, "name": "old"},
        {"id": 2, "updated_at": 20, "name": "B", "summary": None},
        {"id": 3, "updated_at": 5, "name": "C", "summary": "text"},
    )
    got = stg_games(raw)
    assert got.columns == schemas.GAMES.fieldNames()
    assert sorted((r.id, r.name, r.summary) for r in got.collect()) == [
        (2, "B", ""),
        (3, "C", "text"),
    ]


def test_stg_dimension_keeps_one_row_per_id(spark):
    raw = frame(
        spark,
        schemas.PLATFORMS,
        {"id": 6, "name": "old", "updated_at": 1},
        {"id": 6, "name": "PC", "updated_at": 2, "generation": 3},
    )
    assert [(r.id, r.name, r.generation) for r in stg_dimension("platforms", raw).collect()] == [
        (6, "PC", 3)
    ]


def test_five_bridges(spark):
    staged = games(
        spark, {"id": 1, "platforms": [6], "genres": [5, 7], "game_modes": [2], "themes": [],
                "player_perspectives": None},
    )
    sizes = {name: bridge(name, staged).count() for name in BRIDGES}
    assert sizes == {
        "stg_game_platform_bridge": 1,
        "stg_game_genre_bridge": 2,
        "stg_game_mode_bridge": 1,
        "stg_game_theme_bridge": 0,
        "stg_game_perspective_bridge": 0,
    }
    assert bridge("stg_game_mode_bridge", staged).columns == ["game_id", "game_mode_id"]


# --- Dimension


@pytest.mark.parametrize("lookup_rows", [100, 0])
def test_dim_games(spark, lookup_rows):
    staged = games(
        spark,
        {"id": 1, "name": "A", "genres": [5, 999], "platforms": [6], "updated_at": 1},
        {"id": 2, "name": "B", "genres": [], "updated_at": 1},
    )
    named = dims(spark, genres={5: "Shooter"}, platforms={6: "PC"})
    got = dim_games(staged, named, lookup_rows)
    assert [(f.name, f.dataType) for f in got.schema] == [(f.name, f.dataType) for f in DIM_GAMES]
    rows = {r.game_id: r for r in got.collect()}
    assert rows[1].genre_names == ["Shooter", None] and rows[1].platform_names == ["PC"]
    assert rows[2].genre_names is None and rows[2].theme_names is None


def test_merge_keeps_newer_old_row_and_old_names(spark):
    def dim(*rows):
        return frame(spark, DIM_GAMES, *rows)

    old = dim(
        {"game_id": 1, "game_name": "kept", "updated_at": 30},
        {"game_id": 2, "game_name": "gone", "genre_names": ["Old"], "updated_at": 10},
        {"game_id": 3, "game_name": "same", "genre_names": ["Before"], "updated_at": 10},
    )
    new = dim(
        {"game_id": 1, "game_name": "late", "updated_at": 20},
        {"game_id": 2, "game_name": "new", "genre_names": ["New"], "updated_at": 20},
    )
    got = {r.game_id: (r.game_name, r.genre_names) for r in merge_dim_games(old, new).collect()}
    assert got == {1: ("kept", None), 2: ("new", ["New"]), 3: ("same", ["Before"])}


# --- Popularity


def test_stg_popscore_labels(spark):
    scores = spark.createDataFrame([(1, 10, 5, 1.0), (2, 10, 77, 2.0)], schemas.POPSCORE)
    types = frame(
        spark, schemas.POPULARITY_TYPES, {"id": 5, "name": "Peak", "external_popularity_source": 1}
    )
    got = {r.id: r for r in stg_popscore(scores, types).collect()}
    assert (got[1].popularity_type_name, got[1].data_source, got[1].metric_category) == (
        "Peak", "Steam", "Steam Metrics",
    )
    assert (got[2].popularity_type_name, got[2].data_source, got[2].metric_category) == (
        None, "Unknown", "Other",
    )


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_fact_ranks_missing_metrics_as_zero(spark, small_rows):
    scores = spark.createDataFrame(
        [(i, i, 1, 1.0) for i in range(1, 9)] + [(100 + i, i, 3, float(i)) for i in range(5, 9)],
        schemas.POPSCORE,
    )
    fact = fct_game_popularity(scores, small_rows)
    assert len(fact.columns) == 24
    got = {r.game_id: r.playing_percentile for r in fact.collect()}
    assert got == {i: i for i in range(1, 9)}  # games 1-4 have no metric and fill the low buckets


# --- Marts


def dim_rows(spark, *rows):
    return frame(spark, DIM_GAMES, *rows)


def test_recent_and_hyped_split_at_the_given_moment(spark):
    at = int(NOON.timestamp())
    dim = dim_rows(
        spark,
        {"game_id": 1, "game_name": "past", "first_release_date": at - 1, "hypes": 5},
        {"game_id": 2, "game_name": "now", "first_release_date": at, "hypes": 5},
        {"game_id": 3, "game_name": "next", "first_release_date": at + 1, "hypes": 7},
        {"game_id": 4, "game_name": "undated", "hypes": 9},
        {"game_id": 5, "game_name": "quiet", "hypes": 0},
        {"game_id": 6, "game_name": "none"},
    )
    half = NOON + timedelta(milliseconds=500)
    assert [r.game_name for r in marts.recent_games(dim, half).collect()] == ["now", "past"]
    assert [r.game_name for r in marts.top_hyped(dim, half).collect()] == ["undated", "next"]
    assert [r.game_name for r in marts.recent_games(dim, half, n=1).collect()] == ["now"]


def test_release_filter_reaches_the_scan(spark, tmp_path):
    dim_rows(spark, {"game_id": 1, "first_release_date": 1}).write.parquet(f"{tmp_path}/dim")
    plan = plan_of(marts.recent_games(spark.read.parquet(f"{tmp_path}/dim"), NOON))
    assert "LessThanOrEqual(first_release_date" in plan and "TakeOrderedAndProject" in plan
    assert "theme_names" not in plan.split("ReadSchema")[1]


def test_top_rated_statistics_use_all_votes(spark):
    votes = {1: (90.0, 1), 2: (80.0, 2), 3: (70.0, 5), 4: (60.0, 10), 5: (None, 50), 6: (99.0, 0)}
    dim = dim_rows(
        spark,
        *[
            {"game_id": i, "game_name": f"g{i}", "aggregated_rating": r, "aggregated_rating_count": v}
            for i, (r, v) in votes.items()
        ],
    )
    mean, prior = 75.0, 1.75  # over games 1-4
    got = [(r.game_name, r.weighted_rating) for r in marts.top_rated(dim).collect()]
    want = [(f"g{i}", (v * r + prior * mean) / (v + prior)) for i, (r, v) in votes.items() if i in (3, 4)]
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want])


def test_theme_trends_count_unknown_themes(spark):
    dim = dim_rows(
        spark,
        {"game_id": 1, "theme_names": ["Horror", None]},
        {"game_id": 2, "theme_names": ["Horror"]},
        {"game_id": 3},
    )
    assert [tuple(r) for r in marts.theme_trends(dim).collect()] == [("Horror", 2), (None, 1)]


FACT = T.StructType(
    [
        T.StructField("game_id", T.LongType()),
        *[T.StructField(name, T.DoubleType()) for name in METRICS.values()],
        T.StructField("igdb_total_engagement", T.DoubleType()),
        T.StructField("cross_platform_score", T.IntegerType()),
        *[
            T.StructField(f"{name}_percentile", T.IntegerType())
            for name in (
                "positive_reviews", "negative_reviews", "total_reviews", "engagement", "playing",
                "played",
            )
        ],
    ]
)


def fact_rows(spark, *rows):
    base = {f.name: 0 for f in FACT.fields if isinstance(f.dataType, T.IntegerType)}
    return frame(spark, FACT, *[{**base, "igdb_total_engagement": 0.0, **row} for row in rows])


def named_dim(spark, ids, **columns):
    return dim_rows(spark, *[{"game_id": i, "game_name": f"g{i}", **columns} for i in ids])


def test_trending_needs_both_metrics_and_thresholds(spark):
    fact = fact_rows(
        spark,
        {"game_id": 1, "playing": 1.0, "played": 1.0, "playing_percentile": 50, "played_percentile": 20},
        {"game_id": 2, "playing": 1.0, "played": None, "playing_percentile": 90, "played_percentile": 90},
        {"game_id": 3, "playing": 1.0, "played": 1.0, "playing_percentile": 49, "played_percentile": 90},
        {"game_id": 4, "playing": 2.0, "played": 1.0, "playing_percentile": 50, "played_percentile": 20},
        {"game_id": 5, "playing": 9.0, "played": 1.0, "playing_percentile": 99, "played_percentile": 99},
    )
    got = marts.trending_now(named_dim(spark, [1, 2, 3, 4]), fact)
    assert [r.game_name for r in got.collect()] == ["g4", "g1"]  # game 5 is not in the dimension
    assert len(got.columns) == 15


def test_texts_are_fetched_for_winners_only(spark, tmp_path):
    named_dim(spark, [1, 2]).write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim").hint("merge")
    fact_rows(spark, {"game_id": 1}).write.parquet(f"{tmp_path}/fact")
    plan = plan_of(marts.trending_now(dim, spark.read.parquet(f"{tmp_path}/fact").hint("merge")))
    # Below each shuffle only narrow rows are read.
    for below in plan.split("Exchange hashpartitioning")[1:]:
        scan = below[below.index("FileScan"):].split("\n")[0]
        assert "game_summary" not in scan
    assert plan.count("Exchange hashpartitioning") == 2 and "game_summary" in plan


def test_controversial_score_and_thresholds(spark):
    reviews = {"steam_negative_reviews": 1.0, "steam_positive_reviews": 1.0, "steam_total_reviews": 1.0}

    def ranks(negative, positive, total):
        return {"negative_reviews_percentile": negative, "positive_reviews_percentile": positive,
                "total_reviews_percentile": total}

    fact = fact_rows(
        spark,
        {"game_id": 1, **reviews, **ranks(40, 30, 30)},
        {"game_id": 2, **reviews, **ranks(90, 30, 29)},
        {"game_id": 3, **reviews, **ranks(50, 50, 50)},
        {"game_id": 4, **reviews, **ranks(99, 99, 99), "steam_total_reviews": None},
    )
    got = marts.controversial_games(named_dim(spark, [1, 2, 3, 4]), fact)
    assert [(r.game_name, r.controversy_score) for r in got.collect()] == [("g3", 50.0), ("g1", 35.0)]
    assert len(got.columns) == 16


def test_hidden_gems_default_rating_and_either_quality(spark):
    def quiet(game_id, positive):
        return {"game_id": game_id, "positive_reviews_percentile": positive,
                "engagement_percentile": 50, "total_reviews_percentile": 60,
                "negative_reviews_percentile": 40}

    fact = fact_rows(spark, quiet(1, 50), quiet(2, 10), quiet(3, 10),
                     {**quiet(4, 99), "engagement_percentile": 51})
    dim = dim_rows(
        spark,
        {"game_id": 1, "game_name": "liked"},
        {"game_id": 2, "game_name": "praised", "aggregated_rating": 75.0},
        {"game_id": 3, "game_name": "neither", "aggregated_rating": 74.9},
        {"game_id": 4, "game_name": "known"},
    )
    got = marts.hidden_gems(dim, fact)
    scores = {r.game_name: r.hidden_score for r in got.collect()}
    assert scores == pytest.approx({
        "liked": 50 * 0.4 + 75 * 0.3 + 50 * 0.2 + 40 * 0.1,
        "praised": 10 * 0.4 + 75 * 0.3 + 50 * 0.2 + 40 * 0.1,
    })
    assert len(got.columns) == 18


@pytest.mark.parametrize("small_rows", [1000, 0])
def test_rising_ranks_before_games_drop_out(spark, small_rows):
    fact = fact_rows(
        spark,
        *[
            {"game_id": i, "playing": float(i), "played": 10.0, "playing_percentile": 30}
            for i in range(1, 5)
        ],
        {"game_id": 9, "playing": None, "played": 1.0, "playing_percentile": 99},
    )
    # Games 1 and 2 are not in the dimension but still hold velocity buckets 1 and 2.
    got = marts.rising_stars(named_dim(spark, [3, 4, 9]), fact, small_rows=small_rows)
    assert [(r.game_name, r.velocity_percentile, r.velocity_ratio) for r in got.collect()] == [
        ("g4", 4, 0.4), ("g3", 3, 0.3),
    ]
    assert len(got.columns) == 21


# --- Serving


def test_search(spark):
    dim = dim_rows(
        spark,
        {"game_id": 1, "game_name": "Super Mario", "first_release_date": 0},
        {"game_id": 2, "game_name": "mario kart", "first_release_date": 1750343734},
        {"game_id": 3, "game_name": "MARIO undated"},
        {"game_id": 4, "game_name": "Zelda"},
    )
    got = [(r.game_name, r.release_year) for r in serving.search_games(dim, "  mario ").collect()]
    assert got == [("mario kart", 2025), ("Super Mario", 1970), ("MARIO undated", None)]
    assert serving.search_games(dim, "mario", limit=1).count() == 1
    for nothing in ("", None):
        assert serving.search_games(dim, nothing).count() == 0
    assert [r.game_name for r in serving.search_games(dim, "Z_lda").collect()] == ["Zelda"]


def test_summary_of_no_games(spark):
    row = serving.summary_metrics(dim_rows(spark)).first()
    assert (row.total_games, row.last_updated) == (0, None)


def test_fetch_mart_keeps_the_ranking(spark):
    mart = spark.createDataFrame([("a", 1), ("b", 3), (None, 2)], "theme string, count long")
    got = serving.fetch_mart("mart_theme_trends", mart.repartition(3), 2)
    assert [r.theme for r in got.collect()] == ["b", None]


# --- Quality


def test_row_level_checks(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id long")
    parent = spark.createDataFrame([(1,), (1,)], "pid long")
    assert null_rows(df, "id").count() == 2
    assert [tuple(r) for r in repeated_values(df, "id").collect()] == [(1, 2)]
    assert [r.id for r in orphan_rows(df, "id", parent, "pid").collect()] == [2]
    assert [tuple(r) for r in orphan_counts(df, "id", parent, "pid").collect()] == [(2, 1)]


def test_suite_reports_broken_models(spark):
    a = spark.createDataFrame([(1, None), (1, "x"), (None, "y")], "id long, name string")
    b = spark.createDataFrame([(1,), (7,), (7,)], "a_id long")
    checks = [
        Check("a", "id", "not_null"),
        Check("a", "id", "unique"),
        Check("a", "name", "not_null", severity="warn"),
        Check("a", "name", "column_type", expected=T.ArrayType(T.StringType())),
        Check("b", "a_id", "relationships", to_model="a", to_column="id"),
        Check("b", "a_id", "not_null"),
    ]
    got = {
        (r.model, r.column, r.check): (r.failures, r.status)
        for r in run_checks({"a": a, "b": b}, checks).collect()
    }
    assert got == {
        ("a", "id", "not_null"): (1, "fail"),
        ("a", "id", "unique"): (1, "fail"),
        ("a", "name", "not_null"): (1, "warn"),
        ("a", "name", "column_type"): (1, "fail"),
        ("b", "a_id", "relationships"): (2, "fail"),
        ("b", "a_id", "not_null"): (0, "pass"),
    }


def test_suite_scans_each_model_once_and_joins_nothing(spark, tmp_path):
    """Columns that refer to others and are referred to, to several parents, of other types, in empty models."""
    rows = {
        "a": spark.createDataFrame([(1, "x", 2), (2, "x", 9), (3, None, None)], "id long, tag string, up long"),
        "b": spark.createDataFrame([(1,), (1,), (4,), (None,)], "a_id long"),
        "c": spark.createDataFrame([], "a_id long, tag string"),
    }
    models = {}
    for name, frame in rows.items():
        frame.write.parquet(f"{tmp_path}/{name}")
        models[name] = spark.read.schema(frame.schema).parquet(f"{tmp_path}/{name}")
    checks = [
        Check("a", "id", "unique"),
        Check("a", "tag", "unique"),
        Check("a", "tag", "not_null"),
        Check("a", "up", "relationships", to_model="a", to_column="id"),
        Check("a", "id", "relationships", to_model="b", to_column="a_id"),
        Check("b", "a_id", "relationships", to_model="a", to_column="id"),
        Check("b", "a_id", "unique"),
        Check("c", "a_id", "relationships", to_model="a", to_column="id"),
        Check("c", "tag", "relationships", to_model="a", to_column="tag"),
        Check("c", "tag", "not_null"),
    ]
    report = run_checks(models, checks)
    plan = plan_of(report)
    assert plan.count("FileScan") == 3 and "Join" not in plan
    assert [r.failures for r in report.collect()] == [0, 1, 1, 1, 2, 1, 1, 0, 0, 0]


def test_declared_checks():
    kinds = [c.kind for c in CHECKS]
    assert len(CHECKS) == 43
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 25, "unique": 7, "relationships": 10, "column_type": 1,
    }
    assert sum(c.severity == "warn" for c in CHECKS) == 1


# --- Run metrics


def test_run_metrics(spark):
    log = spark.createDataFrame(
        [
            ("games", "sequential", 1001, 10.0),
            ("games", "concurrent", 1001, 4.0),
            ("genres", "sequential", 23, 1.0),
            ("genres", "concurrent", 23, 2.0),
            ("themes", "sequential", 22, 0.0),
        ],
        "entity_name string, mode string, record_count long, elapsed_seconds double",
    )
    assert tuple(run_totals(log).first()) == (2070, 17.0)
    assert tuple(run_totals(log.limit(0)).first()) == (0, 0.0)
    rates = {(r.entity_name, r.mode): (r.records_per_second, r.api_calls) for r in run_rates(log).collect()}
    assert rates["games", "sequential"] == (100.1, 3) and rates["themes", "sequential"] == (0.0, 1)
    modes = {r["mode"]: tuple(r)[1:] for r in mode_summary(log).collect()}
    assert modes["concurrent"] == (1024, 6.0, 4, 170.67)
    compared = compare_modes(log)
    assert sorted((r.entity_name, r.speedup) for r in compared.collect()) == [
        ("games", 2.5), ("genres", 0.5),
    ]
    total = speedup_summary(compared).first()
    assert (total.average_speedup, total.total_speedup, total.total_records) == (1.5, 1.83, 1024)


# --- Loads


def test_incremental_boundary_is_strict_and_five_minutes_back(spark):
    last_run = int(NOON.timestamp())
    rows = spark.createDataFrame(
        [(i, last_run + d) for i, d in enumerate([-301, -300, -299, 0])], "id long, updated_at long"
    )
    assert [r.id for r in changed_since(rows, NOON).orderBy("id").collect()] == [2, 3]


@pytest.mark.parametrize("full_refresh", [True, False])
@pytest.mark.parametrize("known", [True, False])
def test_load_modes_of_every_entity(spark, full_refresh, known):
    last = NOON if known else None
    want = {
        name: "incremental" if known and not full_refresh and name != "popscore" else "full"
        for name in LOAD_ORDER
    }
    assert {n: load_mode(entity(n), last, full_refresh)[0] for n in LOAD_ORDER} == want
    table = spark.createDataFrame(
        [(n, entity(n).kind) for n in LOAD_ORDER], "entity string, kind string"
    )
    states = spark.createDataFrame(
        [(n, NOON.isoformat()) for n in LOAD_ORDER if known], "entity string, last_run_time string"
    )
    got = {r.entity: r["mode"] for r in load_modes(table, states, full_refresh).collect()}
    assert got == want


def sources(spark):
    named = dims(spark, genres={5: "Shooter"}, platforms={6: "PC"})
    return {
        **named,
        "games": games(
            spark,
            {"id": 1, "name": "A", "genres": [5, 999], "platforms": [6], "updated_at": 100,
             "first_release_date": 50, "aggregated_rating": 80.0, "aggregated_rating_count": 6},
            {"id": 2, "name": "B", "hypes": 4, "updated_at": 100},
        ),
        "popscore": frame(
            spark,
            schemas.POPSCORE,
            *[{"id": i, "game_id": 1 + i % 2, "popularity_type": c, "value": 1.0 + i}
              for i, c in enumerate(list(METRICS) + [99])],
        ),
        "popularity_types": frame(
            spark, schemas.POPULARITY_TYPES,
            {"id": 1, "name": "Visits", "external_popularity_source": 121, "updated_at": 1},
        ),
    }


def test_small_increment_lands_in_one_file(spark, root):
    load_all(spark, root, {"games": sources(spark)["games"]}, dt="2025-06-01")
    later = int(datetime.now(timezone.utc).timestamp()) + 60
    many = spark.range(40).repartition(8).selectExpr(
        "id", "cast(id AS string) AS name", f"cast({later} AS bigint) AS updated_at"
    )
    for field in schemas.GAMES.fields:
        if field.name not in many.columns:
            many = many.withColumn(field.name, F.lit(None).cast(field.dataType))
    result = load_all(spark, root, {"games": many}, dt="2025-06-02")[0]
    assert (result["mode"], result["record_count"], result["file_count"]) == ("incremental", 40, 1)


def test_load_and_build_over_three_days(spark, root):
    first = load_all(spark, root, sources(spark), dt="2025-06-01")
    assert [r["entity_name"] for r in first] == LOAD_ORDER
    assert {r["mode"] for r in first} == {"full"}
    counts = {r["entity_name"]: r["record_count"] for r in first}
    assert counts["games"] == 2 and counts["popscore"] == 11  # code 99 is not a known type
    assert counts["themes"] == 0 and RunState(spark, root).get("themes") is not None

    built = build_all(spark, root, dt="2025-06-01", as_of=NOON)
    dim = {r.game_id: r for r in built["dim_games"].collect()}
    assert dim[1].genre_names == ["Shooter", None] and dim[2].genre_names is None
    assert built["mart_top_rated"].count() == 1 and built["mart_top_hyped"].count() == 1
    assert Snapshots(spark, root).read("mart_recent_games").count() == 1

    report = {(r.model, r.column, r.check): r for r in check_all(spark, root, "2025-06-01").collect()}
    assert len(report) == 43
    assert report["stg_game_genre_bridge", "genre_id", "relationships"].failures == 1
    assert report["dim_games", "hypes", "not_null"].status == "warn"
    assert report["dim_games", "platform_names", "column_type"].status == "pass"

    # Second day: one game changed after the last run, popscore in full again.
    later = int(datetime.now(timezone.utc).timestamp()) + 60
    changed = {
        **sources(spark),
        "games": games(
            spark,
            {"id": 2, "name": "B2", "genres": [5], "updated_at": later},
            {"id": 1, "name": "unchanged", "updated_at": 100},
        ),
    }
    second = {r["entity_name"]: r for r in load_all(spark, root, changed, dt="2025-06-02")}
    assert (second["games"]["mode"], second["games"]["record_count"]) == ("incremental", 1)
    assert (second["popscore"]["mode"], second["popscore"]["record_count"]) == ("full", 11)
    assert second["genres"]["record_count"] == 0
    built = build_all(spark, root, dt="2025-06-02", as_of=NOON)
    names = {r.game_id: (r.game_name, r.genre_names) for r in built["dim_games"].collect()}
    assert names == {1: ("A", ["Shooter", None]), 2: ("B2", ["Shooter"])}
    # Rebuilding the same day changes nothing.
    again = build_all(spark, root, dt="2025-06-02", as_of=NOON)
    assert sorted(map(str, again["dim_games"].collect())) == sorted(map(str, built["dim_games"].collect()))

    # Same-day rerun of the time series: same rows, its files replaced.
    load_all(spark, root, {"popscore": sources(spark)["popscore"]}, dt="2025-06-02")
    assert read_scores(spark, root).count() == 11
    assert run_log(spark, root).rows().count() == 17
    landed = landed_folders(spark, root, "2025-06-02")
    status = Manifest(spark, root).statuses(landed).groupBy("status").count().collect()
    assert {r.status: r["count"] for r in status}.keys() == {"final", "outdated"}

    # A full refresh starts dimension and manifest anew.
    fresh = load_all(spark, root, changed, dt="2025-06-03", full_refresh=True)
    assert {r["mode"] for r in fresh} == {"full"}
    built = build_all(spark, root, dt="2025-06-03", as_of=NOON, full_refresh=True)
    assert {r.game_name for r in built["dim_games"].collect()} == {"B2", "unchanged"}


def test_failed_load_leaves_manifest_and_state(spark, root):
    load_all(spark, root, {"games": sources(spark)["games"]}, dt="2025-06-01")
    before = (Manifest(spark, root).files("games", "2025-06-01"), RunState(spark, root).get("games"))
    broken = sources(spark)["games"].withColumn("name", F.expr("raise_error('source down')"))
    with pytest.raises(Exception, match="source down"):
        load_all(spark, root, {"games": broken}, dt="2025-06-01", full_refresh=True)
    assert before == (Manifest(spark, root).files("games", "2025-06-01"), RunState(spark, root).get("games"))
    assert {r.status for r in Manifest(spark, root).statuses().collect()} == {"final"}


@pytest.mark.parametrize("died_at", ["record", "save"])
def test_load_that_dies_after_its_data_changes_nothing(spark, root, monkeypatch, died_at):
    """Dying before the manifest leaves the old rows; dying before the state leaves a load that can be run again."""
    scores = sources(spark)["popscore"]
    load_all(spark, root, {"popscore": scores}, dt="2025-06-01")
    place = Manifest if died_at == "record" else RunState
    newer = scores.withColumn("value", F.lit(7.0))

    def dies(*args, **kwargs):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(place, died_at, dies)
        with pytest.raises(RuntimeError, match="lost"):
            load_entity(spark, root, "popscore", newer, "2025-06-01")
    rows = read_scores(spark, root)
    assert rows.count() == 11
    assert (rows.where("value = 7").count() == 11) == (died_at == "save")
    if died_at == "record":
        # What the dead load landed is known as such and goes once it is old.
        status = Manifest(spark, root).statuses(landed_folders(spark, root, "2025-06-01"))
        assert sorted(r.status for r in status.collect()) == ["final", "temp"]
        assert expire_loads(spark, root, "2025-06-01") == 0
        assert expire_loads(spark, root, "2025-06-01", timedelta(0)) == 1
    load_entity(spark, root, "popscore", newer, "2025-06-01")
    assert read_scores(spark, root).where("value = 7").count() == 11
    assert expire_loads(spark, root) >= 1
    assert read_scores(spark, root).where("value = 7").count() == 11


def test_run_log_counts_dropped_lines(spark, root, tmp_path):
    (tmp_path / "genres").mkdir()
    (tmp_path / "genres" / "a.json").write_text('{"id": 1, "name": "A"}\n{"id": 2, "na\nnone\n{"id": "x"}')
    rows, broken = exported(spark, str(tmp_path))
    result = load_all(spark, root, rows, dt="2025-06-01", broken=broken)[0]
    assert (result["record_count"], result["dropped_lines"]) == (2, 2)
    assert run_log(spark, root).rows().first().dropped_lines == 2


def test_development_build_uses_views(spark, root):
    load_all(spark, root, sources(spark), dt="2025-06-01")
    build_all(spark, root, dt="2025-06-01", as_of=NOON, as_views=True)
    assert spark.sql("SELECT count(*) FROM dim_games").first()[0] == 2
    assert Snapshots(spark, root).path("dim_games") is None


def test_command_line(spark, root, tmp_path, capsys):
    for name in ("games", "popscore", "genres"):
        sources(spark)[name].write.json(f"{tmp_path}/export/{name}")
    arguments = ["--root", root, "--source", f"{tmp_path}/export", "--date", "2025-06-01"]
    # Genre 999 and platform 6 have no dimension row.
    assert main(arguments) == 1
    out = capsys.readouterr().out
    assert "total_records" in out and "relationships" in out
    assert Buckets(spark, root).read("dim_games").count() == 2
    assert main([*arguments, "--load-only", "--full-refresh"]) == 0
    assert Manifest(spark, root).current().where("entity = 'games'").first().total_count == 2


# --- Streaming


def test_stream_merges_new_files_only_and_replays_are_skipped(spark, root):
    tables = Snapshots(spark, root)
    schema = "id long, updated_at long, name string"

    def land(*rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{root}/landing")

    def ingest():
        frame = spark.createDataFrame([], schema)
        got = ingest_available(
            spark, f"{root}/landing", frame.schema, tables, "t", "id", "updated_at",
            f"{root}/checkpoint", max_files=1,
        )
        return sorted(tuple(r) for r in got.collect())

    land((1, 1000, "first"), (2, 1000, "b"))
    assert ingest() == [(1, 1000, "first"), (2, 1000, "b")]
    land((1, 1010, "later"))
    land((1, 1005, "late arrival"), (3, 1, "c"))
    want = [(1, 1010, "later"), (2, 1000, "b"), (3, 1, "c")]
    assert ingest() == want
    versions = tables.log.rows().count()
    assert ingest() == want
    assert tables.log.rows().count() == versions
    assert tables.applied("t", f"{root}/checkpoint#0")
    # As after a crash between the merge and the stream's own commit.
    last = max(int(n) for n in os.listdir(f"{root}/checkpoint/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{root}/checkpoint/commits/{name}"):
            os.remove(f"{root}/checkpoint/commits/{name}")
    assert ingest() == want
    assert tables.log.rows().count() == versions
