import random
from datetime import datetime, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ludolake import functions as lf
from ludolake.operators import (
    assemble_name_arrays,
    exact_percentile,
    explode_bridge,
    global_index,
    latest_by_key,
    lookup_name_arrays,
    page,
    page_numbers,
    percentile_buckets,
    pivot_metrics,
    upsert_latest,
    valid_bridge,
    value_counts,
)

from .conftest import plan_of


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# --- Latest and merge


def test_latest_keeps_newest_with_null_order_last(spark):
    df = spark.createDataFrame(
        [(1, 10, "a"), (1, 20, "b"), (2, None, "c"), (2, 5, "d"), (3, None, "e")],
        "id long, updated_at long, name string",
    )
    assert rows(latest_by_key(df, "id", "updated_at"), "id") == [
        (1, 20, "b"),
        (2, 5, "d"),
        (3, None, "e"),
    ]


def test_latest_shrinks_hot_keys_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("id"), F.col("id").alias("updated_at"))
    plan = plan_of(latest_by_key(df, "id", "updated_at"))
    assert plan.count("WindowGroupLimit") == 2


def test_latest_ties_fall_the_same_way_in_any_order(spark):
    data = [(1, 10, n) for n in "abcdef"]
    schema = "id long, updated_at long, name string"
    first = latest_by_key(spark.createDataFrame(data, schema), "id", "updated_at").collect()
    again = latest_by_key(spark.createDataFrame(data[::-1], schema), "id", "updated_at").collect()
    assert first == again


OLD = [(1, 30, "old1"), (2, 20, "old2"), (3, 20, "old3"), (4, None, "old4"), (6, 5, "old6")]
NEW = [(1, 20, "new1"), (2, 20, "new2"), (3, 25, "new3"), (3, 22, "older"), (4, None, "new4"),
       (5, 1, "new5"), (6, None, "new6")]
MERGED = [(1, 30, "old1"), (2, 20, "new2"), (3, 25, "new3"), (4, None, "new4"), (5, 1, "new5"),
          (6, 5, "old6")]


@pytest.mark.parametrize("small", [1000, 0])
def test_upsert_newest_wins_and_ties_go_to_the_increment(spark, small):
    schema = "id long, updated_at long, name string"
    old, new = spark.createDataFrame(OLD, schema), spark.createDataFrame(NEW, schema)
    assert rows(upsert_latest(old, new, "id", "updated_at", small), "id") == MERGED


@pytest.mark.parametrize("small", [1000, 0])
def test_upsert_is_idempotent_and_fills_missing_columns(spark, small):
    old = spark.createDataFrame([(1, 10)], "id long, updated_at long")
    new = spark.createDataFrame([(2, 11, "x")], "id long, updated_at long, extra string")
    once = upsert_latest(old, new, "id", "updated_at", small)
    twice = upsert_latest(once, new, "id", "updated_at", small)
    assert rows(once, "id") == rows(twice, "id") == [(1, 10, None), (2, 11, "x")]


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("small", [1000, 0])
def test_upsert_against_brute_force(spark, seed, small):
    draw = random.Random(seed)

    def versions(n, side):
        # Key 0 holds a third of the rows; some versions tie across sides.
        return [
            (0 if draw.random() < 0.34 else draw.randrange(1, 40), draw.randrange(12), side)
            for _ in range(n)
        ]

    schema = "id long, updated_at long, side string"
    old = latest_by_key(spark.createDataFrame(versions(60, "old"), schema), "id", "updated_at")
    old = spark.createDataFrame(old.collect(), schema)
    arriving = versions(80, "new")
    want = {r.id: (r.updated_at, r.side) for r in old.collect()}
    for key, version, side in arriving:
        if key not in want or version >= want[key][0]:
            want[key] = (version, side)
    merged = upsert_latest(old, spark.createDataFrame(arriving, schema), "id", "updated_at", small)
    assert {r.id: (r.updated_at, r.side) for r in merged.collect()} == want
    assert merged.count() == len(want)


def test_small_upsert_does_not_shuffle_the_table(spark):
    old = spark.createDataFrame(OLD, "id long, updated_at long, name string")
    new = spark.createDataFrame(NEW, "id long, updated_at long, name string")
    assert "Exchange hashpartitioning" not in plan_of(upsert_latest(old, new, "id", "updated_at"))


# --- Bridges and name arrays

GAMES = [(1, [5, 999, 7]), (2, None), (3, []), (4, [7, 5]), (5, [None])]


@pytest.fixture
def games(spark):
    return spark.createDataFrame(GAMES, "id long, genres array<long>")


@pytest.fixture
def genres(spark):
    return spark.createDataFrame([(5, "Shooter"), (7, "Puzzle")], "id long, name string")


def test_bridge_skips_null_and_empty_arrays(games):
    assert rows(explode_bridge(games, "genres", "genre_id"), "game_id", "genre_id") == [
        (1, 5), (1, 7), (1, 999), (4, 5), (4, 7), (5, None),
    ]


def test_bridge_keeps_array_positions_on_request(games):
    found = explode_bridge(games, "genres", "genre_id", position="position")
    assert rows(found.where("game_id = 4"), "position") == [(4, 0, 7), (4, 1, 5)]


def test_valid_bridge_drops_rows_without_a_game(spark, games):
    bridge = explode_bridge(games, "genres", "genre_id")
    known = spark.createDataFrame([(4,), (4,)], "id long")
    assert rows(valid_bridge(bridge, known), "genre_id") == [(4, 5), (4, 7)]


@pytest.mark.parametrize("build", [assemble_name_arrays, lookup_name_arrays])
def test_name_arrays_keep_order_and_unknown_ids(build, games, genres):
    named = build(games, {"genre_names": ("genres", genres), "again": ("genres", genres)})
    got = {r.id: (r.genre_names, r.again) for r in named.collect()}
    want = {
        1: ["Shooter", None, "Puzzle"],
        2: None,
        3: None,
        4: ["Puzzle", "Shooter"],
        5: [None],
    }
    assert got == {k: (v, v) for k, v in want.items()}


def test_name_arrays_without_a_broadcast_are_the_same(games, genres):
    kinds = {"genre_names": ("genres", genres)}
    shuffled = assemble_name_arrays(games, kinds, small_dimension=0)
    assert rows(shuffled, "id") == rows(assemble_name_arrays(games, kinds), "id")


def test_lookup_does_not_shuffle_games(games, genres):
    assert "hashpartitioning" not in plan_of(
        lookup_name_arrays(games, {"genre_names": ("genres", genres)})
    )


@pytest.mark.parametrize("step, start", [(1, 0), (1, -3), (5, 100), (1_000_003, -7), (2**55, -(2**62))])
def test_dense_and_sparse_ids_find_the_same_names(spark, step, start):
    ids = [start + step * i for i in range(90)]
    dimension = spark.createDataFrame([(i, f"n{i}") for i in ids if i % 7], "id long, name string")
    asked = [ids[3], ids[80], None, ids[0] - 1, ids[0], ids[89], 2**63 - 1, -(2**63), ids[3], ids[1] + 1]
    games = spark.createDataFrame([(1, asked), (2, []), (3, None)], "id long, genres array<bigint>")
    kinds = {"genre_names": ("genres", dimension), "again": ("genres", dimension.limit(1))}
    known = set(ids) - {i for i in ids if i % 7 == 0}
    got = {r.id: r.genre_names for r in lookup_name_arrays(games, kinds).collect()}
    assert got == {1: [f"n{i}" if i in known else None for i in asked], 2: None, 3: None}


def test_name_arrays_with_an_empty_dimension(games, genres):
    none = genres.limit(0)
    for build in (assemble_name_arrays, lookup_name_arrays):
        got = {r.id: r.genre_names for r in build(games, {"genre_names": ("genres", none)}).collect()}
        assert got[1] == [None, None, None] and got[2] is None


# --- Global order


@pytest.mark.parametrize("n, k", [(1, 100), (5, 100), (100, 100), (250, 100), (1000, 7), (99, 3)])
def test_ranged_buckets_equal_ntile(spark, n, k):
    # A third of the values are 0 and many tie.
    df = spark.range(n).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(
        F.pmod(F.hash("id"), F.lit(17))).cast("double").alias("m"), (-F.col("id")).alias("neg"))
    metrics = {"m_bucket": F.col("m"), "neg_bucket": F.col("neg")}
    ranged = percentile_buckets(df, "id", metrics, buckets=k, small_rows=0)
    stock = df.select(
        "id", "m", "neg",
        F.ntile(k).over(Window.orderBy("m", "id")).alias("m_bucket"),
        F.ntile(k).over(Window.orderBy("neg", "id")).alias("neg_bucket"),
    )
    assert rows(ranged.select(*stock.columns), "id") == rows(stock, "id")


def test_ranged_buckets_of_no_rows(spark):
    df = spark.range(0).withColumn("m", F.lit(1.0))
    assert percentile_buckets(df, "id", {"b": F.col("m")}, small_rows=0).count() == 0


def test_ranged_buckets_never_sort_in_one_task(spark):
    df = spark.range(1000).withColumn("m", F.rand(1))
    plan = plan_of(percentile_buckets(df, "id", {"b": F.col("m")}, small_rows=0))
    assert "SinglePartition" not in plan


@pytest.mark.parametrize("small", [10_000, 0])
def test_global_index_and_pages(spark, small):
    df = spark.range(1205).select((F.col("id") * 7919 % 1205).alias("k"))
    indexed = global_index(df, [F.col("k").asc()], small_rows=small)
    assert rows(indexed, "k") == [(k, k) for k in range(1205)]
    paged = page_numbers(df, [F.col("k").asc()], 500, small_rows=small)
    assert [tuple(r) for r in paged.groupBy("page").count().orderBy("page").collect()] == [
        (0, 500), (1, 500), (2, 205),
    ]


def test_page_offset_and_past_the_end(spark):
    df = spark.range(1200)
    assert [r.id for r in page(df, [F.col("id").asc()], 1000).collect()] == list(range(1000, 1200))
    assert page(df, [F.col("id").asc()], 1500).count() == 0
    deep = page(df, [F.col("id").asc()], 1000, small_rows=0)
    assert sorted(r.id for r in deep.collect()) == list(range(1000, 1200))


@pytest.mark.parametrize("values", [[1], [1, 2], [3, 1, 2, 2, 2, 9], [5] * 50 + [1, 2, None]])
@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 1.0])
def test_exact_percentile_both_ways(spark, values, fraction):
    df = spark.createDataFrame([(v,) for v in values], "v long")
    want = df.agg(F.percentile("v", F.lit(fraction))).first()[0]
    counts = value_counts(df, "v")
    for small in (1000, 0):
        assert exact_percentile(counts, fraction, "p", small).first().p == pytest.approx(want)


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.4, 0.999, 1.0])
def test_exact_percentile_of_many_values_narrows_down(spark, fraction):
    """A third of the rows on one value, far outliers, and more values than one round can tell apart."""
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 17.5D WHEN id % 1000 = 1 THEN id * 1e12 ELSE (id * 7919 % 20011) / 8D - 900 END AS v"
    )
    want = df.agg(F.percentile("v", F.lit(fraction))).first()[0]
    counts = value_counts(df, "v")
    found = exact_percentile(counts, fraction, "p", small_values=100)
    assert found.first().p == pytest.approx(want, rel=1e-12)
    # Only the interval that is left goes to one task; all values are filtered where they lie.
    plan = plan_of(exact_percentile(counts, fraction, "p", small_values=100))
    assert "rangepartitioning" not in plan and "hashpartitioning" not in plan
    assert "PushedFilters: [" in plan and "_value," in plan.split("PushedFilters: [")[1]


# --- Pivot


def test_pivot_flags_counts_and_missing_metrics(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.5), (1, 1, 0.7), (1, 5, 2.0), (2, 34, None), (3, 99, 1.0)],
        "game_id long, popularity_type long, value double",
    )
    got = {r.game_id: r.asDict() for r in pivot_metrics(df).collect()}
    assert got[1]["visits"] == 0.7 and got[1]["playing"] is None
    assert got[1]["igdb_total_engagement"] == 0.7
    assert (got[1]["has_igdb_data"], got[1]["has_steam_data"], got[1]["has_twitch_data"]) == (1, 1, 0)
    assert got[1]["available_metrics_count"] == 2 and got[1]["cross_platform_score"] == 2
    # A NULL value still counts as data of that type.
    assert got[2]["has_twitch_data"] == 1 and got[2]["twitch_24hr_hours_watched"] is None
    assert got[3]["cross_platform_score"] == 0 and got[3]["available_metrics_count"] == 1


# --- Functions


def test_guarded_ratio(spark):
    df = spark.createDataFrame(
        [(4.0, 2.0), (4.0, 0.0), (4.0, None), (None, 2.0)], "a double, b double"
    )
    got = [r[0] for r in df.select(lf.guarded_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [2.0, 0.0, 0.0, 0.0]


def test_labels(spark):
    df = spark.createDataFrame([(121, 1), (1, 8), (6, 34), (None, 10), (7, 99)], "s long, c long")
    got = df.select(lf.source_label(F.col("s")), lf.metric_category(F.col("c"))).collect()
    assert [tuple(r) for r in got] == [
        ("IGDB", "User Engagement"),
        ("Steam", "Steam Metrics"),
        ("Twitch", "Streaming"),
        ("Unknown", "Steam Wishlist"),
        ("Unknown", "Other"),
    ]


def test_epoch_text_and_bad_epochs(spark):
    df = spark.createDataFrame([(0,), (1750343734,), (-1,), (10**15,), (None,)], "s long")
    days = [r[0] for r in df.select(lf.epoch_day_text(F.col("s"))).collect()]
    assert days == ["1970-01-01", "2025-06-19", "1969-12-31", None, None]
    minutes = df.limit(2).select(lf.epoch_minute_text(F.col("s"))).collect()
    assert [r[0] for r in minutes] == ["1970-01-01 00:00", "2025-06-19 14:35"]


def test_iso_times_and_run_date(spark):
    df = spark.createDataFrame(
        [("2025-11-11T10:00:00+00:00",), ("2025-11-11T10:00:00",), ("2025-11-11T19:00:00+09:00",)],
        "t string",
    )
    seconds = df.select(F.unix_seconds(lf.iso_timestamp(F.col("t"))))
    assert {r[0] for r in seconds.collect()} == {1762855200}
    assert lf.run_date(datetime(2025, 1, 2, 23, tzinfo=timezone.utc)) == "2025-01-02"
    assert lf.epoch_of(datetime(1970, 1, 1)) == 0


def test_bayesian_rating(spark):
    df = spark.createDataFrame([(80.0, 10, 70.0, 5.0)], "r double, v long, c double, m double")
    got = df.select(lf.bayesian_rating(F.col("r"), F.col("v"), F.col("c"), F.col("m"))).first()[0]
    assert got == pytest.approx(10 / 15 * 80 + 5 / 15 * 70)


@pytest.mark.parametrize("small", [1000, 0])
def test_buckets_on_both_sides_of_the_bound(spark, small):
    """NULL keys, longs that doubles cannot tell apart, a hot value and text, in one ranking or in ranges."""
    rows = [(i if i else None, 2**60 + i % 7, "a" if i % 3 else f"t{i}", 1.0) for i in range(90)]
    df = spark.createDataFrame(rows, "id long, big long, word string, hot double").repartition(5)
    metrics = {name: F.col(c) for name, c in (("b1", "big"), ("b2", "word"), ("b3", "hot"))}
    got = {r.id: r for r in percentile_buckets(df, "id", metrics, buckets=10, small_rows=small).collect()}
    assert len(got) == 90
    for name, column in (("b1", 1), ("b2", 2), ("b3", 3)):
        order = sorted(rows, key=lambda r: (r[column], -1 if r[0] is None else r[0]))
        assert all(got[r[0]][name] == k // 9 + 1 for k, r in enumerate(order))


@pytest.mark.parametrize("small", [1000, 0])
def test_upsert_on_both_sides_of_the_bound(spark, small):
    schema = "k long, at long, v string"
    old = spark.createDataFrame([(None, 1, "old"), (1, 5, "old"), (2**53 + 1, 1, "old"), (4, None, "old")], schema)
    new = spark.createDataFrame(
        [(None, 2, "new"), (None, 1, "older"), (1, 4, "new"), (2**53, 1, "new"), (4, None, "new"), *[(7, i, "hot") for i in range(50)]], schema
    )
    got = sorted(map(tuple, upsert_latest(old, new, "k", "at", small_increment=small).collect()), key=repr)
    want = [(None, 2, "new"), (1, 5, "old"), (2**53 + 1, 1, "old"), (2**53, 1, "new"), (4, None, "new"), (7, 49, "hot")]
    assert got == sorted(want, key=repr)


def test_latest_of_rows_with_maps(spark):
    df = spark.createDataFrame([(1, 1, {"a": 1}), (1, 1, {"b": 2})], "k long, at long, m map<string,int>")
    assert latest_by_key(df, "k", "at").count() == 1


def test_name_arrays_agree_on_repeated_ids_and_null_keys(spark):
    games = spark.createDataFrame([(None, [1, 2]), (1, [2, 9])], "id long, genres array<long>")
    names = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (2, "c")], "id long, name string")
    kinds = {"genre_names": ("genres", names)}
    want = [(None, ["a", "c"]), (1, ["c", None])]
    for make in (lookup_name_arrays, assemble_name_arrays):
        got = [(r.id, r.genre_names) for r in make(games, kinds).collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)


def test_texts_of_times_that_are_none(spark):
    df = spark.createDataFrame([(None,), (10**15,), (60,)], "s long")
    got = [r[0] for r in df.select(lf.epoch_minute_text(F.col("s"))).collect()]
    assert got == [None, None, "1970-01-01 00:01"]
    texts = {
        "2024-01-02": 1704153600, "2024-01-02T03:04:05+05": 1704146645, "2024-01-02T03:04:05-0130": 1704170045,
        "2024-01-02T03:04:05Z": 1704164645, "2024-01-02 03:04:05": 1704164645, "junk": None, "2024-13-99": None, "": None,
    }
    df = spark.createDataFrame(list(texts.items()), "t string, want long")
    rows = df.select("t", "want", F.unix_seconds(lf.iso_timestamp(F.col("t"))).alias("got")).collect()
    assert [(r.t, r.got) for r in rows] == [(r.t, r.want) for r in rows]
