import os

import pytest
from pyspark.sql import functions as F

from ludolake.plans import marts
from ludolake.session import stage
from ludolake.sources import Buckets
from tests.conftest import plan_of
from tests.test_plans import NOON, fact_rows, named_dim


def versions(spark, *rows):
    return spark.createDataFrame(rows, "id long, at long, name string")


def content(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def files(root):
    return {
        os.path.join(folder, name): os.stat(os.path.join(folder, name)).st_mtime_ns
        for folder, _, names in os.walk(f"{root}/marts")
        for name in names
        if name.startswith("part-")
    }


def test_increment_rewrites_only_what_it_meets(spark, root):
    table = Buckets(spark, root, total=8)
    start = versions(spark, *((i, 1, f"n{i}") for i in range(100)))
    table.replace("t", start, "id")
    before, old = files(root), table.read("t")
    was = content(old)
    got = table.upsert("t", versions(spark, (7, 2, "new"), (7, 1, "tie"), (8, 0, "old"), (500, 1, "more")), "id", "at")
    want = {i: (i, 1, f"n{i}") for i in range(100)} | {7: (7, 2, "new"), 500: (500, 1, "more")}
    assert content(got) == sorted(want.values(), key=repr)
    after = files(root)
    # No file changed; the new ones are those of three buckets at most, and the rest is read as it was.
    assert all(after[name] == stamp for name, stamp in before.items())
    made = {name for name in after if name not in before}
    assert 1 <= len(made) <= 3
    read = {f.removeprefix("file://") for f in got.inputFiles()}
    assert made <= read and len(read & set(before)) == len(before) - len(made)
    assert content(old) == was


def test_ties_nulls_new_columns_and_empty_increments(spark, root):
    table = Buckets(spark, root, total=3)
    assert table.read("t", versions(spark).schema).count() == 0
    table.upsert("t", versions(spark, (None, 1, "a"), (1, None, "b"), (1, 2, "c")), "id", "at")
    table.upsert("t", versions(spark), "id", "at")
    wider = versions(spark, (None, 1, "tie"), (2, 1, "d")).withColumn("more", F.lit(5))
    got = table.upsert("t", wider, "id", "at", source="s#2")
    assert content(got.select("id", "at", "name")) == sorted([(None, 1, "tie"), (1, 2, "c"), (2, 1, "d")], key=repr)
    assert table.applied("t", "s#2") and not table.applied("t", "s#3")
    # Written anew, with other buckets than before.
    Buckets(spark, root, total=5).replace("t", versions(spark, (9, 1, "z")), "id")
    assert content(table.read("t")) == [(9, 1, "z")]
    assert content(table.upsert("t", versions(spark, (10, 1, "y")), "id", "at")) == [(10, 1, "y"), (9, 1, "z")]


def test_failed_commit_keeps_the_rows_and_old_versions_expire(spark, root):
    table = Buckets(spark, root, total=4)
    table.replace("t", versions(spark, *((i, 1, "a") for i in range(20))), "id")
    broken = versions(spark, (1, 2, "b")).withColumn("name", F.expr("raise_error('no')"))
    with pytest.raises(Exception):
        table.upsert("t", broken, "id", "at")
    assert table.read("t").where("name = 'a'").count() == 20
    for at in (2, 3):
        table.upsert("t", versions(spark, *((i, at, "b") for i in range(20))), "id", "at")
    assert table.expire("t", keep=1) > 0
    assert table.read("t").where("at = 3").count() == 20
    lines = open(table.address("t")).read().splitlines()
    assert all(os.path.isdir(f"{root}/{line}") for line in lines) and len(lines) == len(table.read("t").select(
        F.regexp_extract("_metadata.file_path", "key_bucket=([0-9]+)", 1)).distinct().collect())


def test_marts_read_their_winners_at_once(spark, root):
    """One wide scan of the dimension, filtered by the ids of all winners."""
    dim = named_dim(spark, range(1, 400), first_release_date=1, hypes=3, aggregated_rating=80.0, aggregated_rating_count=9)
    table = Buckets(spark, root, total=2)
    dim = table.replace("dim_games", dim, "game_id")
    fact = stage(fact_rows(spark, *({"game_id": i} for i in range(1, 30))), "fact")
    winners = stage(spark.range(3, 9).withColumnRenamed("id", "game_id"), "winners")
    plans = []
    original = marts.stage

    def watched(frame, name):
        plans.append((name, plan_of(frame, "formatted")))
        return original(frame, name)

    marts.stage = watched
    try:
        shown = marts.games_of(dim, winners)
        built = marts.all_marts(dim, fact, NOON)
        for mart in built.values():
            mart.collect()
    finally:
        marts.stage = original
    assert sorted(r.game_id for r in shown.collect()) == list(range(3, 9))
    wide = [plan for _, plan in plans if "game_summary" in plan]
    assert [name for name, plan in plans if "game_summary" in plan] == ["shown", "shown"]  # the call above, and the marts
    assert all("PushedFilters: [In(game_id" in plan and plan.count("Scan parquet") == 2 for plan in wide)  # listed and detailed
    for name, mart in built.items():
        if name != "mart_theme_trends":
            assert all("/winners-" in f or "/shown-" in f for f in mart.inputFiles()), name
    assert built["mart_recent_games"].count() == 50
