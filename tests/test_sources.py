import glob
import os
import shutil
from datetime import datetime, timezone
from types import SimpleNamespace

import duckdb
import pytest
from pyspark.sql import functions as F

from ludolake.session import at_most, drop_work, shared_dir, stage, work_path
from ludolake.sources import (
    ENTITIES,
    LOAD_ORDER,
    Manifest,
    RunState,
    Snapshots,
    entity,
    latest_partition,
    raw_path,
    read_entity,
    read_json_lines,
    read_partition,
    schemas,
    write_json_lines,
    write_partition,
)
from ludolake.sources import logs
from ludolake.sources.landing import data_files
from ludolake.sources.logs import Log
from ludolake.sources.manifest import from_json, to_json

AT = datetime(2025, 1, 1, 12, tzinfo=timezone.utc)
POPSCORE = schemas.POPSCORE


def write_text(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as out:
        out.write(text)
    return path


def scores(spark, n, value=1.0, start=0):
    return spark.range(start, start + n, numPartitions=1).select(
        "id",
        F.col("id").alias("game_id"),
        F.lit(1).cast("long").alias("popularity_type"),
        F.lit(value).alias("value"),
    )


# --- Reading


def test_malformed_lines_drop_and_missing_fields_are_null(spark, tmp_path):
    path = write_text(
        f"{tmp_path}/a.jsonl", '{"id": 1, "name": "A"}\n{"id": 2, "na\n{"id": 3, "hypes": 4}'
    )
    got = read_json_lines(spark, path, schemas.GAMES).select("id", "name", "hypes", "genres")
    assert sorted(tuple(r) for r in got.collect()) == [(1, "A", None, None), (3, None, 4, None)]


def test_json_array_file(spark, tmp_path):
    path = write_text(f"{tmp_path}/a.json", '[{"id": 1},\n {"id": 2, "genres": [5]}]')
    got = read_json_lines(spark, path, schemas.GAMES, multi_line=True)
    assert sorted((r.id, r.genres) for r in got.collect()) == [(1, None), (2, [5])]


def test_same_file_twice_is_read_once_and_no_file_is_empty(spark, tmp_path):
    path = write_text(f"{tmp_path}/a.jsonl", '{"id": 1}')
    assert read_json_lines(spark, [path, path], POPSCORE).count() == 1
    none = read_json_lines(spark, [], POPSCORE)
    assert none.count() == 0 and none.schema == POPSCORE


def test_hidden_names_are_not_data(spark, tmp_path):
    base = f"{tmp_path}/raw/popscore"
    write_text(f"{base}/dt=2025-01-01/a.json", '{"id": 1}')
    write_text(f"{base}/dt=2025-01-01/_manifest.json", '{"id": 2}')
    write_text(f"{base}/dt=2025-01-01/_temp_x/b.json", '{"id": 3}')
    write_text(f"{base}/dt=2025-01-02/_manifest.json", '{"id": 4}')
    assert [r.id for r in read_entity(spark, base, POPSCORE).collect()] == [1]
    # The newest date holds no data.
    assert latest_partition(spark, base) == "2025-01-01"
    assert latest_partition(spark, f"{base}/none") is None
    assert read_entity(spark, f"{base}/none", POPSCORE).columns == [*POPSCORE.fieldNames(), "dt"]


# --- Writing


def test_batches_of_at_most_n_rows(spark, tmp_path):
    assert write_json_lines(scores(spark, 250), f"{tmp_path}/a", batch_size=100) == 250
    sizes = [sum(1 for _ in open(f)) for f in glob.glob(f"{tmp_path}/a/part-*")]
    assert sorted(sizes) == [50, 100, 100]


def test_five_rows_by_two_and_exact_multiple(spark, tmp_path):
    write_json_lines(scores(spark, 5), f"{tmp_path}/five", batch_size=2)
    assert len(data_files(spark, f"{tmp_path}/five", POPSCORE)) == 3
    write_json_lines(scores(spark, 2), f"{tmp_path}/two", batch_size=2)
    assert len(data_files(spark, f"{tmp_path}/two", POPSCORE)) == 1


def test_no_rows_write_no_file(spark, tmp_path):
    assert write_json_lines(scores(spark, 0), f"{tmp_path}/none") == 0
    assert data_files(spark, f"{tmp_path}/none", POPSCORE) == []


def test_appends_never_collide(spark, tmp_path):
    for start in (0, 10):
        write_json_lines(scores(spark, 10, start=start), f"{tmp_path}/a")
    assert read_json_lines(spark, f"{tmp_path}/a", POPSCORE).count() == 20


def test_partition_rerun_replaces_only_its_date(spark, tmp_path):
    base = f"{tmp_path}/raw/popscore"
    write_partition(scores(spark, 4, 1.0), base, "2025-01-01")
    for value in (2.0, 3.0):
        write_partition(scores(spark, 3, value), base, "2025-01-02")
    got = read_entity(spark, base, POPSCORE).groupBy("dt").agg(
        F.count("id").alias("n"), F.max("value").alias("v"), F.min("value").alias("w")
    )
    assert sorted(tuple(r) for r in got.collect()) == [
        ("2025-01-01", 4, 1.0, 1.0),
        ("2025-01-02", 3, 3.0, 3.0),
    ]
    assert latest_partition(spark, base) == "2025-01-02"
    assert read_partition(spark, base, POPSCORE, "2025-01-01").count() == 4
    write_partition(scores(spark, 0), base, "2025-01-02")
    assert read_partition(spark, base, POPSCORE, "2025-01-02").count() == 3


def test_date_filter_prunes_partitions(spark, tmp_path):
    base = f"{tmp_path}/raw/popscore"
    for dt in ("2025-01-01", "2025-01-02"):
        write_partition(scores(spark, 2), base, dt)
    assert len(read_partition(spark, base, POPSCORE, "2025-01-01").inputFiles()) >= 1
    # Only the date's own folder is listed.
    files = read_partition(spark, base, POPSCORE, "2025-01-01").inputFiles()
    assert all("dt=2025-01-01" in name for name in files)



# --- Registry


def test_layout():
    assert raw_path("b", "genres", "2025-01-01") == "b/raw/dimensions/genres"
    assert raw_path("b", "games", "2025-01-01") == "b/raw/games/dt=2025-01-01"
    assert raw_path("b", "popscore", "2025-01-01") == "b/raw/popscore/dt=2025-01-01"
    assert raw_path("b", "unknown", "2025-01-01") == "b/raw/unknown/dt=2025-01-01"
    assert raw_path("b", "games") == "b/raw/games"


def test_eight_entities_dimensions_before_facts():
    assert len(ENTITIES) == 8
    assert LOAD_ORDER.index("genres") < LOAD_ORDER.index("games") < LOAD_ORDER.index("popscore")
    with pytest.raises(KeyError):
        entity("nothing")


# --- Manifest


def current(book):
    return {(r.entity, r.dt): r for r in book.current().collect()}


def test_manifest_adds_up_and_lists_a_file_once(spark, root):
    book = Manifest(spark, root)
    book.record("games", "2025-01-01", ["b", "a"], 100, AT)
    book.record("games", "2025-01-01", ["c", "a"], 50, AT)
    row = current(book)["games", "2025-01-01"]
    assert (row.files, row.total_count, row.batch_count) == (["a", "b", "c"], 150, 3)
    assert book.files("games", "2025-01-01") == ["a", "b", "c"]
    assert book.files("games", "2025-01-02") == []


def test_full_refresh_starts_anew(spark, root):
    book = Manifest(spark, root)
    book.record("genres", "2025-01-01", ["a"], 10, AT)
    book.record("genres", "2025-01-02", ["b"], 5, AT, full_refresh=True)
    book.record("genres", "2025-01-03", ["c"], 1, AT)
    # A dimension has one manifest whatever the date.
    assert book.files("genres", "2025-01-03") == ["b", "c"]
    assert {r.file: r.status for r in book.statuses().collect()} == {
        "a": "outdated", "b": "final", "c": "final",
    }


def test_time_series_date_is_replaced_and_history_kept(spark, root):
    book = Manifest(spark, root)
    book.record("popscore", "2025-01-01", ["a"], 10, AT)
    book.record("popscore", "2025-01-02", ["b"], 10, AT)
    book.record("popscore", "2025-01-02", ["c"], 12, AT, full_refresh=True)
    assert book.files("popscore", "2025-01-01") == ["a"]
    assert book.files("popscore", "2025-01-02") == ["c"]
    assert current(book)["popscore", "2025-01-02"].total_count == 12
    assert book.latest_date("popscore") == "2025-01-02" and book.latest_date("games") is None
    assert {r.file: r.status for r in book.statuses().collect()} == {
        "a": "final", "b": "outdated", "c": "final",
    }


def test_full_refresh_outdates_files_of_every_date(spark, root):
    book = Manifest(spark, root)
    book.record("games", "2025-01-01", ["a"], 1, AT)
    book.record("games", "2025-01-02", ["b"], 1, AT, full_refresh=True)
    landed = spark.createDataFrame(
        [("games", "2025-01-02", f) for f in ("b", "x")], "entity string, dt string, file string"
    )
    assert {r.file: r.status for r in book.statuses(landed).collect()} == {
        "a": "outdated", "b": "final", "x": "temp",
    }


def test_manifest_json_round_trip(spark, root):
    book = Manifest(spark, root)
    book.record("games", "2025-01-01", ["b", "a"], 100, AT)
    row = from_json(to_json(book.current())).first()
    assert (row.files, row.total_count, row.batch_count) == (["a", "b"], 100, 2)
    other = spark.createDataFrame(
        [("games", "d", '{"files": ["a", "a"]}')], "entity string, dt string, body string"
    )
    assert from_json(other).first().files == ["a"] and from_json(other).first().total_count is None


# --- State


def test_state_save_reset_and_list(spark, root):
    states = RunState(spark, root)
    assert states.get("games") is None
    states.save("games", datetime(2025, 1, 1))
    states.save("games", AT)
    states.save("genres", AT)
    assert states.get("games") == AT
    states.reset("games")
    assert states.get("games") is None
    assert [(r.entity, r.last_run_time) for r in states.all().collect()] == [
        ("genres", "2025-01-01T12:00:00+00:00")
    ]
    states.save("games", datetime(2025, 1, 1))  # a naive time is UTC
    assert states.get("games") == datetime(2025, 1, 1, tzinfo=timezone.utc)
    assert states.times().count() == 2


# --- Snapshots and staging


def test_snapshot_merged_with_itself_and_old_version_still_readable(spark, root):
    tables = Snapshots(spark, root)
    first = tables.replace("t", spark.range(3))
    tables.replace("t", tables.read("t").union(spark.range(3, 5)), source="s#1")
    assert tables.read("t").count() == 5 and first.count() == 3
    assert tables.applied("t", "s#1") and not tables.applied("t", "s#2")


def test_old_versions_expire(spark, root):
    tables = Snapshots(spark, root)
    for n in range(1, 5):
        tables.replace("t", spark.range(n))
    assert tables.expire("t", keep=2) == 2
    assert tables.read("t").count() == 4
    assert len(os.listdir(f"{root}/marts/t")) == 2
    assert tables.expire("t", keep=2) == 0


def test_missing_snapshot(spark, root):
    tables = Snapshots(spark, root)
    assert tables.read("t", POPSCORE).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read("t")


def test_failed_write_keeps_the_current_version(spark, root):
    tables = Snapshots(spark, root)
    tables.replace("t", spark.range(3))
    with pytest.raises(Exception):
        tables.replace("t", spark.range(3).selectExpr("raise_error('no') AS id"))
    assert tables.read("t").count() == 3


def test_stage_uses_the_shared_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = stage(spark.range(7), "seven")
    assert staged.count() == 7
    assert all(shared_dir(spark) in f for f in staged.inputFiles())
    assert at_most(staged, 7) and not at_most(staged, 6)
    assert work_path(spark, "a") != work_path(spark, "a")


def test_no_machine_local_folder_on_a_cluster():
    cluster = SimpleNamespace(
        conf=SimpleNamespace(get=lambda name, default: default),
        sparkContext=SimpleNamespace(master="yarn", getCheckpointDir=lambda: None),
    )
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(cluster)


def test_drop_work_removes_only_this_application(spark):
    path = f"{shared_dir(spark)}/ludolake/other/file"
    write_text(path, "x")
    stage(spark.range(1), "gone")
    assert drop_work(spark)
    assert os.path.exists(path)


def test_lines_that_do_not_fit(spark, tmp_path):
    """Broken lines go, drifted fields become NULL, and no projection changes the rows."""
    lines = [
        '{"id": 1, "game_id": 2, "popularity_type": 3, "value": 0.5}',
        '{"id": 2, "game_id": "x", "popularity_type": 3, "value": 0.5}',
        '{"id": 3, "game_id": 2.0, "popularity_type": [1], "value": {}}',
        '{"id": 4, "game_id": 2',
        "not json",
        "5",
    ]
    (tmp_path / "a.json").write_text("\n".join(lines))
    rows = read_json_lines(spark, str(tmp_path), POPSCORE)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]
    assert rows.count() == rows.select("id").count() == rows.select("value").count() == 3
    assert rows.where("id = 2").first().value == 0.5


# Tabs, text in numbers, numbers as text, keys twice, elements of another kind, trailing returns.
DRIFTED = [
    ('{"id": 1, "name": "A", "hypes": 4, "genres": [1, "x", null, "3"]}', (1, "A", 4, [1, None, None, 3])),
    ('\t{"id": 2, "name": 5, "hypes": "x"}', (2, "5", None, None)),
    ('  {"id": "3", "hypes": "7", "genres": {}}\r', (3, None, 7, None)),
    ('{"id": 4, "hypes": 1.5, "genres": "none"}', (4, None, None, None)),
    ('{"id": 5, "hypes": true, "name": {"en": "B"}}', (5, '{"en":"B"}', None, None)),
    ('{"id": 6, "id": 7, "name": "twice"}', (7, "twice", None, None)),
    ('{"id": null, "name": "é"}', (None, "é", None, None)),
]
BROKEN = ['{"id": 8, "na', "[1]", "text", "5", "null"]


def drifted(spark, tmp_path, multi_line):
    good = [line for line, _ in DRIFTED]
    if multi_line:
        text = "[" + ",\n".join([*good, *(b for b in BROKEN if b in ("[1]", "5", "null"))]) + "]"
    else:
        text = "\n".join([BROKEN[0], *good, "", " \t ", *BROKEN[1:]])
    write_text(f"{tmp_path}/a.json", text)
    return read_json_lines(spark, str(tmp_path), schemas.GAMES, multi_line)


@pytest.mark.parametrize("multi_line", [False, True])
def test_every_projection_has_the_same_rows(spark, tmp_path, multi_line):
    rows = drifted(spark, tmp_path, multi_line)
    picked = ["id", "name", "hypes", "genres"]
    want = [row for _, row in DRIFTED]
    assert sorted(map(tuple, rows.select(*picked).collect()), key=repr) == sorted(want, key=repr)
    assert rows.count() == len(rows.collect()) == len(want)
    for i, name in enumerate(picked):
        assert sorted((r[0] for r in rows.select(name).collect()), key=repr) == sorted((w[i] for w in want), key=repr)
    assert rows.select("name").count() == rows.select("slug", "hypes").count() == len(want)
    assert rows.schema.fieldNames() == schemas.GAMES.fieldNames()


def test_array_files_of_any_form(spark, tmp_path):
    write_text(f"{tmp_path}/a.json", '[{"id": 1},\n {"id": 2, "hypes": "x"}]')
    write_text(f"{tmp_path}/b.json", '{\n "id": 3\n}')
    write_text(f"{tmp_path}/c.json", '[{"id": 4}, {"id":')  # cut off, so nothing of it counts
    write_text(f"{tmp_path}/d.json", " []\n")
    write_text(f"{tmp_path}/e.json", "")
    rows = read_json_lines(spark, str(tmp_path), schemas.GAMES, multi_line=True)
    assert sorted(r.id for r in rows.collect()) == [1, 2, 3]


def test_dropped_lines_are_counted(spark, tmp_path):
    write_text(f"{tmp_path}/a.json", "\n".join([*(line for line, _ in DRIFTED), "", *BROKEN]))
    from pyspark.sql import Observation

    seen = Observation()
    rows = read_json_lines(spark, str(tmp_path), schemas.GAMES, broken=seen)
    assert rows.select("slug").where("slug IS NULL").count() == len(DRIFTED)
    assert seen.get["dropped"] == len(BROKEN)


@pytest.mark.parametrize("n", [0, 7])
def test_a_write_evaluates_its_rows_once(spark, tmp_path, n):
    seen = spark.sparkContext.accumulator(0)

    def watch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = scores(spark, 20).mapInArrow(watch, POPSCORE).where(F.col("id") < n)
    assert write_json_lines(rows, f"{tmp_path}/a") == n
    assert seen.value == 20
    assert os.path.exists(f"{tmp_path}/a") == bool(n)
    assert write_partition(rows, f"{tmp_path}/b", "2025-01-01") == n
    assert seen.value == 40
    assert os.path.exists(f"{tmp_path}/b/dt=2025-01-01") == bool(n)


# --- Logs and addresses


def test_log_of_many_commits_opens_few_files(spark, root):
    log = Log(spark, f"{root}/log", "n long, t string")
    commits = 2 * logs.MERGE_AFTER + 5
    for n in range(commits):
        log.append(n=n, t=f"row {n}")
        assert len(log.rows().inputFiles()) <= 2 * logs.MERGE_AFTER
    rows = log.rows().orderBy("seq").collect()
    assert [r.n for r in rows] == list(range(commits)) and rows[3].t == "row 3"
    assert len({r.seq for r in rows}) == commits
    assert len(os.listdir(f"{root}/log/commits")) <= 2 * logs.MERGE_AFTER
    assert len(os.listdir(f"{root}/log/merged")) <= 2


def test_log_ignores_a_commit_that_died(spark, root):
    log = Log(spark, f"{root}/log", "n long")
    log.append(n=1)
    done = os.listdir(f"{root}/log/commits")[0]
    half = f"{root}/log/commits/{int(done) + 1:020d}"
    os.makedirs(half)
    for name in os.listdir(f"{root}/log/commits/{done}"):
        if name.endswith(".parquet"):
            shutil.copy(f"{root}/log/commits/{done}/{name}", half)
    assert log.rows().count() == 1
    log.append(n=2)
    assert sorted(r.n for r in log.rows().collect()) == [1, 2]


def test_many_rows_in_one_commit(spark, root):
    log = Log(spark, f"{root}/log", "n long, t string")
    log.append_rows(spark.range(500, numPartitions=3).selectExpr("id AS n", "'x' AS t"))
    log.append(n=-1, t=None)
    assert log.rows().count() == 501 and log.rows().select("seq").distinct().count() == 2
    assert log.rows().agg(F.min_by("n", "seq"), F.max_by("n", "seq")).first()[1] == -1


def test_states_of_many_entities_in_one_commit(spark, root):
    states = RunState(spark, root)
    entries = spark.range(300).selectExpr("concat('e', id) AS entity", "'2025-01-01T00:00:00' AS last_run_time")
    states.save_all(entries, now=AT)
    states.save("e7", AT)
    assert states.all().count() == 300 and len(os.listdir(f"{root}/meta/state/commits")) == 2
    assert states.get("e7") == AT and states.get("e8") == datetime(2025, 1, 1, tzinfo=timezone.utc)


def test_other_engines_follow_the_address(spark, root):
    """DuckDB finds the current version by the stable address, before and after a rebuild."""
    tables = Snapshots(spark, root)

    def outside():
        folder = open(tables.address("t")).read()
        where = f"{root}/{folder}/*.parquet"
        return duckdb.sql(f"SELECT sum(id) FROM read_parquet('{where}')").fetchall()[0][0]

    tables.replace("t", spark.range(4))
    assert outside() == 6
    old = open(tables.address("t")).read()
    tables.replace("t", spark.range(5))
    assert outside() == 10 and open(tables.address("t")).read() != old
    with pytest.raises(Exception):
        tables.replace("t", spark.range(3).selectExpr("raise_error('no') AS id"))
    assert outside() == 10
    assert tables.expire("t", keep=1) == 1 and outside() == 10
