"""One query per operator or model, each over whole tables of ``sf_dir``."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..files import children
from ..functions.dates import epoch_day_text, epoch_minute_text
from ..operators import arrays, latest, order, pivot, quality, runs
from ..plans import build, dimension, loads, marts, popularity, serving, staging
from ..sources import landing, manifest, schemas
from ..sources.registry import ENTITIES, entity, raw_path
from ..sources.buckets import Buckets
from ..sources.snapshots import Snapshots
from ..sources.state import RunState
from ..session import stage, work_path
from ..streaming import ingest_available
from . import standins as st

MISSING = "?"
LOADED_AT = datetime(2024, 2, 1, 12, tzinfo=timezone.utc)


def _plain(df: DataFrame) -> DataFrame:
    """Arrays as text and ints as longs, so that both engines give the same values."""
    small = (T.IntegerType, T.ShortType, T.ByteType)
    columns = []
    for field in df.schema.fields:
        if isinstance(field.dataType, T.ArrayType):
            columns.append(f"array_join({field.name}, '|', '{MISSING}') AS {field.name}")
        elif isinstance(field.dataType, small):
            columns.append(f"cast({field.name} AS bigint) AS {field.name}")
        else:
            columns.append(field.name)
    return df.selectExpr(*columns)


# --- Latest rows and merging -------------------------------------------------


def latest_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = latest.latest_by_key(
        st.events_as_updates(spark, sf_dir), "user_id", "updated_at", ties=["event_id"]
    )
    return newest.where(F.col("event_type").isNotNull())


def _order_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return st.table(spark, sf_dir, "orders").select(
        "o_custkey", st.epoch("o_orderdate").alias("updated_at"), "o_orderkey", "o_totalprice"
    )


def _order_lots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before 1999 as the table; all later ones, and 1998 again, as the increment."""
    rows = _order_versions(spark, sf_dir)
    # One order per customer and day: the greatest key.
    rows = latest.latest_by_key(rows, ["o_custkey", "updated_at"], "o_orderkey")
    until, since = int(datetime(1999, 1, 1, tzinfo=timezone.utc).timestamp()), int(
        datetime(1998, 1, 1, tzinfo=timezone.utc).timestamp()
    )
    old = latest.latest_by_key(rows.where(F.col("updated_at") < until), "o_custkey", "updated_at")
    old = stage(old, "old")
    new = rows.where(F.col("updated_at") >= since)
    return old, new


def _merge_orders(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    old, new = _order_lots(spark, sf_dir)
    return latest.upsert_latest(old, new, "o_custkey", "updated_at", **options)


def upsert_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _merge_orders(spark, sf_dir)


def upsert_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table kept in buckets, the increment in two commits."""
    old, new = _order_lots(spark, sf_dir)
    tables = Buckets(spark, work_path(spark, "lake"), total=8)
    tables.replace("orders", old, "o_custkey")
    half = F.col("updated_at") < _epoch(2000, 1, 1)
    tables.upsert("orders", new.where(half), "o_custkey", "updated_at")
    return tables.upsert("orders", new.where(~half), "o_custkey", "updated_at")


def upsert_latest_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path an increment too large to broadcast takes."""
    return _merge_orders(spark, sf_dir, small_increment=0)


# --- Staging, bridges, dimension ---------------------------------------------


def stg_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every game landed twice; the older copy has another name."""
    games = st.raw_games(spark, sf_dir)
    older = games.withColumns({"name": F.lit("old"), "updated_at": F.col("updated_at") - 1})
    return _plain(staging.stg_games(older.unionByName(games)))


def stg_games_nameless(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A game whose latest version has no name is left out, whatever its older ones say."""
    games = st.raw_games(spark, sf_dir)
    newer = games.where("id % 7 = 0").withColumns(
        {"name": F.lit(None).cast("string"), "updated_at": F.col("updated_at") + 1}
    )
    return staging.stg_games(newer.unionByName(games)).select("id", "name", "updated_at")


def stg_dimensions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dimensions staged from two versions of each row."""
    parts = None
    for name, rows in st.dimensions(spark, sf_dir).items():
        newer = rows.withColumn("updated_at", F.lit(2).cast("long"))
        older = rows.withColumns({"name": F.lower("name"), "updated_at": F.lit(1).cast("long")})
        raw = newer.unionByName(older)
        for field in entity(name).schema.fields:
            if field.name not in raw.columns:
                raw = raw.withColumn(field.name, F.lit(None).cast(field.dataType))
        part = staging.stg_dimension(name, raw).select(
            F.lit(name).alias("entity"), "id", "name", "updated_at"
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def bridge_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.bridge("stg_game_genre_bridge", st.raw_games(spark, sf_dir))


def bridge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = st.raw_games(spark, sf_dir)
    parts = None
    for name, (_, target, _) in staging.BRIDGES.items():
        part = staging.bridge(name, games).select(
            F.lit(name).alias("bridge"), "game_id", F.col(target).alias("dim_id")
        )
        parts = part if parts is None else parts.unionByName(part)
    return parts


def bridge_semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform rows of the games that have one of their own: customers with a balance."""
    games = st.raw_games(spark, sf_dir)
    funded = st.table(spark, sf_dir, "customer").where(F.col("c_acctbal") > 0)
    bridge = staging.bridge("stg_game_platform_bridge", games)
    return arrays.valid_bridge(bridge, funded, key="c_custkey")


def _name_kinds(spark: SparkSession, sf_dir: str):
    dims = st.dimensions(spark, sf_dir)
    return {out: (ids, dims[dim]) for out, (ids, dim) in staging.NAME_ARRAYS.items()}


def dim_name_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bridge rows joined and collected: the way of large dimensions."""
    games = st.raw_games(spark, sf_dir)
    named = arrays.assemble_name_arrays(games, _name_kinds(spark, sf_dir))
    return _plain(named.select("id", *staging.NAME_ARRAYS))


def _dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    games = staging.stg_games(st.raw_games(spark, sf_dir))
    return dimension.dim_games(games, st.dimensions(spark, sf_dir))


def _tabled_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as a written table, for the marts that read it more than once."""
    return stage(_dim(spark, sf_dir), "dim")


def dim_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_dim(spark, sf_dir))


# --- Popularity --------------------------------------------------------------


def source_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fifth of the scores has a code that is not wanted, another fifth none."""
    code = F.when(F.col("id") % 5 == 0, 99).when(F.col("id") % 5 != 1, F.col("popularity_type"))
    return popularity.wanted_scores(st.raw_scores(spark, sf_dir).withColumn("popularity_type", code))


def type_label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return popularity.stg_popscore(st.raw_scores(spark, sf_dir), st.popularity_types(spark))


def type_label_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores whose type is not known, and types of a source that is not."""
    code = F.when(F.col("id") % 4 == 0, F.lit(77).cast("long")).otherwise(F.col("popularity_type"))
    scores = st.raw_scores(spark, sf_dir).withColumn("popularity_type", code)
    source = F.when(F.col("id") % 2 == 0, F.col("external_popularity_source")).when(F.col("id") % 3 == 0, 7)
    types = st.popularity_types(spark).withColumn("external_popularity_source", source)
    return popularity.stg_popscore(scores, types)


def stg_popularity_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The types of the scores, landed twice; the older rows have another name."""
    found = st.raw_scores(spark, sf_dir).select("popularity_type").distinct()
    types = st.popularity_types(spark).join(found, F.col("id") == F.col("popularity_type"), "left_semi")
    newer = _landable("popularity_types", types).withColumn("updated_at", F.lit(2).cast("long"))
    older = newer.withColumns({"name": F.lit("old"), "updated_at": F.lit(1).cast("long")})
    return _plain(staging.stg_popularity_types(older.unionByName(newer)))


def metric_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(pivot.pivot_metrics(st.raw_scores(spark, sf_dir)))


def _fact(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return popularity.fct_game_popularity(st.raw_scores(spark, sf_dir), **options)


def fct_game_popularity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(_fact(spark, sf_dir))


def fct_game_popularity_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path a fact too large for one task takes."""
    return _plain(_fact(spark, sf_dir, small_rows=0))


def percentile_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rankings of all orders; customers tie, and a priority has a fifth of the rows."""
    orders = st.table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_totalprice",
        "o_custkey",
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
    )
    ranked = order.percentile_buckets(
        orders,
        "o_orderkey",
        {
            "price_percentile": F.col("o_totalprice"),
            "customer_percentile": F.col("o_custkey"),
            "priority_percentile": F.col("priority"),
        },
    )
    return _plain(ranked)


def exact_percentile(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = order.value_counts(st.table(spark, sf_dir, "lineitem"), "l_quantity")
    return order.exact_percentile(counts, 0.25, "lower_quartile")


def exact_percentile_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = order.value_counts(st.table(spark, sf_dir, "orders"), "o_totalprice")
    return order.exact_percentile(counts, 0.25, "lower_quartile", small_values=0)


# --- Marts -------------------------------------------------------------------


def mart_recent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.recent_games(_dim(spark, sf_dir), st.AS_OF))


def mart_hyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.top_hyped(_dim(spark, sf_dir), st.AS_OF))


def mart_top_rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.top_rated(_tabled_dim(spark, sf_dir)))


def mart_theme_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.theme_trends(_dim(spark, sf_dir)))


def mart_trending(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.trending_now(_tabled_dim(spark, sf_dir), _fact(spark, sf_dir)))


def mart_controversial(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.controversial_games(_tabled_dim(spark, sf_dir), _fact(spark, sf_dir)))


def mart_hidden_gems(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(marts.hidden_gems(_tabled_dim(spark, sf_dir), _fact(spark, sf_dir)))


def mart_rising(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = stage(_fact(spark, sf_dir), "fact")
    return _plain(marts.rising_stars(_tabled_dim(spark, sf_dir), fact))


def mart_rising_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The path games too many for one task take."""
    fact = stage(_fact(spark, sf_dir, small_rows=0), "fact")
    return _plain(marts.rising_stars(_tabled_dim(spark, sf_dir), fact, small_rows=0))


# --- Serving -----------------------------------------------------------------


def summary_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = serving.summary_metrics(_dim(spark, sf_dir))
    updated = F.unix_seconds("last_updated")
    return totals.select(
        "total_games",
        updated.alias("last_updated"),
        epoch_minute_text(updated).alias("last_updated_text"),
    )


def mart_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First rows of the recent games after a round trip through Parquet."""
    mart = stage(marts.recent_games(_dim(spark, sf_dir), st.AS_OF), "mart")
    rows = serving.fetch_mart("mart_recent_games", mart, 10)
    return _plain(rows.withColumn("release_date", epoch_day_text(F.col("first_release_date"))))


def search_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(serving.search_games(_dim(spark, sf_dir), " OMER#0000001% "))


def search_names_indexed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search by the table of name grams."""
    dim = _tabled_dim(spark, sf_dir)
    grams = stage(serving.name_grams(dim), "grams")
    return _plain(serving.search_games(dim, " OMER#0000001% ", grams=grams))


def search_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same search over whole texts."""
    documents = st.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("game_id"),
        F.col("text").alias("game_name"),
        F.col("n_chars").alias("first_release_date"),
        F.col("lang").alias("platform_names"),
        F.col("source").alias("genre_names"),
        F.col("text").alias("game_summary"),
    )
    found = serving.search_games(documents, "LICENSE")
    return found.select(
        F.md5("game_name").alias("text_hash"), F.col("platform_names").alias("lang"),
        F.col("genre_names").alias("source"),
    )


def page_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = st.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return order.page_numbers(parts, [F.col("p_partkey").asc()])


def page_rows_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of all orders by customer, in the way of large tables."""
    orders = st.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    return order.page_numbers(
        orders, [F.col("o_custkey").asc(), F.col("o_orderkey").asc()], small_rows=0
    )


def page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page cut from the global index, as deep pages are."""
    lines = st.table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return order.page(lines, [F.col("o_orderkey").asc()], offset=1000, limit=500, small_rows=0)


def page_offset(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = st.table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return order.page(parts, [F.col("p_partkey").asc()], offset=100, limit=500)


# --- Partitions and increments -----------------------------------------------


def incremental_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    last_run = datetime(2024, 1, 20, 12, tzinfo=timezone.utc)
    return loads.changed_since(st.events_as_updates(spark, sf_dir), last_run)


def _landed_by_date(spark: SparkSession, sf_dir: str) -> str:
    base = work_path(spark, "popscore")
    scores = st.dated_scores(spark, sf_dir)
    # Rows of a date go together, a date with very many rows in several parts.
    scores.hint("rebalance", "dt").write.partitionBy("dt").json(base)
    return base


def latest_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed_by_date(spark, sf_dir)
    newest = landing.latest_partition(spark, base)
    rows = landing.read_partition(spark, base, schemas.POPSCORE, newest)
    return rows.withColumn("dt", F.lit(newest))


def date_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed_by_date(spark, sf_dir)
    return landing.read_partition(spark, base, schemas.POPSCORE, "2024-01-15")


def all_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = _landed_by_date(spark, sf_dir)
    rows = landing.read_entity(spark, base, schemas.POPSCORE)
    return rows.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n_rows"), F.max("value").alias("max_value")
    )


def file_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per date, the date taken from the path of the file."""
    base = _landed_by_date(spark, sf_dir)
    rows = landing.read_entity(spark, base, schemas.POPSCORE)
    date = landing.partition_of(F.col("_metadata.file_path"))
    return rows.select(date.alias("file_date")).groupBy("file_date").agg(
        F.count(F.lit(1)).alias("n_rows")
    )


# --- Landing zone ------------------------------------------------------------


def json_lines_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = work_path(spark, "lines")
    landing.write_json_lines(st.raw_scores(spark, sf_dir), path)
    return landing.read_json_lines(spark, path, schemas.POPSCORE)


def _lines_and_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, line, element): scores as JSON, some drifted, led by a tab, cut off or no objects."""
    scores = st.raw_scores(spark, sf_dir)
    whole = F.to_json(F.struct("id", "game_id", "popularity_type", "value"))
    kind = F.col("id") % 10

    def with_text(column: str, text) -> F.Column:
        fields = [f for f in schemas.POPSCORE.fieldNames() if f != column]
        rest = F.to_json(F.struct(*fields))
        return F.concat(F.lit("{"), F.lit(f'"{column}": '), text, F.lit(", "), F.substring(rest, 2, 1 << 20))

    drifted = (
        F.when(kind == 0, with_text("value", F.lit('"x"')))
        .when(kind == 1, F.concat(F.lit("\t"), with_text("value", F.lit('{"v": 1}'))))
        .when(kind == 3, with_text("game_id", F.concat(F.lit('"'), F.col("game_id").cast("string"), F.lit('"'))))
        .when(kind == 4, with_text("popularity_type", F.lit("[1, 2]")))
        .when(kind == 5, F.concat(F.lit("["), whole, F.lit("]")))
        .otherwise(whole)
    )
    cut = F.when(kind == 2, F.substring(whole, 1, 12)).otherwise(drifted)
    return scores.select("id", cut.alias("line"), F.when(kind == 2, "5").otherwise(drifted).alias("element"))


def json_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What remains of lines, and of array files of a thousand elements, that do not all fit."""
    texts = _lines_and_elements(spark, sf_dir)
    lines, arrays = work_path(spark, "lines"), work_path(spark, "arrays")
    texts.select(F.col("line").alias("value")).write.text(lines)
    part = F.expr("id div 1000").alias("part")
    joined = texts.groupBy(part).agg(F.concat_ws(",\n", F.collect_list("element")).alias("all"))
    files = joined.select("part", F.concat(F.lit("["), "all", F.lit("]")).alias("value"))
    files.write.partitionBy("part").text(arrays)
    shapes = [("lines", lines, False), ("arrays", f"{arrays}/*", True)]
    rows = [
        landing.read_json_lines(spark, path, schemas.POPSCORE, multi_line).select(F.lit(name).alias("shape"), "*")
        for name, path, multi_line in shapes
    ]
    return rows[0].unionByName(rows[1])


def batched_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per file of at most 300 each: totals and whether the bound held."""
    path = work_path(spark, "batches")
    landing.write_json_lines(st.raw_scores(spark, sf_dir), path, batch_size=300)
    rows = landing.read_json_lines(spark, path, schemas.POPSCORE)
    per_file = rows.groupBy(F.input_file_name().alias("file")).agg(F.count("id").alias("n"))
    return per_file.agg(
        F.sum("n").alias("n_rows"), (F.max("n") <= 300).cast("long").alias("bound_held")
    )


def hidden_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed dates beside a load that is still under way and a manifest of another tool, which are no data."""
    base = _landed_by_date(spark, sf_dir)
    scores = st.raw_scores(spark, sf_dir)
    scores.write.json(f"{base}/dt=2024-01-15/_temp_1")
    scores.write.json(f"{base}/dt=2024-01-15/.hidden")
    return landing.read_entity(spark, base, schemas.POPSCORE)


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every date landed once, then one date again with other values."""
    base = _landed_by_date(spark, sf_dir)
    scores = st.dated_scores(spark, sf_dir)
    again = scores.where(F.col("dt") == "2024-01-15").drop("dt").withColumn("value", F.lit(0.5))
    for _ in range(2):
        landing.write_partition(again, base, "2024-01-15")
    return landing.read_entity(spark, base, schemas.POPSCORE)


def _two_loads(spark: SparkSession, sf_dir: str, refresh: bool) -> tuple[str, manifest.Manifest]:
    """Scores as a dated fact: even ids first, odd ids in a second load."""
    root = work_path(spark, "lake")
    book = manifest.Manifest(spark, root)
    scores = st.raw_scores(spark, sf_dir)
    for i, rows in enumerate([scores.where("id % 2 = 0"), scores.where("id % 2 = 1")]):
        folder = landing.new_load(raw_path(root, "scores", "2024-02-01"))
        count = landing.write_json_lines(rows, folder)
        book.record("scores", "2024-02-01", [folder], count, LOADED_AT, refresh and i == 1)
    return root, book


def manifest_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the manifest's folders after two loads that add up."""
    _, book = _two_loads(spark, sf_dir, refresh=False)
    files = book.files("scores", "2024-02-01")
    return landing.read_json_lines(spark, files + files, schemas.POPSCORE)


def manifest_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the manifest's folders when the second load replaces the first."""
    _, book = _two_loads(spark, sf_dir, refresh=True)
    files = book.files("scores", "2024-02-01")
    return landing.read_json_lines(spark, files, schemas.POPSCORE)


def manifest_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of two loads through its JSON form and back."""
    _, book = _two_loads(spark, sf_dir, refresh=False)
    read = manifest.from_json(manifest.to_json(book.current()))
    return read.select(
        "entity",
        "dt",
        "total_count",
        (F.size("files") == F.col("batch_count")).cast("long").alias("files_match"),
        F.unix_seconds("created_at").alias("created_at"),
        F.unix_seconds("updated_at").alias("updated_at"),
    )


def file_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in load folders of each status: replaced, current, and landed but not recorded."""
    root, book = _two_loads(spark, sf_dir, refresh=True)
    base = raw_path(root, "scores", "2024-02-01")
    landing.write_json_lines(st.raw_scores(spark, sf_dir), landing.new_load(base))
    folders = [f"{base}/{name}" for name in children(spark, base)]  # three loads
    landed = spark.createDataFrame(
        [("scores", "2024-02-01", f) for f in folders], "entity string, dt string, file string"
    )
    statuses = book.statuses(landed).select(_folder_name("file").alias("name"), "status")
    rows = landing.read_json_lines(spark, folders, schemas.POPSCORE)
    read_from = _folder_name(F.regexp_replace(F.input_file_name(), "/[^/]*$", ""))
    per_folder = rows.groupBy(read_from.alias("name")).agg(F.count("id").alias("n"))
    return per_folder.join(statuses, "name").groupBy("status").agg(F.sum("n").alias("n_rows"))


def _folder_name(path) -> F.Column:
    return F.substring_index(path, "/", -1)


def snapshot_switch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table merged with itself twice, each time into a new version."""
    tables = Snapshots(spark, work_path(spark, "lake"))
    versions = st.events_as_updates(spark, sf_dir)
    early = versions.where(F.col("updated_at") < _epoch(2024, 1, 15))
    tables.replace("users", latest.latest_by_key(early, "user_id", "updated_at", ["event_id"]))
    late = versions.where(F.col("updated_at") >= _epoch(2024, 1, 14))
    for _ in range(2):
        merged = latest.upsert_latest(tables.read("users"), late, "user_id", "updated_at")
        tables.replace("users", merged)
    return tables.read("users")


def _epoch(*date: int) -> int:
    return int(datetime(*date, tzinfo=timezone.utc).timestamp())


def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events landed in two lots, the second overlapping the first, each ingested as it lands."""
    root = work_path(spark, "lake")
    tables = Buckets(spark, root)
    versions = st.events_as_updates(spark, sf_dir)
    table = None
    for lot in [
        versions.where(F.col("updated_at") < _epoch(2024, 1, 15)),
        versions.where(F.col("updated_at") >= _epoch(2024, 1, 10)),
    ]:
        lot.write.mode("append").json(f"{root}/landing")
        table = ingest_available(
            spark,
            f"{root}/landing",
            versions.schema,
            tables,
            "users",
            "user_id",
            "updated_at",
            f"{root}/stream",
        )
    return table


def state_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load modes of all users, with the last event of each as its state.

    Users divisible by three count as time series, which always load in full.
    """
    events = st.events_as_updates(spark, sf_dir)
    states = events.where(F.col("event_type") != "view").groupBy("user_id").agg(
        F.max("updated_at").cast("string").alias("last_run_time")
    )
    kind = F.when(F.col("c_custkey") % 3 == 0, "time_series").otherwise("fact")
    entities = st.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("entity"), kind.alias("kind")
    )
    return loads.load_modes(entities, states.withColumnRenamed("user_id", "entity"), False)


def load_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight entities loaded, marts built, twice; the run log and table sizes."""
    root = work_path(spark, "lake")
    sources = {
        **{name: _landable(name, rows) for name, rows in st.dimensions(spark, sf_dir).items()},
        "games": st.raw_games(spark, sf_dir),
        "popscore": st.raw_scores(spark, sf_dir),
        "popularity_types": _landable("popularity_types", st.popularity_types(spark)),
    }
    for _ in range(2):
        loads.load_all(spark, root, sources, dt="2024-02-01")
    tables = build.build_all(spark, root, dt="2024-02-01", as_of=st.AS_OF)
    sizes = None
    for name, rows in tables.items():
        part = rows.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
        sizes = part if sizes is None else sizes.unionByName(part)
    log = loads.run_log(spark, root).rows()
    loaded = log.groupBy(
        F.concat(F.lit("load "), "entity_name", F.lit(" "), "mode").alias("name")
    ).agg(F.sum("record_count").alias("n_rows"))
    return sizes.unionByName(loaded)


def load_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after a second day on which a third of the games changed and some are new."""
    root = work_path(spark, "lake")
    games = st.raw_games(spark, sf_dir)
    dims = {name: _landable(name, rows) for name, rows in st.dimensions(spark, sf_dir).items()}
    loads.load_all(spark, root, {**dims, "games": games.where("id % 5 <> 0")}, dt="2024-02-01")
    build.build_all(spark, root, dt="2024-02-01", as_of=st.AS_OF)
    later = F.lit(_epoch(2100, 1, 1))
    changed = games.withColumns(
        {
            "updated_at": F.when(F.col("id") % 3 == 0, later).otherwise(F.col("updated_at")),
            "name": F.when(F.col("id") % 3 == 0, F.concat("name", F.lit(" II"))).otherwise("never read"),
        }
    )
    loads.load_all(spark, root, {**dims, "games": changed}, dt="2024-02-02")
    tables = build.build_all(spark, root, dt="2024-02-02", as_of=st.AS_OF)
    return _plain(tables["dim_games"].select("game_id", "game_name", "updated_at", "platform_names"))


def build_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every model of a build, staging models and bridges among them."""
    root = work_path(spark, "lake")
    sources = {
        **{name: _landable(name, rows) for name, rows in st.dimensions(spark, sf_dir).items()},
        "games": st.raw_games(spark, sf_dir),
        "popscore": st.raw_scores(spark, sf_dir),
        "popularity_types": _landable("popularity_types", st.popularity_types(spark)),
    }
    loads.load_all(spark, root, sources, dt="2024-02-01")
    tables = build.build_all(spark, root, dt="2024-02-01", as_of=st.AS_OF, every_model=True)
    names = [name for name in tables if name.startswith("stg_")]
    sizes = [tables[name].agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows")) for name in names]
    return reduce(DataFrame.unionByName, sizes)


def _landable(name: str, rows: DataFrame) -> DataFrame:
    for field in ENTITIES[name].schema.fields:
        if field.name not in rows.columns:
            value = F.lit(0) if field.name == "updated_at" else F.lit(None)
            rows = rows.withColumn(field.name, value.cast(field.dataType))
    return rows


# --- Quality and run metrics -------------------------------------------------


def dq_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    dim = _dim(spark, sf_dir)
    return quality.null_rows(dim, "hypes").select("game_id", "game_name")


def dq_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_values(st.table(spark, sf_dir, "orders"), "o_custkey")


def dq_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    bridge = staging.bridge("stg_game_platform_bridge", st.raw_games(spark, sf_dir))
    nations = st.dimensions(spark, sf_dir)["platforms"]
    return quality.orphan_rows(bridge, "platform_id", nations, "id")


def dq_relationship_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = st.table(spark, sf_dir, "documents").select("doc_id")
    labels = st.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("label_id"))
    return quality.orphan_counts(documents, "doc_id", labels, "label_id")


def dq_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 43 declared checks on the stand-in models."""
    games = stage(staging.stg_games(st.raw_games(spark, sf_dir)), "games")
    dims = st.dimensions(spark, sf_dir)
    models = {f"stg_{name}": rows for name, rows in dims.items()}
    models["stg_games"] = games
    models["dim_games"] = stage(dimension.dim_games(games, dims), "dim")
    for name in staging.BRIDGES:
        models[name] = staging.bridge(name, games)
    return quality.run_checks(models, build.CHECKS)


def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.run_totals(st.runs(spark, sf_dir))


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.mode_summary(st.runs(spark, sf_dir))


def mode_comparison(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.compare_modes(st.runs(spark, sf_dir))


def speedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.speedup_summary(runs.compare_modes(st.runs(spark, sf_dir)))


def run_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State saved for each event type at its last event, one reset, then listed."""
    states = RunState(spark, work_path(spark, "lake"))
    last = st.events_as_updates(spark, sf_dir).groupBy("event_type").agg(
        F.max("updated_at").alias("seconds")
    )
    for days in (1, 0):  # an earlier run, then the last one
        moment = F.timestamp_seconds(F.col("seconds") - days * 86_400)
        text = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ssXXX")
        states.save_all(
            last.select(F.col("event_type").alias("entity"), F.regexp_replace(text, "Z$", "+00:00").alias("last_run_time")),
            now=LOADED_AT,
        )
    states.reset("view", now=LOADED_AT)
    return states.all().join(
        states.times().select("entity", F.unix_seconds("last_run").alias("last_run")), "entity"
    )


QUERIES = {
    f.__name__: f
    for f in [
        latest_by_key,
        upsert_latest,
        upsert_latest_shuffled,
        upsert_buckets,
        stg_games,
        stg_games_nameless,
        stg_dimensions,
        stg_popularity_types,
        bridge_explode,
        bridge_all,
        bridge_semi_join,
        dim_name_arrays,
        dim_games,
        source_filter,
        type_label_join,
        type_label_unknown,
        metric_pivot,
        fct_game_popularity,
        fct_game_popularity_ranged,
        percentile_buckets,
        exact_percentile,
        exact_percentile_ranged,
        mart_recent,
        mart_hyped,
        mart_top_rated,
        mart_theme_trends,
        mart_trending,
        mart_controversial,
        mart_hidden_gems,
        mart_rising,
        mart_rising_ranged,
        summary_metrics,
        mart_fetch,
        search_names,
        search_names_indexed,
        search_documents,
        page_rows,
        page_rows_ranged,
        page_offset,
        page_deep,
        incremental_read,
        latest_partition,
        date_partition,
        all_partitions,
        file_dates,
        json_lines_roundtrip,
        json_malformed,
        batched_write,
        hidden_paths,
        partition_replace,
        manifest_scan,
        manifest_refresh,
        manifest_json,
        file_status,
        snapshot_switch,
        stream_upsert,
        state_modes,
        load_run,
        load_increment,
        build_models,
        dq_not_null,
        dq_unique,
        dq_relationships,
        dq_relationship_counts,
        dq_suite,
        run_totals,
        run_metrics,
        mode_comparison,
        speedup,
        run_state,
    ]
}
