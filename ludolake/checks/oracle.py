"""DuckDB SQL each query must equal, written over the driver's tables."""

from __future__ import annotations

# The stand-in games: the same derivation as standins.raw_games.
GAMES = """
per_customer AS (
  SELECT o_custkey, count(*) AS n_orders,
         sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents,
         count(*) FILTER (o_orderstatus = 'O') AS n_open,
         min(o_orderdate) AS first_order, max(o_orderdate) AS last_order,
         list_sort(list(DISTINCT o_orderkey % 27)) AS platforms,
         list_sort(list(DISTINCT CAST(substr(o_orderpriority, 1, 1) AS BIGINT))) AS genres,
         list_sort(list(DISTINCT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END)) AS game_modes,
         list_sort(list(DISTINCT year(o_orderdate) - 1995)) AS themes
  FROM orders GROUP BY o_custkey),
games AS (
  SELECT c_custkey AS id, c_name AS name, lower(replace(c_name, '#', '-')) AS slug,
         CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS summary,
         CAST(c_nationkey % 5 AS BIGINT) AS game_type, CAST(c_nationkey AS BIGINT) AS cover,
         'https://example.org/games/' || c_custkey AS url,
         CAST(epoch_us(first_order) // 1000000 AS BIGINT) AS created_at,
         CAST(coalesce(epoch_us(last_order) // 1000000, 0) AS BIGINT) AS updated_at,
         genres, platforms, game_modes, themes,
         CASE WHEN c_custkey % 11 = 0 THEN [] ELSE [c_nationkey % 7] END AS player_perspectives,
         CAST(epoch_us(first_order) // 1000000 AS BIGINT) AS first_release_date,
         nullif(n_open, 0) AS hypes,
         CASE WHEN n_orders > 0 THEN least(100.0::DOUBLE,
              floor(CAST(cents AS DOUBLE) / (n_orders * 500000) * 64) / 64) END AS aggregated_rating,
         n_orders AS aggregated_rating_count
  FROM customer LEFT JOIN per_customer ON c_custkey = o_custkey)
"""

# array column, output, dimension table, its key, its name
_ARRAYS = [
    ("platforms", "platform_names", "nation", "n_nationkey", "n_name"),
    ("genres", "genre_names", "region", "r_regionkey", "r_name"),
    ("game_modes", "game_mode_names", "region", "r_regionkey", "r_name"),
    ("themes", "theme_names", "nation", "n_nationkey", "n_name"),
    ("player_perspectives", "perspective_names", "region", "r_regionkey", "r_name"),
]

NAMES = ",\n".join(
    f"""{output} AS (
  SELECT e.id, string_agg(coalesce(d.{name}, '?'), '|' ORDER BY e.v) AS {output}
  FROM (SELECT id, unnest({ids}) AS v FROM games) e LEFT JOIN {table} d ON d.{key} = e.v
  GROUP BY e.id)"""
    for ids, output, table, key, name in _ARRAYS
)

DIM = f"""{GAMES.strip()},
{NAMES},
dim AS (
  SELECT g.id AS game_id, g.name AS game_name, g.slug AS game_slug, g.summary AS game_summary,
         platform_names.platform_names, genre_names.genre_names, game_mode_names.game_mode_names,
         theme_names.theme_names, perspective_names.perspective_names,
         g.url, g.cover, g.hypes, g.aggregated_rating, g.aggregated_rating_count,
         g.first_release_date, g.created_at, g.updated_at
  FROM games g
  {' '.join(f'LEFT JOIN {output} ON {output}.id = g.id' for _, output, *_ in _ARRAYS)})"""

SCORES = """scores AS (
  SELECT event_id AS id, user_id AS game_id,
         CAST([1,2,3,4,5,6,7,8,9,10,34][CAST(json_extract_string(props, '$.k') AS INT) % 11 + 1] AS BIGINT) AS popularity_type,
         value, strftime(ts, '%Y-%m-%d') AS dt
  FROM events)"""

_METRICS = [
    (1, "visits"),
    (2, "want_to_play"),
    (3, "playing"),
    (4, "played"),
    (5, "steam_24hr_peak_players"),
    (6, "steam_positive_reviews"),
    (7, "steam_negative_reviews"),
    (8, "steam_total_reviews"),
    (9, "steam_global_top_sellers"),
    (10, "steam_most_wishlisted"),
    (34, "twitch_24hr_hours_watched"),
]

WIDE = f"""{SCORES},
per_type AS (
  SELECT game_id, popularity_type AS t, max(value) AS v FROM scores GROUP BY game_id, popularity_type),
wide AS (
  SELECT game_id, {', '.join(f'max(v) FILTER (t = {t}) AS {name}' for t, name in _METRICS)},
         coalesce(max(v) FILTER (t = 1), 0) + coalesce(max(v) FILTER (t = 2), 0)
           + coalesce(max(v) FILTER (t = 3), 0) + coalesce(max(v) FILTER (t = 4), 0) AS igdb_total_engagement,
         CAST(bool_or(t BETWEEN 1 AND 4) AS BIGINT) AS has_igdb_data,
         CAST(bool_or(t BETWEEN 5 AND 10) AS BIGINT) AS has_steam_data,
         CAST(bool_or(t = 34) AS BIGINT) AS has_twitch_data,
         count(*) AS available_metrics_count,
         CAST(bool_or(t BETWEEN 1 AND 4) AS BIGINT) + CAST(bool_or(t BETWEEN 5 AND 10) AS BIGINT)
           + CAST(bool_or(t = 34) AS BIGINT) AS cross_platform_score
  FROM per_type GROUP BY game_id)"""


def _ntile(metric: str, output: str, key: str = "game_id") -> str:
    return f"CAST(ntile(100) OVER (ORDER BY {metric}, {key}) AS BIGINT) AS {output}"


FACT = f"""{WIDE},
fact AS (
  SELECT *,
    {_ntile('coalesce(steam_positive_reviews, 0)', 'positive_reviews_percentile')},
    {_ntile('coalesce(steam_negative_reviews, 0)', 'negative_reviews_percentile')},
    {_ntile('coalesce(steam_total_reviews, 0)', 'total_reviews_percentile')},
    {_ntile('igdb_total_engagement', 'engagement_percentile')},
    {_ntile('coalesce(playing, 0)', 'playing_percentile')},
    {_ntile('coalesce(played, 0)', 'played_percentile')}
  FROM wide)"""

MODEL = f"{DIM},\n{FACT}"

VERSIONS = """versions AS (
  SELECT user_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS updated_at, event_id, event_type, value
  FROM events)"""

RUNS = """runs AS (
  SELECT event_type AS entity_name,
         CASE WHEN event_id % 2 = 0 THEN 'sequential' ELSE 'concurrent' END AS mode,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 37 AS record_count,
         floor(value * 4) / 4 AS elapsed_seconds
  FROM events)"""

COMPARED = f"""{RUNS},
compared AS (
  SELECT entity_name,
         sum(elapsed_seconds) FILTER (mode = 'sequential') AS sequential_elapsed,
         sum(elapsed_seconds) FILTER (mode = 'concurrent') AS concurrent_elapsed,
         CAST(sum(record_count) FILTER (mode = 'sequential') AS BIGINT) AS record_count,
         round(sum(elapsed_seconds) FILTER (mode = 'sequential')
               / sum(elapsed_seconds) FILTER (mode = 'concurrent'), 2) AS speedup
  FROM runs GROUP BY entity_name)"""

MERGED = """
WITH days AS (
  SELECT o_custkey, CAST(epoch_us(o_orderdate) // 1000000 AS BIGINT) AS updated_at, o_orderkey, o_totalprice
  FROM orders)
SELECT o_custkey, updated_at, o_orderkey, o_totalprice FROM days
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY updated_at DESC, o_orderkey DESC) = 1
"""

LATEST = f"""
WITH {VERSIONS}
SELECT * FROM versions
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY updated_at DESC, event_id DESC) = 1
"""

ALL_SCORES = f"WITH {SCORES} SELECT id, game_id, popularity_type, value FROM scores"

FACT_ROWS = f"WITH {FACT} SELECT * FROM fact"

FOUND = f"""
WITH {DIM}
SELECT game_name, year(make_timestamp(first_release_date * 1000000)) AS release_year,
       platform_names, genre_names, game_summary
FROM dim WHERE game_name ILIKE '%OMER#0000001%%'
ORDER BY first_release_date DESC, game_id LIMIT 100"""

_CARD = "first_release_date, game_summary, cover, url"
_RECENT = f"""
  SELECT game_name, first_release_date, platform_names, genre_names, game_summary, cover, url
  FROM dim WHERE first_release_date <= epoch(TIMESTAMP '1997-01-01')
  ORDER BY first_release_date DESC, game_id"""

_PERCENTILES_OF_ORDERS = f"""
WITH o AS (
  SELECT o_orderkey, o_totalprice, o_custkey, CAST(substr(o_orderpriority, 1, 1) AS DOUBLE) AS priority
  FROM orders)
SELECT *, {_ntile('o_totalprice', 'price_percentile', 'o_orderkey')},
       {_ntile('o_custkey', 'customer_percentile', 'o_orderkey')},
       {_ntile('priority', 'priority_percentile', 'o_orderkey')}
FROM o
"""

_BRIDGES = [
    ("stg_game_platform_bridge", "platforms"),
    ("stg_game_genre_bridge", "genres"),
    ("stg_game_mode_bridge", "game_modes"),
    ("stg_game_theme_bridge", "themes"),
    ("stg_game_perspective_bridge", "player_perspectives"),
]

_DIMENSIONS = [
    ("platforms", "nation", "n_nationkey", "n_name"),
    ("genres", "region", "r_regionkey", "r_name"),
    ("game_modes", "region", "r_regionkey", "r_name"),
    ("themes", "nation", "n_nationkey", "n_name"),
    ("player_perspectives", "region", "r_regionkey", "r_name"),
]


def _suite() -> str:
    rows = []

    def add(model: str, column: str, check: str, failures: str, severity: str = "error") -> None:
        rows.append(
            f"SELECT '{model}' AS model, '{column}' AS \"column\", '{check}' AS \"check\", "
            f"'{severity}' AS severity, CAST(({failures}) AS BIGINT) AS failures"
        )

    def keyed(model: str, table: str, key: str, name: str) -> None:
        add(model, "id", "not_null", f"SELECT count(*) FROM {table} WHERE {key} IS NULL")
        add(model, "id", "unique", _repeats(table, key))
        add(model, "name", "not_null", f"SELECT count(*) FROM {table} WHERE {name} IS NULL")

    def _repeats(table: str, key: str) -> str:
        return f"SELECT count(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING count(*) > 1)"

    keyed("stg_games", "games", "id", "name")
    for dimension, table, key, name in _DIMENSIONS:
        keyed(f"stg_{dimension}", table, key, name)
    targets = ["platform_id", "genre_id", "game_mode_id", "theme_id", "perspective_id"]
    for (bridge, ids), target, (_, table, key, _) in zip(_BRIDGES, targets, _DIMENSIONS):
        pairs = f"(SELECT id AS game_id, unnest({ids}) AS v FROM games)"
        add(bridge, "game_id", "not_null", f"SELECT count(*) FROM {pairs} WHERE game_id IS NULL")
        add(bridge, "game_id", "relationships",
            f"SELECT count(*) FROM {pairs} WHERE game_id NOT IN (SELECT id FROM games)")
        add(bridge, target, "not_null", f"SELECT count(*) FROM {pairs} WHERE v IS NULL")
        add(bridge, target, "relationships",
            f"SELECT count(*) FROM {pairs} WHERE v NOT IN (SELECT {key} FROM {table})")
    add("dim_games", "game_id", "not_null", "SELECT count(*) FROM dim WHERE game_id IS NULL")
    add("dim_games", "game_id", "unique", _repeats("dim", "game_id"))
    add("dim_games", "game_name", "not_null", "SELECT count(*) FROM dim WHERE game_name IS NULL")
    add("dim_games", "platform_names", "column_type", "SELECT 0")
    add("dim_games", "hypes", "not_null", "SELECT count(*) FROM dim WHERE hypes IS NULL", "warn")
    checks = "\nUNION ALL ".join(rows)
    return f"""WITH {DIM}, results AS ({checks})
SELECT *, CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM results"""


def _load_sizes() -> str:
    counts = {
        "stg_games": "SELECT count(*) FROM customer",
        "dim_games": "SELECT count(*) FROM customer",
        "fct_game_popularity": "SELECT count(*) FROM fact",
        "mart_recent_games": "SELECT least(50, count(*)) FROM dim WHERE first_release_date <= 852076800",
        "mart_top_hyped": "SELECT least(50, count(*)) FROM dim WHERE hypes > 0 AND (first_release_date IS NULL OR first_release_date > 852076800)",
        "mart_top_rated": "SELECT least(50, count(*)) FROM dim WHERE aggregated_rating_count >= 5",
        "mart_theme_trends": "SELECT least(50, count(DISTINCT v)) FROM (SELECT unnest(themes) AS v FROM games)",
        "mart_trending_now": "SELECT least(100, count(*)) FROM fact JOIN dim USING (game_id) WHERE playing >= 0 AND played >= 0 AND playing_percentile >= 50 AND played_percentile >= 20",
        "mart_controversial_games": "SELECT least(100, count(*)) FROM fact JOIN dim USING (game_id) WHERE steam_negative_reviews IS NOT NULL AND steam_positive_reviews IS NOT NULL AND steam_total_reviews IS NOT NULL AND negative_reviews_percentile >= 40 AND positive_reviews_percentile >= 30 AND total_reviews_percentile >= 30",
        "mart_hidden_gems": "SELECT least(100, count(*)) FROM fact JOIN dim USING (game_id) WHERE (positive_reviews_percentile >= 50 OR aggregated_rating >= 75) AND engagement_percentile <= 50 AND total_reviews_percentile <= 60 AND negative_reviews_percentile <= 40",
        "mart_rising_stars": "SELECT least(100, count(*)) FROM fact JOIN dim USING (game_id) WHERE playing IS NOT NULL AND playing_percentile >= 30",
        "load games full": "SELECT count(*) FROM customer",
        "load popscore full": "SELECT 2 * count(*) FROM events",
        "load popularity_types full": "SELECT 11",
    }
    for dimension, table, *_ in _DIMENSIONS:
        counts[f"load {dimension} full"] = f"SELECT count(*) FROM {table}"
    for name in ["games", "popularity_types", *[d for d, *_ in _DIMENSIONS]]:
        counts[f"load {name} incremental"] = "SELECT 0"
    rows = "\nUNION ALL ".join(
        f"SELECT '{name}' AS name, CAST(({count}) AS BIGINT) AS n_rows" for name, count in counts.items()
    )
    return f"WITH {MODEL} {rows}"


def _model_sizes() -> str:
    counts = {"stg_games": "games", "stg_popscore": "events", "stg_popularity_types": "range(11)"}
    counts.update({f"stg_{dimension}": table for dimension, table, *_ in _DIMENSIONS})
    counts.update({bridge: f"(SELECT unnest({ids}) FROM games)" for bridge, ids in _BRIDGES})
    rows = "\nUNION ALL ".join(f"SELECT '{name}' AS name, count(*) AS n_rows FROM {rows}" for name, rows in counts.items())
    return f"WITH {GAMES} {rows}"


ORACLE = {
    "latest_by_key": LATEST,
    "upsert_latest": MERGED,
    "upsert_latest_shuffled": MERGED,
    "upsert_buckets": MERGED,
    "stg_games": f"""
WITH {GAMES}
SELECT id, name, slug, summary, game_type, CAST(NULL AS BIGINT) AS parent_game, cover, url,
       CAST(NULL AS VARCHAR) AS checksum, created_at, updated_at,
       array_to_string(genres, '|') AS genres, array_to_string(platforms, '|') AS platforms,
       array_to_string(game_modes, '|') AS game_modes,
       array_to_string(player_perspectives, '|') AS player_perspectives,
       array_to_string(themes, '|') AS themes, CAST(NULL AS VARCHAR) AS game_engines,
       CAST(NULL AS VARCHAR) AS keywords, first_release_date, CAST(NULL AS VARCHAR) AS release_dates,
       CAST(NULL AS VARCHAR) AS screenshots, CAST(NULL AS VARCHAR) AS websites,
       hypes, aggregated_rating, aggregated_rating_count
FROM games""",
    "stg_games_nameless": f"WITH {GAMES} SELECT id, name, updated_at FROM games WHERE id % 7 <> 0",
    "stg_dimensions": "\nUNION ALL ".join(
        f"SELECT '{entity}' AS entity, CAST({key} AS BIGINT) AS id, {name} AS name, CAST(2 AS BIGINT) AS updated_at FROM {table}"
        for entity, table, key, name in _DIMENSIONS
    ),
    "bridge_explode": f"WITH {GAMES} SELECT id AS game_id, unnest(genres) AS genre_id FROM games",
    "bridge_all": f"WITH {GAMES} "
    + "\nUNION ALL ".join(
        f"SELECT '{bridge}' AS bridge, id AS game_id, CAST(unnest({ids}) AS BIGINT) AS dim_id FROM games"
        for bridge, ids in _BRIDGES
    ),
    "bridge_semi_join": f"""
WITH {GAMES}, bridge AS (SELECT id AS game_id, unnest(platforms) AS platform_id FROM games)
SELECT * FROM bridge WHERE game_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
    "dim_name_arrays": f"""
WITH {DIM}
SELECT game_id AS id, platform_names, genre_names, game_mode_names, theme_names, perspective_names FROM dim""",
    "dim_games": f"WITH {DIM} SELECT * FROM dim",
    "source_filter": ALL_SCORES + " WHERE id % 5 NOT IN (0, 1)",
    "type_label_unknown": f"""
WITH {SCORES},
types AS (
  SELECT id, name, CASE WHEN id % 2 = 0 THEN source WHEN id % 3 = 0 THEN 7 END AS source
  FROM (VALUES {', '.join(f"({t}, '{name}', {121 if t <= 4 else 6 if t == 34 else 1})" for t, name in _METRICS)}) AS v(id, name, source)),
coded AS (SELECT * REPLACE (CASE WHEN id % 4 = 0 THEN 77 ELSE popularity_type END AS popularity_type) FROM scores)
SELECT s.id, s.game_id, s.popularity_type, s.value, t.name AS popularity_type_name,
       CAST(t.source AS BIGINT) AS external_popularity_source,
       CASE t.source WHEN 121 THEN 'IGDB' WHEN 1 THEN 'Steam' WHEN 6 THEN 'Twitch' ELSE 'Unknown' END AS data_source,
       CASE WHEN s.popularity_type <= 4 THEN 'User Engagement' WHEN s.popularity_type <= 8 THEN 'Steam Metrics'
            WHEN s.popularity_type <= 10 THEN 'Steam Wishlist' WHEN s.popularity_type = 34 THEN 'Streaming' ELSE 'Other' END AS metric_category
FROM coded s LEFT JOIN types t ON s.popularity_type = t.id""",
    "stg_popularity_types": f"""
WITH {SCORES}
SELECT CAST(id AS BIGINT) AS id, name, CAST(source AS BIGINT) AS external_popularity_source,
       CAST(NULL AS BIGINT) AS popularity_source, CAST(NULL AS BIGINT) AS created_at,
       CAST(2 AS BIGINT) AS updated_at, CAST(NULL AS VARCHAR) AS checksum
FROM (VALUES {', '.join(f"({t}, '{name}', {121 if t <= 4 else 6 if t == 34 else 1})" for t, name in _METRICS)}) AS v(id, name, source)
WHERE id IN (SELECT popularity_type FROM scores)""",
    "type_label_join": f"""
WITH {SCORES},
types AS (
  SELECT * FROM (VALUES {', '.join(f"({t}, '{name}', {121 if t <= 4 else 6 if t == 34 else 1})" for t, name in _METRICS)})
  AS v(id, name, source))
SELECT s.id, s.game_id, s.popularity_type, s.value, t.name AS popularity_type_name,
       CAST(t.source AS BIGINT) AS external_popularity_source,
       CASE t.source WHEN 121 THEN 'IGDB' WHEN 1 THEN 'Steam' WHEN 6 THEN 'Twitch' ELSE 'Unknown' END AS data_source,
       CASE WHEN s.popularity_type <= 4 THEN 'User Engagement' WHEN s.popularity_type <= 8 THEN 'Steam Metrics'
            WHEN s.popularity_type <= 10 THEN 'Steam Wishlist' ELSE 'Streaming' END AS metric_category
FROM scores s LEFT JOIN types t ON t.id = s.popularity_type""",
    "metric_pivot": f"WITH {WIDE} SELECT * FROM wide",
    "fct_game_popularity": FACT_ROWS,
    "fct_game_popularity_ranged": FACT_ROWS,
    "percentile_buckets": _PERCENTILES_OF_ORDERS,
    "exact_percentile": "SELECT quantile_cont(l_quantity, 0.25) AS lower_quartile FROM lineitem",
    "exact_percentile_ranged": "SELECT quantile_cont(o_totalprice, 0.25) AS lower_quartile FROM orders",
    "mart_recent": f"WITH {DIM} {_RECENT} LIMIT 50",
    "mart_hyped": f"""
WITH {DIM}
SELECT game_name, hypes, aggregated_rating, aggregated_rating_count, platform_names, genre_names,
       game_summary, cover, url
FROM dim
WHERE hypes > 0 AND coalesce(first_release_date > epoch(TIMESTAMP '1997-01-01'), true)
ORDER BY hypes DESC, game_id LIMIT 50""",
    "mart_top_rated": f"""
WITH {DIM},
stats AS (
  SELECT sum(aggregated_rating) / count(*) AS c, quantile_cont(aggregated_rating_count, 0.25) AS m
  FROM dim WHERE aggregated_rating IS NOT NULL AND aggregated_rating_count > 0)
SELECT game_name, aggregated_rating, aggregated_rating_count,
       (CAST(aggregated_rating_count AS FLOAT) / (aggregated_rating_count + m)) * aggregated_rating
         + (m / (aggregated_rating_count + m)) * c AS weighted_rating,
       genre_names, first_release_date, cover, url
FROM dim, stats
WHERE aggregated_rating IS NOT NULL AND aggregated_rating_count >= 5
ORDER BY weighted_rating DESC, aggregated_rating_count DESC, game_id LIMIT 50""",
    "mart_theme_trends": f"""
WITH {GAMES}, themed AS (SELECT unnest(themes) AS v FROM games)
SELECT n_name AS theme, count(*) AS count
FROM themed LEFT JOIN nation ON n_nationkey = v
GROUP BY n_name ORDER BY count DESC, theme LIMIT 50""",
    "mart_trending": f"""
WITH {MODEL}
SELECT game_name, playing, played, playing_percentile, played_percentile, igdb_total_engagement,
       steam_positive_reviews, cross_platform_score, aggregated_rating, platform_names, genre_names, {_CARD}
FROM dim JOIN fact USING (game_id)
WHERE playing IS NOT NULL AND played IS NOT NULL AND playing_percentile >= 50 AND played_percentile >= 20
ORDER BY playing_percentile DESC, playing DESC, game_id LIMIT 100""",
    "mart_controversial": f"""
WITH {MODEL}
SELECT game_name,
       negative_reviews_percentile * 0.5::DOUBLE + positive_reviews_percentile * 0.3::DOUBLE
         + total_reviews_percentile * 0.2::DOUBLE AS controversy_score,
       steam_negative_reviews, steam_positive_reviews, steam_total_reviews,
       negative_reviews_percentile, positive_reviews_percentile, total_reviews_percentile,
       igdb_total_engagement, aggregated_rating, platform_names, genre_names, {_CARD}
FROM dim JOIN fact USING (game_id)
WHERE steam_negative_reviews IS NOT NULL AND steam_positive_reviews IS NOT NULL
  AND steam_total_reviews IS NOT NULL AND negative_reviews_percentile >= 40
  AND positive_reviews_percentile >= 30 AND total_reviews_percentile >= 30
ORDER BY controversy_score DESC, steam_total_reviews DESC, game_id LIMIT 100""",
    "mart_hidden_gems": f"""
WITH {MODEL}
SELECT game_name,
       positive_reviews_percentile * 0.4::DOUBLE + coalesce(aggregated_rating, 75) * 0.3::DOUBLE
         + (100 - engagement_percentile) * 0.2::DOUBLE + (100 - total_reviews_percentile) * 0.1::DOUBLE AS hidden_score,
       steam_positive_reviews, steam_negative_reviews, steam_total_reviews, positive_reviews_percentile,
       total_reviews_percentile, engagement_percentile, igdb_total_engagement, cross_platform_score,
       aggregated_rating, aggregated_rating_count, platform_names, genre_names, {_CARD}
FROM dim JOIN fact USING (game_id)
WHERE (positive_reviews_percentile >= 50 OR aggregated_rating >= 75) AND engagement_percentile <= 50
  AND total_reviews_percentile <= 60 AND negative_reviews_percentile <= 40
ORDER BY hidden_score DESC, aggregated_rating DESC, positive_reviews_percentile DESC, game_id LIMIT 100""",
    "mart_rising": f"""
WITH {MODEL},
moving AS (
  SELECT *, CASE WHEN played > 0 THEN playing / played ELSE 0 END AS velocity_ratio
  FROM fact WHERE playing IS NOT NULL),
ranked AS (
  SELECT *, {_ntile('coalesce(twitch_24hr_hours_watched, 0)', 'twitch_percentile')},
         {_ntile('velocity_ratio', 'velocity_percentile')}
  FROM moving)
SELECT game_name,
       playing_percentile * 0.3::DOUBLE + velocity_percentile * 0.25::DOUBLE
         + engagement_percentile * 0.05::DOUBLE + positive_reviews_percentile * 0.15::DOUBLE
         + twitch_percentile * 0.1::DOUBLE + coalesce(aggregated_rating, 75) * 0.15::DOUBLE AS rising_score,
       playing_percentile, velocity_percentile, engagement_percentile, velocity_ratio,
       positive_reviews_percentile, twitch_percentile, cross_platform_score, steam_positive_reviews,
       steam_total_reviews, playing, played, igdb_total_engagement, aggregated_rating,
       platform_names, genre_names, {_CARD}
FROM dim JOIN ranked USING (game_id)
WHERE playing_percentile >= 30
ORDER BY rising_score DESC, first_release_date DESC, playing_percentile DESC, game_id LIMIT 100""",
    "summary_metrics": f"""
WITH {GAMES}
SELECT count(*) AS total_games, max(updated_at) AS last_updated,
       strftime(make_timestamp(max(updated_at) * 1000000), '%Y-%m-%d %H:%M') AS last_updated_text
FROM games""",
    "mart_fetch": f"""
WITH {DIM}, mart AS ({_RECENT} LIMIT 50)
SELECT *, strftime(make_timestamp(first_release_date * 1000000), '%Y-%m-%d') AS release_date
FROM mart ORDER BY first_release_date DESC, game_name LIMIT 10""",
    "search_names": FOUND,
    "search_names_indexed": FOUND,
    "search_documents": """
SELECT md5(text) AS text_hash, lang, source FROM documents WHERE text ILIKE '%LICENSE%'
ORDER BY n_chars DESC, doc_id LIMIT 100""",
    "page_rows": """
SELECT p_partkey, p_name, (row_number() OVER (ORDER BY p_partkey) - 1) // 500 AS page FROM part""",
    "page_rows_ranged": """
SELECT o_custkey, o_orderkey, (row_number() OVER (ORDER BY o_custkey, o_orderkey) - 1) // 500 AS page
FROM orders""",
    "page_offset": "SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 500 OFFSET 100",
    "page_deep": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 500 OFFSET 1000",
    "incremental_read": f"""
WITH {VERSIONS}
SELECT * FROM versions WHERE updated_at > epoch(TIMESTAMP '2024-01-20 11:55:00')""",
    "latest_partition": f"""
WITH {SCORES} SELECT * FROM scores WHERE dt = (SELECT max(dt) FROM scores)""",
    "date_partition": ALL_SCORES + " WHERE dt = '2024-01-15'",
    "all_partitions": f"""
WITH {SCORES} SELECT dt, count(*) AS n_rows, max(value) AS max_value FROM scores GROUP BY dt""",
    "file_dates": f"WITH {SCORES} SELECT dt AS file_date, count(*) AS n_rows FROM scores GROUP BY dt",
    "json_lines_roundtrip": ALL_SCORES,
    "json_malformed": f"""
WITH {SCORES}
SELECT shape, id, CAST(game_id AS BIGINT) AS game_id, CASE WHEN id % 10 <> 4 THEN popularity_type END AS popularity_type,
       CASE WHEN id % 10 NOT IN (0, 1) THEN value END AS value
FROM scores, (VALUES ('lines'), ('arrays')) AS v(shape) WHERE id % 10 NOT IN (2, 5)""",
    "batched_write": "SELECT count(*) AS n_rows, CAST(1 AS BIGINT) AS bound_held FROM events",
    "hidden_paths": f"WITH {SCORES} SELECT * FROM scores",
    "partition_replace": f"""
WITH {SCORES}
SELECT id, game_id, popularity_type, CASE WHEN dt = '2024-01-15' THEN 0.5::DOUBLE ELSE value END AS value, dt
FROM scores""",
    "manifest_scan": ALL_SCORES,
    "manifest_refresh": ALL_SCORES + " WHERE id % 2 = 1",
    "manifest_json": """
SELECT 'scores' AS entity, '2024-02-01' AS dt, count(*) AS total_count, CAST(1 AS BIGINT) AS files_match,
       CAST(epoch(TIMESTAMP '2024-02-01 12:00:00') AS BIGINT) AS created_at,
       CAST(epoch(TIMESTAMP '2024-02-01 12:00:00') AS BIGINT) AS updated_at
FROM events""",
    "file_status": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'outdated' ELSE 'final' END AS status, count(*) AS n_rows
FROM events GROUP BY 1
UNION ALL SELECT 'temp', count(*) FROM events""",
    "snapshot_switch": LATEST,
    "stream_upsert": LATEST,
    "state_modes": f"""
WITH {VERSIONS},
states AS (SELECT user_id, max(updated_at) AS t FROM versions WHERE event_type <> 'view' GROUP BY user_id)
SELECT c_custkey AS entity,
       CASE WHEN c_custkey % 3 = 0 OR t IS NULL THEN 'full' ELSE 'incremental' END AS mode,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST(t AS VARCHAR) END AS since
FROM customer LEFT JOIN states ON user_id = c_custkey""",
    "load_run": _load_sizes(),
    "load_increment": f"""
WITH {DIM}
SELECT game_id, CASE WHEN game_id % 3 = 0 THEN game_name || ' II' ELSE game_name END AS game_name,
       CASE WHEN game_id % 3 = 0 THEN CAST(epoch(TIMESTAMP '2100-01-01') AS BIGINT) ELSE updated_at END AS updated_at, platform_names
FROM dim WHERE game_id % 5 <> 0 OR game_id % 3 = 0""",
    "build_models": _model_sizes(),
    "dq_not_null": f"WITH {DIM} SELECT game_id, game_name FROM dim WHERE hypes IS NULL",
    "dq_unique": "SELECT o_custkey, count(*) AS n_rows FROM orders GROUP BY 1 HAVING count(*) > 1",
    "dq_relationships": f"""
WITH {GAMES}, bridge AS (SELECT id AS game_id, unnest(platforms) AS platform_id FROM games)
SELECT * FROM bridge WHERE platform_id NOT IN (SELECT n_nationkey FROM nation)""",
    "dq_relationship_counts": """
SELECT doc_id, count(*) AS n_rows FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels) GROUP BY doc_id""",
    "dq_suite": _suite(),
    "run_totals": f"""
WITH {RUNS}
SELECT CAST(sum(record_count) AS BIGINT) AS total_records, round(sum(elapsed_seconds), 2) AS total_seconds
FROM runs""",
    "run_metrics": f"""
WITH {RUNS}
SELECT mode, CAST(sum(record_count) AS BIGINT) AS total_records,
       round(sum(elapsed_seconds), 2) AS total_elapsed_seconds,
       CAST(sum((record_count + 499) // 500) AS BIGINT) AS total_api_calls,
       round(sum(record_count) / sum(elapsed_seconds), 2) AS records_per_second
FROM runs GROUP BY mode""",
    "mode_comparison": f"WITH {COMPARED} SELECT * FROM compared",
    "speedup": f"""
WITH {COMPARED}
SELECT CAST(sum(record_count) AS BIGINT) AS total_records, sum(sequential_elapsed) AS total_sequential,
       sum(concurrent_elapsed) AS total_concurrent, round(avg(speedup), 2) AS average_speedup,
       round(sum(sequential_elapsed) / sum(concurrent_elapsed), 2) AS total_speedup
FROM compared""",
    "run_state": """
SELECT event_type AS entity, strftime(date_trunc('second', max(ts)), '%Y-%m-%dT%H:%M:%S+00:00') AS last_run_time,
       '2024-02-01T12:00:00+00:00' AS updated_at, CAST(epoch_us(max(ts)) // 1000000 AS BIGINT) AS last_run
FROM events WHERE event_type <> 'view' GROUP BY event_type""",
}

ORACLE["mart_rising_ranged"] = ORACLE["mart_rising"]
