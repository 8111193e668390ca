"""URL rules by a sort-merge range join on reversed hosts.

A host is written with its labels reversed (``www.example.net`` as ``net.example.www.``),
so a rule's host and all subdomains are the keys from ``net.example.`` up to, but
not including, ``net.example/`` (``/`` follows ``.``): an interval. Such intervals are nested or apart.
Hosts and interval ends are sorted into ranges; a sweep over each range keeps the
stack of the rules that are open, one window column per depth, and ranges hand their
open rules on. Each distinct host then knows its rules, and each page the longest
whose path its own begins with.

DataFrame functions only. Rules are data like the pages: nothing is collected but
the depth of their nesting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import table

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
#: The verdict of urls that no rule fits.
DEFAULT = "allow"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def parts(url: str) -> tuple[Column, Column]:
    """(host, path) of a url column; both empty for null and for what has no ``://``."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substring(F.col(url), start + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), _UPPER, _LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def reversed_host(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def _ranged(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """Hosts, openings and closings in ranges of the key; staged, so the ranges stay as they are."""
    opened = F.reverse(F.split("host", r"\."))
    key = F.concat(F.array_join(opened, "."), F.lit("."))
    after = F.concat(F.array_join(opened, "."), F.lit("/"))
    none = F.lit(None).cast("string")
    # Closings come first, then openings (shorter keys first, so outer rules before inner), then hosts.
    rows = hosts.select(reversed_host(F.col("host")).alias("key"), F.lit(2).alias("kind"), "host", none.alias("rule"))
    rows = rows.union(rules.select(key, F.lit(1), none, F.col("host")))
    rows = rows.union(rules.select(after, F.lit(0), none, F.col("host")))
    rows = rows.repartitionByRange("key", "kind").withColumn("range", F.spark_partition_id())
    return stage(rows, "ranged")


def open_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): for each distinct host the rule hosts whose interval holds it, outermost first."""
    labels = rules.select(F.coalesce(F.max(F.size(F.split("host", r"\."))), F.lit(0))).first()[0]
    rows = _ranged(hosts, rules)
    step = F.when(F.col("kind") == 1, 1).when(F.col("kind") == 0, -1).otherwise(0)
    # Depth at the end of earlier ranges; one row per range.
    change = rows.groupBy("range").agg(F.sum(step).alias("change"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    base = change.select("range", F.coalesce(F.sum("change").over(before), F.lit(0)).alias("base"))
    run = Window.partitionBy("range").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = rows.join(F.broadcast(base), "range").withColumn("depth", F.col("base") + F.sum(step).over(run))
    # An opening stands at the depth it makes; what is open at depth d is the last opening there.
    level = lambda d: F.when((F.col("kind") == 1) & (F.col("depth") == d), F.col("rule"))
    swept = swept.select("*", *(F.last(level(d), ignorenulls=True).over(run).alias(f"own{d}") for d in range(1, labels + 1)))
    ends = swept.groupBy("range").agg(
        F.lit(0).alias("_"), *(F.max_by(f"own{d}", F.struct("key", "kind")).alias(f"end{d}") for d in range(1, labels + 1))
    )
    handed = ends.select("range", *(F.last(f"end{d}", ignorenulls=True).over(before).alias(f"in{d}") for d in range(1, labels + 1)))
    found = swept.where("kind = 2").join(F.broadcast(handed), "range")
    stack = [F.when(F.col("depth") >= d, F.coalesce(f"own{d}", f"in{d}")) for d in range(1, labels + 1)]
    stack = F.filter(F.array(*stack), lambda x: x.isNotNull()) if stack else F.array().cast("array<string>")
    return found.select("host", stack.alias("rules"))


def verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """(id, host, path, rule, verdict) of each page.

    ``rules`` has (host, path, action); repeated rules count once, and of equal rules
    with different actions the one first in order (allow) holds. Rules with a null
    host or path are left out. The longest rule wins, by its text ``host || path``;
    of equally long ones that with the longer host. Null urls, and those without
    ``://``, have an empty host, which no rule fits. Repeated rows and null ids are
    judged like any other; other columns are not read.
    """
    rules = rules.where("host IS NOT NULL AND path IS NOT NULL AND host <> ''")
    rules = rules.groupBy("host", "path").agg(F.min("action").alias("action"))
    grouped = rules.groupBy("host").agg(F.collect_list(F.struct("path", "action")).alias("paths"))
    host, path = parts("_url")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("_url"))
    rows = rows.select("id", host.alias("host"), path.alias("path"))
    hosts = rows.select("host").where("host <> ''").distinct()
    held = open_rules(hosts, rules.select("host").distinct()).where(F.size("rules") > 0)
    named = held.select("host", F.explode("rules").alias("r")).join(grouped.withColumnRenamed("host", "r"), "r")
    of_host = named.select("host", "r", F.explode("paths").alias("p")).groupBy("host").agg(
        F.sort_array(
            F.collect_list(F.struct((F.length("r") + F.length("p.path")).alias("size"), F.length("r").alias("host_size"),
                                    F.concat("r", "p.path").alias("rule"), F.col("p.path").alias("path"), F.col("p.action").alias("action"))),
            asc=False,
        ).alias("rules")
    )
    judged = rows.join(of_host, "host", "left")
    fits = F.filter("rules", lambda r: F.col("path").startswith(r["path"]))
    best = F.get(fits, F.lit(0))
    return judged.select(
        "id", "host", "path", best["rule"].alias("rule"), F.coalesce(best["action"], F.lit(default)).alias("verdict")
    )


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(rules, "host string, path string, action string")


def op4_url_rules(spark, sf_dir) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return verdicts(pages, rule_table(spark)).withColumnRenamed("id", "page_id")


OP4_SQL = r"""
WITH r(rhost, rpath, action) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
u AS (
  SELECT row_number() OVER () AS n, page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) END AS rest FROM pages),
p AS (
  SELECT n, page_id, translate(coalesce(regexp_extract(rest, '(?s)^([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1), '') AS path FROM u),
b AS (
  SELECT n, max_by(rhost || rpath, length(rhost || rpath)) AS rule, max_by(action, length(rhost || rpath)) AS action
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) GROUP BY n)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN b USING (n)
"""
