"""Quality rules with host-level verdicts.

Every document is measured against simple rules. Failures are counted per host
(the ``source`` of a document), each host's rate is shrunk towards the rate of all
hosts by a beta prior fitted to the hosts themselves, and hosts whose shrunk rate
is too high lose all their documents.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import WordIds, slices, table, texts, windows
from .ngram_join import CHUNK_BYTES, WordHashes

SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED = 20  # percent of words
#: A document counts against its host also when symbols exceed this percentage of its word characters.
MOST_SYMBOLS = 10
#: Hosts above this shrunk failure rate are rejected.
MOST_FAILING = 0.5
#: Verdicts on so many hosts may be sent to all tasks.
BROADCAST_HOSTS = 1 << 16

_SPACE = b" \t\n\x0b\x0c\r"
# Deleting white space and UTF-8 continuation bytes leaves one byte per code point.
_NOT_COUNTED = _SPACE + bytes(range(0x80, 0xC0))


def measured(text: bytes | None, ids: WordIds | np.ndarray) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words); ``ids`` are those of its words, or give them."""
    text = text or b""
    if isinstance(ids, WordIds):
        ids = ids.of(text.split())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    repeated = 0
    if len(ids) > 5:
        _, at, counts = np.unique(windows(ids, 5), return_inverse=True, return_counts=True)
        starts = np.flatnonzero(counts[at] > 1)
        if len(starts):
            edges = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + 5, -1)
            repeated = int((np.cumsum(edges[:-1]) > 0).sum())
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    return len(ids), len(text.translate(None, _NOT_COUNTED)), symbols, len(lines) - len(set(lines)), repeated


def measures(documents: Iterable[bytes | None], words: WordHashes) -> Iterator[tuple[int, int, int, int, int]]:
    """``measured`` of each text (null counts as empty); words of about ``CHUNK_BYTES`` are hashed together."""

    def cut(held):
        ids, counts = words.of(held)
        for text, own in zip(held, np.split(ids, np.cumsum(counts)[:-1])):
            yield measured(text, own)

    held, waiting = [], 0
    for text in documents:
        held.append(text or b"")
        waiting += len(held[-1])
        if waiting >= CHUNK_BYTES:
            yield from cut(held)
            held, waiting = [], 0
    if held:
        yield from cut(held)


FIELDS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def with_measures(docs: DataFrame, text_col: str = "text", keep: list[str] = ()) -> DataFrame:
    """The columns ``keep`` and the five measures (null text counts as empty)."""
    schema = docs.select(*keep).schema
    names = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches):
        words = WordHashes()
        for batch in slices(batches):
            rows = list(measures(texts(batch.column(0)), words))
            found = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(FIELDS))]
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], *found], [*batch.schema.names[1:], *FIELDS])

    rows = docs.select(F.col(text_col).cast("string").alias("_text"), *keep)
    return rows.mapInArrow(run, ", ".join([names, *(f"{f} long" for f in FIELDS)]))


def failing_hosts(hosts: DataFrame, most: float = MOST_FAILING) -> DataFrame:
    """``hosts`` (host, docs, failed) with the shrunk rate and a verdict.

    The beta prior has the mean of all documents; its strength comes from the
    spread of the hosts' rates (weighted by documents) beyond what chance gives,
    within 2 .. 1e6. With one host, or no spread, the prior is strong.
    """
    total = hosts.agg(
        F.sum("docs").cast("double").alias("d"), F.sum("failed").cast("double").alias("f"), F.count("*").cast("double").alias("k")
    )
    rate = F.col("failed") / F.col("docs")
    spread = hosts.crossJoin(F.broadcast(total)).groupBy("d", "f", "k").agg(  # one row on the right
        (F.sum(F.col("docs") * F.pow(rate - F.col("f") / F.col("d"), 2)) / F.max("d")).alias("v")
    )
    mean = F.col("f") / F.col("d")
    chance = mean * (1 - mean) * F.col("k") / F.col("d")
    extra = F.col("v") - chance
    strength = F.when(extra > 0, mean * (1 - mean) / extra - 1).otherwise(1e6)
    prior = spread.select(mean.alias("mean"), F.greatest(F.lit(2.0), F.least(F.lit(1e6), strength)).alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("docs") + F.col("strength"))
    return hosts.crossJoin(F.broadcast(prior)).select(  # one row on the right
        "host", "docs", "failed", shrunk.alias("rate"), (shrunk > most).alias("rejected")
    )


def base_failed():
    """Fewer than ten words, or over a fifth of them in repeated windows."""
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(docs: DataFrame, keep: list[str], host_col: str = "source", text_col: str = "text") -> DataFrame:
    """The columns ``keep``, measures, ``base_failed``, the host's ``host_rate`` and ``kept``.

    A null host is a host like any other. Null and blank texts have no words and
    fail. Every row is judged by itself, repeated rows included. No rows give none.
    """
    docs = docs.withColumn("_host", F.col(host_col))
    rows = lambda *names: with_measures(docs, text_col, [*names, "_host"]).withColumn("base_failed", base_failed())
    fails = F.col("base_failed") | (100 * F.col("n_symbols") > MOST_SYMBOLS * F.col("word_chars"))
    hosts = rows().groupBy(F.col("_host").alias("host")).agg(
        F.count("*").alias("docs"), F.sum(fails.cast("long")).alias("failed")
    )
    # Staged, so that their number is known: few verdicts are sent to the rows, which then stay where they are.
    verdicts = stage(failing_hosts(stage(hosts, "hosts")).select("host", F.col("rate").alias("host_rate"), "rejected"), "verdicts")
    verdicts = F.broadcast(verdicts) if at_most(verdicts, BROADCAST_HOSTS) else verdicts
    rows = rows(*keep).join(verdicts, F.col("_host").eqNullSafe(F.col("host")), "left").drop("_host", "host")
    return rows.withColumn("kept", ~F.col("base_failed") & ~F.col("rejected")).drop("rejected")


def op8_host_rules(spark, sf_dir) -> DataFrame:
    rows = judged(table(spark, sf_dir, "documents", "doc_id", "source", "text"), ["doc_id"])
    return rows.withColumn("host_rate", F.round("host_rate", 6))


def passing(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, unchanged; extra columns may have any name."""
    rows = docs.select(F.struct(*docs.columns).alias("doc"), "source", "text")
    return judged(rows, ["doc"]).where("kept").select("doc.*")


OP8_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
grams AS (
  SELECT r, i, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + o) AS n FROM twice, range(0, 5) t(o) GROUP BY r),
lines AS (
  SELECT r, count(*) - count(DISTINCT l) AS n
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (
  SELECT doc_id, source, len(w) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(lines.n, 0) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words
  FROM d LEFT JOIN lines USING (r) LEFT JOIN covered USING (r)),
b AS (
  SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (
  SELECT source AS host, count(*) AS docs,
         sum(CASE WHEN base_failed OR 100 * n_symbols > 10 * word_chars THEN 1 ELSE 0 END) AS failed
  FROM b GROUP BY source),
t AS (SELECT sum(docs)::DOUBLE AS d, sum(failed)::DOUBLE AS f, count(*)::DOUBLE AS k FROM h),
v AS (SELECT f / d AS mean, sum(docs * (failed / docs - f / d) * (failed / docs - f / d)) / d AS v, k / d AS kd
      FROM h, t GROUP BY d, f, k),
p AS (SELECT mean, CASE WHEN v - mean * (1 - mean) * kd > 0
        THEN greatest(2.0, least(1e6, mean * (1 - mean) / (v - mean * (1 - mean) * kd) - 1)) ELSE 1e6 END AS strength FROM v)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       round((failed + mean * strength) / (docs + strength), 6) AS host_rate,
       NOT base_failed AND (failed + mean * strength) / (docs + strength) <= 0.5 AS kept
FROM b JOIN h ON b.source IS NOT DISTINCT FROM h.host, p
"""
