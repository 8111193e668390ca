"""Mixing sources to target weights.

Each source's words are one stream, packed into blocks of ``BLOCK`` words. The mix
is a sequence of slots of one block each, dealt to output shards. For every shard
the numbers of slots per source are a multinomial draw, one draw per slot by a
hash; where the draws of all shards together miss a source's target, the surplus
slots of other sources are handed to it, so that totals are exact. Slot ``g`` of a
source is its block ``permutation(g mod blocks)``, a keyed permutation of the
source's blocks, so the first pass takes every block once before any is repeated.
Slots and blocks are then joined by index.

DataFrame functions only. Results depend on the words and the key alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import WORD, positions, table

BLOCK = 128
SHARD = 4096
WEIGHTS = (5, 2, 1)
#: Size of the mix, and the most a source may give, in parts of the sizes.
TOTAL = 1.5
MOST = 2.0
ROUNDS = 4


def targets(sizes: DataFrame, total: float = TOTAL, most: float = MOST, weights=WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size) with ``weight`` and ``target``.

    Weights go round over the sources by code point, null last. ``total`` times all
    words is shared by weight; no target is above ``most`` times its source, and what
    is cut off is shared again by weight among the others. That is one level ``c``
    with target = min(most * size, weight * c), found by ordering the sources by the
    level at which they fill up. One row per source.
    """
    first = Window.orderBy(F.col("source").isNull(), "source")
    place = F.row_number().over(first) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (place % len(weights) + 1).cast("int"))
    rows = sizes.withColumn("weight", weight).withColumn("cap", most * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    every = Window.partitionBy()
    full = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    open_ = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (total * F.sum("source_size").over(every) - full) / open_
    rows = rows.withColumn("level", level)
    # The level of the first source that does not fill up; if all do, no source is limited by it.
    fits = F.when(F.col("weight") * F.col("level") <= F.col("cap"), F.col("level"))
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("level", F.first(fits, ignorenulls=True).over(whole))
    target = F.least(F.col("cap"), F.col("weight") * F.coalesce("level", F.lit(float("inf"))))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def permuted(value: Column, size: Column, key: Column) -> Column:
    """A keyed permutation of 0 .. size - 1: an alternating Feistel network on a grid that just holds them, with cycle-walking.

    The grid has ``a = ceil(sqrt(size))`` columns and fewer than ``a`` cells too many, so a
    walk of ``a + 1`` steps always ends; longer ones than 64 do not happen for large grids,
    where a step ends the walk with probability 1 - 1 / a at least.
    """
    a = F.ceil(F.sqrt(size.cast("double")))
    b = F.ceil(size / a)

    def once(x: Column) -> Column:
        left, right = x % a, F.floor(x / a)
        for k in range(ROUNDS):
            if k % 2:
                right = F.pmod(right + F.pmod(F.xxhash64(key, F.lit(k), left), b), b)
            else:
                left = F.pmod(left + F.pmod(F.xxhash64(key, F.lit(k), right), a), a)
        return right * a + left

    steps = F.sequence(F.lit(1), F.least(F.lit(64), (a + 1).cast("int")))
    return F.aggregate(steps, once(value), lambda x, _: F.when(x < size, x).otherwise(once(x)))


CELLS = 4096


def in_interval(points: DataFrame, at: str, intervals: DataFrame, low: str, high: str, total: int) -> DataFrame:
    """Join each point to the interval [low, high) that holds it, by a grid of cells: an equi-join, then a filter."""
    width = max(1, -(-total // CELLS))
    cells = F.sequence(F.floor(F.col(low) / width), F.floor((F.col(high) - 1) / width))
    dealt = intervals.where(F.col(low) < F.col(high)).select("*", F.explode(cells).alias("_cell"))
    met = points.withColumn("_cell", F.floor(F.col(at) / width)).join(dealt, "_cell")
    return met.where((F.col(at) >= F.col(low)) & (F.col(at) < F.col(high))).drop("_cell")


def slots(sources: DataFrame, key: int = 0, shard: int = SHARD) -> DataFrame:
    """(source, g, shard, slot): slot ``g`` of each source and its place in the mix.

    ``sources`` has (source, source_size, blocks, target), one row per source.
    """
    share = F.col("target") / F.greatest(F.col("source_size"), F.lit(1))  # blocks of a source have this size on average
    n = sources.withColumn("quota", F.least(F.round(share * F.col("blocks")).cast("long"), (MOST * F.col("blocks")).cast("long")))
    order = Window.orderBy(F.col("source").isNull(), "source")
    n = n.withColumn("high", F.sum("quota").over(order)).withColumn("low", F.col("high") - F.col("quota"))
    n = stage(n.where("quota > 0").select("source", "blocks", "quota", "low", "high"), "quotas")
    total = n.agg(F.coalesce(F.max("high"), F.lit(0))).first()[0]
    spark = sources.sparkSession
    draws = spark.range(total).select(F.col("id").alias("slot"), F.floor(F.col("id") / shard).alias("shard"))
    # A draw by the shares of the sources: a uniform ticket falls in a source's interval.
    draws = draws.withColumn("ticket", F.pmod(F.xxhash64(F.lit(key), "slot"), F.lit(max(total, 1))))
    drawn = in_interval(draws, "ticket", n.select("source", "low", "high"), "low", "high", total)
    within = Window.partitionBy("shard", "source").orderBy("slot")  # at most ``shard`` rows
    drawn = drawn.select("source", "shard", "slot", (F.row_number().over(within) - 1).alias("place"))
    drawn = stage(drawn, "draws")
    counts = drawn.groupBy("source", "shard").agg(F.count("*").alias("n"))
    so_far = Window.partitionBy("source").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("before", F.coalesce(F.sum("n").over(so_far), F.lit(0)))
    counts = counts.select(F.col("source").alias("_s"), F.col("shard").alias("_h"), "before")
    numbered = drawn.join(counts, F.col("source").eqNullSafe(F.col("_s")) & (F.col("shard") == F.col("_h")))
    numbered = numbered.select("source", "shard", "slot", (F.col("before") + F.col("place")).alias("g"))
    quotas = n.select(F.col("source").alias("_s"), "quota")
    numbered = numbered.join(quotas, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    kept = numbered.where("g < quota").select("source", "g", "shard", "slot")
    # Surplus slots, a few standard deviations of the draws, in order; and what is missing, in order.
    surplus = stage(numbered.where("g >= quota").select("shard", "slot"), "surplus")
    surplus = positions(surplus, [], [F.col("slot")], F.lit(1)).select("shard", "slot", F.col("start").alias("i"))
    had = drawn.groupBy("source").agg(F.count("*").alias("had"))
    lack = n.join(had.withColumnRenamed("source", "_s"), F.col("source").eqNullSafe(F.col("_s")), "left")
    lack = lack.select("source", "quota", F.least(F.coalesce("had", F.lit(0)), "quota").alias("had"))
    lack = lack.withColumn("to", F.sum(F.col("quota") - F.col("had")).over(order)).withColumn("from", F.col("to") - (F.col("quota") - F.col("had")))
    given = in_interval(surplus, "i", lack, "from", "to", total)
    return kept.union(given.select("source", (F.col("had") + F.col("i") - F.col("from")).alias("g"), "shard", "slot"))


def mixed(docs: DataFrame, key: int = 0, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK):
    """(pieces, documents) of the mix.

    ``documents``: (row, id, digest, size, source, source_size, target, taken) of each
    document. ``pieces``: (row, shard, slot, offset, from_word, n_words), which words of
    which document stand in which slot. Null and blank texts have no words; they and
    documents of sources without words take nothing. A null source is one source; rows
    that repeat an id are documents of their own. A source's last block may be short.
    """
    text = F.col(text_col).cast("string")
    rows = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("digest"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
    )
    rows = stage(rows.withColumn("row", F.monotonically_increasing_id()), "sizes")
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = stage(targets(sizes), "targets")
    blocks = sources.select("source", "source_size", F.ceil(F.col("source_size") / block).alias("blocks"), "target")
    # A document's words are words start .. start + size - 1 of its source.
    # Equal rows stand side by side, in any order; the place of a row comes from its content, not from ``row``.
    equal = rows.where("size > 0").groupBy("source", "id", "digest", "size").agg(F.sort_array(F.collect_list("row")).alias("rows"))
    equal = stage(equal, "equal")
    many = F.size("rows")
    placed = positions(equal, ["source"], [F.xxhash64("id", "digest"), F.col("id"), F.col("digest")], F.col("size") * many)
    placed = placed.select("source", "size", "start", F.posexplode("rows").alias("at", "row"))
    placed = placed.withColumn("start", F.col("start") + F.col("at") * F.col("size"))
    first, last = F.floor(F.col("start") / block), F.floor((F.col("start") + F.col("size") - 1) / block)
    parts = placed.select("row", "source", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
    low, high = F.greatest(F.col("block") * block, "start"), F.least((F.col("block") + 1) * block, F.col("start") + F.col("size"))
    parts = parts.select(
        "row", "source", "block", (low - F.col("start")).alias("from_word"), (high - low).alias("n_words"), (low - F.col("block") * block).alias("offset")
    )
    taken_slots = slots(blocks, key)
    at = taken_slots.join(blocks.select(F.col("source").alias("_s"), "blocks"), F.col("source").eqNullSafe(F.col("_s")))
    index = permuted(F.pmod(F.col("g"), F.col("blocks")), F.col("blocks"), F.xxhash64(F.lit(key), "source"))
    at = at.select(F.col("_s"), index.alias("_b"), "shard", "slot", F.floor(F.col("g") / F.col("blocks")).alias("turn"))
    pieces = parts.join(at, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    pieces = pieces.select("row", "shard", "slot", "offset", "from_word", "n_words", "turn")
    sums = pieces.groupBy("row").agg(F.sum("n_words").alias("taken"))
    known = sources.select(F.col("source").alias("_s"), "source_size", "target")
    out = rows.join(known, F.col("source").eqNullSafe(F.col("_s"))).drop("_s").join(sums, "row", "left")
    return pieces, out.withColumn("taken", F.coalesce("taken", F.lit(0)).cast("long"))


def op3_mixing(spark, sf_dir) -> DataFrame:
    _, rows = mixed(table(spark, sf_dir, "documents", "doc_id", "text", "source"))
    return rows.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def mixed_documents(docs: DataFrame, key: int = 0) -> DataFrame:
    """The mix as documents, columns as in ``docs``: for each turn that takes of a document, a row with the words taken.

    Words keep the white space after them; what a turn leaves out of a document is cut
    out. The second turn of a document is a row of its own. Documents nothing is taken
    of do not appear.
    """
    pieces, rows = mixed(docs, key)
    words = F.array_sort(F.collect_list(F.struct("from_word", "n_words")))
    turns = pieces.groupBy("row", "turn").agg(words.alias("_pieces"))
    turns = turns.groupBy("row").agg(F.collect_list("_pieces").alias("_turns"))
    # Rows that repeat id, text and source are one text here, with the turns of all of them.
    names = {"_row": rows["row"], "_id": rows["id"], "_digest": rows["digest"], "_source": rows["source"]}
    key = F.xxhash64("_id", "_digest", "_source")
    named = rows.select(*(c.alias(n) for n, c in names.items()))
    again = named.groupBy("_id", "_digest", "_source").agg(F.count("*").alias("n")).where("n > 1")
    turns = named.join(turns.withColumnRenamed("row", "_row"), "_row").groupBy("_id", "_digest", "_source")
    turns = turns.agg(F.flatten(F.collect_list("_turns")).alias("_turns")).withColumn("_key", key)
    digest = F.xxhash64(F.col("text"))
    # Columns of the documents, whatever their names, travel in one of ours.
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"]).alias("_doc")
    keyed = docs.select("doc_id", "text", "source", others)
    keyed = keyed.withColumn("_at", F.xxhash64(F.col("doc_id"), digest, F.col("source")))
    if not at_most(again, 0):
        keyed = keyed.withColumn("_text", digest).dropDuplicates(["doc_id", "_text", "source"])
    found = keyed.join(turns, (F.col("_at") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")))
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*"), F.lit(0))
    found = found.withColumn("_words", words).withColumn("_take", F.explode("_turns"))
    cut = F.transform("_take", lambda p: F.slice("_words", (p["from_word"] + 1).cast("int"), p["n_words"].cast("int")))
    found = found.withColumn("text", F.array_join(F.flatten(cut), ""))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return found.select(*[own.get(c, F.col("_doc").getField(c)).alias(c) for c in docs.columns])
