"""Packing documents into fixed-length sequences by cutting-stock column generation.

The driver sees one bounded thing: how many documents leave each remainder length
(fewer than 4096 numbers). It solves the linear program over packing patterns by
column generation, where a knapsack dynamic program prices new patterns, and
rounds the solution. Documents are then ranked within their length class and each
takes the sequence that its rank falls in. The least filled sequences are not
built; their documents are cut to fill the gaps that the others leave.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import positions, table, texts
from .tokens import TokenBytes, tokenizer_path

LENGTH = 4096
#: Lengths are planned in steps of this many tokens.
STEP = 16
#: Gaps below this are left as padding rather than filled by a cut.
LEAST_PIECE = 32
BROADCAST_IDS = 1 << 20


# --- The plan (driver, bounded by the number of length classes) ---------------


def knapsack(values: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Best total value of items of sizes 1, 2, ... (any number of each) within ``capacity``."""
    values = values[:capacity]
    best = np.zeros(capacity + 1)
    pick = np.zeros(capacity + 1, np.int64)
    for c in range(1, capacity + 1):
        totals = values[:c] + best[c - 1 :: -1][:c] if c <= len(values) else values + best[c - 1 : c - len(values) - 1 : -1]
        k = int(np.argmax(totals))
        if totals[k] > best[c - 1] + 1e-12:
            best[c], pick[c] = totals[k], k + 1
        else:
            best[c] = best[c - 1]
    counts, c = np.zeros(len(values), np.int64), capacity
    while c > 0:
        if pick[c]:
            counts[pick[c] - 1] += 1
            c -= pick[c]
        else:
            c -= 1
    return float(best[capacity]), counts


def column_generation(demand: np.ndarray, capacity: int, gap: float = 5e-4, rounds: int = 3000):
    """Fractional cutting-stock solution: [(pattern, amount)], sizes 1 .. len(demand).

    Revised simplex on the covering program; stops at the Farley bound ``gap``.
    """
    sizes = np.flatnonzero(demand) + 1
    if not len(sizes):
        return []
    rows = len(sizes)
    patterns = [np.eye(rows, dtype=np.int64)[i] * (capacity // s) for i, s in enumerate(sizes)]
    costs = np.ones(rows)
    inverse = np.diag([1.0 / (capacity // s) for s in sizes])
    amounts = inverse @ demand[sizes - 1].astype(float)
    values = np.zeros(int(sizes.max()))
    for _ in range(rounds):
        duals = costs @ inverse
        worst = int(np.argmin(duals))
        if duals[worst] < -1e-9:  # covering more than the demand is allowed
            column, cost = np.zeros(rows, np.int64), 0.0
            column[worst] = -1
        else:
            values[:] = 0
            values[sizes - 1] = duals
            worth, counts = knapsack(values, capacity)
            if worth <= 1 + 1e-9 or 1 - 1 / worth < gap:
                break
            column, cost = counts[sizes - 1], 1.0
        step = inverse @ column
        ratios = np.where(step > 1e-9, amounts / np.where(step > 1e-9, step, 1), np.inf)
        out = int(np.argmin(ratios))
        if not np.isfinite(ratios[out]):
            break
        amounts = np.maximum(amounts - ratios[out] * step, 0)
        amounts[out] = ratios[out]
        pivot = inverse[out] / step[out]
        inverse -= np.outer(step, pivot)
        inverse[out] = pivot
        patterns[out], costs[out] = column, cost
    found = []
    for p, x, c in zip(patterns, amounts, costs):
        if c and x > 1e-9:
            full = np.zeros(len(demand), np.int64)
            full[sizes - 1] = p
            found.append((full, x))
    return found


def plan(lengths: np.ndarray, length: int = LENGTH, step: int = STEP):
    """Integer patterns for ``lengths[r]`` documents of remainder r: ([(pattern, copies)], left over per class).

    Class k holds remainders of k * step + 1 .. (k + 1) * step. What the rounded
    patterns leave is packed first-fit decreasing, at most one odd sequence per
    class and one more. Copies with the largest gaps are then given up until their
    documents fill the gaps of the rest.
    """
    r = np.arange(len(lengths))
    kind = np.maximum(r - 1, 0) // step
    classes = length // step
    demand = np.bincount(kind[1:], weights=lengths[1:], minlength=classes).astype(np.int64)
    tokens = np.bincount(kind[1:], weights=(lengths * r)[1:], minlength=classes)
    mean = np.where(demand > 0, tokens / np.maximum(demand, 1), 0)
    rest, chosen = demand.copy(), []
    for pattern, amount in sorted(column_generation(demand, classes), key=lambda x: -x[1]):
        used = pattern > 0
        copies = min(int(amount + 1e-9), int((rest[used] // pattern[used]).min()))
        if copies:
            chosen.append((pattern, copies))
            rest = rest - pattern * copies
    odd: list[tuple[int, np.ndarray]] = []  # room left, pattern
    for k in np.flatnonzero(rest)[::-1]:
        left = int(rest[k])
        for i, (room, pattern) in enumerate(odd):
            fit = min(left, room // (k + 1))
            if fit:
                pattern[k] += fit
                odd[i] = (room - fit * (k + 1), pattern)
                left -= fit
        while left:
            fit = min(left, classes // (k + 1))
            pattern = np.zeros(classes, np.int64)
            pattern[k] = fit
            odd.append((classes - fit * (k + 1), pattern))
            left -= fit
    chosen += [(p, 1) for _, p in odd]
    # Give up the emptiest copies as filling for the others.
    gaps = [(length - float(p @ mean), p, c) for p, c in chosen]
    gaps.sort(key=lambda x: x[0])
    room = sum(g * c for g, _, c in gaps if g >= LEAST_PIECE)
    filling, spare = 0.0, np.zeros(classes, np.int64)
    while gaps and gaps[-1][0] >= LEAST_PIECE and filling < room:
        g, p, c = gaps.pop()
        # One copy given up adds its tokens to the filling and takes its gap away.
        give = min(c, max(1, int((room - filling) / length)))
        filling += give * (length - g)
        room -= give * g
        spare += p * give
        if c > give:
            gaps.append((g, p, c - give))
            if filling + length > room:
                break
    return [(p, c) for _, p, c in gaps], spare


# --- The job ----------------------------------------------------------------


def tokenized(docs: DataFrame, id_col: str, text_col: str, path: str, length: int) -> DataFrame:
    """(row, id, digest, tokens, crcs) of each document; crcs are of its pieces of ``length`` and the rest."""

    def run(batches):
        ids = TokenBytes(path)
        for batch in batches:
            tokens, crcs = [], []
            for text in texts(batch.column(1)):
                got = ids.of(text)
                tokens.append(len(got) // 4)
                crcs.append([zlib.crc32(got[k : k + 4 * length]) for k in range(0, len(got), 4 * length)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(tokens, pa.int64()), pa.array(crcs, pa.list_(pa.int64()))],
                ["id", "digest", "tokens", "crcs"],
            )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), F.xxhash64(text).alias("digest"))
    rows = rows.mapInArrow(run, "id long, digest long, tokens long, crcs array<long>")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "tokens")


def _recut(docs, id_col, text_col, cuts: DataFrame, path: str) -> DataFrame:
    """``cuts`` (row, id, digest, start, length, ...) with the CRC of each piece, from the texts themselves."""

    def run(batches):
        ids = TokenBytes(path)
        for batch in batches:
            crcs = []
            for text, pieces in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                got = ids.of(text)
                crcs.append([zlib.crc32(got[4 * p["start"] : 4 * (p["start"] + p["length"])]) for p in pieces])
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), pa.array(crcs, pa.list_(pa.int64())), *(batch.column(i) for i in (2, 3))],
                ["pieces", "crcs", "id", "tokens"],
            )

    piece = "array<struct<start:long,length:long,sequence:long,offset:long>>"
    whole = cuts.groupBy("row", "id", "digest", "tokens").agg(
        F.collect_list(F.struct("start", "length", "sequence", "offset")).alias("pieces")
    )
    text = F.col(text_col).cast("string")
    source = docs.select(F.col(id_col).cast("long").alias("_id"), text.alias("text"), F.xxhash64(text).alias("_digest"))
    keys = whole.select("id", "digest").distinct()
    keys = F.broadcast(keys) if at_most(keys, BROADCAST_IDS) else keys
    match = source["_id"].eqNullSafe(keys["id"]) & (source["_digest"] == keys["digest"])
    # Rows that repeat id and text are one text here.
    source = source.join(keys, match, "left_semi").dropDuplicates(["_id", "_digest"])
    match = source["_id"].eqNullSafe(whole["id"]) & (source["_digest"] == whole["digest"])
    rows = source.join(whole, match).select("text", "pieces", "id", "tokens")
    rows = rows.mapInArrow(run, f"pieces {piece}, crcs array<long>, id long, tokens long")
    rows = rows.select("id", "tokens", F.explode(F.arrays_zip("pieces", "crcs")).alias("p"))
    return rows.select("id", "tokens", "p.pieces.*", F.col("p.crcs").alias("crc"))


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, path: str | None = None) -> DataFrame:
    """One row per piece: (id, start, length, crc, tokens, sequence, offset).

    A document is its ids and the end id, so null, empty or blank texts are one
    token long. Repeated rows and null ids are documents like any other; columns
    besides the two named are not read. No document gives no row.
    """
    path = path or tokenizer_path()
    rows = tokenized(docs, id_col, text_col, path, length)
    size = F.col("tokens") % length
    rows = rows.withColumns({"rest": size, "full": F.floor(F.col("tokens") / length)})
    held = rows.where("rest > 0").groupBy("rest").agg(F.count("*").alias("n")).collect()  # fewer than ``length`` rows
    lengths = np.zeros(length, np.int64)
    for r in held:
        lengths[r["rest"]] = r["n"]
    patterns, spare = plan(lengths, length)

    spark = docs.sparkSession
    base, taken, slots = 0, np.zeros(length // STEP, np.int64), []
    for pattern, copies in patterns:
        for k in np.flatnonzero(pattern):
            each = int(pattern[k])
            slots.append((int(k), int(taken[k]), int(taken[k] + each * copies), each, base))
            taken[k] += each * copies
        base += copies
    slots = spark.createDataFrame(slots, "kind long, low long, high long, each long, base long")
    rests = rows.where("rest > 0").withColumn("kind", F.floor((F.col("rest") - 1) / STEP))
    ranked = positions(rests, ["kind"], [F.xxhash64("row"), F.col("row")], F.lit(1)).withColumnRenamed("start", "rank")
    # The slots are bounded by the number of patterns, a few per length class.
    hit = (F.col("kind") == F.col("k")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(slots.withColumnRenamed("kind", "k")), hit, "left")
    placed = placed.withColumn("sequence", F.col("base") + F.floor((F.col("rank") - F.col("low")) / F.col("each")))
    placed = stage(placed.select("row", "id", "digest", "tokens", "rest", "sequence", F.element_at("crcs", -1).alias("crc")), "placed")

    before = Window.partitionBy("sequence").orderBy(F.desc("rest"), "row").rowsBetween(Window.unboundedPreceding, -1)
    whole = placed.where("sequence IS NOT NULL").withColumn("offset", F.coalesce(F.sum("rest").over(before), F.lit(0)))
    whole = whole.select(
        "id", (F.col("tokens") - F.col("rest")).alias("start"), F.col("rest").alias("length"), "crc", "tokens", "sequence", "offset"
    )

    # Filling: a stream of tokens of the documents that got no slot, laid along the gaps.
    fill = positions(placed.where("sequence IS NULL"), [], [F.xxhash64("row"), F.col("row")], F.col("rest"))
    fill = stage(fill.select("row", "id", "digest", "tokens", "rest", F.col("start").alias("s")), "fill")
    parts = whole.unionByName(
        _filled(docs, id_col, text_col, placed, fill, base, length, path)
    )
    # Pieces of full length are sequences of their own.
    long = positions(rows.where("full > 0").select("row", "id", "tokens", "full", "crcs"), [], [F.xxhash64("row"), F.col("row")], F.col("full"))
    over = fill.agg(F.coalesce(F.sum("rest"), F.lit(0))).first()[0] // length + 1
    long = long.select("id", "tokens", "start", F.posexplode(F.slice("crcs", F.lit(1), F.col("full").cast("int"))).alias("k", "crc"))
    long = long.select(
        "id", (F.col("k").cast("long") * length).alias("start"), F.lit(length).cast("long").alias("length"), "crc", "tokens",
        (F.col("start") + F.col("k") + base + over).alias("sequence"), F.lit(0).cast("long").alias("offset"),
    )
    return parts.unionByName(long)


def _filled(docs, id_col, text_col, placed, fill, base: int, length: int, path: str) -> DataFrame:
    used = placed.where("sequence IS NOT NULL").groupBy("sequence").agg(F.sum("rest").alias("used"))
    gaps = used.where(length - F.col("used") >= LEAST_PIECE).withColumn("gap", length - F.col("used"))
    gaps = positions(gaps, [], [F.xxhash64("sequence"), F.col("sequence")], F.col("gap"))
    gaps = stage(gaps.select("sequence", "used", "gap", F.col("start").alias("g")), "gaps")
    total = gaps.agg(F.coalesce(F.sum("gap"), F.lit(0))).first()[0]
    # Both streams are cut by the same grid; a pair meets in each cell it shares and is kept in the first.
    cells = lambda low, size: F.explode(F.sequence(F.floor(low / length), F.floor((low + size - 1) / length))).alias("cell")
    inside = fill.where(F.col("s") < total)
    left = inside.select("*", cells(F.col("s"), F.col("rest")))
    right = gaps.select("*", cells(F.col("g"), F.col("gap")))
    low, high = F.greatest("s", "g"), F.least(F.col("s") + F.col("rest"), F.col("g") + F.col("gap"))
    met = left.join(right, "cell").where((low < high) & (F.floor(low / length) == F.col("cell")))
    origin = F.col("tokens") - F.col("rest") - F.col("s")
    cuts = met.select(
        "row", "id", "digest", "tokens", (low + origin).alias("start"), (high - low).alias("length"), "sequence",
        (F.col("used") + low - F.col("g")).alias("offset"),
    )
    # Beyond the gaps, the stream goes on in sequences of its own.
    beyond = fill.where(F.col("s") + F.col("rest") > total).withColumn("low", F.greatest(F.col("s"), F.lit(total)) - total)
    beyond = beyond.withColumn("high", F.col("s") + F.col("rest") - total)
    beyond = beyond.select("*", F.explode(F.sequence(F.floor(F.col("low") / length), F.floor((F.col("high") - 1) / length))).alias("cell"))
    start = F.greatest(F.col("low"), F.col("cell") * length)
    end = F.least(F.col("high"), (F.col("cell") + 1) * length)
    beyond = beyond.select(
        "row", "id", "digest", "tokens", (start + total + origin).alias("start"), (end - start).alias("length"),
        (F.col("cell") + base).alias("sequence"), (start - F.col("cell") * length).alias("offset"),
    )
    cuts = stage(cuts.union(beyond), "cuts")
    return _recut(docs, id_col, text_col, cuts, path)


def packed_documents(docs: DataFrame) -> DataFrame:
    """The columns of the query's contract."""
    return pack(docs).select(
        F.col("id").alias("doc_id"), F.col("start").cast("long"), F.col("length").cast("long"),
        F.col("crc").alias("ids_crc32"), F.col("tokens").alias("doc_tokens"),
        F.col("sequence").cast("long").alias("sequence_id"), F.col("offset").cast("long"),
    )


def op7_packing(spark, sf_dir) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
