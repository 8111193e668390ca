"""N-gram Jaccard join with adaptive multi-match prefixes.

A document is the set of its distinct word n-grams. Every set is put into one
global order, frequent n-grams last. If two sets of sizes n and m are similar,
their prefixes of ``n - ceil(t n) + l`` and ``m - ceil(t m) + l`` elements share at
least ``l`` elements, for every ``l``. Each document picks its own ``l``: a longer
prefix where its postings promise many candidates, which must then share that
many elements. A pair is verified when it shares ``min(l, l')`` prefix elements.
``l`` counts in steps of ``STEP`` percent of the set: what texts share by chance
is less than a step, so a document whose prefix shares less with all others
together has no partner and leaves before any pair is made.

How it stays whole and linear:

* Documents with equal sets are one class; only classes are joined.
* Any total order gives the same result. Frequencies cover all documents (32-bit
  buckets, counted in one packed shuffle); the ``ORDERED`` most frequent buckets,
  8 MB, are sent to the tasks, all others count as rare.
* Postings travel as packed, compressed arrays by hash of the n-gram; n-grams that only one
  class has, most of them, end there.
* Components do not need every pair of a group of near copies: each member of a
  posting list is first verified against one leader of its list. What is then
  in one component is not paired again. Lists of the same classes are joined as one.
* A similar pair of known sizes must share a known number of the elements that lie in
  their shortest prefixes (``core``). A document whose lists hold fewer of them for every
  size of partner leaves: a near copy with too many n-grams of its own does so without
  meeting the thousands it was copied from. The others ask the shortest of their lists, as many
  as no partner in another component can avoid, so no link between components is
  missed. Pairs whose shared elements are too few are not verified.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, discard, stage
from .common import mixed, slices, table, texts, windows
from .components import connected

ORDERED = 1 << 20
MATCHES = 4
#: Percent of a set's size by which its number of matches rises.
STEP = 5
#: Cost of verifying a pair, in units of reading one posting.
VERIFY = 16
PART_BYTES = 8 << 20
FLUSH = 1 << 21
LEADER_ROUNDS = 3
#: Members of posting lists above this length are verified against a leader without counting what they share.
LONG = 64
#: Bytes of text hashed together, and the number of sets that a task remembers.
CHUNK_BYTES = 1 << 17
SEEN = 1 << 18
#: Any odd number whose powers spread: 3 or 5 modulo 8.
BASE = np.uint64(0xD1342543DE82EF95)
#: Rows of ids (8 bytes each) that may be sent to all tasks.
BROADCAST_IDS = 1 << 20
#: Copies that the tasks are told of (8 bytes each in the driver); more are merged as rows of their class.
COPIES = 1 << 21
#: Bands of sizes in a power of e: a band is 2 percent wide.
BANDS = 50


def _powers(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the odd ``BASE`` modulo 2^64, and their inverses."""
    inverse = pow(int(BASE), -1, 1 << 64)
    out = []
    for base in (BASE, np.uint64(inverse)):
        steps = np.full(count, base)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class WordHashes:
    """64-bit hashes of the words of texts, by array operations: no word becomes an object.

    A word is a polynomial in ``BASE`` whose coefficients are random 64-bit values of its
    bytes, so two words share a hash about as rarely as two random numbers do.
    """

    def __init__(self):
        rng = np.random.default_rng(20)
        self.letters = rng.integers(1, 1 << 64, 256, np.uint64)
        self.space = np.zeros(256, bool)
        self.space[[0x20, *range(0x09, 0x0E)]] = True
        self.up, self.down = _powers(2 * CHUNK_BYTES)

    def of(self, texts_: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of all texts in order, and how many each text has."""
        data = np.frombuffer(b" " + b" ".join(texts_) + b" ", np.uint8)
        blank = self.space[data]
        edges = np.flatnonzero(blank[1:] != blank[:-1]) + 1
        starts, ends = edges[::2], edges[1::2]
        hashes = np.empty(len(starts), np.uint64)
        at = 0
        while at < len(starts):  # words of some bytes at once; a longer one by itself
            to = max(at + 1, int(np.searchsorted(ends, starts[at] + CHUNK_BYTES, "right")))
            first, last = starts[at], ends[to - 1]
            up, down = (self.up, self.down) if last - first <= len(self.up) else _powers(int(last - first))
            sums = np.zeros(last - first + 1, np.uint64)
            np.cumsum(self.letters[data[first:last]] * up[: last - first], out=sums[1:])
            begin = starts[at:to] - first
            hashes[at:to] = (sums[ends[at:to] - first] - sums[begin]) * down[begin]
            at = to
        bounds = np.cumsum([1] + [len(t) + 1 for t in texts_])
        return mixed(hashes), np.diff(np.searchsorted(starts, bounds))


def _distinct(hashes: np.ndarray) -> np.ndarray:
    hashes = np.sort(hashes)
    new = hashes[1:] != hashes[:-1]
    return hashes if new.all() else hashes[np.concatenate([[True], new])]


def _cut(held: list[bytes], words: WordHashes, size: int) -> Iterator[np.ndarray]:
    ids, counts = words.of(held)
    hashes, start = windows(ids, size), 0
    for count in counts.tolist():
        if count >= size:
            yield _distinct(hashes[start : start + count - size + 1])
        else:
            yield windows(ids[start : start + count], count) if count else np.empty(0, np.uint64)
        start += count


def shingles(documents: Iterable[bytes | None], words: WordHashes, size: int = 5) -> Iterator[np.ndarray]:
    """Sorted distinct hashes of each text; fewer words than ``size`` count as one n-gram.

    Short texts are hashed together, about ``CHUNK_BYTES`` at a time.
    """
    held, waiting = [], 0
    for text in documents:
        held.append((text or b"").lower())
        waiting += len(held[-1])
        if waiting >= CHUNK_BYTES:
            yield from _cut(held, words, size)
            held, waiting = [], 0
    if held:
        yield from _cut(held, words, size)


def _sets(docs: DataFrame, id_col: str, text_col: str, size: int) -> DataFrame:
    """Size and key of each document's set, beside its compressed text, which takes less room than the set."""

    def run(batches):
        words, pack = WordHashes(), zstandard.ZstdCompressor(level=1)
        for batch in slices(batches):
            rows = [(t or b"").lower() for t in texts(batch.column(1))]
            ns, keys = [], []
            for items in shingles(rows, words, size):
                ns.append(len(items))
                keys.append(xxhash.xxh3_128_digest(items) if len(items) else None)
            packed = [pack.compress(t) if n else None for t, n in zip(rows, ns)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(ns, pa.int64()), pa.array(keys, pa.binary()), pa.array(packed, pa.binary())],
                ["id", "digest", "n", "key", "t"],
            )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("t"), F.xxhash64(text).alias("digest"))
    rows = rows.mapInArrow(run, "id long, digest long, n long, key binary, t binary")
    return stage(rows.withColumn("row", F.monotonically_increasing_id()), "sets")


def _copies(members: DataFrame) -> tuple[bool, bytes | None]:
    """Whether the tasks can be told of all copies, and the sorted rows that are not the first of their class, packed."""
    copies = members.where("row <> node").select("row")
    count = copies.count()
    if not 0 < count <= COPIES:
        return count == 0, None
    return True, _squeezed(np.sort(copies.toArrow().column("row").to_numpy()), True)


def _unseen(batches, size: int, copies: bytes | None = None):
    """(row, n, items) of rows that are no known copies and whose set this task has not had yet."""
    known = None if copies is None else _expanded(copies, np.int64, True)
    seen, words, unpack = set(), WordHashes(), zstandard.ZstdDecompressor()
    names = deque()

    def fresh():
        for batch in slices(batches):
            if known is not None:
                rows = batch.column(0).to_numpy()
                at = np.minimum(np.searchsorted(known, rows), len(known) - 1)
                batch = batch.filter(pa.array(known[at] != rows))
            rows, ns, keys, packed = (batch.column(i).to_pylist() for i in range(4))
            for row, n, key, text in zip(rows, ns, keys, packed):
                if key is not None and key not in seen:
                    if len(seen) >= SEEN:
                        seen.clear()
                    seen.add(key)
                    names.append((row, n))
                    yield unpack.decompress(text)

    for items in shingles(fresh(), words, size):
        row, n = names.popleft()
        yield row, n, items


def _squeezed(values: np.ndarray, rising: bool = False) -> bytes:
    """Integers by byte plane, compressed; of sorted ones the steps from each to the next."""
    if rising:
        values = np.diff(values, prepend=values.dtype.type(0))
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expanded(data: bytes, kind, rising: bool = False) -> np.ndarray:
    kind = np.dtype(kind)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(kind.itemsize, -1)
    values = np.ascontiguousarray(planes.T).view(kind).ravel()
    return np.cumsum(values, dtype=kind) if rising else values


def _bucket(items: np.ndarray) -> np.ndarray:
    return (items >> np.uint64(32)).astype(np.uint32)


def _parts(values: np.ndarray, parts: int) -> np.ndarray:
    """Where each part of sorted 32- or 64-bit values begins, and the end."""
    span = 1 << (values.dtype.itemsize * 8)
    cuts = np.array([span * i // parts for i in range(1, parts)], values.dtype)
    return np.concatenate([[0], np.searchsorted(values, cuts), [len(values)]])


def _frequent(sets: DataFrame, total: int, size: int, copies) -> tuple[np.ndarray, np.ndarray]:
    """About the ``ORDERED`` most frequent buckets of n-grams, sorted, and their numbers of documents."""
    parts = max(1, total * 4 // PART_BYTES + 1)

    def packed(held: list[np.ndarray]):
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        counts = np.minimum(counts, 2**32 - 1).astype(np.uint32)
        once = counts == 1
        for many, (v, c) in enumerate(((values[once], None), (values[~once], counts[~once]))):
            at = _parts(v, parts)
            for p in np.flatnonzero(np.diff(at)):
                cut = slice(at[p], at[p + 1])
                yield int(p), _squeezed(v[cut], True), _squeezed(c[cut]) if many else None

    def count(batches):
        def out(rows):
            columns = list(zip(*rows)) or [(), (), ()]
            kinds = (pa.int32(), pa.binary(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["part", "v", "c"])

        held, waiting = [], 0
        for _, n, items in _unseen(batches, size, copies.value):
            held.append(_bucket(items))
            waiting += n
            if waiting >= FLUSH:
                yield out(packed(held))
                held, waiting = [], 0
        if held:
            yield out(packed(held))

    def merge(group: pa.Table) -> pa.Table:
        values, counts = [], []
        for v, c in zip(group.column("v").to_pylist(), group.column("c").to_pylist()):
            values.append(_expanded(v, np.uint32, True))
            counts.append(np.ones(len(values[-1]), np.uint32) if c is None else _expanded(c, np.uint32))
        values, counts = np.concatenate(values), np.concatenate(counts)
        order = np.argsort(values, kind="stable")
        values, counts = values[order], counts[order]
        first = np.flatnonzero(np.diff(values, prepend=values[0] ^ np.uint32(1)))
        sums = np.add.reduceat(counts, first, dtype=np.int64)
        keep = sums > 1
        return pa.table({"v": values[first][keep].view(np.int32), "n": sums[keep]})

    rows = sets.select("row", "n", "key", "t").mapInArrow(count, "part int, v binary, c binary")
    counted = stage(rows.groupBy("part").applyInArrow(merge, "v int, n long"), "counted")
    top = _most(counted, ORDERED).toArrow()
    discard(counted)
    values = top.column("v").to_numpy().view(np.uint32)
    order = np.argsort(values)
    return values[order], top.column("n").to_numpy()[order]


def _most(counted: DataFrame, wanted: int) -> DataFrame:
    """About ``wanted`` rows (v, n) of largest n: all above the number at which they are reached, of that one a range of v.

    Only how often each number occurs is gathered, nothing is ordered: an order of that many
    rows would fill the heap of a single task. ``v`` are hashes, so a range holds its share of them.
    """
    taken = 0
    for n, rows in sorted(counted.groupBy("n").count().collect(), reverse=True):
        if taken + rows > wanted:
            below = -(1 << 31) + ((wanted - taken) << 32) // rows
            return counted.where((F.col("n") > n) | (F.col("n") == n) & (F.col("v") < below))
        taken += rows
    return counted


def step_of(n: int, percent: int) -> int:
    """The least number of matches of a set of ``n`` elements; it never falls with ``n``."""
    return max(1, min(-(-percent * n // 100), n * STEP // 100))


def _need(n: str, percent: int) -> str:
    """The least overlap of a set of ``n`` elements with any partner, in SQL."""
    return f"(({percent} * {n} + 99) div 100)"


def _step(n: str, percent: int) -> str:
    """``step_of`` in SQL."""
    return f"greatest(1, least(({percent} * {n} + 99) div 100, {n} * {STEP} div 100))"


def matches(weights: np.ndarray, need: int, step: int = 1) -> int:
    """How many prefix elements a set asks its partners to share, a multiple of ``step``.

    ``weights`` are the estimated posting lengths in the global order and ``need``
    is the least overlap with any partner. With ``l`` matches, the prefix reads its
    postings and at most a share of 1 / ``l`` of them can become candidates.
    """
    n = len(weights)
    reads = np.cumsum(weights)
    best, cost = step, None
    for l in range(step, min(MATCHES * step, need) + 1, step):
        read = reads[n - need + l - 1]
        now = read + VERIFY * (read - (n - need + l)) / l
        if cost is None or now < cost:
            best, cost = l, now
    return best


def _postings(sets: DataFrame, total: int, size: int, percent: int, frequent, copies) -> DataFrame:
    """(item, row, steps, core) of prefix elements that at least two rows have.

    The row asks for ``steps`` times its step of matches; ``core`` is 1 in the prefix of one step, else 0.
    """
    parts = max(1, total * 4 // PART_BYTES + 1)
    known = sets.sparkSession.sparkContext.broadcast(frequent)

    def prefixes(batches):
        values, numbers = known.value
        likely = np.zeros(1 << 22, bool)  # of a bucket's leading bits: most n-grams need no search
        likely[values >> 10] = True

        def pack(held):
            items, rows, steps = (np.concatenate(x) for x in zip(*held))
            order = np.argsort(items, kind="stable")
            items, rows, steps = items[order], rows[order], steps[order]
            at = _parts(items, parts)
            full = np.flatnonzero(np.diff(at))
            cut = lambda x: pa.array([_squeezed(x[at[p] : at[p + 1]], x is items) for p in full], pa.binary())
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), cut(items), cut(rows), cut(steps)], ["part", "item", "row", "steps"]
            )

        held, waiting = [], 0
        for row, n, items in _unseen(batches, size, copies.value):
            weights = np.ones(n, np.int64)
            if len(values):
                bucket = _bucket(items)
                asked = np.flatnonzero(likely[bucket >> np.uint32(10)])
                bucket = bucket[asked]
                at = np.minimum(np.searchsorted(values, bucket), len(values) - 1)
                weights[asked] = np.where(values[at] == bucket, numbers[at], 1)
            order = np.argsort(weights, kind="stable")  # items are sorted, so ties go by hash
            need = -(-percent * n // 100)
            step = step_of(n, percent)
            l = matches(weights[order], need, step)
            chosen = items[order[: n - need + l]]
            k = len(chosen)
            marks = np.full(k, 2 * (l // step), np.uint8)
            marks[: n - need + step] += 1
            held.append((chosen, np.full(k, row), marks))
            waiting += k
            if waiting >= FLUSH // 2:
                yield pack(held)
                held, waiting = [], 0
        if held:
            yield pack(held)

    def shared(group: pa.Table) -> pa.Table:
        kinds = {"item": np.uint64, "row": np.int64, "steps": np.uint8}
        c = {k: np.concatenate([_expanded(b, t, k == "item") for b in group.column(k).to_pylist()]) for k, t in kinds.items()}
        order = np.argsort(c["item"], kind="stable")
        items = c["item"][order]
        same = items[1:] == items[:-1]
        keep = order[np.concatenate([same, [False]]) | np.concatenate([[False], same])]
        marks = c["steps"][keep].astype(np.int32)
        return pa.table({"item": c["item"][keep].view(np.int64), "row": c["row"][keep], "steps": marks // 2, "core": marks % 2})

    rows = sets.select("row", "n", "key", "t").mapInArrow(
        prefixes, "part int, item binary, row binary, steps binary"
    )
    return rows.groupBy("part").applyInArrow(shared, "item long, row long, steps int, core int")


def _partnered(postings: DataFrame, by: str, percent: int) -> DataFrame:
    """Postings of those ``by`` that share enough core elements, with all others together, to have a partner.

    A partner of a set of n has at least need(n) elements and so shares a step of that size or more
    in the prefixes of one step.
    """
    held = postings.withColumn("held", F.sum("core").over(Window.partitionBy(by)))
    return held.where(f"held >= {_step(_need('n', percent), percent)}").drop("held")


def _near(postings: DataFrame, percent: int) -> DataFrame:
    """Postings beside each band of partners' sizes of their list, where such partners are possible.

    Of the ``held`` core elements in a document's lists with such partners, it shares at
    least ``least`` with any that is similar: that is the overlap the sizes ask for,
    without what lies beyond the longer or the shorter of both prefixes.
    """
    beyond = lambda n: f"{_need(n, percent)} - {_step(n, percent)}"
    sized = postings.withColumn("band", F.expr(f"int(ln(n) * {BANDS})"))
    sizes = sized.selectExpr("item", "band", "n AS m", f"{beyond('n')} AS rest").groupBy("item", "band")
    sizes = sizes.agg(F.min("m").alias("lo"), F.max("m").alias("hi"), F.max("rest").alias("rest"))
    near = postings.join(sizes, "item").where(f"100 * hi >= {percent} * n AND {percent} * lo <= 100 * n")
    same = Window.partitionBy("node", "band")
    near = near.withColumns({"held": F.sum("core").over(same), "lo": F.min("lo").over(same), "rest": F.max("rest").over(same)})
    lo, rest = f"greatest(lo, {_need('n', percent)})", f"greatest(rest, {beyond('n')})"
    both = f"{percent} * (n + {lo})"
    near = near.withColumn("least", F.expr(f"({both} + {99 + percent}) div {100 + percent} - {rest}"))
    return near.where("held >= least").drop("lo", "hi", "rest")


def _viable(postings: DataFrame, percent: int) -> DataFrame:
    """Postings of documents and lists in which a partner is possible."""
    return _near(postings, percent).select(*postings.columns).distinct()


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of different components whose postings allow them to be similar.

    Of two components the one with fewer postings asks. A document has ``held`` core elements and a
    partner shares ``least`` of them, so it has one of any ``held - least + 1``: those of the shortest lists.
    """
    ranks = postings.groupBy("component").agg(F.count("*").alias("rank"))
    postings = postings.join(_small(ranks), "component")
    shortest = Window.partitionBy("node", "band").orderBy("size", "item").rowsBetween(Window.unboundedPreceding, -1)
    asks = _near(postings, percent).where("core > 0").withColumn("before", F.coalesce(F.sum("core").over(shortest), F.lit(0)))
    asks = asks.where("before <= held - least").select("item", "band", "node", "n", "component", "rank")
    names = ("item", f"int(ln(n) * {BANDS}) AS band", "node AS b", "n AS m", "component AS other", "rank AS its")
    met = asks.join(postings.selectExpr(*names), ["item", "band"]).where("component <> other")
    met = met.where("rank < its OR rank = its AND component < other")
    met = met.where(f"100 * least(n, m) >= {percent} * greatest(n, m)")
    pairs = met.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b")).distinct()
    # What they share in all, from one row per document.
    first = postings.groupBy("node").agg(
        F.first("n").alias("n"), F.first("l").alias("l"), F.collect_list(F.struct("item", "w", "core")).alias("x")
    )
    second = first.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("l").alias("k"), F.col("x").alias("y"))
    full = pairs.join(first.withColumnRenamed("node", "a"), "a").join(second, "b")
    full = full.withColumn("x", F.expr("filter(x, e -> array_contains(y.item, e.item))"))
    full = full.withColumn("common", F.expr("aggregate(x, 0L, (s, e) -> s + e.w)"))
    full = full.withColumn("inner", F.expr("aggregate(x, 0L, (s, e) -> s + e.core)"))
    need = {n: _need(n, percent) for n in "nm"}
    short = f"greatest({need['n']} - {_step('n', percent)}, {need['m']} - {_step('m', percent)})"
    long = f"greatest({need['n']} - l, {need['m']} - k)"
    room = f"{100 + percent} * least(inner + {short}, common + {long}) >= {percent} * (n + m)"
    return full.where(f"common >= least(l, k) AND {room}").select("a", "b")


def _small(ids: DataFrame) -> DataFrame:
    """Hint a broadcast only when the counted size allows it."""
    return F.broadcast(ids) if at_most(ids, BROADCAST_IDS) else ids


def _verified(pairs: DataFrame, sets: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets really are similar; compressed texts travel, and only those of pairs."""

    def check(batches):
        words, unpack = WordHashes(), zstandard.ZstdDecompressor()
        last = None  # a leader's pairs mostly follow each other
        y = np.empty(0, np.uint64)
        for batch in slices(batches):
            _, bs, first, second = (batch.column(i).to_pylist() for i in range(4))
            new = [b != before for b, before in zip(bs, [last, *bs])]

            def needed():
                for x, t, other in zip(first, second, new):
                    yield unpack.decompress(x)
                    if other:
                        yield unpack.decompress(t)

            found, keep = shingles(needed(), words, size), []
            for other in new:
                x = next(found)
                y = next(found) if other else y
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            last = bs[-1] if bs else last
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    wanted = _small(pairs.select(F.explode(F.array("a", "b")).alias("row")))
    held = sets.select("row", "t").join(wanted, "row", "left_semi")
    first = held.select(F.col("row").alias("a"), F.col("t").alias("x"))
    second = held.select(F.col("row").alias("b"), F.col("t").alias("y"))
    full = pairs.join(first, "a").join(second, "b").select("a", "b", "x", "y")
    return full.mapInArrow(check, "a long, b long")


def _counted(shared: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b), with ``likely``: whether the elements of ``shared`` are enough for them to be similar.

    ``shared`` has a row (node, b, n, m, l, k, w, size) for ``w`` shared elements. Beyond the
    shorter prefix of a document lie need - l elements.
    """
    rows = shared.select(F.least("node", "b").alias("a"), F.greatest("node", "b").alias("b"), "n", "m", "l", "k", "w", "size")
    need = lambda n, l: F.ceil(percent * F.col(n) / 100) - F.col(l)
    pairs = rows.groupBy("a", "b").agg(
        F.sum("w").alias("common"),
        F.min(F.least("l", "k")).alias("needed"),
        F.min(F.col("n") + F.col("m")).alias("both"),
        F.max(F.greatest(need("n", "l"), need("m", "k"))).alias("beyond"),
        F.max("size").alias("size"),
    )
    room = F.expr(f"{100 + percent} * (common + beyond) >= {percent} * both")
    return pairs.select("a", "b", "size", (F.expr("common >= needed") & room).alias("likely"))


def _grouped(docs: DataFrame, id_col: str, text_col: str, size: int, percent: int) -> DataFrame:
    """(row, id, digest, n, node, component) of each document; digest is of its text."""
    spark = docs.sparkSession
    sets = _sets(docs, id_col, text_col, size)
    classes = sets.where("key IS NOT NULL").groupBy("key").agg(F.min("row").alias("node"))
    members = sets.select("row", "id", "digest", "n", "key").join(classes, "key", "left")
    members = stage(members.select("row", "id", "digest", "n", F.coalesce("node", "row").alias("node")), "members")
    total = sets.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    told, copies = _copies(members)
    copies = spark.sparkContext.broadcast(copies)
    frequent = _frequent(sets, total, size, copies)
    postings = _postings(sets, total, size, percent, frequent, copies).join(members.select("row", "node", "n"), "row")
    postings = _partnered(postings, "row", percent).withColumn("l", F.expr(f"steps * {_step('n', percent)}"))
    postings = postings.select("item", "node", "n", "l", "core")
    # Where the tasks know all copies, every class has one row.
    postings = stage(postings if told else postings.distinct(), "postings")
    # Near copies share long runs of n-grams: lists of the same classes become one of ``w`` n-grams. Should
    # two lists share a hash, their pairs count more than they share, and are verified.
    same = F.xxhash64(F.bit_xor(F.xxhash64("node")), F.count("*"))
    lists = postings.groupBy("item").agg(same.alias("list"), F.count("*").alias("size")).where("size > 1")
    shared = _partnered(postings.join(lists, "item"), "node", percent)
    # A member of many long lists is likely the text that the others are copies of.
    shared = shared.withColumn("weight", F.sum("size").over(Window.partitionBy("node")))
    first = lambda *names: (F.max(c).alias(c) for c in names)
    shared = shared.groupBy("node", "list").agg(F.count("*").alias("w"), F.sum("core").alias("core"), *first("n", "l", "size", "weight"))
    every, postings = postings, stage(_viable(shared.withColumnRenamed("list", "item"), percent), "postings")
    discard(every)

    fits = f"100 * least(n, m) >= {percent} * greatest(n, m)"
    component = None
    done, labelled = None, postings.withColumn("component", F.col("node"))
    for turn in range(LEADER_ROUNDS):
        # Another leader each time; partial aggregation keeps a hot list off any single task.
        first = F.col("weight") if turn == 0 else F.xxhash64(F.lit(turn), "node")
        rank = F.struct(first.alias("h"), "node", F.col("n").alias("m"), F.col("l").alias("k"), "component")
        leaders = labelled.groupBy("item").agg(F.max(rank).alias("best"))
        leaders = leaders.select("item", F.col("best.node").alias("b"), "best.m", "best.k", F.col("best.component").alias("other"))
        pairs = labelled.join(leaders, "item").where("component <> other").where(fits)
        # What a leader's lists hold too little of is left to the lists as a whole, below.
        pairs = _counted(pairs, percent).where(f"likely OR size > {LONG}").select("a", "b")
        pairs = _new(pairs, done)
        links = stage(_verified(pairs, sets, size, percent), "links")
        done = pairs if done is None else done.union(pairs)
        if at_most(links, 0):
            break
        component = _joined(component, links)
        labelled, left = _relabelled(postings, component)
        if (left["pairs"] or 0) <= 4 * (left["rows"] or 0):
            break
    # All that the leaders left: pairs across components.
    labelled = stage(_viable(labelled, percent), "labelled")
    pairs = _new(_candidates(labelled, percent), done)
    found = stage(_verified(pairs, sets, size, percent), "links")
    discard(sets)
    if component is None or not at_most(found, 0):
        component = _joined(component, found)
    # A document without words is its own node, so it is a group of its own.
    return members.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _new(pairs: DataFrame, done: DataFrame | None) -> DataFrame:
    return stage(pairs if done is None else pairs.join(done, ["a", "b"], "left_anti"), "pairs")


def _joined(component: DataFrame | None, links: DataFrame) -> DataFrame:
    """Components after further links."""
    known = links if component is None else links.union(component.select(F.col("node").alias("a"), F.col("component").alias("b")))
    return connected(known)


def similar_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """Groups of documents linked by Jaccard similarity of word n-grams, one row per document.

    Returns (id, n_shingles, class, component_id): the size of the set, a number for
    documents with equal sets, and the smallest id reachable by links. Texts without
    words (null included) have the empty set and link with nothing. Rows that repeat
    an id are documents of their own. A null id takes part in links but is never the
    smallest; a group of null ids only has component_id null. Other columns are not read.
    """
    grouped = _grouped(docs, id_col, text_col, size, percent)
    smallest = grouped.groupBy("component").agg(F.min("id").alias("component_id"))
    out = grouped.join(smallest, "component")
    return out.select("id", F.col("n").alias("n_shingles"), F.col("node").alias("class"), "component_id")


def _relabelled(postings: DataFrame, component: DataFrame):
    """Postings with components, without the lists that lie in one; and how many pairs these still hold."""
    tagged = postings.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = tagged.groupBy("item").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y")
    tagged = stage(tagged.join(mixed.select("item"), "item"), "labelled")
    sizes = tagged.groupBy("item", "component").agg(F.count("*").alias("k"))
    per = sizes.groupBy("item").agg(F.sum("k").alias("t"), F.sum(F.col("k") * F.col("k")).alias("q"))
    left = per.agg(F.sum((F.col("t") * F.col("t") - F.col("q")) / 2).alias("pairs"), F.sum("t").alias("rows")).first()
    return tagged, left


def op2_ngram_join(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return similar_sets(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", F.col("class").alias("class_id"))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: the smallest doc_id (null last), then text hash.

    Documents without words all stay; of equal rows with words one stays.
    """
    grouped = stage(_grouped(docs, "doc_id", "text", size, percent).where("n > 0"), "grouped")
    first = F.min(F.struct(F.col("id").isNull(), "id", "digest", "row"))
    best = grouped.groupBy("component").agg(first.alias("best"))
    judged = grouped.join(best, "component")
    same = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("digest") == F.col("best.digest"))
    name = [F.col("id").alias("_id"), F.col("digest").alias("_digest")]
    lost = _small(judged.where(~same).select(*name).distinct())
    on = lambda side: docs["doc_id"].cast("long").eqNullSafe(side["_id"]) & (F.xxhash64(docs["text"]) == side["_digest"])
    kept = docs.join(lost, on(lost), "left_anti")
    again = judged.where(same).groupBy(*name).agg(F.count("*").alias("_rows")).where("_rows > 1").drop("_rows")
    if at_most(again, 0):
        return kept
    again = _small(again)
    single = kept.join(again, on(again), "left_anti")
    own = "_digest"
    while own in docs.columns:
        own += "_"
    repeated = kept.join(again, on(again), "left_semi").withColumn(own, F.xxhash64("text"))
    return single.union(repeated.dropDuplicates(["doc_id", own]).drop(own))
