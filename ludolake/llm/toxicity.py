"""Toxic passages by maximum-scoring segment search.

Words get log-odds of the toxic against the clean labelled texts, smoothed with an
informative Dirichlet prior (the pooled counts). A word that the labels do not show
often enough takes the log-odds of its longest known prefix. Shifted so that clean
text drifts down, the scores of a text have maximal segments that one linear scan
finds, all of them. Under clean text the best segment of ``n`` words follows an
extreme-value law, P(S > x) = 1 - exp(-K n exp(-lambda x)); ``lambda`` solves
E[exp(lambda s)] = 1 over the words of clean training texts and ``K`` is fitted to
their best segments. What each segment exceeds the expected best by, ``lambda S -
ln(K n)``, adds up to the evidence of a text, which a logistic curve fitted on the
training rows turns into a score.

Everything that is learned comes from labelled rows outside the held-out fold, all
of them; only sums leave the tasks. Every feature of at least ``LEAST_COUNT`` words
counts: the ``VOCABULARY`` most frequent ones are sent to the tasks, the others are
joined to the texts that hold them. A Bloom filter of these others goes along, so
that texts ask the join for little that it does not have.

Words of scripts without spaces and words of more than ``LONG`` characters are scored
by every run of ``GRAM`` characters in them, so texts without white space are scanned
whole too.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import table, texts

#: Features sent to the tasks, 16 bytes each.
VOCABULARY = 1_000_000
#: Bits of the Bloom filter of all others, at most (16 MB); ten a feature below that.
FILTER_BITS = 1 << 27
FILTER_SHIFTS = (0, 18, 36)
PREFIXES = (7, 6, 5, 4)
LEAST_COUNT = 5
#: Pseudo-counts of the prior, spread over words as the pooled counts are.
PRIOR = 100.0
#: Mean score of a word of clean text.
DRIFT = -1.0
#: Log-odds are cut off beyond these.
LOW, HIGH = -4.0, 6.0
#: A passage is reported when its chance in clean text is below this.
SIGNIFICANT = 0.01
FOLDS = 5
BROADCAST_LABELS = 1 << 20
#: Joined log-odds (16 bytes) that may be sent to all tasks beside their texts' digests.
BROADCAST_OTHERS = 1 << 20
#: Words a task remembers.
MEMORY = 400_000
LONG, GRAM = 32, 3
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")
_RUNS = re.compile(r"[^\W_]+")
_UNSPACED = re.compile(r"[\u0E00-\u0EFF\u1000-\u109F\u1780-\u17FF\u3040-\u30FF\u3400-\u4DBF\u4E00-\u9FFF\uF900-\uFAFF]")


def _units(word: bytes) -> list[bytes]:
    """What a word is scored by: itself without its edges, or its runs of ``GRAM`` characters."""
    if len(word) <= LONG and word.isalpha():  # ASCII letters only
        return [word.lower()]
    text = word.decode().lower()
    if len(text) > LONG or not text.isascii() and _UNSPACED.search(text):
        runs = _RUNS.findall(text)
        return [r[k : k + GRAM].encode() for r in runs for k in range(max(1, len(r) - GRAM + 1))] or [b""]
    return [(text if text.isalpha() else _EDGES.sub("", text)).encode()]


def _features(unit: bytes | str) -> list[int]:
    """The unit and its prefixes, most specific first, as numbers; none of an empty one."""
    unit = unit.encode() if isinstance(unit, str) else unit
    if not unit:
        return []
    digest = xxhash.xxh3_64_intdigest
    if unit.isascii():
        return [digest(b"=" + unit) >> 1] + [digest(unit[:k] + b"*") >> 1 for k in PREFIXES if len(unit) > k]
    text = unit.decode()
    return [digest(b"=" + unit) >> 1] + [digest(f"{text[:k]}*".encode()) >> 1 for k in PREFIXES if len(text) > k]


def held_out(doc_id):
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def _training(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, toxic) of labelled rows outside the held-out fold; a document labelled twice counts as toxic if either says so."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    known = F.broadcast(known) if at_most(known, BROADCAST_LABELS) else known
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).join(known, "doc_id").select("text", "toxic")


def _counted(rows: DataFrame) -> DataFrame:
    """(features, y1, y0) of the units of texts, most specific feature first; units without any count in the totals only."""

    def run(batches):
        sides = (Counter(), Counter())

        def out():
            found: dict[bytes, list[int]] = {}
            for label, side in enumerate(sides):
                for word, n in side.items():
                    for unit in _units(word):
                        found.setdefault(unit, [0, 0])[label] += n
                side.clear()
            columns = [_features(u) for u in found], [p[1] for p in found.values()], [p[0] for p in found.values()]
            kinds = pa.list_(pa.int64()), pa.int64(), pa.int64()
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["features", "y1", "y0"])

        for batch in batches:
            for text, toxic in zip(texts(batch.column(0)), batch.column(1).to_pylist()):
                sides[int(toxic > 0)].update((text or b"").split())
            if sum(map(len, sides)) > 300_000:
                yield out()
        yield out()

    return rows.mapInArrow(run, "features array<bigint>, y1 long, y0 long")


class Odds:
    """Sorted features and their log-odds, and a Bloom filter of the features that are joined instead."""

    def __init__(self, features=(), values=(), bits: np.ndarray | None = None):
        order = np.argsort(np.asarray(features, np.int64))
        self.features, self.values = np.asarray(features, np.int64)[order], np.asarray(values, float)[order]
        self.bits = bits

    def __len__(self) -> int:
        return len(self.features)

    def __contains__(self, feature: int) -> bool:
        return bool(self.of(np.array([feature]))[1][0])

    def of(self, features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log-odds of ``features``, and which of them are here."""
        if not len(self.features):
            return np.zeros(len(features)), np.zeros(len(features), bool)
        at = np.minimum(np.searchsorted(self.features, features), len(self.features) - 1)
        return self.values[at], self.features[at] == features

    def elsewhere(self, features: np.ndarray) -> np.ndarray:
        """Which features the joined ones may include."""
        if self.bits is None:
            return np.zeros(len(features), bool)
        hit, last = np.ones(len(features), bool), len(self.bits) * 8 - 1
        for shift in FILTER_SHIFTS:
            at = (features >> shift) & last
            hit &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return hit


def _filter(others: DataFrame) -> np.ndarray:
    """The Bloom filter of ``feature``; each set of 32,768 bits is put together by an aggregate of its own."""
    bits = 1 << 15
    wanted = 10 * others.count()
    while bits < wanted and bits < FILTER_BITS:
        bits *= 2
    places = F.array(*(F.shiftright("feature", k).bitwiseAND(F.lit(bits - 1)) + 1 for k in FILTER_SHIFTS))
    rows = others.select(F.explode(places).alias("p"))
    parts = rows.groupBy(F.bitmap_bucket_number("p").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    out = np.zeros(bits // 8, np.uint8)
    for part, held in parts.toLocalIterator():  # bits / 32,768 rows of 4 KB
        out[(part - 1) * 4096 : part * 4096] = np.frombuffer(held, np.uint8)
    return out


def log_odds(rows: DataFrame, limit: int | None = None) -> tuple[Odds, DataFrame | None, float]:
    """Smoothed log-odds of every feature: the ``limit`` most frequent ones, a staged table (feature, d) of the
    others, if any, and the mean log-odds of the words of clean texts."""
    limit = VOCABULARY if limit is None else limit
    units = stage(_counted(rows).groupBy("features").agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")), "units")
    total = units.agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).first()
    if not total["y1"] or not total["y0"]:
        return Odds(), None, 0.0
    n1, n0 = float(total["y1"]), float(total["y0"])
    y1, y0 = F.col("y1"), F.col("y0")
    sums = units.select(F.explode("features").alias("feature"), "y1", "y0").groupBy("feature")
    sums = sums.agg(F.sum("y1").alias("y1"), F.sum("y0").alias("y0")).where(y1 + y0 >= LEAST_COUNT)
    prior = (y1 + y0) * (PRIOR / (n1 + n0))
    delta = F.log((y1 + prior) / (n1 + PRIOR - y1 - prior)) - F.log((y0 + prior) / (n0 + PRIOR - y0 - prior))
    scored = stage(sums.select("feature", delta.alias("d"), (y1 + y0).alias("n")), "odds")
    # A unit takes its first feature that is known; what has none counts as 0.
    asked = units.where("y0 > 0").select(F.posexplode("features").alias("place", "feature"), F.col("features")[0].alias("unit"), "y0")
    best = asked.join(scored, "feature").groupBy("unit").agg(F.min(F.struct("place", "d", "y0")).alias("best"))
    value = F.greatest(F.lit(LOW), F.least(F.lit(HIGH), F.col("best.d")))
    mean = (best.agg(F.sum(value * F.col("best.y0"))).first()[0] or 0.0) / n0
    # Features of one count are all sent or all joined; their scores do not depend on it.
    sent, least = 0, LEAST_COUNT
    if not at_most(scored, limit):
        least = None
        for n, many in scored.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
            sent += many
            if sent > limit:
                break
            least = n
    top = scored.where(F.col("n") >= least).select("feature", "d").toArrow() if least is not None else None
    odds = Odds(top.column("feature").to_numpy(), top.column("d").to_numpy()) if top else Odds()
    if least == LEAST_COUNT:
        return odds, None, mean
    others = scored.where(F.col("n") < least) if least is not None else scored
    others = others.select("feature", "d")
    odds.bits = _filter(others)
    return odds, others, mean


def _with_others(rows: DataFrame, model, others: DataFrame | None) -> DataFrame:
    """``rows`` (text among them) with ``others``: the features of the text that are joined, with their log-odds."""
    if others is None:
        return rows.withColumn("others", F.lit(None).cast("map<bigint, double>"))

    def run(batches):
        own = Scores(model.value, 0.0)
        for batch in batches:
            digests, features = [], []
            for digest, text in zip(batch.column(0).to_pylist(), texts(batch.column(1))):
                asked = own.asked(text)
                digests += [digest] * len(asked)
                features += asked
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.int64()), pa.array(features, pa.int64())], ["digest", "feature"])

    digest = F.xxhash64("text")
    asked = rows.select(digest.alias("digest"), "text").mapInArrow(run, "digest long, feature long").distinct()
    found = asked.join(others, "feature").groupBy("digest").agg(F.map_from_entries(F.collect_list(F.struct("feature", "d"))).alias("others"))
    found = stage(found.withColumnRenamed("digest", "_digest"), "found")
    held = found.agg(F.coalesce(F.sum(F.size("others") + 1), F.lit(0))).first()[0]
    found = F.broadcast(found) if held <= BROADCAST_OTHERS else found
    return rows.withColumn("_digest", digest).join(found, "_digest", "left").drop("_digest")


class Scores:
    """Texts to scores; at most ``MEMORY`` words are remembered."""

    def __init__(self, odds: Odds, shift: float):
        self.odds, self.shift = odds, shift
        self.single: dict[bytes, float] = {}
        #: Words of several units, or with features that may be joined: (value, features that come before it) of each unit.
        self.many: dict[bytes, list[tuple[float, list[int]]]] = {}

    def score(self, odds: float) -> float:
        return min(max(odds, LOW), HIGH) - self.shift

    def _learn(self, words: set[bytes], more: set[bytes]) -> None:
        """Remember ``words``, and ``more`` too where that makes it forget all others."""
        if len(self.single) + len(self.many) + len(words) > MEMORY:
            self.single.clear()
            self.many.clear()
            words = words | more
        units = [[_features(u) or [-1] for u in _units(w)] for w in words]  # no feature is below 0
        each = list(chain.from_iterable(units))
        flat = np.array(list(chain.from_iterable(each)), np.int64)
        begin = np.concatenate([[0], np.cumsum(np.fromiter(map(len, each), np.int64, len(each)))])
        values, known = self.odds.of(flat)
        # Of each unit the place of its first known feature; its end if it has none.
        places = np.where(known, np.arange(len(flat)), len(flat))
        first = np.minimum(np.minimum.reduceat(places, begin[:-1]), begin[1:])
        got = np.where(first < begin[1:], np.append(values, 0.0)[first], 0.0)
        scores = (np.minimum(np.maximum(got, LOW), HIGH) - self.shift).tolist()
        joined: dict[int, list[int]] = {}
        if self.odds.bits is not None:
            hits = np.flatnonzero(self.odds.elsewhere(flat) & (flat >= 0))
            owners = np.searchsorted(begin, hits, "right") - 1
            for k in np.flatnonzero(hits < first[owners]):
                joined.setdefault(int(owners[k]), []).append(int(flat[hits[k]]))
        if len(each) == len(words) and not joined:
            self.single.update(zip(words, scores))
            return
        at = 0
        for word, us in zip(words, units):
            if len(us) == 1 and at not in joined:
                self.single[word] = scores[at]
            else:
                self.many[word] = [(scores[k], joined.get(k, [])) for k in range(at, at + len(us))]
            at += len(us)

    def _know(self, words: list[bytes]) -> None:
        own = set(words)
        new = own.difference(self.single)
        if self.many:
            new.difference_update(self.many)
        if new:
            self._learn(new, own)

    def asked(self, text: bytes | None) -> list[int]:
        """The features of the text that its score wants from the joined ones."""
        words = (text or b"").split()
        self._know(words)
        return list({f for w in set(words) if w in self.many for _, before in self.many[w] for f in before})

    def of(self, text: bytes | None, others: list[tuple[int, float]] | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The scores of the units of a text and the place of each one's word; ``others`` are its joined features."""
        words = (text or b"").split()
        single = self.single
        for _ in range(2):
            try:
                return np.fromiter(map(single.__getitem__, words), float, len(words)), np.arange(len(words))
            except KeyError:  # a word that is new, or of several scores
                self._know(words)
        more, scores, places = dict(others or ()), [], []
        for place, word in enumerate(words):
            value = single.get(word)
            if value is not None:
                scores.append(value)
                places.append(place)
                continue
            for own, before in self.many[word]:
                found = next((more[f] for f in before if f in more), None)
                scores.append(own if found is None else self.score(found))
                places.append(place)
        return np.array(scores, float), np.array(places, np.int64)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments as (start, end, sum), by the linear-time scan of Ruzzo and Tompa."""
    sums = [0.0, *np.cumsum(scores).tolist()]
    stack: list[tuple[int, int, float, float, int]] = []  # start, end, sum before, sum after, earlier with less before
    for i in np.flatnonzero(scores > 0).tolist():
        start, end, left, right = i, i + 1, sums[i], sums[i + 1]
        j = len(stack) - 1
        while True:
            while j >= 0 and stack[j][2] >= left:
                j = stack[j][4]
            if j < 0 or stack[j][3] >= right:
                stack.append((start, end, left, right, j))
                break
            start, left, j_next = stack[j][0], stack[j][2], stack[j][4]
            del stack[j:]
            j = j_next
    return [(s, e, right - left) for s, e, left, right, _ in stack]


STEP = 0.25


def _observed(rows: DataFrame, odds, shift: float) -> DataFrame:
    """Per training text (toxic, n units, sums of its segments); per step of score the number of clean units (n, bin)."""

    def run(batches):
        own, bins = Scores(odds.value, shift), Counter()
        kinds = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.int64()]
        for batch in batches:
            out = []
            for text, toxic, others in zip(texts(batch.column(0)), *(batch.column(i).to_pylist() for i in (1, 2))):
                got, _ = own.of(text, others)
                out.append((int(toxic > 0), len(got), [s for _, _, s in segments(got)], None))
                if toxic <= 0:
                    bins.update(np.round(got / STEP).astype(int).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)], ["toxic", "n", "sums", "bin"])
        if bins:
            out = [(None, n, None, b) for b, n in bins.items()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], ["toxic", "n", "sums", "bin"])

    return stage(rows.mapInArrow(run, "toxic int, n long, sums array<double>, bin long"), "observed")


def extreme_rate(values: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(rate * score)] = 1, within 0.05 .. 3."""
    share = counts / counts.sum()
    low, high = 0.05, 3.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if (share * np.exp(mid * values)).sum() < 1 else (low, mid)
    return (low + high) / 2


def logistic(x: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[float, float]:
    """Intercept and slope by Newton's method with a slight ridge."""
    a, b = 0.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a + b * x, -30, 30)))
        w = total * p * (1 - p) + 1e-9
        g = np.array([(positive - total * p).sum() - 1e-3 * a, (x * (positive - total * p)).sum() - 1e-3 * b])
        h = np.array([[w.sum() + 1e-3, (w * x).sum()], [(w * x).sum(), (w * x * x).sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a + step[0], b + step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)


def fit(docs: DataFrame, labels: DataFrame) -> dict:
    """The model: log-odds (sent and joined), shift, extreme-value parameters and the logistic curve. Without both classes it is empty."""
    rows = _training(docs, labels)
    odds, others, mean = log_odds(rows)
    if not len(odds) and others is None:
        return {"odds": Odds(), "others": None, "shift": 1.0, "rate": 1.0, "k": 1.0, "a": -5.0, "b": 0.0}
    known = docs.sparkSession.sparkContext.broadcast(odds)
    rows = _with_others(rows, known, others)
    shift = mean - DRIFT
    seen = _observed(rows, known, shift)
    bins = seen.where("bin IS NOT NULL").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()  # a few dozen steps
    rate = extreme_rate(bins["bin"].to_numpy() * STEP, bins["n"].to_numpy()) if len(bins) else 1.0
    best = F.coalesce(F.array_max("sums"), F.lit(0.0))
    clean = seen.where("toxic = 0 AND n > 0").agg(F.count("*"), F.sum(F.col("n") * F.exp(-rate * best))).first()
    k = clean[0] / clean[1] if clean[0] else 1.0
    expected = F.log(F.lit(k) * F.greatest(F.col("n"), F.lit(1)))
    above = F.aggregate("sums", F.lit(0.0), lambda t, s: t + F.greatest(F.lit(0.0), rate * s - expected))
    cells = seen.where("toxic IS NOT NULL").select("toxic", F.round(F.log1p(above) * 20).alias("x"))
    cells = cells.groupBy("x").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).orderBy("x").toPandas()  # some hundred steps
    a, b = logistic(cells["x"].to_numpy() / 20, cells["t"].to_numpy(float), cells["n"].to_numpy(float))
    return {"odds": odds, "others": others, "shift": shift, "rate": rate, "k": k, "a": a, "b": b}


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score, predicted, n_passages, passages): passages as start:end in words, the significant ones.

    Null, empty and blank texts have no evidence and get the lowest score. Rows are
    scored one by one from their text alone, so repeated rows and null ids are like any other.
    """
    spark = docs.sparkSession
    others = model["others"]
    sent = spark.sparkContext.broadcast({k: v for k, v in model.items() if k != "others"})

    def run(batches):
        m = sent.value
        own = Scores(m["odds"], m["shift"])
        least = -math.log(SIGNIFICANT)
        for batch in batches:
            scores, passages = [], []
            for text, others in zip(texts(batch.column(1)), batch.column(2).to_pylist()):
                got, places = own.of(text, others)
                expected = math.log(m["k"] * max(len(got), 1))
                above = [(s, e, m["rate"] * x - expected) for s, e, x in segments(got)]
                evidence = sum(max(0.0, x) for _, _, x in above)
                scores.append(1 / (1 + math.exp(-min(max(m["a"] + m["b"] * math.log1p(evidence), -30), 30))))
                passages.append([f"{places[s]}:{places[e - 1] + 1}" for s, e, x in above if x >= least])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()),
                 pa.array([len(p) for p in passages], pa.int64()), pa.array([",".join(p) for p in passages], pa.string())],
                ["id", "score", "predicted", "n_passages", "passages"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = _with_others(rows, spark.sparkContext.broadcast(model["odds"]) if others is not None else None, others).select("id", "text", "others")
    return rows.mapInArrow(run, f"id {kind}, score double, predicted int, n_passages long, passages string")


def op5_toxicity(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "toxic")
    rows = scored(docs, fit(docs, labels))
    return rows.select(
        F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted", "n_passages", "passages"
    )
