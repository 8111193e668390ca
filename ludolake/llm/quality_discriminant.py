"""Quality of texts by a regularised quadratic discriminant over document statistics.

Each whole text becomes some twenty statistics: sizes by their logarithm, shares by
the arcsine of their root, so that both spread about evenly. Per class the labelled
rows give a mean and a covariance; the covariance is drawn towards the pooled one and
towards its own diagonal by two weights that cross-validation picks from a grid. The
score of a text is the posterior of its class from the difference of two Mahalanobis
log-densities, computed with the Cholesky factors of both covariances.

Statistics are kept as whole multiples of 1/1024, so that all sums are exact and a
model does not depend on how rows are dealt to tasks. All labelled rows outside the
held-out fold count; only sums of products leave the tasks, and the driver solves a
few matrices of some twenty rows.

A null text counts as an empty one, and empty texts have all statistics 0. Null ids
and unlabelled rows are scored like others but teach nothing. Repeated rows count as
often as they stand there; of several labels of one id the lowest counts. Without
labels of both classes every score is the share of the class there is, or one half.
No rows give no rows, and other columns are not read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import table, texts

#: Steps of a statistic in one.
SCALE = 1024
#: Parts of the training rows for choosing the weights.
PARTS = 4
#: Weights of the pooled covariance and of the diagonal, tried in all pairs.
TOWARDS_POOLED = (0.0, 0.1, 0.5, 1.0)
TOWARDS_DIAGONAL = (0.0, 0.1, 0.5)
#: Added to each variance, so that constant statistics do no harm.
LEAST_VARIANCE = 1e-3
BROADCAST_LABELS = 1 << 20

_SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
_STOPS = b".,;:"
_CALLS = b"!?"
_QUOTES = b"\"'()-"


def _classes() -> bytes:
    """Every byte to the letter of its class."""
    kinds = bytearray(b"h" * 256)  # the rest: beyond ASCII
    for c in range(128):
        kinds[c] = ord("c")
    for kind, members in {
        "l": range(97, 123), "u": range(65, 91), "d": range(48, 58), "w": b" \t\r\x0b\x0c",
        "n": b"\n", "s": _SYMBOLS, "p": _STOPS, "x": _CALLS, "q": _QUOTES,
    }.items():
        for c in members:
            kinds[c] = ord(kind)
    return bytes(kinds)


_CLASSES = _classes()
NAMES = (
    "log_bytes", "log_words", "lower", "upper", "digits", "beyond", "symbols", "stops", "calls", "quotes", "spaces", "breaks",
    "word_bytes", "distinct", "lettered", "titled", "shouted", "top_word", "repeated_lines", "line_words", "echoes",
)


def _share(part: float, whole: float) -> float:
    return math.asin(math.sqrt(min(part / whole, 1.0))) if whole else 0.0


def statistics(text: bytes | None) -> list[int]:
    """The statistics of ``NAMES`` in steps."""
    text = text or b""
    words = text.split()
    if not words:
        return [0] * len(NAMES)
    size, n = len(text), len(words)
    kinds = text.translate(_CLASSES)
    count = {k: kinds.count(k) for k in (b"l", b"u", b"d", b"h", b"s", b"p", b"x", b"q", b"w", b"n")}
    letters = count[b"l"] + count[b"u"] + count[b"h"]
    forms = kinds.split(b"w") if not count[b"n"] else kinds.replace(b"n", b"w").split(b"w")
    plain = sum(1 for f in forms if f.rstrip(b"pxq").isalpha() and not f.strip(b"luhpxq"))
    lines = [line for line in text.split(b"\n") if not line.isspace() and line]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    values = [
        math.log1p(size),
        math.log1p(n),
        _share(count[b"l"], size),
        _share(count[b"u"], letters),
        *(_share(count[k], size) for k in (b"d", b"h", b"s", b"p", b"x", b"q", b"w", b"n")),
        math.log1p(size / n),
        math.log1p(len(seen)) / math.log1p(n),
        _share(plain, n),
        _share(kinds.count(b"ul"), n),
        _share(kinds.count(b"uu"), size),
        _share(max(seen.values()), n),
        _share(len(lines) - len(set(lines)), len(lines)),
        math.log1p(n / max(len(lines), 1)),
        _share(sum(map(eq, words, words[1:])), n),
    ]
    return [round(v * SCALE) for v in values]


def described(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, x array<int>): the statistics of every row, staged; the texts are not read again."""

    def run(batches):
        for batch in batches:
            x = [statistics(t) for t in texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(x, pa.list_(pa.int32()))], ["id", "x"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return stage(rows.mapInArrow(run, f"id {kind}, x array<int>"), "statistics")


@dataclass
class Gaussian:
    mean: np.ndarray
    whiten: np.ndarray  # the inverse of the Cholesky factor
    log_det: float

    def log_density(self, x: np.ndarray) -> np.ndarray:
        # einsum adds in one order whatever the number of rows, so a text scores alike in any batch.
        z = np.einsum("ij,kj->ik", x - self.mean, self.whiten)
        return -0.5 * np.einsum("ij,ij->i", z, z) - self.log_det


@dataclass
class Model:
    """Log prior ratio and both classes, or a constant where a class is missing."""

    ratio: float
    classes: tuple[Gaussian, Gaussian] | None

    def evidence(self, x: np.ndarray) -> np.ndarray:
        """The log-odds of class 1."""
        if self.classes is None:
            return np.full(len(x), self.ratio)
        bad, good = self.classes
        return self.ratio + good.log_density(x) - bad.log_density(x)


def _posterior(evidence: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(evidence, -36, 36)))


def regularised(moments: dict[int, np.ndarray], pooled_weight: float, diagonal_weight: float) -> Model:
    """From the sums of (1, x)(1, x)' of both classes to a model."""
    counts = {k: m[0, 0] for k, m in moments.items()}
    if not all(counts.values()):
        share = counts[1] / max(sum(counts.values()), 1) if sum(counts.values()) else 0.5
        return Model(float(np.clip(math.log(max(share, 1e-9) / max(1 - share, 1e-9)), -36, 36)), None)
    means = {k: m[0, 1:] / counts[k] for k, m in moments.items()}
    own = {k: m[1:, 1:] / counts[k] - np.outer(means[k], means[k]) for k, m in moments.items()}
    pooled = sum(counts[k] * own[k] for k in own) / sum(counts.values())
    made = []
    for k in (0, 1):
        mixed = (1 - pooled_weight) * own[k] + pooled_weight * pooled
        mixed = (1 - diagonal_weight) * mixed + diagonal_weight * np.diag(np.diag(mixed))
        factor = np.linalg.cholesky(mixed + LEAST_VARIANCE * np.eye(len(mixed)))
        made.append(Gaussian(means[k], np.linalg.inv(factor), float(np.log(np.diag(factor)).sum())))
    return Model(math.log(counts[1] / counts[0]), (made[0], made[1]))


def _matrix(batch_column) -> np.ndarray:
    return np.asarray(batch_column.flatten(), np.int64).reshape(-1, len(NAMES))


def _moments(rows: DataFrame) -> list[dict[int, np.ndarray]]:
    """The sums of (1, x)(1, x)' for each part of the rows (x, label, part) and each class."""
    size = len(NAMES) + 1

    def run(batches):
        sums = np.zeros((PARTS, 2, size, size), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0))
            x = np.concatenate([np.ones((len(x), 1), np.int64), x], 1)
            label, part = (np.asarray(batch.column(i)) for i in (1, 2))
            for p in range(PARTS):
                for k in (0, 1):
                    mine = x[(part == p) & (label == k)]
                    sums[p, k] += mine.T @ mine
        places = np.nonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(p, pa.int32()) for p in places), pa.array(sums[places], pa.int64())], ["part", "label", "i", "j", "s"]
        )

    total = rows.mapInArrow(run, "part int, label int, i int, j int, s long")
    total = total.groupBy("part", "label", "i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    out = [{k: np.zeros((size, size)) for k in (0, 1)} for _ in range(PARTS)]
    for part, label, i, j, s in total.collect():  # a few matrices
        out[part][label][i, j] = float(s) / SCALE ** ((i > 0) + (j > 0))
    return out


def _losses(rows: DataFrame, models: list[list[Model]]) -> np.ndarray:
    """The log-loss of each candidate over all parts, each part judged by the model of the others."""
    sent = rows.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        sums = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(0)) / SCALE
            label, part = (np.asarray(batch.column(i)) for i in (1, 2))
            for c, by_part in enumerate(sent.value):
                for p in range(PARTS):
                    mine = part == p
                    right = np.where(label[mine] == 1, 1, -1) * by_part[p].evidence(x[mine])
                    # In millionths and capped by the clip of the scores, so that the sum is exact.
                    sums[c] += np.rint(np.logaddexp(0, -np.clip(right, -36, 36)) * 1e6).astype(np.int64).sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(sums)), pa.int32()), pa.array(sums, pa.int64())], ["c", "s"])

    found = rows.mapInArrow(run, "c int, s long").groupBy("c").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    out = np.zeros(len(models))
    for c, s in found:
        out[c] = float(s)
    return out


def fit(known: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Model:
    """The model from ``known`` (id, x) and the rows of ``labels`` that may teach."""
    own = labels.select(F.col(f"`{id_col}`").alias("_id"), (F.col(f"`{label_col}`") > 0).cast("int").alias("label"))
    own = own.where("_id IS NOT NULL AND label IS NOT NULL").groupBy("_id").agg(F.min("label").alias("label"))
    own = F.broadcast(own) if at_most(own, BROADCAST_LABELS) else own  # an id and a bit each
    part = F.pmod(F.xxhash64("id"), F.lit(PARTS)).cast("int")
    rows = stage(known.join(own, known["id"] == own["_id"]).select("x", "label", part.alias("part")), "taught")
    sums = _moments(rows)

    def over(parts) -> dict[int, np.ndarray]:
        return {k: sum(sums[p][k] for p in parts) for k in (0, 1)}

    grid = [(a, b) for a in TOWARDS_POOLED for b in TOWARDS_DIAGONAL]
    others = [[p for p in range(PARTS) if p != q] for q in range(PARTS)]
    trials = [[regularised(over(o), *weights) for o in others] for weights in grid]
    best = int(np.argmin(_losses(rows, trials)))
    return regularised(over(range(PARTS)), *grid[best])


def scored(known: DataFrame, model: Model) -> DataFrame:
    """(id, score, predicted, evidence) of every row of ``known``."""
    sent = known.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            evidence = sent.value.evidence(_matrix(batch.column(1)) / SCALE) if batch.num_rows else np.zeros(0)
            score = _posterior(evidence)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32)), pa.array(evidence)],
                ["id", "score", "predicted", "evidence"],
            )

    kind = known.schema["id"].dataType.simpleString()
    return known.mapInArrow(run, f"id {kind}, score double, predicted int, evidence double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op12_quality_discriminant(spark, sf_dir) -> DataFrame:
    known = described(table(spark, sf_dir, "documents", "doc_id", "text"))
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out(F.col("doc_id")))
    rows = scored(known, fit(known, labels))
    return rows.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score", "predicted", "evidence")
