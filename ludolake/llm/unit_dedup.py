"""Substring deduplication by hashing lines and what they are made of.

A text is cut into units at line ends, at sentence ends and, so that long lines are
not all or nothing, after words whose hash is the least of their neighbourhood; such
a cut depends on near words of the same sentence and line only, so lines and sentences are cut alike
wherever they stand, and passages but for their first and last words. Units are normalised
(lower case, no punctuation at the ends of words) and hashed, digests are grouped
globally, and of each digest the earliest occurrence by (document, place) stays.
Later ones are removed where they form a run of at least ``LEAST_WORDS`` words;
their offsets in the original text are returned.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import mixed, table

#: A unit also ends after a word whose hash is the least among so many words of its sentence to either side.
CUT = 5
LEAST_WORDS = 30
PART_BYTES = 16 << 20
#: Units that a task sorts at once, and rows of text that it holds as Python objects.
FLUSH = 1 << 18
SLICE = 256
#: Repeats found within a task are dealt to the groups in pieces of this size.
DEAL = 1 << 14
BROADCAST_DOCS = 1 << 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")


class Normal(dict):
    """Word to the 64-bit id of its normal form, doubled, plus 1 if a sentence may end there."""

    def __missing__(self, word: str) -> tuple[int, bool]:
        plain = word.lower()
        if not plain.isalnum():
            plain = _EDGES.sub("", plain)
        value = (xxhash.xxh3_64_intdigest(plain.encode()), word[-1] in ".!?")
        if len(self) < 300_000 and len(word) <= 64:
            self[word] = value
        return value


def units(text: str, normal: Normal) -> tuple[np.ndarray, ...]:
    """(digests, words, start, end) of the units of a text, in order; offsets are code points."""
    spans = [m.span() for m in _WORD.finditer(text)]
    if not spans:
        none = np.empty(0, np.int32)
        return np.empty(0, np.uint64), none, none, none
    found = [normal[text[a:b]] for a, b in spans]
    ids = np.fromiter((f[0] for f in found), np.uint64, len(found))
    hashes = mixed(ids)
    ends = np.fromiter((f[1] for f in found), bool, len(found))
    starts, stops = (np.array(x, np.int32) for x in zip(*spans))
    breaks, at = [], text.find("\n")
    while at >= 0:
        breaks.append(at)
        at = text.find("\n", at + 1)
    if breaks:
        lines = np.searchsorted(np.array(breaks), starts)
        ends[:-1] |= lines[1:] != lines[:-1]
    ends[-1] = True
    # A gap between sentences and lines keeps what lies beyond them out of the neighbourhood.
    at = np.arange(len(hashes)) + CUT * (1 + np.cumsum(ends) - ends)
    around = np.full(at[-1] + CUT + 1, np.uint64(2**64 - 1))
    around[at] = hashes
    least = np.lib.stride_tricks.sliding_window_view(around, 2 * CUT + 1).min(axis=1)
    ends |= hashes == least[at - CUT]
    last = np.flatnonzero(ends)
    first = np.concatenate([[0], last[:-1] + 1])
    # A polynomial over the words of each unit, by differences of a running sum of mixed ids and places.
    place = np.arange(len(ids)) - np.repeat(first, last - first + 1)
    terms = mixed(ids + mixed(place.astype(np.uint64) + np.uint64(1)))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
    digests = mixed(sums[last + 1] - sums[first])
    return digests, (last - first + 1).astype(np.int32), starts[first], stops[last]


_KINDS = {"digest": np.uint64, "doc": np.int64, "text": np.int64, "unit": np.int32, "words": np.int32, "start": np.int32, "end": np.int32}
_FOUND = {**{k: t for k, t in _KINDS.items() if k != "digest"}, "first": np.int64}
_NO_ID = np.int64(2**63 - 1)


def _earliest(held: dict[str, np.ndarray]):
    """(first rows of each digest, later rows, the first row of each later one), by (digest, doc, text, unit)."""
    order = np.lexsort((held["unit"], held["text"], held["doc"], held["digest"]))
    digest = held["digest"][order]
    new = np.concatenate([[True], digest[1:] != digest[:-1]])
    group = np.cumsum(new) - 1
    heads = order[new]
    later = order[~new]
    return heads, later, heads[group[~new]]


def _later(held, later, heads):
    """Later occurrences with the document that has the unit earlier; the very same place is no repeat."""
    same = (held["doc"][later] == held["doc"][heads]) & (held["text"][later] == held["text"][heads]) & (held["unit"][later] == held["unit"][heads])
    later, heads = later[~same], heads[~same]
    return {**{k: held[k][later] for k in _FOUND if k != "first"}, "first": held["doc"][heads]}


_SENT = ("digest", "doc", "text", "unit", "words", "start", "end", "first")
_SENT_SCHEMA = "part int, " + ", ".join(f"`{k}` binary" for k in _SENT)


def _sent(rows: list[dict]) -> pa.RecordBatch:
    columns = [pa.array([r["part"] for r in rows], pa.int32())]
    columns += [pa.array([r[k].tobytes() if k in r else None for r in rows], pa.binary()) for k in _SENT]
    return pa.RecordBatch.from_arrays(columns, ["part", *_SENT])


def _repeats(docs: DataFrame, id_col: str, text_col: str, parts: int) -> DataFrame:
    """(doc, text, unit, words, start, end, first) of every later occurrence of a unit."""

    def gather(batches):
        normal, held, size = Normal(), [], 0

        def flush():
            # Of what one task has, only the earliest occurrence of a digest goes to its group:
            # a unit in a third of all documents is sent once per flush.
            all_of = {k: np.concatenate([h[k] for h in held]) for k in _KINDS}
            heads, later, of = _earliest(all_of)
            done, rows = _later(all_of, later, of), []
            for at in range(0, len(done["doc"]), DEAL):
                cut = {k: v[at : at + DEAL] for k, v in done.items()}
                place = mixed((cut["doc"][:1] ^ cut["text"][:1]).view(np.uint64))[0] % np.uint64(parts)
                rows.append({"part": int(place), **cut})
            where = (all_of["digest"][heads] % np.uint64(parts)).astype(np.int64)
            order = np.argsort(where, kind="stable")
            at = np.searchsorted(where[order], np.arange(parts + 1))
            for p in np.flatnonzero(np.diff(at)):
                rows.append({"part": int(p), **{k: all_of[k][heads[order[at[p] : at[p + 1]]]] for k in _KINDS}})
            return _sent(rows)

        slices = (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE))
        for batch in slices:
            for doc, digest, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                digests, words, start, end = units(text or "", normal)
                n = len(digests)
                if n:
                    held.append({"digest": digests, "doc": np.full(n, _NO_ID if doc is None else doc), "text": np.full(n, digest),
                                 "unit": np.arange(n, dtype=np.int32), "words": words, "start": start, "end": end})
                    size += n
                if size >= FLUSH:
                    yield flush()
                    held.clear()
                    size = 0
        if held:
            yield flush()

    def merge(group: pa.Table) -> pa.Table:
        # Rows that name the first document are repeats that a task found by itself.
        known = group.column("first").is_valid()
        read = lambda rows, kinds: {
            k: np.concatenate([np.empty(0, t), *(np.frombuffer(b, t) for b in rows.column(k).to_pylist())]) for k, t in kinds.items()
        }
        out = read(group.filter(known), _FOUND)
        held = read(group.filter(pc.invert(known)), _KINDS)
        if len(held["digest"]):
            _, later, heads = _earliest(held)
            more = _later(held, later, heads)
            out = {k: np.concatenate([out[k], more[k]]) for k in _FOUND}
        return pa.table(out)

    found = "doc long, text long, unit int, words int, start int, end int, first long"
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(gather, _SENT_SCHEMA).groupBy("part").applyInArrow(merge, found)


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_words: int = LEAST_WORDS) -> DataFrame:
    """Spans to remove: (id, digest, start, end, n_words, first_id), one row per run of repeated units.

    ``first_id`` is a document that holds part of the run earlier: the smallest such
    id. Null ids rank last. Null, empty and blank texts have no units. Rows with the
    same id and text are one document here. Other columns are not read.
    """
    size = docs.agg(F.coalesce(F.sum(F.length(text_col).cast("long")), F.lit(0))).first()[0]
    units_ = _repeats(docs, id_col, text_col, max(1, size // PART_BYTES + 1))
    key = ["doc", "text"]
    one = units_.groupBy(*key, "unit").agg(F.min("words").alias("words"), F.min("start").alias("start"), F.min("end").alias("end"), F.min("first").alias("first"))
    run = F.col("unit") - F.row_number().over(Window.partitionBy(*key).orderBy("unit"))
    runs = one.withColumn("run", run).groupBy(*key, "run").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"), F.min("first").alias("first")
    )
    known = lambda c: F.when(F.col(c) != int(_NO_ID), F.col(c))
    return runs.where(F.col("n_words") >= least_words).select(
        known("doc").alias("id"), F.col("text").alias("digest"), F.col("start").cast("long"), F.col("end").cast("long"), "n_words", known("first").alias("first_id")
    )


def without_repeats(docs: DataFrame, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` with the repeated spans cut out of ``text``; other columns as they are."""
    spans = repeated_spans(docs, least_words=least_words).groupBy("id", "digest").agg(
        F.array_sort(F.collect_list(F.struct("start", "end"))).alias("_spans")
    )
    spans = stage(spans.select(F.col("id").alias("_id"), F.col("digest").alias("_digest"), "_spans"), "spans")
    spans = F.broadcast(spans) if at_most(spans, BROADCAST_DOCS) else spans
    match = docs["doc_id"].cast("long").eqNullSafe(spans["_id"]) & (F.xxhash64(docs["text"]) == spans["_digest"])
    rows = docs.join(spans, match, "left")
    spans_ = F.col("_spans")
    state = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))
    step = lambda s, x: F.struct(
        F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int"))).alias("out"), x["end"].alias("at")
    )
    cut = F.aggregate(spans_, state, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.lit(2**31 - 1))))
    return rows.withColumn("text", F.when(spans_.isNull(), F.col("text")).otherwise(cut)).select(*docs.columns)


def op6_unit_dedup(spark, sf_dir) -> DataFrame:
    rows = repeated_spans(table(spark, sf_dir, "documents", "doc_id", "text"))
    return rows.select(F.col("id").alias("doc_id"), F.col("start").alias("start_char"), F.col("end").alias("end_char"), "n_words", F.col("first_id").alias("first_doc_id"))
