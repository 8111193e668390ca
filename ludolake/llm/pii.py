"""Personal data: pattern matches, and terms that reveal them.

The base finds e-mail addresses, IP addresses, card and phone numbers. Each found
value is a protected entity. The corpus then tells which ordinary terms give an
entity away: the corpus is a set of units of ``UNIT`` words, units of the same terms
counting once, ``p(t)`` is the share of units that a term falls in, and the words around each mention of an entity are
its contexts. A term discloses

    PMI(t; e) / IC(e),   PMI = log p(t, e) / (p(t) p(e)),   IC = -log p(e)

of the entity: 1 means that whoever reads the term knows the entity. Terms at or
above ``DISCLOSED`` that stand beside the entity in at least ``SUPPORT`` different
contexts are reported, in every document that holds the entity; equal contexts
count once, so copies of a document are no evidence. ``sanitised`` generalises
entities to their kind and removes the terms.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, stage
from .common import slices, table

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
UNIT = 21
SUPPORT = 3
DISCLOSED = 0.8
BROADCAST_DOCS = 1 << 17

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_EDGES = re.compile(r"^[^\w]+|[^\w]+$")


def _emails(text: str):
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            end = match.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def _ips(text: str):
    for chain in _DOTTED.finditer(text):
        parts = chain.group().split(".")
        at = chain.start()
        for k in range(0, len(parts) - 3, 4):
            four = parts[k : k + 4]
            size = sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield at, at + size
            at += size + 1


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        value = int(d) * (1 + k % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _cards(text: str):
    for match in _DIGITS.finditer(text):
        digits = match.group().replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and _luhn(digits):
            yield match.span()


def _phones(text: str):
    if "+" in text:
        for match in _PHONE.finditer(text):
            if 9 <= sum(map(str.isdigit, match.group())) <= 15:
                yield match.span()


def entities(text: str) -> list[tuple[int, int, str]]:
    """(start, kind, end) of base matches, leftmost and not overlapping within a kind, in order."""
    found = [(s, k, e) for k, f in enumerate((_emails, _ips, _cards, _phones)) for s, e in f(text)]
    return [(s, KINDS[k], e) for s, k, e in sorted(found)]


def _value(text: str, start: int, kind: str, end: int) -> int:
    value = text[start:end].lower()
    if kind in ("card", "phone"):
        value = re.sub("[^0-9]", "", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{value}".encode()) >> 1


def _term(word: str) -> str | None:
    """A word as a term: lower case without punctuation at its ends; at least three letters, no digits."""
    term = word.lower()
    if not term.isalpha():
        term = _EDGES.sub("", term)
    return term if len(term) >= 3 and term.isalpha() else None


def _number(term: str) -> int:
    return xxhash.xxh3_64_intdigest(term.encode()) >> 1


def _terms(text: str, memory: dict[str, str | None]) -> list[str | None]:
    """The terms of a text, word by word; at most 300,000 words are remembered."""
    terms = []
    for word in text.split() if text.isascii() else _WORD.findall(text):
        if word in memory:
            terms.append(memory[word])
        else:
            terms.append(_term(word))
            if len(memory) < 300_000 and len(word) < 64:
                memory[word] = terms[-1]
    return terms


def _units(terms: list[str | None]):
    """(number, terms) of the units of a text; units of the same terms have the same number."""
    for k in range(0, len(terms), UNIT):
        unit = set(terms[k : k + UNIT]) - {None}
        yield _set_number(unit), unit


def _set_number(terms: set[str]) -> int:
    return xxhash.xxh3_64_intdigest("\n".join(sorted(terms)).encode()) >> 1


def _gathered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows of three sorts: counts (term, units) among the different units of part of a task, contexts (entity, context, term) with the document, and units (context alone)."""

    def run(batches):
        names = ["digest", "entity", "context", "term", "units"]
        counts, seen = Counter(), set()

        def counted():
            none = lambda n: pa.nulls(n, pa.int64())
            numbers, n, u = [_number(t) for t in counts], len(counts), len(seen)
            counted = [none(n), none(n), none(n), pa.array(numbers, pa.int64()), pa.array(list(counts.values()), pa.int64())]
            different = [none(u), none(u), pa.array(list(seen), pa.int64()), none(u), none(u)]
            counts.clear()
            seen.clear()
            return [pa.RecordBatch.from_arrays(c, names) for c in (counted, different)]

        memory: dict[str, str | None] = {}
        for batch in slices(batches):
            rows = []
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = text or ""
                terms = _terms(text, memory)
                for number, unit in _units(terms):
                    if number not in seen:
                        seen.add(number)
                        counts.update(unit)
                found = entities(text)
                if found:
                    starts = [m.start() for m in _WORD.finditer(text)]
                    for start, kind, end in found:
                        low, high = _around(starts, start, end)
                        near = set(terms[max(0, low - UNIT // 2) : low] + terms[high : high + UNIT // 2]) - {None}
                        context = _set_number(near)
                        entity = _value(text, start, kind, end)
                        rows += [(digest, entity, context, _number(t), None) for t in near] or [(digest, entity, context, None, None)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names)
            if len(counts) + len(seen) > 300_000:
                yield from counted()
        yield from counted()

    text = F.col(text_col).cast("string")
    rows = docs.select(F.xxhash64(text).alias("digest"), text.alias("text"))
    return rows.mapInArrow(run, "digest long, entity long, context long, term long, units long")


def _unit_counts(docs: DataFrame, text_col: str, wanted: DataFrame) -> DataFrame:
    """(term, n_t): in how many different units of the corpus each of the ``wanted`` terms (staged) falls."""
    few = at_most(wanted, BROADCAST_DOCS)
    sent = docs.sparkSession.sparkContext.broadcast(set(wanted.toArrow().column("term").to_pylist()) if few else None)

    def run(batches):
        memory: dict[str, str | None] = {}
        numbers: dict[str, int | None] = {}
        asked, out, size = sent.value, set(), 300_000
        batch_of = lambda: pa.RecordBatch.from_arrays([pa.array([p[i] for p in out], pa.int64()) for i in (0, 1)], ["unit", "term"])
        for batch in slices(batches):
            for text in batch.column(0).to_pylist():
                for unit, terms in _units(_terms(text or "", memory)):
                    for term in terms:
                        if term in numbers:
                            number = numbers[term]
                        else:
                            number = _number(term)
                            number = number if asked is None or number in asked else None
                            if len(numbers) < size:
                                numbers[term] = number
                        if number is not None:
                            out.add((unit, number))
                if len(out) > size:
                    yield batch_of()
                    out.clear()
        yield batch_of()

    pairs = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "unit long, term long")
    pairs = pairs if few else pairs.join(wanted, "term", "left_semi")
    return pairs.distinct().groupBy("term").agg(F.count("*").alias("n_t"))


def _around(starts: list[int], start: int, end: int) -> tuple[int, int]:
    """The words that a span touches: from the one it begins in to the first that begins after it."""
    from bisect import bisect_left, bisect_right

    return max(0, bisect_right(starts, start) - 1), bisect_left(starts, end)


def disclosing(docs: DataFrame, id_col: str, text_col: str, support: int, disclosed: float) -> DataFrame:
    """(digest, terms): the terms to hide in the documents of that digest, as numbers."""
    rows = stage(_gathered(docs, id_col, text_col), "gathered")
    contexts = rows.where("entity IS NOT NULL")
    units = rows.where("entity IS NULL AND term IS NULL").select("context").distinct().count()
    joint = contexts.where("term IS NOT NULL").select("entity", "context", "term").distinct()
    joint = joint.groupBy("entity", "term").agg(F.count("*").alias("n_te")).where(F.col("n_te") >= support)
    single = contexts.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n_e"))
    wanted = joint.select("term").distinct()
    wanted = F.broadcast(wanted) if at_most(wanted, BROADCAST_DOCS) else wanted
    corpus = rows.where("entity IS NULL AND term IS NOT NULL").join(wanted, "term", "left_semi")
    corpus = corpus.groupBy("term").agg(F.max("units").alias("n_t"))
    total = float(max(units, 1))
    pmi = F.log(F.col("n_te") * total / (F.col("n_t") * F.col("n_e")))
    content = -F.log(F.least(F.col("n_e") / total, F.lit(1 - 1e-12)))
    # Different units of part of a task are no more than those of the corpus: no pair is lost to this bound.
    pairs = stage(joint.join(corpus, "term").join(single, "entity").where(pmi >= disclosed * content).drop("n_t"), "bounded")
    exact = _unit_counts(docs, text_col, stage(pairs.select("term").distinct(), "wanted"))
    pairs = pairs.join(exact, "term").where(pmi >= disclosed * content).select("entity", "term")
    holders = contexts.select("digest", "entity").distinct()
    return holders.join(pairs, "entity").groupBy("digest").agg(F.collect_set("term").alias("terms"))


def _annotated(docs: DataFrame, keep: list[str], text_col: str, found: DataFrame):
    """(keep, text, terms) of every document."""
    text = F.col(text_col).cast("string")
    rows = docs.select(*keep, text.alias("_text"), F.xxhash64(text).alias("_digest"))
    found = found.withColumnRenamed("digest", "_digest").withColumnRenamed("terms", "_terms")
    found = stage(found, "disclosing")
    found = F.broadcast(found) if at_most(found, BROADCAST_DOCS) else found
    return rows.join(found, "_digest", "left").drop("_digest")


def _spans(text: str, terms: set[int]) -> tuple[list, list]:
    base = entities(text)
    if not terms:
        return base, base
    taken = [(s, e) for s, _, e in base]
    extra = []
    for match in _WORD.finditer(text):
        term = _term(match.group())
        if term and _number(term) in terms:
            low = match.start() + match.group().lower().find(term)
            high = low + len(term)
            if not any(s < high and low < e for s, e in taken):
                extra.append((low, TERM, high))
    order = {k: i for i, k in enumerate((*KINDS, TERM))}
    return base, sorted(base + extra, key=lambda x: (x[0], order[x[1]], x[2]))


def _joined(spans: list) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, kind, end in spans)


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """Spans of personal data of every document.

    Returns (id column, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term).
    Null and empty texts have no spans; repeated rows and null ids are reported like
    any other; no rows give none. Other columns are not read.
    """
    rows = _annotated(docs, [F.col(id_col).alias("_id")], text_col, disclosing(docs, id_col, text_col, support, disclosed))

    def run(batches):
        for batch in slices(batches):
            out = []
            for text, terms in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                base, spans = _spans(text or "", set(terms or ()))
                kinds = Counter(k for _, k, _ in spans)
                out.append((*(kinds[k] for k in KINDS), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans), kinds[TERM]))
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, types))],
                ["id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"],
            )

    kind = rows.schema["_id"].dataType.simpleString()
    rows = rows.select("_id", "_text", "_terms").mapInArrow(
        run, f"id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_term long"
    )
    return rows.withColumnRenamed("id", id_col)


def hidden(text: str, terms: set[int]) -> str:
    """The text with entities generalised to their kind and disclosing terms removed; overlaps become one."""
    _, spans = _spans(text, terms)
    out, at = [], 0
    for start, kind, end in spans:
        if end <= at:
            continue
        if start >= at:
            out.append(text[at:start])
            out.append("" if kind == TERM else f"[{kind.upper()}]")
        at = end
    return "".join([*out, text[at:]])


def sanitised(docs: DataFrame, support: int = SUPPORT, disclosed: float = DISCLOSED) -> DataFrame:
    """``docs`` (with text and n_chars among its columns) with personal data hidden; null texts stay null."""
    names = docs.columns
    others = F.struct(*(c for c in names if c not in ("text", "n_chars"))).alias("doc")
    found = disclosing(docs, "doc_id", "text", support, disclosed)
    rows = _annotated(docs, [others], "text", found).select("_text", "_terms", "doc")

    def run(batches):
        for batch in slices(batches):
            pairs = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            text = [None if t is None else hidden(t, set(m or ())) for t, m in pairs]
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(text, pa.string())], ["doc", "text"])

    rows = rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, text string")
    made = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return rows.select(*(made.get(c, F.col("doc")[c]).alias(c) for c in names))


def op10_pii(spark, sf_dir) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents", "doc_id", "text"))
