"""Spelling variants: words one code point apart, found in a trie of letter counts.

A word is described by how often it has each group of letters. One inserted, deleted
or replaced code point changes these counts by a surplus of at most one and a deficit
of at most one, so near words lie in a trie of successive counts where a depth-first
search arrives that may once meet one more and once meet one less. What it finds at
the leaves is verified letter by letter.

The trie is searched in parts. Its top, down to prefixes with at most ``SHARD`` words,
is a histogram of the vocabulary that the tasks know; the search of a word through it
tells which parts the word has to visit, and each part is searched by one task for all
its visitors at once. More words of the same counts than ``SHARD`` are dealt into pieces
that are all visited. A pair is found from one side only, in the later of its two parts.

Only words and sums leave the texts. A null text holds no words, a null id stands as an
empty one, a row that is repeated counts as often as it stands there, and no rows give
no rows; other columns are not read. Ties between near words go to the smaller one.
"""

from __future__ import annotations

import re
from collections import Counter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import at_most, discard, stage
from .common import table

LEAST_LENGTH = 5
LEAST_COUNT = 3
#: One run in so many loses a letter.
DAMAGE = 97
#: Words in one part of the trie.
SHARD = 20_000
#: Distinct words a task holds before it sends their counts on.
HELD = 200_000
#: Pairs of words and visitors below which a node is compared as it is.
FEW = 2_000

# The levels of the trie: one letter each, rare ones together, and the letters beyond a-z in three groups.
_BEYOND = [chr(c) for c in range(0xC0, 0x100)]
GROUPS = [*"eanirtsoldu", *"chmgpb", "fv", "kq", "wz", "yjx", *("".join(_BEYOND[k::3]) for k in range(3))]
#: Counts from here on are one; they differ no more than the true ones.
MOST = 15


class _Utf8(dict):
    def __missing__(self, word: bytes) -> bytes:
        out = word.decode("latin-1").encode()
        if len(self) < 100_000:
            self[word] = out
        return out


def words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the runs of letters, some of which lose one, and how often each result occurs."""

    def run(batches):
        # Latin-1 has one byte for each letter that counts, and "?" for all others.
        runs, utf8, counts = re.compile(rb"[a-z\xc0-\xff]{%d,}" % LEAST_LENGTH), _Utf8(), Counter()

        def out():
            found = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in counts], pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"]
            )
            counts.clear()
            return found

        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                low = (text or b"").lower()  # of bytes, so A-Z only
                plain = low.isascii()
                found = runs.findall(low if plain else low.decode().encode("latin-1", "replace"))
                start = crc32(f"{doc}:".encode())
                if plain:
                    hit = [i for i, w in enumerate(found) if not crc32(w, start) % DAMAGE]
                else:
                    hit = [i for i, w in enumerate(found) if not crc32(w if w.isascii() else utf8[w], start) % DAMAGE]
                for i in hit:
                    w = found[i]
                    k = crc32(utf8[w], start) % len(w)
                    found[i] = w[:k] + w[k + 1 :]
                counts.update(found)
                for i in hit:
                    if len(found[i]) < LEAST_LENGTH:
                        counts.pop(found[i], None)
                if len(counts) > HELD:
                    yield out()
        yield out()

    ids = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    counted = docs.select(ids.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counts_text():
    """The counts of a word as one hexadecimal digit a level."""
    word = F.col("word")
    counts = [F.length(word) - F.length(F.translate(word, group, "")) for group in GROUPS]
    return F.concat(*(F.hex(F.least(c, F.lit(MOST)).cast("long")) for c in counts))


def _parts(known: DataFrame, shard: int) -> tuple[frozenset, dict[str, int]]:
    """The prefixes that go on, and those that are parts, with the pieces of each.

    A prefix goes on while more than ``shard`` words have it, so both grow with the
    vocabulary over ``shard``, not with the texts.
    """
    total = known.count()
    if total <= shard:
        return frozenset(), {"": 1}
    onward, parts, open_ = {""}, {}, [""]
    for depth in range(1, len(GROUPS) + 1):
        here = known.where(F.substring("counts", 1, depth - 1).isin(open_)) if depth > 1 else known
        sizes = here.groupBy(F.substring("counts", 1, depth).alias("prefix")).count().collect()
        open_ = []
        for prefix, n in sizes:
            if n > shard and depth < len(GROUPS):
                open_.append(prefix)
            else:
                parts[prefix] = -(-n // shard)
        onward.update(open_)
        if not open_:
            break
    return frozenset(onward), parts


def _visited(counts: str, onward: frozenset, parts: dict[str, int]) -> list[str]:
    """The parts where words near one of these counts may be, by a depth-first search from the top."""
    found, stack = [], [("", False, False)]
    while stack:
        prefix, more, less = stack.pop()
        if prefix in parts:
            found.append(prefix)
        elif prefix in onward:
            c = int(counts[len(prefix)], 16)
            stack.append((f"{prefix}{c:X}", more, less))
            if not more and c < MOST:
                stack.append((f"{prefix}{c + 1:X}", True, less))
            if not less and c:
                stack.append((f"{prefix}{c - 1:X}", more, True))
    return found


def _routed(known: DataFrame, shard: int) -> DataFrame:
    """(part, piece, home, word, n, counts): each word in its own part, and as a visitor in later ones."""
    onward, parts = _parts(known, shard)
    deepest = max(map(len, parts))

    def run(batches):
        memory: dict[str, tuple[str, list[str]]] = {}
        for batch in batches:
            rows: list[list] = [[] for _ in range(6)]
            for word, n, counts in zip(*(c.to_pylist() for c in batch.columns)):
                top = counts[:deepest]
                if top not in memory:
                    if len(memory) > 100_000:
                        memory.clear()
                    home = next(top[:d] for d in range(deepest + 1) if top[:d] in parts)
                    memory[top] = home, [p for p in _visited(counts, onward, parts) if p > home]
                home, others = memory[top]
                own = crc32(word.encode()) % parts[home]
                places = [(home, own, True)] + [(home, k, False) for k in range(own + 1, parts[home])]
                places += [(p, k, False) for p in others for k in range(parts[p])]
                for place in places:
                    for column, value in zip(rows, (*place, word, n, counts)):
                        column.append(value)
                if len(rows[0]) > 50_000:
                    yield _batch(rows, _ROUTED)
                    rows = [[] for _ in range(6)]
            yield _batch(rows, _ROUTED)

    schema = "part string, piece int, home boolean, word string, n long, counts string"
    return known.select("word", "n", "counts").mapInArrow(run, schema)


_ROUTED = {"part": pa.string(), "piece": pa.int32(), "home": pa.bool_(), "word": pa.string(), "n": pa.int64(), "counts": pa.string()}
_PAIRS = {"word": pa.string(), "n": pa.int64(), "other": pa.string(), "other_n": pa.int64()}


def _batch(columns, kinds) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.values())], list(kinds))


def near(a: bytes, b: bytes) -> bool:
    """Whether two different words of one byte a letter differ by one inserted, deleted or replaced letter."""
    if len(a) < len(b):
        a, b = b, a
    if len(a) - len(b) > 1:
        return False
    x = int.from_bytes(a[: len(b)], "big") ^ int.from_bytes(b, "big")
    if not x:
        return True  # the longer one has one more at its end
    first = len(b) - 1 - (x.bit_length() - 1) // 8
    return a[first + 1 :] == b[first + (len(a) == len(b)) :]


class _Verifier:
    """``near`` for many pairs of ``words`` at once, all words being different."""

    WIDTH = 24

    def __init__(self, words: list[bytes]):
        self.words, width = words, self.WIDTH
        self.sizes = np.fromiter(map(len, words), np.int64, len(words))
        lines = [b"".join(w[:width].ljust(width, b"\0") for w in words), b"".join(w[::-1][:width].ljust(width, b"\0") for w in words)]
        self.ahead, self.back = (np.frombuffer(x, np.uint8).reshape(-1, width) for x in lines)
        # One letter cannot change the first two and the last two of five.
        self.first, self.last = (np.ascontiguousarray(x[:, :2]).view(np.uint16).ravel() for x in (self.ahead, self.back))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The near ones of the pairs (a, b)."""
        some = (self.first[a] == self.first[b]) | (self.last[a] == self.last[b])
        a, b = a[some], b[some]
        sizes = np.minimum(self.sizes[a], self.sizes[b])
        more = np.abs(self.sizes[a] - self.sizes[b])
        common = [np.where((unlike := x[a] != x[b]).any(1), unlike.argmax(1), self.WIDTH) for x in (self.ahead, self.back)]
        good = (more <= 1) & (common[0] + common[1] >= sizes - (more == 0))
        for k in np.flatnonzero(sizes >= self.WIDTH):  # words that do not fit the lines
            good[k] = near(self.words[a[k]], self.words[b[k]])
        return a[good], b[good]


def _search(held: np.ndarray, asking: np.ndarray):
    """Blocks of (held, asking) indexes whose counts differ by a surplus and a deficit of at most one.

    ``held`` is sorted by its columns. A node of the trie is a range of it; the search
    takes all visitors along that can still afford the node.
    """
    levels = held.shape[1]
    stack = [(0, len(held), 0, np.arange(len(asking)), np.zeros(len(asking), bool), np.zeros(len(asking), bool))]
    while stack:
        lo, hi, level, who, more, less = stack.pop()
        if not len(who) or lo == hi:
            continue
        if level == levels or (hi - lo) * len(who) <= FEW:
            step = max(1, FEW * 16 // (hi - lo))
            for at in range(0, len(who), step):
                some = who[at : at + step]
                apart = held[lo:hi, None, level:] - asking[None, some, level:]
                above = np.maximum(apart, 0).sum(2, dtype=np.int32) + more[at : at + step]
                below = np.maximum(-apart, 0).sum(2, dtype=np.int32) + less[at : at + step]
                i, j = np.nonzero((above <= 1) & (below <= 1))
                yield lo + i, some[j]
            continue
        column = held[lo:hi, level]
        edges = [0, *(np.flatnonzero(np.diff(column)) + 1), hi - lo]
        asked = asking[who, level]
        for start, end in zip(edges, edges[1:]):
            apart = column[start] - asked
            up, down = apart == 1, apart == -1
            keep = (apart == 0) | (up & ~more) | (down & ~less)
            stack.append((lo + start, lo + end, level + 1, who[keep], (more | up)[keep], (less | down)[keep]))


def _pairs(routed: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all near words, in both directions."""

    def search(part: pa.Table) -> pa.Table:
        # Words of the part first, by their counts; then its visitors.
        part = part.sort_by([("home", "descending"), ("counts", "ascending"), ("word", "ascending")])
        names, n = part.column("word").to_pylist(), part.column("n").to_pylist()
        held = sum(part.column("home").to_pylist())
        counts = "".join(part.column("counts").to_pylist()).encode()
        digits = np.frombuffer(counts, np.uint8).reshape(len(names), -1).astype(np.int8)
        digits = np.where(digits > 57, digits - 55, digits - 48).astype(np.int8)
        verify = _Verifier([w.encode("latin-1") for w in names])
        found = []
        for i, j in _search(digits[:held], digits):
            later = i < j  # a pair of the part's own words is met from both sides
            found.append(verify(i[later], j[later]))
        left, right = (np.concatenate([f[k] for f in found] or [np.zeros(0, int)]).tolist() for k in (0, 1))
        a, b = left + right, right + left
        rows = [[names[k] for k in a], [n[k] for k in a], [names[k] for k in b], [n[k] for k in b]]
        return pa.Table.from_batches([_batch(rows, _PAIRS)])

    return routed.groupBy("part", "piece").applyInArrow(search, "word string, n long, other string, other_n long")


def _roots(steps: DataFrame) -> DataFrame:
    """``steps`` (word, form) to (word, root): what its forms lead to, by doubling the steps.

    Each form occurs at least twice as often as its word, so there are no circles and
    the number of rounds is at most the logarithm of the logarithm of the largest count.
    """
    now = stage(steps.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = now.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        joined = now.join(further, F.col("root") == F.col("_word"), "left")
        after = stage(joined.select("word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")), "roots")
        discard(now)
        now = after.drop("moved")
        now.staged_at = after.staged_at
        if after.where("moved").isEmpty():
            return now


def variants(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_COUNT, shard: int = SHARD
) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word that occurs ``least`` times."""
    known = words(docs, id_col, text_col).where(F.col("n") >= least)
    known = stage(known.withColumn("counts", _counts_text()), "words")
    pairs = _pairs(_routed(known, shard))
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("n"), "other")).alias("best"))
    joined = known.select("word", "n").join(best, "word", "left")
    taken = -F.col("best.n") >= 2 * F.col("n")
    judged = stage(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(taken, F.col("best.other")).alias("form"), F.when(taken, -F.col("best.n")).alias("form_n"),
        ),
        "judged",
    )
    discard(known)
    roots = _roots(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_spelling_variants(spark, sf_dir) -> DataFrame:
    return variants(table(spark, sf_dir, "documents", "doc_id", "text"))


def _sql_step(state: str, byte: str, name: str) -> str:
    return f"list_reduce(range(8), lambda {name}, i{name}: xor({name} >> 1, 3988292384 * ({name} & 1)), xor({state}, {byte}))"


_STEP = _sql_step("a", "b", "x")
_TWO_STEPS = _sql_step(_sql_step("a", "192 + (b >> 6)", "x"), "128 + (b & 63)", "y")
_CRC = f"""xor(4294967295, list_reduce(list_transform(string_split(doc_id || ':' || run, ''), lambda c: unicode(c)::BIGINT),
    lambda a, b: CASE WHEN b < 128 THEN {_STEP} ELSE {_TWO_STEPS} END, 4294967295::BIGINT))"""

OP13_SQL = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS doc_id,
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
  FROM documents
), counted AS (
  SELECT doc_id, run, count(*) AS n, {_CRC} AS h FROM runs WHERE length(run) >= {LEAST_LENGTH} GROUP BY doc_id, run
), words AS (
  SELECT CASE WHEN h % {DAMAGE} = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM counted GROUP BY 1 HAVING length(word) >= {LEAST_LENGTH} AND sum(n) >= {LEAST_COUNT}
), cut AS (
  SELECT word, n, i, left(word, i - 1) || '*' || substr(word, i + 1) AS hole, left(word, i - 1) || substr(word, i + 1) AS less
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), pairs AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.hole = b.hole AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.less = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.less = b.word
), best AS (
  SELECT word, count(*) AS n_near, min(struct_pack(n := -other_n, w := other)) AS top FROM pairs GROUP BY word
), judged AS (
  SELECT words.word, words.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -top.n >= 2 * words.n THEN top.w END AS form, CASE WHEN -top.n >= 2 * words.n THEN -top.n END AS form_n
  FROM words LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS stand, form AS ahead FROM judged
  UNION ALL SELECT walk.word, judged.word, judged.form FROM walk JOIN judged ON walk.ahead = judged.word
)
SELECT judged.word, form, stand AS root, n, n_near, form_n FROM judged JOIN walk ON judged.word = walk.word AND ahead IS NULL
"""
