"""Operators on texts against brute force, and on odd input."""

import random
import re
import struct
import zlib

import numpy as np
import pytest

from ludolake.llm import host_rules, mixing, ngram_join, packing, pii, toxicity, training_order, unit_dedup
from ludolake.llm.tokens import TokenBytes, tokenizer_path
from ludolake.session import work_path

from .conftest import ODD


def words_of(text):
    return (text or "").encode().lower().split()


def groups(rows):
    """Brute-force (n_shingles, component id) of each row of (id, text)."""
    sets = []
    for _, text in rows:
        w = words_of(text)
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return [(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)]


def copies(seed, bases=12, each=12, long=0):
    """Texts and copies of them with ever more words changed; one base has many copies."""
    rnd = random.Random(seed)
    rows = []
    for b in range(bases):
        base = [f"b{b}x{rnd.randrange(400)}" for _ in range(rnd.choice([4, 7, 40, 120]))]
        for c in range(long if b == 0 and long else each):
            own = list(base)
            for _ in range(rnd.randrange(4)):
                own[rnd.randrange(len(own))] = f"e{rnd.randrange(10**6)}"
            rows.append((len(rows), " ".join(own)))
    return rows


@pytest.mark.parametrize("seed,long", [(1, 0), (2, 0), (3, 150)])
def test_join_equals_brute_force(spark, seed, long):
    rows = copies(seed, long=long)
    got = ngram_join.similar_sets(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got.collect()) == sorted(groups(rows))


def test_join_odd_rows(odd, clashing, none):
    want = sorted(groups([(r[0], r[1]) for r in ODD]), key=repr)
    for docs in (odd, clashing):
        got = ngram_join.similar_sets(docs).collect()
        assert sorted(((r.id, r.n_shingles, r.component_id) for r in got), key=repr) == want
    assert ngram_join.similar_sets(none).count() == 0


def test_keep_one(odd, clashing, none):
    kept = ngram_join.keep_one(clashing)
    assert kept.columns == clashing.columns
    got = sorted(((r.doc_id, r.text) for r in kept.select("doc_id", "text").collect()), key=repr)
    texts = {(r[0], r[1]) for r in ODD}
    gone = {(None, ODD[6][1]), (6, "ONE two three")}
    assert got == sorted(texts - gone, key=repr)
    assert ngram_join.keep_one(none).count() == 0


@pytest.mark.parametrize("kind", [np.uint8, np.int32, np.uint32, np.int64, np.uint64])
@pytest.mark.parametrize("n", [0, 1, 1000])
def test_squeezed_round_trip(kind, n):
    top = np.iinfo(kind).max
    values = np.random.default_rng(n).integers(0, top, n, kind, endpoint=True)
    for given, rising in ((values, False), (np.sort(values), True)):
        back = ngram_join._expanded(ngram_join._squeezed(given, rising), kind, rising)
        assert back.dtype == kind and (back == given).all()


@pytest.mark.parametrize("n", [1, 2, 5, 40, 300])
def test_prefixes_share_enough(n):
    rnd = np.random.default_rng(n)
    weights = np.sort(rnd.integers(1, 1000, n))
    need = -(-80 * n // 100)
    l = ngram_join.matches(weights, need)
    assert 1 <= l <= ngram_join.MATCHES and n - need + l <= n


def test_tokens_equal_tokenizer():
    from tokenizers import Tokenizer

    whole, fast = Tokenizer.from_file(tokenizer_path()), TokenBytes(tokenizer_path(), limit=50)
    rnd = random.Random(5)
    letters = "aeT'sdlmrv 1.,é ßÖ日\n\t<|endoftext|>ÀİΣſ\xa0 "
    texts = ["it's don't WE'LL <|endoftext|>", "ǅ \x00 \x1c ́e", *("".join(rnd.choice(letters) for _ in range(60)) for _ in range(300))]
    for text in texts:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert fast.of(text.encode(), None) == struct.pack(f"<{len(ids)}I", *ids), text


def check_pieces(rows, texts):
    """Each id in one piece, gapless sequences of at most 4096, right CRCs."""
    tokens = TokenBytes(tokenizer_path())
    want = sorted((tokens.of((t or "").encode()) for t in texts), key=len)
    assert sum(r["length"] for r in rows) * 4 == sum(map(len, want))
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    used = []
    for pieces in by.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        used.append(at)
    assert max(used, default=0) <= packing.LENGTH
    return used


def test_packing(spark, odd, clashing, none):
    rows = packing.packed_documents(odd).collect()
    check_pieces(rows, [r[1] for r in ODD])
    assert len(packing.packed_documents(clashing).collect()) == len(rows)
    tokens = TokenBytes(tokenizer_path())
    whole = tokens.of(ODD[11][1].encode())
    mine = sorted((r for r in rows if r["doc_id"] == 8), key=lambda r: r["start"])
    assert [r["start"] for r in mine] == list(np.cumsum([0] + [r["length"] for r in mine])[:-1])
    assert all(r["ids_crc32"] == zlib.crc32(whole[4 * r["start"] : 4 * (r["start"] + r["length"])]) for r in mine)
    assert packing.packed_documents(none).count() == 0


def test_packing_pads_little(spark):
    rnd = random.Random(3)
    texts = [" ".join(rnd.choice("abcdefgh") for _ in range(int(rnd.expovariate(1 / 700)))) for _ in range(1500)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = packing.packed_documents(docs).collect()
    used = check_pieces(rows, texts)
    assert sum(packing.LENGTH - u for u in used) <= 0.01 * sum(used)
    crc = {i: TokenBytes(tokenizer_path()).of(t.encode()) for i, t in enumerate(texts[:40])}
    for r in rows:
        if r["doc_id"] in crc:
            assert r["ids_crc32"] == zlib.crc32(crc[r["doc_id"]][4 * r["start"] : 4 * (r["start"] + r["length"])])


def test_knapsack_and_plan():
    value, counts = packing.knapsack(np.array([1.0, 2.5, 3.0]), 7)
    assert value == pytest.approx(8.5) and (counts * [1, 2, 3]).sum() <= 7
    lengths = np.zeros(4096, np.int64)
    lengths[[1000, 1500, 2100, 3000, 17]] = [300, 200, 150, 90, 500]
    patterns, spare = packing.plan(lengths)
    kinds = (np.maximum(np.arange(4096) - 1, 0) // packing.STEP)
    demand = np.bincount(kinds[1:], weights=lengths[1:], minlength=256)
    assert (sum(p * c for p, c in patterns) + spare == demand).all()
    assert all((p * (np.arange(256) + 1)).sum() <= 256 for p, _ in patterns)


@pytest.mark.parametrize("n", [1, 2, 3, 10, 257, 5000])
def test_slot_permutation(n):
    there = training_order.permuted(np.arange(n), n, 11)
    assert sorted(there) == list(range(n))
    assert (training_order.permuted(there, n, 11, inverse=True) == np.arange(n)).all()


@pytest.mark.parametrize("chunk", [100, 1 << 18])
def test_shards_round_trip(spark, odd, none, monkeypatch, chunk):
    monkeypatch.setattr(training_order, "CHUNK", chunk)
    folder = work_path(spark, "shards")
    rows = training_order.materialise(odd, folder, key=4, stride=64, per_shard=128).toPandas()
    total = sum(len(TokenBytes(tokenizer_path()).of((t or "").encode())) // 4 for _, t, *_ in ODD)
    assert rows["n_tokens"].sum() == total
    assert sorted(rows["slot"]) == list(range(-(-total // 64)))
    ids = {}
    for shard, part in rows.groupby("shard"):
        records = training_order.read_records(folder, int(shard), 1, 64)
        assert len(records) == len(part) - 1
        for r in part.itertuples():
            if r.record:
                got = records[r.record - 1][: r.n_tokens]
                assert zlib.crc32(got.astype("<u4").tobytes()) == r.ids_crc32
                ids[r.sequence_id] = got
    again = training_order.materialise(odd, work_path(spark, "shards"), key=4, stride=64, per_shard=128).toPandas()
    assert rows.sort_values("slot").equals(again.sort_values("slot")) or set(rows.ids_crc32) == set(again.ids_crc32)
    assert training_order.materialise(none, work_path(spark, "shards")).count() == 0


def brute_spans(text):
    found = []
    luhn = lambda d: sum(int(c) if k % 2 == 0 else (int(c) * 2 - 9 * (int(c) > 4)) for k, c in enumerate(d[::-1])) % 10 == 0
    digits = lambda s: re.sub("[^0-9]", "", s)
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        if 12 <= len(digits(m.group())) <= 19 and luhn(digits(m.group())):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(digits(m.group())) <= 15:
            found.append((m.start(), 3, m.end()))
    return [(s, pii.KINDS[k], e) for s, k, e in sorted(found)]


def test_entities_equal_patterns():
    rnd = random.Random(9)
    for _ in range(30_000):
        text = "".join(rnd.choice("a1@.-+ 0(25") for _ in range(rnd.randint(1, 40)))
        assert pii.entities(text) == brute_spans(text), text


def test_disclosing_terms(spark, make):
    rnd = random.Random(2)
    filler = lambda k: " ".join(rnd.choice(["alpha", "beta", "gamma", "delta"]) + " and" for _ in range(k))
    rows = [(i, f"{filler(9)} zorblatt keeps me@secret.org {filler(9)}", "en", "s", 1) for i in range(6)]
    rows += [(10 + i, filler(60), "en", "s", 1) for i in range(40)]
    got = {r.doc_id: r for r in pii.personal_data(make(rows)).collect()}
    assert all(got[i].n_email == 1 and "zorblatt" in [rows[i][1][int(a):int(b)] for k, a, b in (s.split(":") for s in got[i].spans.split(",")) if k == "term"] for i in range(6))
    assert all(got[10 + i].spans == "" for i in range(40))
    clean = {r.doc_id: r.text for r in pii.sanitised(make(rows)).collect()}
    assert all("zorblatt" not in clean[i] and "[EMAIL]" in clean[i] for i in range(6))
    assert all(clean[10 + i] == rows[6 + i][1] for i in range(40))


def test_pii_odd(odd, clashing, none):
    rows = pii.personal_data(odd).collect()
    assert len(rows) == len(ODD)
    assert [r.spans for r in rows if r.doc_id == 7] == ["email:9:23,ip:27:35"]
    assert pii.sanitised(clashing).columns == clashing.columns
    assert pii.sanitised(clashing).count() == len(ODD)
    assert pii.personal_data(none).count() == 0


def brute_measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + o for i, g in enumerate(grams) if grams.count(g) > 1 for o in range(5)} if len(grams) < 500 else set()
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def test_measures():
    ids = host_rules.WordIds()
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab c\n#é|\t") for _ in range(150)) for _ in range(300)] + [None, "", "a a a a a a a", "x y z w v x y z w v"]
    for text in texts:
        assert host_rules.measured(None if text is None else text.encode(), ids) == brute_measures(text), text


def test_hosts(spark, make, odd, clashing, none):
    good = "plain words that follow each other without any repetition at all here {}"
    rows = [(i, good.format(i), "en", "good", 1) for i in range(60)]
    rows += [(100 + i, "short" if i % 10 else good.format(i), "en", "bad", 1) for i in range(60)]
    got = {r.doc_id: r for r in host_rules.judged(make(rows), ["doc_id"]).collect()}
    assert all(got[i].kept for i in range(60))
    assert not any(got[100 + i].kept for i in range(60))
    assert not got[100].base_failed and got[100].host_rate > 0.5
    assert host_rules.judged(odd, ["doc_id"]).count() == len(ODD)
    assert host_rules.passing(clashing).columns == clashing.columns
    assert host_rules.passing(none).count() == 0


def best_first(scores, at=0):
    """Maximal segments by their definition: the best one, then what is left of and right of it."""
    sums = np.concatenate([[0.0], np.cumsum(scores)])
    best = max(((sums[j] - sums[i], -i, -j) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    i, j = -best[1], -best[2]
    return best_first(scores[:i], at) + [(at + i, at + j)] + best_first(scores[j:], at + j)


def test_segments():
    rnd = np.random.default_rng(4)
    for _ in range(500):
        scores = rnd.normal(-0.3, 1, rnd.integers(0, 14))
        assert [s[:2] for s in toxicity.segments(scores)] == best_first(scores)


def test_toxicity(spark, odd, none):
    rnd = random.Random(8)
    bad = ["grumble", "snarlface", "grumbling"]
    rows, labels = [], []
    for i in range(400):
        words = [f"w{rnd.randrange(300)}" for _ in range(60)]
        toxic = i % 4 == 0
        if toxic:
            words[20:24] = [rnd.choice(bad) for _ in range(4)]
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    got = {r.id: r for r in toxicity.scored(docs, model).collect()}
    out = {r.doc_id for r in docs.where(toxicity.held_out(docs["doc_id"])).collect()}
    assert 40 < len(out) < 140
    assert all(got[i].predicted == y for i, y in labels if i in out)
    assert all(0 <= r.score <= 1 for r in got.values())
    assert sum(r.n_passages > 0 for i, r in got.items() if i % 4 == 0) > 90
    assert toxicity.scored(odd.select("doc_id", "text"), model).count() == len(ODD)
    assert toxicity.scored(none, model).count() == 0
    empty = toxicity.fit(docs, known.where("toxic = 0"))
    assert {r.predicted for r in toxicity.scored(docs, empty).collect()} == {0}


def brute_repeats(rows, least):
    normal, seen, later, cut = unit_dedup.Normal(), {}, {}, {}
    for doc, text in sorted(set(rows)):
        cut[doc] = unit_dedup.units(text, normal)
        for k, d in enumerate(cut[doc][0].tolist()):
            if d in seen:
                later.setdefault(doc, []).append(k)
            seen.setdefault(d, doc)
    out = set()
    for doc, units in later.items():
        _, words, start, end = cut[doc]
        runs = np.split(units, np.flatnonzero(np.diff(units) > 1) + 1)
        out |= {(doc, int(start[r[0]]), int(end[r[-1]]), int(words[r].sum())) for r in runs if words[r].sum() >= least}
    return out


def test_repeats(spark, odd, none):
    rnd = random.Random(6)
    fresh = lambda k: [f"u{rnd.randrange(10**9)}" for _ in range(k)]
    passage = fresh(80)
    rows = []
    for i in range(30):
        words = fresh(200)
        for k in range(9, len(words), 17):
            words[k] += rnd.choice([".", "\n", ","])
        if i % 3 == 0:
            place = rnd.randrange(200)
            words[place:place] = passage
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.id, r.start, r.end, r.n_words) for r in unit_dedup.repeated_spans(docs).collect()}
    assert got == brute_repeats(rows, unit_dedup.LEAST_WORDS)
    assert {g[0] for g in got} == {i for i in range(3, 30, 3)}
    cut = {r.doc_id: r.text for r in unit_dedup.without_repeats(docs).collect()}
    for i, text in rows:
        want, at = "", 0
        for _, start, end, _ in sorted(g for g in got if g[0] == i):
            want, at = want + text[at:start], end
        assert cut[i] == want + text[at:]
    assert unit_dedup.repeated_spans(odd).where("id = 1 AND first_id = 1").count() == 0
    assert unit_dedup.repeated_spans(none).count() == 0


def test_mix(spark, make, odd, clashing, none):
    rnd = random.Random(3)
    rows = [(i, " ".join(f"w{k}" for k in range(rnd.randrange(5, 400))), "en", rnd.choice(["a", "a", "b", "c", None]), 1) for i in range(600)]
    _, got = mixing.mixed(make(rows))
    got = got.toPandas()
    sizes = {i: len(t.split()) for i, t, *_ in rows}
    assert all(sizes[r.id] == r.size for r in got.itertuples())
    assert (got.taken <= 2 * got["size"]).all()
    by = got.groupby(got.source.fillna("~")).agg(size=("source_size", "first"), target=("target", "first"), taken=("taken", "sum"))
    want = brute_targets(dict(by["size"]))
    for s, r in by.iterrows():
        assert r.target == pytest.approx(want[s])
        assert abs(r.taken - r.target) <= 2 * mixing.BLOCK + 0.01 * r.target
    _, again = mixing.mixed(make(rows).repartition(7))
    assert sorted(map(tuple, again.select("id", "taken").collect())) == sorted(zip(got.id, got.taken))
    out = mixing.mixed_documents(make(rows)).toPandas()
    taken = out.groupby("doc_id").text.apply(lambda t: sum(len(x.split()) for x in t))
    assert all(taken.get(r.id, 0) == r.taken for r in got.itertuples())
    assert mixing.mixed(odd)[1].count() == len(ODD)
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    assert mixing.mixed(none)[1].count() == 0 and mixing.mixed_documents(none).count() == 0


def brute_targets(sizes):
    order = sorted(sizes)
    weight = {s: [5, 2, 1][k % 3] for k, s in enumerate(order)}
    free, left, out = set(order), 1.5 * sum(sizes.values()), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * left / total > 2 * sizes[s]}
        if not over:
            return out | {s: weight[s] * left / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return out
