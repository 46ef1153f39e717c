"""Collocations, SimHash components and ranked search against plain versions, and on hard rows."""

import collections
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from barloom.llm import collocations, nra, simhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"w{i % 997}x{i % 1009}" for i in range(300_000))  # longer than a slice of any operator


def texts():
    rng = random.Random(11)
    vocab = ["the", "of", "Straße", "naïve", "it's", "x1", "日本", "--", "CAFÉ"] + ["".join(rng.choice("abcde") for _ in range(rng.randint(2, 5))) for _ in range(40)]
    mark = lambda: rng.choice([" ", " ", " ", "  ", "\t", ", ", ". ", "\n", "!\r", "\x0b"])
    text = lambda n: "".join(rng.choice(vocab) + mark() for _ in range(n))
    base = text(90)
    out = [base, base, base.replace("the", "THE"), base + "tail", "Start " + base, None, "", " \n\t ", "!!!", "One", "one two", "one  TWO", "a b c", "new york city " * 40, "new york, city. " * 40, LONG]
    return out + [text(rng.randint(1, 200)) for _ in range(60)]


TEXTS = texts()


@pytest.fixture(scope="module")
def docs(spark):
    """Rows with repeated, null and unordered ids, and names that operators use themselves as extra columns."""
    rows = [((i * 7) % 101 if i % 13 else None, t, ["en", None, "de"][i % 3]) for i, t in enumerate(TEXTS)] + [(7, TEXTS[1], "en")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    return df.withColumns({c: F.lit(-7) for c in ("id", "fp", "k", "v", "n", "a", "b", "chunk", "local", "word", "phrase", "doc", "term", "tf", "item", "component")})


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


# ---- phrases ----------------------------------------------------------------------------------------------------
def plain_collocations(rows, top, least, share=80):
    f = collections.defaultdict(collections.Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                f["und" if lang is None else lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= share * cand[p[i : i + k]]}
        found = []
        for p in cand.keys() - gone:
            a = cand[p]
            s, k = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p)))
            found.append((-s, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        n = sum(x for p, x in c.items() if len(p) == 1)
        out |= {(lang, i, p.decode(), -a, l, r, n, -s) for i, (s, a, p, l, r) in enumerate(sorted(found)[:top], 1)}
    return out


@pytest.mark.parametrize("top, least", [(2000, 3), (5, 2)])
def test_collocations(docs, none, top, least, monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 2000)
    got = collocations.collocations(docs, top=top, least=least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == plain_collocations([(r.text, r.lang) for r in docs.select("text", "lang").collect()], top, least)
    assert collocations.collocations(none).count() == 0


def test_tiles_count_like_a_dictionary():
    rng = np.random.default_rng(3)
    for high in (5, 600, 5000, 1 << 40):
        a, b = rng.integers(0, high, 40_000), rng.integers(0, high, 40_000)
        x, y, n = collocations.tiled_counts(a, b)
        assert dict(zip(zip(x.tolist(), y.tolist()), n.tolist())) == collections.Counter(zip(a.tolist(), b.tolist())) and len(x) == len(set(zip(x.tolist(), y.tolist())))
    assert all(len(x) == 0 for x in collocations.tiled_counts(a[:0], b[:0]))


@pytest.mark.parametrize("high", [40, 1 << 33])
def test_phrases_of_ids_with_and_without_a_filter(high):
    rng = np.random.default_rng(5)
    ids = np.where(rng.random(6000) < 0.1, -1, high // 40 * rng.integers(0, 40, 6000))
    for length in (2, 3, 4):
        grams = [tuple(ids[i : i + length].tolist()) for i in range(len(ids) - length + 1)]
        want = collections.Counter(g for g in grams if min(g) >= 0)
        words, n = collocations.phrases_in(ids, length)
        assert dict(zip(zip(*[w.tolist() for w in words]), n.tolist())) == want and len(n) == len(want)
        none = np.zeros(1 << 17, np.uint8)  # nothing passes
        assert length == 2 or not len(collocations.phrases_in(ids, length, none)[1])
        assert not len(collocations.phrases_in(ids[:1], length)[1])
        rows = np.lexsort(words[::-1])
        columns = [c[rows] for c in (*words, n)]
        assert all((a == b).all() for a, b in zip(collocations._opened(collocations._shut(columns), length + 1), columns))


def shuffled(spark):
    """Bytes that all stages so far have written for shuffles."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return {(stages.apply(i).stageId(), stages.apply(i).attemptId()): stages.apply(i).shuffleWriteBytes() for i in range(stages.size())}


def test_collocations_send_little(spark, monkeypatch):
    """What is shuffled stays near the size of the texts, though nearly all pairs of a chunk are sent."""
    monkeypatch.setattr(collocations, "CHUNK", 100_000)
    rng = np.random.default_rng(7)
    vocabulary = np.array(["".join("abcdefghij"[int(d)] for d in str(i + 1000)) for i in range(5000)])
    draws = vocabulary[np.minimum(rng.zipf(1.3, (400, 1000)) - 1, 4999)]
    texts = [" ".join(x) for x in draws.tolist()]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    before = shuffled(spark).keys()
    assert collocations.collocations(df, least=5).count() == 2000
    sent = sum(n for k, n in shuffled(spark).items() if k not in before)
    assert sent < 2 * sum(map(len, texts))  # with a row for each pair of a chunk: 3.9


def test_scores_are_exact_beyond_64_bits(spark):
    big = [(9_000_000_000_000_000_000, 9_100_000_000_000_000_000, 9_200_000_000_000_000_001), (30, 31, 61), (30, 30, 30)]
    df = spark.createDataFrame(big, "a long, l long, r long")
    got = [r[0] for r in df.select(collocations._score(F.col("a"), F.col("l"), F.col("r"))).collect()]
    assert got == [2000000 * a // (l + r) for a, l, r in big]


# ---- fingerprints -----------------------------------------------------------------------------------------------
def plain_fingerprint(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_parts(prints):
    """The least member each of a list of numbers reaches over at most three differing bits, by comparing all."""
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(root)
    for i, a in enumerate(order):
        for b in order[:i]:
            if (a ^ b).bit_count() <= 3:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {p: find(p) for p in order}


@pytest.mark.parametrize("group", [1 << 14, 1])
def test_simhash_components(docs, none, group):
    rows = docs.select("doc_id", "text").collect()
    of = plain_parts({plain_fingerprint(r.text) for r in rows})
    least = {}
    for r in rows:
        p = of[plain_fingerprint(r.text)]
        if r.doc_id is not None:
            least[p] = min(r.doc_id, least.get(p, r.doc_id))
    want = collections.Counter((r.doc_id, f"{plain_fingerprint(r.text):016x}", least.get(of[plain_fingerprint(r.text)])) for r in rows)
    assert collections.Counter(tuple(r) for r in simhash.simhash_components(docs, group=group).collect()) == want
    assert simhash.simhash_components(none).count() == 0


def near_prints(seed, n):
    rng = random.Random(seed)
    centres, out = [rng.getrandbits(64) for _ in range(4)], set()
    while len(out) < n:
        x = rng.choice(centres)
        for _ in range(rng.randint(0, 9)):
            x ^= 1 << rng.randrange(64)
        out.add(x)
    return sorted(out)


@pytest.mark.parametrize("group", [1 << 14, 40, 2])
def test_no_link_is_lost_however_keys_are_dealt(spark, group):
    prints = near_prints(group, 900)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in prints], "fp long")
    links = [(r.a % 2**64, r.b % 2**64) for r in simhash.links_between(df, group).collect()]
    assert all((a ^ b).bit_count() <= 3 for a, b in links)
    want, root = plain_parts(prints), {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[max(find(a), find(b))] = min(find(a), find(b))
    assert {p: find(p) for p in prints} == want


def test_every_near_pair_has_a_chain_and_shares_its_key():
    rng = random.Random(2)
    assert simhash.BUDGETS == [0, 0, 1, 1, 1, 2, 2, 3] and all(bin(int(m)).count("1") >= 50 for m in simhash.MASKS[-1])
    for _ in range(2000):
        diff = sum(1 << b for b in rng.sample(range(64), rng.randint(1, 3)))
        first_two = [sum(1 << b for b in simhash._ring(s, [0, 1])) for s in range(8)]
        starts = [s for s in range(8) if diff & first_two[s] == 0 and len(simhash._chained(np.array([diff], np.uint64), s))]
        assert starts
        for s in starts:
            assert any(diff & int(m) == 0 for m in simhash.MASKS[0][3 * s : 3 * s + 3])


def test_rows_of_a_key_over_many_batches_are_dealt_again_once():
    fp = np.arange(50, dtype=np.uint64)
    rows = pa.table({"k": pa.array([0] * 50, pa.int32()), "v": pa.array([0] * 50, pa.int64()), "fp": pa.array(fp.view(np.int64))})
    for size in (1, 3, 7, 50):
        out = pa.Table.from_batches(list(simhash._meet(0, 10)(iter(rows.to_batches(max_chunksize=size)))))
        assert sorted(out.column("a").to_pylist()) == list(range(50)) and out.column("b").null_count == 50


# ---- ranked search ----------------------------------------------------------------------------------------------
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def plain_search(rows, items, best):
    found = [(i, collections.Counter(TERM.findall((t or "").translate(LOWER)))) for i, t in rows]
    found = [x for x in found if x[1]]
    n_docs, n_terms = len(found), sum(c.total() for _, c in found)
    df = collections.Counter(t for _, c in found for t in c)
    out = collections.Counter()
    for item, text in set(items):
        query, scores = collections.Counter(TERM.findall((text or "").translate(LOWER))), []
        for i, c in found:
            m = 25 + 75 * c.total() * n_docs // n_terms
            s = sum(k * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in query.items() if c[t])
            if s > 0:
                scores.append((-s, i is None, i))
        out.update((item, rank, i, -s) for rank, (s, _, i) in enumerate(sorted(scores, key=lambda x: x[:2] + (x[2] or 0,))[:best], 1))
    return out


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, TEXTS[0]), (1, TEXTS[0]), (2, TEXTS[20]), (2, TEXTS[21]), (3, "new new york THE of"), (4, None), (5, "unheard"), (6, ""), (None, "x1 日本"), (7, TEXTS[15][:4000]), (8, "the")]
    return spark.createDataFrame(rows, "item_id long, text string").withColumns({c: F.lit(-7) for c in ("item", "term", "times", "doc_id")})


@pytest.mark.parametrize("best, first, shard, block", [(10, 64, 1 << 19, 1 << 18), (10, 1, 1, 5), (3, 2, 300, 40), (200, 5, 2000, 1)])
def test_search(docs, items, best, first, shard, block):
    got = nra.search(docs, items, best=best, first=first, shard=shard, block=block)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    want = plain_search([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], [(r.item_id, r.text) for r in items.select("item_id", "text").collect()], best)
    assert collections.Counter(tuple(r) for r in got.collect()) == want


def test_search_of_nothing(docs, items, none):
    assert nra.search(none, items).count() == 0 == nra.search(docs, items.where("item_id = 4")).count()


def test_ties_go_to_the_smaller_id_and_lists_are_read_by_impact(spark):
    df = spark.createDataFrame([(100 - i, "alpha beta" if i % 2 else "alpha gamma delta") for i in range(60)] + [(500, "omega")] * 40, "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta"), (2, "delta")], "item_id long, text string")
    got = sorted(tuple(r) for r in nra.search(df, items, best=4, first=2).collect())
    assert [r[2] for r in got] == [41, 43, 45, 47, 42, 44, 46, 48] and len({r[3] for r in got[:4]}) == 1


def test_lists_are_read_by_impact_until_scores_are_final():
    rng = np.random.default_rng(7)
    for _ in range(200):
        n_docs, n_lists = int(rng.integers(1, 60)), int(rng.integers(1, 8))
        dense = rng.random((n_lists, n_docs)) < rng.random((n_lists, 1))
        impact = np.where(dense, rng.integers(1, 6, (n_lists, n_docs)) * rng.integers(1, 50, (n_lists, 1)), 0)
        term, doc = np.nonzero(dense)
        shard = nra.Shard(n_lists, n_docs, term, doc, impact[term, doc])
        assert all((np.diff(shard.impact[shard.start[t] : shard.start[t + 1]]) <= 0).all() for t in range(n_lists))
        lists = rng.permutation(n_lists)[: rng.integers(1, n_lists + 1)]
        times, best, bar = rng.integers(1, 4, len(lists)), int(rng.integers(1, 6)), int(rng.integers(1, 80))
        inside, score = shard.best(lists, times, bar, best, int(rng.integers(1, 9)))
        whole = times @ impact[lists]
        least = max(bar, np.sort(whole)[-best] if (whole > 0).sum() >= best else 1)
        assert set(np.flatnonzero(whole >= least)) <= set(inside.tolist()) and (score == whole[inside]).all()
