"""The corpus operators against plain versions, on small tables with nulls, empty and long texts, ties and repeats."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from barloom.llm import bpe, components, exact_dedup, fingerprints, hpylm, induced, jaccard, langid, mixing, suffix_dedup, token_counts, warc

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))


def fixture_rows():
    rng = random.Random(5)
    vocab = ["the", "of", "Straße", "naïve", "data", "it's", "x1", "日本", "--", "café"] + ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(80)]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    base, passage = text(120), text(60)
    near = base.split(" ")
    near[60] = "changed"
    texts = [base, base, " ".join(near), "Intro. " + base, text(40) + " " + passage + " " + text(30), text(10) + " " + passage, None, "", " \n\t ", "one two", "One  two", "a b c d", "a b c d e", "!!! 123", "aaaa" * 100, "ab " * 400, text(6000)]
    texts += [text(rng.randint(1, 60)) for _ in range(25)]
    langs = ["en", "de", None]
    return [(i * 3 + 1, t, langs[i % 3], ["s2", "s1", None, "s10"][i % 4], None) for i, t in enumerate(texts)]


ROWS = fixture_rows()


@pytest.fixture(scope="module")
def docs(spark):
    """The table with names that operators use themselves as extra columns."""
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    for c in ("id", "hash", "row", "size", "key", "rep", "component", "bucket", "_id"):
        df = df.withColumn(c, F.lit("x"))
    return df


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


# ---- exact dedup ------------------------------------------------------------------------------------------------
def test_exact_dedup(spark, docs, none):
    keep = {}
    for i, t, *_ in ROWS:
        keep[t or ""] = max(i, keep.get(t or "", -1))
    n = collections.Counter(t or "" for _, t, *_ in ROWS)
    want = {(i, keep[t or ""], n[t or ""], i == keep[t or ""], hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in ROWS}
    assert {tuple(r) for r in exact_dedup.exact_duplicates(docs, capacity=4).collect()} == want
    assert exact_dedup.exact_duplicates(none).count() == 0
    assert {r.doc_id for r in exact_dedup.keep_one(docs).collect()} == set(keep.values())


def test_exact_dedup_of_repeated_and_null_ids(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 1, 3, True), (1, 1, 3, True), (None, 1, 3, False), (None, None, 1, True)], key=str)


def test_directory_splits_overfull_buckets(spark):
    df = spark.range(2000).select(F.xxhash64("id").alias("hash"))
    depth, cells = exact_dedup.directory(df, capacity=100)
    rows = cells.collect()
    assert max(r.n_entries for r in rows) <= 100 and len({r.cell for r in rows}) == len(rows) <= 2**depth
    assert sum({r.bucket: r.n_entries for r in rows}.values()) == 2000


# ---- suffix dedup -----------------------------------------------------------------------------------------------
def plain_repeats(rows):
    seen, out = set(), {}
    for i, t in sorted((i, t or "") for i, t, *_ in rows):
        b = t.encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - 99):
            if b[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(b[k : k + 100])
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i] = (len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest())
    return out


def test_suffix_dedup_merges_strings_of_hot_anchors_in_the_task():
    import pyarrow as pa

    # 500 texts share a passage; its anchor is hot. A string goes out once, with its first place, and the others are marked.
    shared = bytes(np.random.default_rng(0).integers(97, 122, 160, dtype=np.uint8)).decode()
    texts = [f"{i:04d} {shared} {i:04d}" for i in range(500)]
    ask = np.array([(7, 5, 60, 1)], suffix_dedup._ASK).tobytes()
    ids = [*range(500), 3]  # a row stands twice
    rows = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array([texts[i] for i in ids]), pa.array([[ask]] * 501)], ["id", "hash", "text", "asks"])
    out = pa.Table.from_batches(suffix_dedup._read(8)(iter([rows]))).to_pylist()
    sent = [r for r in out if not r["mark"]]
    assert sum(len(r["bytes"]) for r in sent) == 61 * 100
    assert all(set(np.frombuffer(r["ids"], "<i8")) == {0} for r in sent)
    marked = {r["id"]: np.frombuffer(r["data"], "<i8").tolist() for r in out if r["mark"]}
    assert marked == {i: [5, 165] for i in range(1, 500)}


@pytest.mark.parametrize("hot", [2000, 1])
def test_suffix_dedup(spark, docs, none, monkeypatch, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs).collect()}
    assert got == plain_repeats(ROWS)
    if hot == 1:
        assert suffix_dedup.remove_repeats(none).count() == 0


def test_suffixes_against_sorting():
    rng = random.Random(1)
    for _ in range(300):
        k, cap = rng.choice([1, 2, 3, 200]), rng.choice([1, 4, 100])
        t = bytes(rng.randrange(k) for _ in range(rng.randint(1, 50))) * rng.choice([1, 1, 4])
        order, lcp = induced.suffixes(np.frombuffer(t, np.uint8), cap)
        want = sorted(range(len(t)), key=lambda i: t[i : i + cap])
        assert [t[i : i + cap] for i in order] == [t[i : i + cap] for i in want]
        for j in range(1, len(t)):
            a, b = t[order[j - 1] :][:cap], t[order[j] :][:cap]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert lcp[j] == n


def test_queues_spill(tmp_path):
    q = induced.Queues(3, in_memory=4)
    parts = [np.array([(i, 0), (i + 1, 1)], induced._KIND) for i in range(0, 20, 2)]
    for i, p in enumerate(parts):
        q.push(i % 2, p)
    assert q.file is not None
    assert q.pop(0)["at"].tolist() == [x for p in parts[::2] for x in p["at"]] and len(q.pop(2)) == 0


# ---- language model ---------------------------------------------------------------------------------------------
def test_lm_scores(spark, docs, none):
    got = {r.doc_id: r for r in hpylm.score_texts(docs).collect()}
    tokens = {i: [*words(t), None] for i, t, *_ in ROWS}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    for i, ws in tokens.items():
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        assert r.score < 0
    trained = [i for i in tokens if not held[i]]
    assert sum(got[i].score for i in trained) > sum(got[i].base_score for i in trained)
    assert hpylm.score_texts(none).count() == 0


def test_lm_prefers_what_it_saw(spark):
    seen = "a" * 60 + "b" * 25 + "c" * 12 + "d" * 6 + "e" * 4 + "f" * 4 + "g" * 2 + "h"
    df = spark.createDataFrame(list(enumerate(seen)), "doc_id long, text string")
    held = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    probes = spark.createDataFrame(list(zip(held, ["a", "b", "e", "zzz"])), "doc_id long, text string")
    got = {r.doc_id: r for r in hpylm.score_texts(df.unionByName(probes)).collect()}
    assert all(got[h].held_out and 10 ** got[h].score < 1 for h in held)
    assert got[held[0]].score > got[held[1]].score > got[held[2]].score > got[held[3]].score


def test_lm_split_words_have_one_table_total(spark, monkeypatch):
    # "a" and the begin mark are split over 12 buckets. Words that were never seen have one probability after "a", whichever
    # bucket they are in.
    rng = random.Random(3)
    rows = [(i, " ".join(f"a w{int(rng.paretovariate(0.8)) % 3000}" for _ in range(60))) for i in range(1, 60)]
    held = [i for i in range(1000, 3000) if zlib.crc32(str(i).encode()) % 10 == 0][:30]
    df = spark.createDataFrame(rows + [(h, f"a unseen{h}") for h in held], "doc_id long, text string")
    monkeypatch.setattr(hpylm, "n_partitions", lambda spark: 12)
    got = {r.doc_id: r.score for r in hpylm.score_texts(df).collect()}
    assert max(got[h] for h in held) - min(got[h] for h in held) < 1e-4


def test_lm_split_restaurant_seats_as_a_whole_one():
    rng = np.random.default_rng(1)
    train = np.minimum((rng.pareto(0.8, 20000) + 1).astype(np.int64), 5000)
    parent, zero = np.full(len(train), 1 / len(train)), np.zeros(1, np.int64)
    parts = np.array_split(rng.permutation(len(train)), 40)
    draw = lambda k, totals, seed, draws: hpylm.seat(train[k], zero, parent[k], train.sum(keepdims=True), totals, 0.7, np.random.default_rng(seed), draws)[0]
    whole = draw(np.arange(len(train)), None, 99, 4).sum()
    totals = [np.array([len(train)])]
    while len(totals) <= 4:
        totals.append(np.array([sum(draw(k, totals, i, len(totals)).sum() for i, k in enumerate(parts))]))
    assert totals[4][0] == pytest.approx(whole, rel=0.02)


def test_lm_draws_of_split_words_are_not_made_again(spark, monkeypatch, tmp_path):
    # Every first word is split. Eight draws are made for the totals of the two exchanges and four for the seating itself; made
    # from the start for each total they are 24.
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{rng.randrange(40)}" for _ in range(200))) for i in range(200)]
    rows += [(i, "same pair " * 100) for i in range(200, 210)]  # two split pairs, drawn once each
    tokens = [["<", *t.split(), ">"] for _, t in rows]
    pairs = {p for t in tokens for p in zip(t, t[1:])}
    plain, log = hpylm.sample_tables, tmp_path / "drawn"

    def counted(customers, *rest):
        with log.open("a") as f:
            f.write(f"{len(customers)}\n")
        return plain(customers, *rest)

    monkeypatch.setattr(hpylm, "sample_tables", counted)
    cloudpickle.register_pickle_by_value(hpylm)  # so that the workers have it too
    try:
        hpylm.score_texts(spark.createDataFrame(rows, "doc_id long, text string"))
    finally:
        cloudpickle.unregister_pickle_by_value(hpylm)
    drawn = sum(map(int, log.read_text().split()))
    assert 11 * len(pairs) < drawn < 13 * len(pairs)


def test_lm_draw_given_totals_needs_no_other_draw():
    rng = np.random.default_rng(2)
    train = rng.integers(0, 5, 3000) * rng.integers(0, 30, 3000) // 4
    heads = np.arange(0, 3000, 50)
    parent, owner = rng.random(3000) / 3000, np.repeat(np.arange(60), 50)
    seats, totals = np.bincount(owner, train), [np.bincount(owner, np.minimum(train, 1)) + 3 * k for k in range(5)]
    of = lambda step: np.random.default_rng([7, step])
    most = np.argmax(train)
    split = ([most], [np.array([x]) for x in (9, 5, 6, 7)])  # a pair that is drawn elsewhere
    draw = lambda k, heads, **how: hpylm.seat(train[k], heads, parent[k], seats, totals, 0.6, of, 4, **how)
    tables, mean = draw(np.arange(3000), heads, split=split, averaged=True)
    late, late_mean = draw(np.arange(3000), heads, split=split, averaged=True, begin=hpylm.BURN_IN)
    assert (late == tables).all() and (late_mean == mean).all() and tables[most] == 7
    k = owner[most]
    assert mean[most] == pytest.approx((train[most] - 0.6 * 6 + (hpylm.STRENGTH + 0.6 * np.mean([t[k] for t in totals[2:]])) * parent[most]) / (hpylm.STRENGTH + seats[k]))
    k = np.flatnonzero((train > 1) & (np.arange(3000) != most))
    last, _ = draw(k, np.searchsorted(k, heads), begin=3)
    assert (last == tables[k]).all() and (tables[train < 2] == train[train < 2]).all()


def test_lm_order_of_pairs():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 40, (2, 5000))
    for scale in (1, 1 << 50):  # packed in 64 bits, and not
        assert (hpylm._order(a * scale, b, 40) == np.lexsort((b, a))).all()
    words = rng.integers(0, 1 << 48, 300, np.uint64)[a]
    assert all((x == y).all() for x, y in zip(hpylm._ranked(words), np.unique(words, return_inverse=True)))
    assert len(hpylm._order(a[:0], b[:0], 1)) == 0


def test_table_draws():
    rng = np.random.default_rng(0)
    c = np.array([0, 1, 2, 5, 32, 33, 1000, 100000])
    t = hpylm.sample_tables(c, np.full(len(c), 0.1), 0.5, rng)
    assert (t <= c).all() and (t[c > 0] >= 1).all() and t[0] == 0
    many = hpylm.sample_tables(np.full(20000, 2), np.full(20000, 1.0), 0.5, rng)
    assert abs((many == 2).mean() - 1 / 1.5) < 0.02  # weights: one table 1 - d, two tables the open weight


# ---- jaccard ----------------------------------------------------------------------------------------------------
def plain_components(rows):
    sets = {}
    for i, t, *_ in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {(i, len(s), find(i)) for i, s in sets.items()}


def near_rows():
    """A chain of documents, each a little changed from the one before, with a passage that all have, and others."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(60):
        if i % 3 == 0:
            base = list(base)
            base[rng.randrange(150)] = f"n{i}"
        own = list(base)
        for _ in range(rng.randint(0, 3)):
            own[rng.randrange(150)] = f"m{rng.randrange(1000)}"
        rows.append((i, " ".join(own)))
    shared = " ".join(f"p{k}" for k in range(40))
    rows += [(100 + i, shared + " " + " ".join(f"q{i}-{k}" for k in range(rng.randint(1, 12)))) for i in range(40)]
    return rows


def test_jaccard(spark, docs, none):
    assert {tuple(r) for r in jaccard.jaccard_components(docs).collect()} == plain_components(ROWS)
    assert jaccard.jaccard_components(none).count() == 0


@pytest.mark.parametrize("small", [24, 3])
def test_jaccard_of_large_groups(spark, monkeypatch, small):
    """With few pairs at once, pivots and the rest must find the same links."""
    monkeypatch.setattr(jaccard, "SMALL", small)
    rows = near_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in jaccard.jaccard_components(df).collect()} == plain_components(rows)


def test_components(spark):
    edges = [(i, i + 1) for i in range(20, 40)] + [(5, 9), (9, 7), (7, 50)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 20 for i in range(20, 41)) and {got[i] for i in (5, 7, 9, 50)} == {5}


# ---- language ID ------------------------------------------------------------------------------------------------
def test_language_id(spark, none):
    rng = random.Random(2)
    lex = {"en": "the of and with ing tion that".split(), "de": "der die und sch ung keit für".split()}
    text = lambda k: " ".join("".join(rng.choice(lex[k]) for _ in range(rng.randint(1, 2))) for _ in range(30))
    rows = [(i, text(k), k) for i, k in enumerate(rng.choice(["en", "de"]) for _ in range(120))]
    rows += [(500, None, None), (501, "123 !!! --", "en"), (502, "", "de"), (503, text("en") + " " + text("de"), None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.fit_and_identify(df).collect()}
    assert all(got[i].lang_pred == k for i, _, k in rows[:120]) and {got[i].lang_pred for i in (500, 501, 502)} == {"und"}
    assert all(0 <= r.score <= 1 for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    model = langid.fit(langid.sample(df, "text", "lang"))
    mixed_words = langid.identify(df.where("doc_id = 503"), model, words=True).head().word_langs
    assert sum(x == "en" for x in mixed_words[:30]) > 25 and sum(x == "de" for x in mixed_words[30:]) > 25
    assert langid.keep_identified(df, model, 0.5).where("doc_id in (500, 501, 502)").count() == 0
    assert langid.fit_and_identify(none).count() == 0
    assert {r.lang_pred for r in langid.fit_and_identify(df.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_forward_backward_against_all_paths():
    import itertools

    rng = np.random.default_rng(3)
    s, tr = rng.normal(size=(7, 3)), rng.normal(size=(3, 3))
    before = np.array([0, 4, 4, 7])
    got = langid.forward_backward(s, before, tr)
    for a, b in ((0, 4), (4, 7)):
        total, marg = 0, np.zeros((b - a, 3))
        for path in itertools.product(range(3), repeat=b - a):
            w = np.exp(sum(s[a + i, y] for i, y in enumerate(path)) + sum(tr[x, y] for x, y in zip(path, path[1:])))
            total += w
            for i, y in enumerate(path):
                marg[i, y] += w
        assert np.allclose(got[a:b], marg / total)


# ---- tokens -----------------------------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def reference_encoder():
    tiktoken = pytest.importorskip("tiktoken")
    tables = pytest.importorskip("public_tokenizers")
    return tiktoken.Encoding("own", pat_str=tables.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})


def test_bpe(spark, docs, none, reference_encoder):
    out = bpe.encode(docs, decoded=True)
    for r in out.collect():
        t = next(t for i, t, *_ in ROWS if i == r.doc_id) or ""
        assert np.frombuffer(r.ids, "<u4").tolist() == reference_encoder.encode_ordinary(t) and r.decoded == t.encode()
        assert r.n_tokens == len(r.ids) // 4
    back = {r.doc_id: r.text for r in bpe.decode_ids(out).collect()}
    assert back == {i: t or "" for i, t, *_ in ROWS}
    assert bpe.encode(none).count() == 0


def test_bpe_of_hard_texts(reference_encoder):
    rng = random.Random(4)
    parts = ["'s", "'re", "'", "''", "  ", "\n", " ", "\t", "ll", "ve", "a", "é", "ß", "1", "²", "!", "--", "日本", "　", "\xa0", "x'", "'LL", "😀", "́", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(2000)] + ["=" * 700, "ab" * 500]
    own = bpe.Encoder(bpe.Ranks(bpe.read_ranks(bpe.default_path())))
    raw = [t.encode() for t in texts]
    ids, before = own.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    for i, t in enumerate(texts):
        assert ids[before[i] : before[i + 1]].tolist() == reference_encoder.encode_ordinary(t), t


def test_token_counts(spark, docs, none, reference_encoder, monkeypatch):
    monkeypatch.setattr(token_counts, "BLOCK", 7)
    n = collections.defaultdict(list)
    for _, t, _, s, _ in ROWS:
        n[s].append(len(reference_encoder.encode_ordinary(t or "")))
    want = set()
    for s, ls in n.items():
        for x in set(ls):
            want.add((s, x, ls.count(x), sum(y >= x for y in ls), sum(y for y in ls if y >= x), sum(min(y, x) for y in ls), sum(y <= x for y in ls) / len(ls)))
    sums = token_counts.token_counts(docs)
    assert {tuple(r) for r in sums.collect()} == want
    at = {(r.source, r.limit): (r.tokens, r.cut_docs) for r in token_counts.at_limits(sums, spark.createDataFrame([(5,), (100,), (10**6,)], "limit long")).collect()}
    assert at == {(s, x): (sum(min(y, x) for y in ls), sum(y > x for y in ls)) for s, ls in n.items() for x in (5, 100, 10**6)}
    assert token_counts.token_counts(none).count() == 0


# ---- fingerprints -----------------------------------------------------------------------------------------------
def edit_distance(a, b):
    d = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        p, d[0] = d[0], i
        for j, y in enumerate(b, 1):
            p, d[j] = d[j], min(d[j] + 1, d[j - 1] + 1, p + (x != y))
    return d[-1]


def test_distances():
    rng = random.Random(6)
    mk = lambda: bytes(rng.choice(b"ABCa+/") for _ in range(rng.randint(0, 64)))
    a, b = [mk() for _ in range(200)], [mk() for _ in range(200)]
    assert fingerprints.distances(a, b).tolist() == [edit_distance(x, y) for x, y in zip(a, b)]


def test_fingerprints(spark, docs, none):
    got = {r.doc_id: r for r in fingerprints.compare_with_next(docs).collect()}
    plain = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    rows = sorted((i, t or "") for i, t, *_ in ROWS)
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        cut = len(t) // 4
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == plain[i] and 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert len(r.fingerprint.split(":")[1]) <= fingerprints.MOST
        if t == after:
            assert r.near_next == 1.0
        if t == edited:
            assert r.near_edited == 1.0 and r.edited_fingerprint == r.fingerprint
    long = got[next(i for i, t, *_ in ROWS if t and len(t) > 20000)]
    assert long.near_edited > 0.5 > long.near_next
    assert fingerprints.compare_with_next(none).count() == 0
    one = fingerprints.compare_with_next(docs.where("doc_id = 1")).head()
    assert one.near_next == 1.0


# ---- archive ----------------------------------------------------------------------------------------------------
def test_archive(spark, tmp_path):
    big = "<p>" + "é" * 600 + "</p>"
    rows = [(1, "http://a", big), (5, "http://b\r\nX: y", big), (3, None, big), (2, "u", "small"), (4, "u", "small"), (6, "u", None), (7, "u", ""), (8, "u", "x" * 999), (9, "u", "x" * 999), (8, "u", "x" * 999)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = str(tmp_path / "archive")
    got = collections.Counter(tuple(r) for r in warc.archive_pages(df.withColumn("id", F.lit(1)).withColumn("payload", F.lit(2)), path=path).collect())
    want = collections.Counter()
    for i, _, h in rows:
        b = (h or "").encode()
        keep = max(j for j, _, g in rows if (g or "") == (h or ""))
        revisit = len(b) >= 1000 and i != keep
        want[(i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", keep if revisit else None)] += 1
    assert got == want
    assert spark.read.parquet(f"{path}/payloads").select("sha256").distinct().count() == 4
    record = bytes(warc.records(spark, path).where("id = 5").head().record)
    head, _, body = record.partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\nWARC-Type: response\r\n") and b"\r\nX: y" not in head
    assert body == big.encode() + b"\r\n\r\n" and f"Content-Length: {len(big.encode())}".encode() in head
    assert warc.archive_pages(df.where("page_id < 0")).count() == 0


# ---- mixing -----------------------------------------------------------------------------------------------------
def plain_targets(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: (5.0, 2.0, 1.0)[k % 3] for k, s in enumerate(order)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(order)
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if w[s] * level > 2 * sizes[s]}
        if not over:
            out |= {s: w[s] * level for s in free}
            break
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_mixing(spark, none):
    rng = random.Random(8)
    sources = ["a", "B", "é", None, "z", "empty"]
    rows = [(i, " ".join(["w"] * rng.randint(0, 30)), sources[min(4, int(rng.expovariate(0.7)))]) for i in range(3000)] + [(5000, None, "empty"), (5001, "", "empty")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("size", F.lit("x"))
    got = mixing.mix(df).collect()
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    size = collections.Counter()
    for _, t, s in rows:
        size[s] += len((t or "").split())
    want, taken = plain_targets(dict(size)), collections.Counter()
    by_id = {i: (s, len((t or "").split())) for i, t, s in rows}
    for r in got:
        s, n = by_id[r.doc_id]
        assert r.size == n and r.source_size == size[s] and r.target == pytest.approx(want[s]) and r.taken <= 2 * n
        taken[s] += r.taken
    for s in size:
        assert abs(taken[s] - want[s]) <= max(60, 0.02 * want[s])
    assert mixing.mix(none).count() == 0
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and out.count() == sum(r.copies for r in got)


def test_pivot_keeps_the_sum():
    rng = np.random.default_rng(1)
    p = rng.random(500)
    hits = np.zeros(500)
    for _ in range(300):
        q = mixing.pivot(p, rng.random(500))
        assert ((q > 1e-9) & (q < 1 - 1e-9)).sum() <= 1 and abs(q.sum() - p.sum()) < 1e-6
        hits += q
    assert abs(hits / 300 - p).mean() < 0.04
