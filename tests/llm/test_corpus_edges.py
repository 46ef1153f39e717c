"""Corpus operators on hard rows: repeated and null ids, equal texts, very long texts, clashing names, hot groups, forced hashes."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import bpe, exact_dedup, fingerprints, hpylm, induced, jaccard, langid, mixing, suffix_dedup, warc

LONG = " ".join(f"w{i % 997}x{i % 1009}" for i in range(150_000))  # longer than a slice of any operator


@pytest.fixture(scope="module")
def hard(spark):
    rows = [(1, "a b c d e f", "s", "en"), (1, "a b c d e f", "s", "en"), (1, "other words entirely here now", "s", "en"), (None, "a b c d e f", None, None), (None, None, "t", "en"), (5, "", "t", None), (6, None, None, "en"), (7, LONG, "s", "en"), (8, LONG, "t", "en"), (9, "é" * 300, "t", "fr")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")


def clashing(df, *names):
    return df.withColumns({n: F.lit(-7) for n in names})


# ---- exact dedup ------------------------------------------------------------------------------------------------
def test_texts_of_one_forced_hash_are_told_apart_by_their_bytes(spark):
    rows = [(i, f"text {i % 5}") for i in range(20)] + [(20, None), (21, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    forced = lambda t: F.when(F.length(t) > 0, F.lit(7)).otherwise(F.lit(-3)).cast("long")
    index = exact_dedup.Index(df, hash_of=forced, capacity=2)
    chains = {(r.hash, r.chain_length) for r in index.buckets.collect()}
    assert chains == {(7, 5), (-3, 1)}
    got = {tuple(r)[:4] for r in exact_dedup.exact_duplicates(df, hash_of=forced, capacity=2).collect()}
    assert got == {tuple(r)[:4] for r in exact_dedup.exact_duplicates(df).collect()}
    assert {(r[0], r[1]) for r in got} == {(i, 15 + i % 5) for i in range(20)} | {(20, 21), (21, 21)}


def test_index_is_looked_up_by_bucket(spark):
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.concat(F.lit("t"), (F.col("id") % 300).cast("string")).alias("text"))
    index = exact_dedup.Index(df, capacity=16)
    cells = {r.cell: r.bucket for r in index.directory.collect()}
    rows = index.buckets.collect()
    assert len(rows) == 300 and len({r.bucket for r in rows}) >= 300 / 16
    assert all(cells[(r.hash % 2**64) >> (64 - index.depth)] == r.bucket for r in rows)
    assert max(collections.Counter(r.bucket for r in rows).values()) <= 16


def test_exact_keep_one_with_clashing_names(hard):
    df = clashing(hard, "id", "hash", "cell", "bucket", "text_sha256", "keep_id", "kept")
    out = exact_dedup.keep_one(df)
    assert out.columns == df.columns
    assert collections.Counter((r.doc_id, r.text and r.text[:5]) for r in out.collect()) == collections.Counter([(1, "a b c"), (1, "a b c"), (1, "other"), (6, None), (8, LONG[:5]), (9, "ééééé")])


# ---- near duplicates --------------------------------------------------------------------------------------------
def shingles(text):
    w = (text or "").split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def plain_components(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                u, v = find(i), find(j)
                root[max(u, v)] = min(u, v)
    return {i: find(i) for i in ids}


def near_rows(n, seed):
    """Groups of near copies, and texts that share a long common passage and little else."""
    r = random.Random(seed)
    word = lambda: f"v{r.randrange(4000)}"
    common = [word() for _ in range(60)]
    bases = [[word() for _ in range(70)] for _ in range(4)]
    rows = []
    for i in range(n):
        if i % 3 == 0:
            t = list(bases[0] if i % 2 else r.choice(bases))
            for _ in range(r.randrange(4)):
                t[r.randrange(len(t))] = word()
        elif i % 3 == 1:
            t = common + [word() for _ in range(r.randrange(2, 25))]
        else:
            t = [word() for _ in range(r.randrange(1, 50))]
        rows.append((i, " ".join(t)))
    return rows


@pytest.mark.parametrize("small, block, seed", [(24, 1024, 1), (3, 16, 2), (2, 4, 3)])
def test_components_equal_brute_force_in_hot_groups(spark, monkeypatch, small, block, seed):
    monkeypatch.setattr(jaccard, "SMALL", small)
    monkeypatch.setattr(jaccard, "BLOCK", block)
    rows = near_rows(150, seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    want = plain_components(rows)
    assert got == {i: (len(shingles(t)), want[i]) for i, t in rows}


def test_near_keep_one_tells_rows_of_one_id_apart(spark, hard):
    df = spark.createDataFrame([(1, "a b c d e f"), (2, "a b c d e f"), (2, "x y z u v w"), (None, "x y z u v w"), (None, "alone here"), (3, None), (4, "")], "doc_id long, text string")
    df = clashing(df, "id", "n", "d1", "d2", "a", "b", "token", "component", "_id")
    out = jaccard.keep_one(df)
    assert out.columns == df.columns
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=str) == sorted([(1, "a b c d e f"), (2, "x y z u v w"), (None, "alone here"), (3, None), (4, "")], key=str)
    assert collections.Counter(r.doc_id for r in jaccard.keep_one(hard).collect())[7] == 1  # 8 is a copy of 7
    assert jaccard.keep_one(df.where("doc_id < 0")).count() == 0


# ---- mixing -----------------------------------------------------------------------------------------------------
def test_mixed_documents_keep_their_columns_and_tell_rows_apart(hard):
    df = clashing(hard, "_id", "_copies", "_copy", "id", "key", "copies", "size", "rank", "node", "p", "extra", "target")
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns and {r["_copy"] for r in out.collect()} <= {-7}
    took = mixing._drawn(df, "doc_id", "text", "source", mixing.WEIGHTS, mixing.SHARE, mixing.MAX_REPEAT, 1)
    want = collections.Counter()
    for r in took.collect():
        want[r.id] += r["copies"]
    assert collections.Counter(r.doc_id for r in out.collect()) == +want
    assert mixing.mixed_documents(df.where("doc_id < 0")).count() == 0


def test_mix_of_repeated_and_null_rows(hard):
    rows = mixing.mix(hard).collect()
    assert len(rows) == 10 and all(r.taken == r["copies"] * r["size"] and r["copies"] <= 2 for r in rows)
    assert {r["size"] for r in rows if r.doc_id in (5, 6)} == {0}
    assert [r["size"] for r in rows if r.doc_id == 7] == [150_000]


# ---- suffix dedup -----------------------------------------------------------------------------------------------
def test_repeats_with_null_ids_and_long_texts(hard):
    rows = suffix_dedup.remove_repeats(clashing(hard, "id", "hash", "runs", "kept")).collect()
    by = collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    n = len(LONG.encode())
    assert by[8][0].n_removed == n and by[8][0].n_spans == 1 and bytes(by[8][0].kept) == b""
    assert by[9][0].n_bytes == 600 and by[9][0].n_removed == 598  # a run of one character repeats itself from the next one on
    assert len(by[1]) == 3 and len(by[None]) == 2 and by[6][0].n_bytes == 0


def test_queues_in_portions_on_disk_sort_a_shard_above_their_memory(monkeypatch):
    monkeypatch.setattr(induced, "IN_MEMORY", 40)
    monkeypatch.setattr(induced, "PORTION", 7)
    spilled = []
    spill = induced.Queues.spill
    monkeypatch.setattr(induced.Queues, "spill", lambda self: (spilled.append(self.held), spill(self)))
    t = np.random.default_rng(3).integers(0, 3, 3000)
    t[1500:1600] = t[100:200]
    order, lcp = induced.suffixes(t, 50)
    raw = bytes(t.tolist())
    read = [raw[i : i + 50] for i in order]
    assert read == sorted(read) and sorted(order.tolist()) == list(range(len(t)))
    assert all(read[k][: lcp[k]] == read[k - 1][: lcp[k]] and read[k][lcp[k] : lcp[k] + 1] != read[k - 1][lcp[k] : lcp[k] + 1] or lcp[k] == 50 for k in range(1, len(t)))
    assert len(spilled) > 20 and max(spilled) <= 40 + 3000


# ---- language model ---------------------------------------------------------------------------------------------
def test_large_batches_of_short_texts(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "200000")
    try:
        df = spark.range(0, 70_000, 1, 1).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("").alias("text"))
        got = {r.n_tokens: r["count"] for r in hpylm.score_texts(df).groupBy("n_tokens").count().collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == {1: 70_000 - 23_334, 2: 23_334}


def test_scores_do_not_depend_on_how_hot_pairs_are_spread(spark):
    r = random.Random(5)
    rows = [(i, " ".join(["the", "end"] * r.randrange(3) + [f"w{r.randrange(300)}" for _ in range(r.randrange(12))])) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    total = lambda: {x.doc_id: x.score for x in hpylm.score_texts(df).collect()}
    before = spark.conf.get("spark.sql.shuffle.partitions")
    one = total()
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "13")
        many = total()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert abs(sum(many.values()) / sum(one.values()) - 1) < 0.01
    assert np.corrcoef([one[i] for i in range(1500)], [many[i] for i in range(1500)])[0, 1] > 0.995


def test_score_of_hard_rows(hard):
    rows = hpylm.score_texts(clashing(hard, "row", "id", "held", "word", "bucket")).collect()
    assert collections.Counter((r.doc_id, r.n_tokens) for r in rows)[(7, 150_001)] == 1
    assert len(rows) == 10 and all(r.score < 0 and np.isfinite(r.score) for r in rows)
    assert hpylm.score_texts(hard.where("doc_id < 0")).count() == 0


def seated_one_by_one(train, parent, discount, sweeps, rng):
    """Mean predictive probabilities of a restaurant by the sequential process: each customer is seated anew in turn."""
    tables = [[c] if c else [] for c in train]
    out = np.zeros(len(train))
    for sweep in range(sweeps):
        for d, c in enumerate(train):
            for _ in range(c):
                t = tables[d]
                k = rng.choice(len(t), p=np.array(t) / sum(t))
                t[k] -= 1
                if not t[k]:
                    t.pop(k)
                total = sum(map(len, tables))
                w = np.array([x - discount for x in t] + [(hpylm.STRENGTH + discount * total) * parent[d]])
                k = rng.choice(len(w), p=w / w.sum())
                if k == len(t):
                    t.append(1)
                else:
                    t[k] += 1
        if sweep >= sweeps // 10:
            n, total = sum(train), sum(map(len, tables))
            out += [(sum(t) - discount * len(t) + (hpylm.STRENGTH + discount * total) * p) / (hpylm.STRENGTH + n) for t, p in zip(tables, parent)]
    return out / (sweeps - sweeps // 10)


def test_seating_in_blocks_agrees_with_customers_one_by_one():
    train, discount = np.array([9, 4, 1, 1, 0, 0]), 0.6
    parent = np.array([0.3, 0.2, 0.1, 0.1, 0.2, 0.1])
    want = seated_one_by_one(train, parent, discount, 1200, np.random.default_rng(1))
    # Words without a customer take part with their parent's share; the mean is over many draws here.
    got = np.mean([hpylm.seat(train, np.array([0]), parent, np.array([train.sum()]), None, discount, np.random.default_rng(k), averaged=True)[1] for k in range(400)], 0)
    assert abs(want.sum() - 1) < 1e-9 and abs(got.sum() - 1) < 1e-9
    assert np.abs(got / want - 1).max() < 0.05


# ---- language ID ------------------------------------------------------------------------------------------------
DE = "der die das und nicht ist eine mit auf für werden haben straße schön können müssen".split()
EN = "the and not is with for have which would should could their there about people through".split()


def spoken(words, n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(words) for _ in range(n))


def test_switched_sequences_hold_the_same_words():
    cuts = np.array([0, 5, 6, 14, 20, 31, 40, 48])
    take, new = langid.switched(cuts)
    assert sorted(take.tolist()) == list(range(48)) and new[-1] == 48 and (np.diff(new) > 0).all()
    assert (np.diff(take) != 1).sum() > len(new) - 2  # some sequences go on elsewhere


def test_switches_inside_a_text_are_found(spark):
    rows = [(spoken(w, 60, 10 * k + j), lang) for k in range(20) for j, (w, lang) in enumerate(((DE, "de"), (EN, "en")))]
    model = langid.fit(rows)
    off = model.transitions[0, 1] - model.transitions[0, 0]
    assert -8 < off < 0  # a switch is rare, not impossible
    text = " ".join(spoken(w, 12, 90 + i) for i, w in enumerate((DE, EN, DE)))
    df = spark.createDataFrame([(1, text), (2, None), (2, None), (3, LONG)], "doc_id long, text string")
    out = {r.doc_id: r for r in langid.identify(df, model, words=True).collect()}
    want = ["de"] * 12 + ["en"] * 12 + ["de"] * 12
    assert sum(a == b for a, b in zip(out[1].word_langs, want)) >= 34
    assert out[2].lang_pred == "und" and len(out[3].word_langs) == 150_000


def test_sample_has_rare_languages_and_no_copies(spark):
    rows = [(f"common text {i}", "aa") for i in range(400)] + [("copied text", "aa")] * 300 + [(f"rare {i}", "zz") for i in range(3)] + [(LONG, "bb"), (None, "bb"), ("x", None)]
    got = langid.sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang", rows=30, chars=500)
    n = collections.Counter(lang for _, lang in got)
    assert n == {"aa": 10, "zz": 3, "bb": 1} and len(set(got)) == len(got)
    assert [len(t) for t, lang in got if lang == "bb"] == [500]


# ---- fingerprints -----------------------------------------------------------------------------------------------
def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def plain_likeness(a, b):
    (sa, x1, x2), (sb, y1, y2) = ([int(p[0]), p[1], p[2]] for p in (a.split(":"), b.split(":")))
    if a == b:
        return 1.0
    pairs = [(x1, y1)] + [(x2, y2)] * (len(x2) > 3 and len(y2) > 3) if sa == sb else [(x1, y2)] if sa == 2 * sb else [(x2, y1)] if sb == 2 * sa else []
    return max([1 - edit_distance(x, y) / max(1, len(x), len(y)) for x, y in pairs], default=0.0)


def test_likeness_equals_brute_force(spark):
    r = random.Random(4)
    words = [f"k{i}" for i in range(200)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randrange(0, 400)))) for i in range(40)] + [(40, None), (41, ""), (42, LONG[:200_000])]
    out = {x.doc_id: x for x in fingerprints.compare_with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, _ in rows:
        x = out[i]
        assert abs(x.near_edited - plain_likeness(x.fingerprint, x.edited_fingerprint)) < 1e-12
        assert abs(x.near_next - plain_likeness(x.fingerprint, out[(i + 1) % len(rows)].fingerprint)) < 1e-12


def test_signature_cuts_where_the_window_says_so():
    """Every byte's window is hashed alone; a chunk ends after a window whose hash is 0 modulo the block size."""
    from barloom.llm.common import mixed, powers, _VALUE

    raw = LONG[:3000].encode()
    buf = np.frombuffer(raw, np.uint8)
    (size, one, two), = fingerprints.signatures(buf, np.array([0, len(raw)]))
    p, q = powers(len(raw) + 1)

    def window(i):  # the hash of the WINDOW bytes that begin at i, from its own sum
        s = np.uint64(0)
        for k in range(i, i + fingerprints.WINDOW):
            s = s + _VALUE[buf[k]] * p[k]
        return int(mixed(np.array([s * q[i]], np.uint64))[0])

    with np.errstate(over="ignore"):
        ends = {k: [i + fingerprints.WINDOW for i in range(len(raw) - fingerprints.WINDOW) if window(i) % (1 << k) == 0] for k in (size, size + 1, size - 1)}
    assert len(one) == len(ends[size]) + 1 <= fingerprints.MOST and len(two) == len(ends[size + 1]) + 1
    assert len(ends[size - 1]) + 1 > fingerprints.MOST  # the size below would give too many


def test_fingerprints_of_hard_rows(hard):
    rows = fingerprints.compare_with_next(hard).collect()
    assert len(rows) == 10
    long = [r for r in rows if r.doc_id in (7, 8)]
    assert long[0].fingerprint == long[1].fingerprint and max(r.near_next for r in long) == 1.0


# ---- archive ----------------------------------------------------------------------------------------------------
def test_records_are_whole_and_dated(spark, tmp_path):
    rows = [(1, "u", "p" * 2000), (2, "u", "p" * 2000), (3, None, "a\r\n\r\nb"), (4, "u", None)]
    path = str(tmp_path / "a")
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    for r in warc.records(spark, path).collect():
        head, body = bytes(r.record).split(b"\r\n\r\n", 1)
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        html = (dict((i, h) for i, _, h in rows)[r.id] or "").encode()
        assert head.startswith(b"WARC/1.1\r\n") and fields["WARC-Date"] == warc.DATE and fields["WARC-Record-ID"] == f"<urn:page:{r.id}>"
        assert body == (b"" if r.id == 1 else html) + b"\r\n\r\n" and int(fields["Content-Length"]) == len(body) - 4
        assert fields["WARC-Payload-Digest"] == "sha1:" + hashlib.sha1(html).hexdigest() and r.verified


def test_a_payload_shared_by_many_records_is_spread(spark, monkeypatch):
    monkeypatch.setattr(warc, "RECORDS_A_COPY", 10)
    df = spark.range(205).select(F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 2 == 0, "same").otherwise(F.col("id").cast("string")).alias("html"))
    got = {r.page_id: (r.payload_bytes, r.record_type) for r in warc.archive_pages(df).collect()}
    assert got == {i: (4 if i % 2 == 0 else len(str(i)), "response") for i in range(205)}


def test_a_damaged_payload_is_refused(spark, tmp_path):
    path = str(tmp_path / "b")
    warc.write_archive(spark.createDataFrame([(1, "u", "good")], "page_id long, url string, html string"), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"evil"))
    bad = spark.createDataFrame(bad.collect(), bad.schema)
    bad.write.mode("overwrite").parquet(f"{path}/payloads")
    r = warc.records(spark, path).head()
    assert not r.verified


# ---- encoding ---------------------------------------------------------------------------------------------------
def test_encoding_of_hard_rows(hard):
    rows = bpe.encode(clashing(hard, "ids", "n_tokens", "id"), decoded=True).collect()
    assert len(rows) == 10 and {bytes(r.decoded).decode() for r in rows if r.doc_id in (7, 8)} == {LONG}
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (5, 6))
