"""Words whose letters are arranged so that polynomial hashes agree, hashes that are forced to agree, and rows that repeat many times."""

import collections
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.llm import bpe, common, exact_dedup, hpylm, jaccard, suffix_dedup, token_counts


def thue_morse(n, a, b):
    return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(n))


LETTERS = ["ab", "az", "mn"]
PAIRS = [(thue_morse(n, *x), thue_morse(n, *x[::-1])) for n in (512, 1024, 2048, 4096) for x in LETTERS]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(2 * i + k, w, "en") for i, pair in enumerate(PAIRS) for k, w in enumerate(pair)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_arranged_words_have_different_hashes():
    for pair in PAIRS:
        raw = [w.encode() for w in pair]
        buf = np.frombuffer(b"".join(raw), np.uint8)
        h = common.span_hashes(buf, np.array([0, len(raw[0])]), np.array([len(raw[0]), len(buf)]))
        assert h[0] != h[1]


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    rng = np.random.default_rng(1)
    buf = rng.integers(97, 100, 5000).astype(np.uint8)
    s = rng.integers(0, 4900, 4000)
    e = s + rng.integers(0, 20, 4000)
    of = collections.defaultdict(set)
    for x, y, h in zip(s, e, common.span_hashes(buf, s, e).tolist()):
        of[buf[x:y].tobytes()].add(h)
    assert all(len(v) == 1 for v in of.values()) and len({h for v in of.values() for h in v}) == len(of)


def test_bpe_and_lengths_of_arranged_words(docs):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    enc = tiktoken.Encoding("x", pat_str=tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(bpe.default_path()), special_tokens={})
    want = {r.doc_id: enc.encode_ordinary(r.text) for r in docs.collect()}
    got = bpe.encode(docs, decoded=True).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == want
    assert {bytes(r.decoded) for r in got} == {w.encode() for pair in PAIRS for w in pair}
    assert {r.doc_id: r.n_tokens for r in bpe.lengths(docs).collect()} == {i: len(x) for i, x in want.items()}


def test_bpe_tells_pre_tokens_of_one_hash_apart(monkeypatch):
    tiktoken, tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    ranks = bpe.read_ranks(bpe.default_path())
    enc = tiktoken.Encoding("x", pat_str=tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    monkeypatch.setattr(bpe, "span_hashes", lambda buf, s, e: (e - s).astype(np.uint64))
    own, texts = bpe.Encoder(bpe.Ranks(ranks)), ["some words have the same size here", "others as well", "some words"]
    for text in texts:
        buf = np.frombuffer(text.encode(), np.uint8)
        ids, before = own.encode(buf, np.array([0, len(buf)]))
        assert ids.tolist() == enc.encode_ordinary(text) and before.tolist() == [0, len(ids)]


def test_near_duplicates_of_arranged_words(docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: (1, i) for i in range(2 * len(PAIRS))}


def test_language_model_counts_arranged_words_apart(docs):
    held = hpylm.score_texts(docs).collect()
    assert all(r.n_known == (1 if r.held_out else 2) for r in held)


def test_suffix_dedup_of_arranged_words(docs):
    seen, want = set(), {}
    for r in sorted(docs.collect()):
        b, gone = r.text.encode(), np.zeros(len(r.text), bool)
        for k in range(len(b) - 99):
            gone[k : k + 100] |= b[k : k + 100] in seen
            seen.add(b[k : k + 100])
        want[r.doc_id] = (int(gone.sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    assert {r.doc_id: (r.n_removed, r.kept_sha256) for r in suffix_dedup.remove_repeats(docs, with_kept=False).collect()} == want


def test_near_duplicates_of_rows_that_repeat_many_times(spark):
    text = " ".join(f"w{i}" for i in range(60))
    two = spark.range(20_000).select((F.col("id") % 2).alias("doc_id"), F.when(F.col("id") % 2 == 0, text).otherwise(text + " more").alias("text"))
    got = jaccard.jaccard_components(two).groupBy("doc_id", "n_shingles", "component_id").count().collect()
    assert {tuple(r) for r in got} == {(0, 56, 0, 10_000), (1, 57, 0, 10_000)}
    assert jaccard.keep_one(two).select("doc_id").distinct().collect() == [(0,)]


def test_an_id_that_repeats_with_many_near_texts(spark):
    base = [f"w{i}" for i in range(80)]
    rows = [(i % 2, " ".join(base[:k] + ["x"] + base[k + 1 :])) for k in range(0, 80, 4) for i in range(2)]
    got = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == len(rows) and {r.component_id for r in got} == {0}


def test_copies_below_and_above_the_hot_share(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HOT_SHARE", 1 / 4)
    big = "x" * 20_000
    rows = spark.range(3000).select("id", F.when(F.col("id") % 5 == 0, F.lit(big)).when(F.col("id") % 2 == 0, F.lit("y")).otherwise(F.col("id").cast("string")).alias("text")).withColumnRenamed("id", "doc_id")
    index = exact_dedup.Index(rows)
    assert index.hot.count() == 1 and index.buckets.where("text is not null").count() == 0
    got = {r.keep_id: r.group_size for r in exact_dedup.exact_duplicates(rows).where("kept").collect()}
    assert got[2995] == 600 and got[2998] == 1200 and len(got) == 1202


def test_pairs_are_split_by_the_size_of_a_bucket(spark, monkeypatch):
    """A pair with a quarter of a bucket is split though it has less than 1 / 512 of all pairs; the table of pairs goes."""
    monkeypatch.setattr(hpylm, "BUCKET_PAIRS", 400)
    often = spark.range(150).select(F.col("id").alias("doc_id"), F.lit("same pair").alias("text"))
    rare = spark.range(150, 4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.concat(F.lit("w"), F.hash("id", F.lit(k)).cast("string")) for k in range(24)]).alias("text"))
    docs = often.unionByName(rare)
    words, pairs, n = hpylm._hot_words(docs.select("text"))
    assert n == 150 * 3 + 3850 * 25 and len(words) >= 1 and len(pairs) >= 1 and 150 / n < hpylm.HOT_SHARE
    got = hpylm.score_texts(docs).where("doc_id < 150").select("n_known", "score").distinct().collect()
    assert {r.n_known for r in got} == {3} and max(r.score for r in got) - min(r.score for r in got) < 1e-6
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("pairs_")]
