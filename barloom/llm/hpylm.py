"""A hierarchical Pitman-Yor language model of word pairs: seating sampled by Gibbs, predictive probabilities averaged.

Every word is a restaurant of the words that follow it. Its customers are the pairs seen in training; each of its tables
sends one customer to the parent, the one restaurant of single words that all of them share, whose tables send customers
to the uniform base. Words are 48-bit hashes inside the model (a parameter of precision, not of size).

All pairs of the corpus, with the texts they stand in, are dealt once to buckets by their first word; a word that begins
more than a share of all pairs is dealt by both words, and a pair that is itself such a share by the portion of texts as well.
A round of sampling exchanges, between buckets of pairs and buckets of words, a table count and a count of customers for
each word that a bucket has. Tables of the split words are added up over all buckets before every draw. A split pair is
known by all its customers in every bucket that has it, and drawn and counted in one of them.
"""

from __future__ import annotations

import functools
import math
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import SLICE_ROWS, discard, each_slice, from_planes, lowered, mixed, n_partitions, new_path, planes, release, remove, span_hashes, word_spans, written

#: Texts whose crc32 of the id leaves 0 when divided by FOLDS are held out.
FOLDS = 10
#: Exchanges between the levels, seatings drawn in each, and of the last exchange those that come before averaging.
ROUNDS, SWEEPS, BURN_IN = 2, 4, 1
STRENGTH = 1.0
#: Pairs of a bucket, pairs that a task gathers before it deals them out.
BUCKET_PAIRS, GATHER = 1_000_000, 600_000
#: A first word, or a pair, is split when it has a quarter of a bucket's pairs, or, so that their number stays bounded, the
#: lesser of these shares of all pairs; at most 1 / LEAST_SHARE words and as many pairs are split.
HOT_SHARE, LEAST_SHARE = 1 / 512, 1 / 65536
#: Texts of a portion; a text is known by its place in the portion, in two bytes.
PORTION = 1 << 15
assert PORTION + SLICE_ROWS <= 1 << 16
SLICE = 1 << 20
_END, _BEGIN = np.uint64(0x5DEECE66D5A10001), np.uint64(0x1B873593CC9E2D51)
_SMALL = 32


def pairs_of(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first words, second words, texts) of all pairs: each word and then the end, after the one before it or the begin."""
    low = lowered(buf)
    s, e, before = word_spans(low, offs)
    h = span_hashes(low, s, e)
    docs = len(offs) - 1
    n = np.diff(before)
    doc = np.repeat(np.arange(docs), n + 1)
    at = np.arange(len(h)) + np.repeat(np.arange(docs), n)
    first, second = np.empty(len(doc), np.uint64), np.empty(len(doc), np.uint64)
    first[before[:-1] + np.arange(docs)] = _BEGIN
    first[at + 1] = h
    second[at] = h
    second[before[1:] + np.arange(docs)] = _END
    return first >> np.uint64(16), second >> np.uint64(16), doc


def _pack(a: np.ndarray) -> bytes:
    """48-bit values in six bytes each."""
    return a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def _unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, 6)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :6] = raw
    return out.reshape(-1).view("<u8")


def _spread(h: np.ndarray, n: int) -> np.ndarray:
    """Buckets of 48-bit values by their range."""
    return (((h >> np.uint64(16)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _both(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 48-bit hash of pairs of words."""
    return (first ^ (second * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(16))) & np.uint64((1 << 48) - 1)


def _bucket(first: np.ndarray, second: np.ndarray, hot: np.ndarray, hot_pairs: np.ndarray, portion: int, n: int) -> np.ndarray:
    both = _both(first, second)
    salt = mixed(np.array([portion], np.uint64))[0] >> np.uint64(16)
    return _spread(np.where(np.isin(first, hot), np.where(np.isin(both, hot_pairs), both ^ salt, both), first), n)


def _ranked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique(x, return_inverse=True) where most values repeat: only the distinct ones are sorted."""
    coded = pa.array(x).dictionary_encode()
    values = coded.dictionary.to_numpy()
    order = np.argsort(values)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return values[order], rank[coded.indices.to_numpy()]


def _order(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """np.lexsort((b, a)) of numbers from 0, those of b below n: where both and the place fit in 64 bits, one plain sort."""
    size = len(a)
    bits = max(1, size).bit_length()
    if not size or (int(a.max()) + 1) * n >= 1 << (64 - bits):
        return np.lexsort((b, a))
    key = a.astype(np.uint64)
    key *= np.uint64(n)
    key += b.astype(np.uint64)
    key <<= np.uint64(bits)
    key |= np.arange(size, dtype=np.uint64)
    key.sort()
    key &= np.uint64((1 << bits) - 1)
    return key.view(np.int64)


def _gathered(batches: Iterator[pa.RecordBatch], with_rows: bool):
    """(first, second, text, rows) of about GATHER pairs at a time."""
    got, rows, many, docs = [], [], 0, 0
    for batch, buf, offs in each_slice(batches, "text", SLICE):
        a, b, d = pairs_of(buf, offs)
        got.append((a, b, (d + docs).astype(np.uint16)))
        docs += len(offs) - 1
        many += len(a)
        if with_rows:
            rows.append(batch.drop_columns(["text"]))
        if many >= GATHER or docs >= PORTION:
            yield (*(np.concatenate(x) for x in zip(*got)), pa.Table.from_batches(rows) if rows else None)
            got, rows, many, docs = [], [], 0, 0
    if got:
        yield (*(np.concatenate(x) for x in zip(*got)), pa.Table.from_batches(rows) if rows else None)


def _hot_words(docs: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """First words that are split, hashes of pairs that are split, and the number of pairs."""
    # A word and the space after it take about six bytes; the share only has to be of the right size.
    size = docs.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    share = min(HOT_SHARE, max(LEAST_SHARE, BUCKET_PAIRS / 4 / max(1, size / 6)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, _, _ in _gathered(batches, False):
            w, c = np.unique(a, return_counts=True)
            keep = c >= len(a) * share / 2
            p, m = np.unique(_both(a, b), return_counts=True)
            often = m >= len(a) * share / 2
            word = np.concatenate([w[keep].view(np.int64), p[often].view(np.int64), [-1]])
            kind = np.repeat([0, 1, 2], [keep.sum(), often.sum(), 1])
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(word), pa.array(np.concatenate([c[keep], m[often], [len(a)]]))], ["kind", "word", "n"])

    counted = docs.select("text").mapInArrow(run, "kind int, word long, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    counted = written(counted, "frequent")
    total = counted.where("kind = 2").head()
    if total is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), 0
    hot = counted.where((F.col("kind") < 2) & (F.col("n") >= share * total["n"])).collect()
    words, pairs = (np.array(sorted(r["word"] for r in hot if r["kind"] == k), np.int64).view(np.uint64) for k in (0, 1))
    return words, pairs, total["n"]


_DEALT = "bucket int, first binary, runs binary, second binary, train binary, uses binary, texts binary, size binary, who binary"
_BUCKET = "bucket int, first binary, runs binary, second binary, train binary, entry binary, uses binary, texts binary, size binary, who binary"
_SPLIT = "bucket int, words binary, sure binary, runs binary, customers binary, parent binary, number binary, of binary, split_parent binary, tables binary, split_tables binary"
_WHO = np.dtype([("row", "<i8"), ("id", "<i8"), ("held", "?")])
_SUMS = "row long, n_tokens binary, n_known binary, base_score binary, score binary"


def _deal(docs: DataFrame, hot: np.ndarray, hot_pairs: np.ndarray, n: int) -> DataFrame:
    """Distinct pairs of each portion of texts, with the texts that have them, by bucket.

    A portion is known by the number of its first row, a text by its place in the portion. Ids, and which texts are held
    out, go along with the portion's first bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for a, b, d, rows in _gathered(batches, True):
            row, held = rows["row"].to_numpy(), rows["held"].to_numpy()
            who = np.empty(len(row), _WHO)
            who["row"], who["id"], who["held"] = row, rows["id"].to_numpy(), held
            # A first word is the second word of the pair before it, or the begin.
            begin = _BEGIN >> np.uint64(16)
            words, second = _ranked(np.append(b, begin))
            first = np.where(a == begin, second[-1], np.roll(second[:-1], 1))
            second = second[:-1]
            order = _order(first, second, len(words))  # stable, so texts stay in order
            first, second, d = first[order], second[order], d[order]
            del order
            heads = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (second[1:] != second[:-1])]))
            uses = np.diff(np.append(heads, len(d)))
            train = np.add.reduceat((~held[d]).astype(np.int64), heads)
            ea, eb = words[first[heads]], words[second[heads]]
            ek = _bucket(ea, eb, hot, hot_pairs, int(row[0]), n)
            by = np.argsort(ek.astype(np.uint16) if n <= 1 << 16 else ek, kind="stable")
            ea, eb, ek, train, heads, uses = (x[by] for x in (ea, eb, ek, train, heads, uses))
            ends = np.append(0, np.cumsum(uses))
            d = d[np.repeat(heads - ends[:-1], uses) + np.arange(len(d))]
            cuts = np.searchsorted(ek, np.arange(n + 1))
            tcuts = ends[cuts]
            out = []
            for j in np.flatnonzero(np.diff(cuts)).tolist():
                x, t = slice(cuts[j], cuts[j + 1]), slice(tcuts[j], tcuts[j + 1])
                f = ea[x]
                fh = np.flatnonzero(np.concatenate([[True], f[1:] != f[:-1]]))
                size = np.array([row[0], len(row), cuts[j + 1] - cuts[j], tcuts[j + 1] - tcuts[j]], "<i8")
                out.append((j, _pack(f[fh]), np.diff(np.append(fh, len(f))).astype("<u4").tobytes(), _pack(eb[x]), train[x].astype("<u4").tobytes(), uses[x].astype("<u4").tobytes(), d[t].astype("<u2").tobytes(), size.tobytes(), b"" if out else who.tobytes()))
            for i in range(0, len(out), 8):
                cols = list(zip(*out[i : i + 8]))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.binary()) for c in cols[1:]]], [f.split()[0] for f in _DEALT.split(", ")])

    return docs.mapInArrow(run, _DEALT)


def _merge(table: pa.Table) -> pa.Table:
    """One row for a bucket: its distinct pairs in order with their training counts, and for each portion which of them
    it has and in which of its texts."""
    column = lambda x: table[x].to_pylist()
    firsts, a = _ranked(np.concatenate([_unpack(x) for x in column("first")]))
    a = np.repeat(a, np.frombuffer(b"".join(column("runs")), "<u4"))
    seconds, b = _ranked(np.concatenate([_unpack(x) for x in column("second")]))
    order = _order(a, b, len(seconds)).astype(np.int32)
    a, b = a[order], b[order]
    new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])
    entry = np.empty(len(a), np.int32)
    entry[order] = np.cumsum(new, dtype=np.int32) - 1
    heads = np.flatnonzero(new)
    ea, eb = firsts[a[heads]], seconds[b[heads]]
    del a, b
    counts = np.add.reduceat(np.frombuffer(b"".join(column("train")), "<u4")[order], heads, dtype=np.int64)
    fh = np.flatnonzero(np.concatenate([[True], ea[1:] != ea[:-1]]))
    one = {
        "first": _pack(ea[fh]),
        "runs": np.diff(np.append(fh, len(ea))).astype("<u4").tobytes(),
        "second": _pack(eb),
        "train": planes(counts),
        "entry": np.diff(entry, prepend=0).astype("<i4").tobytes(),
        **{x: b"".join(column(x)) for x in ("uses", "texts", "size", "who")},
    }
    return pa.table({"bucket": pa.array([table["bucket"][0].as_py()], pa.int32()), **{k: pa.array([v], pa.binary()) for k, v in one.items()}})


def _pairs(r: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first words, pairs of each, second words, training counts) of a bucket."""
    second = _unpack(r["second"])
    return _unpack(r["first"]), np.frombuffer(r["runs"], "<u4").astype(np.int64), second, from_planes(r["train"], len(second))


# ---- seating ----------------------------------------------------------------------------------------------------
@functools.lru_cache(maxsize=8)
def _arrangements(discount: float, most: int = _SMALL) -> np.ndarray:
    """Logarithms of the weights of c customers at t tables (generalised Stirling numbers), c and t from 0 to most."""
    s = np.zeros((most + 1, most + 1))
    s[1, 1] = 1
    for c in range(1, most):
        for t in range(1, c + 2):
            s[c + 1, t] = s[c, t - 1] + (c - discount * t) * s[c, t]
    with np.errstate(divide="ignore"):
        return np.log(s)


def sample_tables(customers: np.ndarray, opens: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables at which the customers of each dish sit, drawn given everything else.

    opens: (strength + discount * tables of the restaurant) * probability of the dish at the parent. Up to _SMALL
    customers are seated anew all at once, from the exact conditional over arrangements; the others of a dish follow in
    portions of a quarter, each opening tables at the rate that holds when it comes.
    """
    t = np.minimum(customers, 1)
    weights = _arrangements(discount)
    start = np.minimum(customers, _SMALL)
    order = np.argsort(start.astype(np.uint8), kind="stable")
    cuts = np.cumsum(np.bincount(start, minlength=_SMALL + 1))
    for c in range(2, _SMALL + 1):
        k = order[cuts[c - 1] : cuts[c]]
        if len(k):
            w = weights[c, 1 : c + 1, None] + np.arange(c)[:, None] * np.log(opens[k])
            w = np.exp(w - w.max(0)).cumsum(0)
            t[k] = 1 + (w < rng.random(len(k)) * w[-1]).sum(0)
    k = np.flatnonzero(customers > _SMALL)
    n = start[k]
    while len(k):
        more = np.minimum(np.maximum(1, n // 4), customers[k] - n)
        rate = opens[k] / (opens[k] + np.maximum(n + more / 2 - discount * t[k], 1e-9))
        t[k] += rng.binomial(more, np.minimum(rate, 1.0))
        n = n + more
        live = n < customers[k]
        k, n = k[live], n[live]
    return t


def seat(train: np.ndarray, heads: np.ndarray, parent: np.ndarray, seats: np.ndarray | None, totals: list[np.ndarray] | None, discount: float, rng, draws: int = SWEEPS, averaged: bool = False, split: tuple = ((), ()), begin: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(tables of each pair after the last draw, mean probability of each pair if averaged).

    Pairs of a restaurant lie together and begin at heads; parent is the probability of each pair's second word at the
    parent, seats the customers of each restaurant. totals has the tables of each restaurant before the first draw, after
    it and so on; None if all pairs of the restaurants are here. Given totals, a draw depends on no other one: those before
    begin are left out, and rng is a function of the draw. split: places of pairs that are not drawn here, and their tables
    after each draw."""
    owner = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(train))))
    tables = np.minimum(train, 1)
    if not len(train):
        return tables, np.zeros(0)
    # Pairs of one customer have one table, whatever is drawn.
    at, known = np.asarray(split[0], np.int64), split[1]
    some = np.flatnonzero((train > 1) & ~np.isin(np.arange(len(train)), at))
    customers, of, share = train[some], owner[some], parent[some]
    whole = np.bincount(owner, tables, len(heads))
    sure = whole - np.bincount(of, minlength=len(heads))
    many, opened = np.zeros(len(some)), np.zeros(len(heads))
    for step in range(begin, draws):
        before = whole if totals is None else totals[step]
        opens = (STRENGTH + discount * before)[of] * share
        drawn = sample_tables(customers, opens, discount, rng(step) if callable(rng) else rng)
        if totals is None:
            whole = sure + np.bincount(of, drawn, len(heads))
        if averaged and step >= BURN_IN:
            many += drawn
            opened += whole if totals is None else totals[step + 1]
    if draws > begin:
        tables[some] = drawn
        tables[at] = known[draws - 1] if len(at) else 0
    if not averaged:
        return tables, np.zeros(0)
    mean = np.minimum(train, 1).astype(float)
    mean[some] = many / (draws - BURN_IN)
    mean[at] = np.mean(known[BURN_IN:draws], 0) if len(at) else 0
    return tables, ((train - discount * mean) + (STRENGTH + discount * opened / (draws - BURN_IN))[owner] * parent) / (STRENGTH + seats)[owner]


def _words_out(bucket: int, w: np.ndarray, word: np.ndarray, train: np.ndarray, tables: np.ndarray, n: int) -> pa.RecordBatch:
    """What a bucket of pairs tells the buckets of words: of each of its second words w, in order, uses in training and
    tables. word: place of each pair's second word."""
    c, t = (np.bincount(word, x, len(w)).astype(np.int64) for x in (train, tables))
    cuts = np.searchsorted(_spread(w, n), np.arange(n + 1))
    k = np.flatnonzero(np.diff(cuts)).tolist()
    part = lambda x, how: pa.array([how(x[cuts[i] : cuts[i + 1]]) for i in k], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array([bucket] * len(k), pa.int32()), part(w, _pack), part(c, planes), part(t, planes)], ["to", "bucket", "words", "uses", "tables"])


_WORDS = "to int, bucket int, words binary, uses binary, tables binary"
_REPLY = "bucket int, to int, mass binary, uses binary, known long, customers long, open long, total long"


def _parent(discount: float, seed: int):
    """A range of the parent restaurant: seats its customers and tells every bucket that asked what its words have."""

    def run(table: pa.Table) -> pa.Table:
        asked = [_unpack(x) for x in table["words"].to_pylist()]
        words, which = _ranked(np.concatenate(asked))
        sent = lambda c: np.concatenate([from_planes(x, len(w)) for x, w in zip(table[c].to_pylist(), asked)])
        add = lambda c: np.bincount(which, sent(c), len(words)).astype(np.int64)
        uses, customers = add("uses"), add("tables")
        rng = np.random.default_rng([seed, table["to"][0].as_py()])
        seats, mean = np.minimum(customers, 1), np.zeros(len(words))
        known = (uses > 0).sum()
        for step in range(SWEEPS):
            opens = (STRENGTH + discount * max(1, seats.sum())) / max(1, known)
            seats = sample_tables(customers, np.full(len(words), max(opens, 1e-9)), discount, rng)
            if step >= BURN_IN:
                mean += seats / (SWEEPS - BURN_IN)
        mass = (customers - discount * mean).astype("<f4")
        cuts = np.cumsum([0, *map(len, asked)])
        cut = lambda x, how: pa.array([how(x[which[a:b]]) for a, b in zip(cuts[:-1], cuts[1:])], pa.binary())
        first = np.arange(len(asked)) == 0  # the sums of the range, once
        return pa.table(
            {"bucket": table["bucket"], "to": table["to"], "mass": cut(mass, lambda x: x.tobytes()), "uses": cut(uses, planes)}
            | {k: pa.array(np.where(first, int(round(v)), 0)) for k, v in (("known", known), ("customers", customers.sum()), ("open", mean.sum()), ("total", uses.sum()))}
        )

    return run


def _hot_rows(first: np.ndarray, sizes: np.ndarray, tables: np.ndarray, hot: np.ndarray) -> list[tuple[int, int, int]]:
    k = np.flatnonzero(np.isin(first, hot))
    return [(int(first[i]), int(sizes[i]), int(tables[i])) for i in k]


def score_texts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row: id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity.

    Tokens of a text are its words, A-Z lower-cased, and an end. score is the model's log10 probability of the text,
    perplexity that per token; base_score that of smoothed single-word counts. The model learns from the rows that are
    not held out. Null and empty texts have the end alone. A null id counts as the empty text when folds are dealt;
    rows that repeat an id are scored each, and learnt from each. No rows give no rows. Texts of any length are scored
    whole; columns other than the two are not read, so their names cannot clash. The result is a table in the shared
    folder, as the table of pairs is dropped when it is made.
    """
    spark = docs.sparkSession
    name, path = f"pairs_{uuid.uuid4().hex}", new_path(spark, "pairs")
    try:
        return _scores(docs, id_column, text_column, name, path)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove(spark, path)


def _scores(docs: DataFrame, id_column: str, text_column: str, name: str, path: str) -> DataFrame:
    """score_texts() with a table of pairs of this name, whose files lie at path."""
    spark = docs.sparkSession
    held = F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0
    kind = docs.schema[id_column].dataType
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.coalesce(F.col(id_column).cast("long"), F.lit(-(2**63))).alias("id"), held.alias("held"), F.col(text_column).cast("string").alias("text"))
    hot, hot_pairs, pairs = _hot_words(rows)
    n = max(n_partitions(spark), math.ceil(pairs / BUCKET_PAIRS))

    # One row for each bucket, in files of its own, so that later rounds join the table where it lies.
    merged = _deal(rows, hot, hot_pairs, n).groupBy("bucket").applyInArrow(_merge, _BUCKET)
    merged.write.bucketBy(n, "bucket").option("compression", "zstd").option("path", path).saveAsTable(name)
    del merged
    release(spark)
    table = spark.table(name)

    light = table.select("bucket", "first", "runs", "second", "train")

    def split_pairs(r: dict, first: np.ndarray, runs: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(places, numbers) of the split pairs that a bucket has."""
        if not len(hot_pairs):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = _both(np.repeat(first, runs), second)
        at = np.flatnonzero(np.isin(both, hot_pairs))
        return at, np.searchsorted(hot_pairs, both[at])

    def of_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                first, runs, second, train = _pairs(r)
                at, number = split_pairs(r, first, runs, second)
                yield pa.RecordBatch.from_arrays([pa.array(number), pa.array(train[at]), pa.array(np.full(len(at), r["bucket"], np.int64))], ["number", "customers", "bucket"])

    # Of each split pair its customers, and the one bucket that counts it.
    pair_customers, pair_bucket = np.zeros(len(hot_pairs), np.int64), np.zeros(len(hot_pairs), np.int64)
    if len(hot_pairs):
        for r in light.mapInArrow(of_pairs, "number long, customers long, bucket long").groupBy("number").agg(F.sum("customers").alias("c"), F.min("bucket").alias("b")).collect():
            pair_customers[r["number"]], pair_bucket[r["number"]] = r["c"], r["b"]

    def known_pairs(r: dict):
        """(first words, pairs of each, second words, customers with all those of split pairs, places and numbers of these,
        and whether each pair counts here)."""
        first, runs, second, train = _pairs(r)
        at, number = split_pairs(r, first, runs, second)
        train = train.copy()
        train[at] = pair_customers[number]
        counts = np.ones(len(train), bool)
        counts[at] = pair_bucket[number] == r["bucket"]
        return first, runs, second, train, (at, number), counts

    def seat_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                _, _, second, train, _, counts = known_pairs(r)
                yield _words_out(r["bucket"], *np.unique(second, return_inverse=True), train * counts, np.minimum(train, 1) * counts, n)

    def hot_stats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the split first words their customers and tables; under -1 and -2 how many pairs were seen once and twice."""
        for b in batches:
            for r in b.to_pylist():
                first, runs, _, train, _, counts = known_pairs(r)
                heads, train = np.cumsum(runs) - runs, train * counts
                out = _hot_rows(first, np.add.reduceat(train, heads), np.add.reduceat(np.minimum(train, 1), heads), hot)
                out += [(-1, int((train == 1).sum()), 0), (-2, int((train == 2).sum()), 0)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*out)], ["word", "customers", "tables"])

    stats = {r["word"]: (r["c"], r["t"]) for r in light.mapInArrow(hot_stats, "word long, customers long, tables long").groupBy("word").agg(F.sum("customers").alias("c"), F.sum("tables").alias("t")).collect()}
    once, twice = stats.get(-1, (0, 0))[0], stats.get(-2, (0, 0))[0]
    discount = min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5
    customers_of, tables_of = (np.array([stats.get(w, (0, 0))[x] for w in hot.view(np.int64).tolist()], float) for x in (0, 1))

    def answered(round_: int, asked: DataFrame) -> tuple[DataFrame, tuple[int, int, float, int]]:
        replies = written(asked.groupBy("to").applyInArrow(_parent(discount, round_), _REPLY), "replies")
        release(spark)
        t = replies.agg(*[F.sum(x) for x in ("known", "customers", "open", "total")]).head()
        got = replies.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("to", "mass", "uses"))).alias("answers"))
        return got, tuple(x or 0 for x in t)

    def opened(r: dict, sums: tuple):
        """A bucket: (distinct second words, training counts, whether each pair counts here, place of each pair's word among
        the bucket's, their uses, probability of each pair's second word at the parent, and of the split and of the other
        first words: pairs, heads, words, and the split pairs among them)."""
        known, customers, open_, _ = sums
        first, runs, second, train, split, counts = known_pairs(r)
        mass = np.frombuffer(b"".join(x["mass"] for x in r["answers"]), "<f4").astype(float)
        uses = np.concatenate([from_planes(x["uses"], len(x["mass"]) // 4) for x in r["answers"]])
        words, word = np.unique(second, return_inverse=True)
        parent = ((mass + (STRENGTH + discount * open_) / (known + 1)) / (STRENGTH + customers))[word]
        parts, often = [], np.isin(first, hot)
        for k in (often, ~often):
            mine = runs[k]
            pairs = np.flatnonzero(np.repeat(k, runs))
            parts.append((pairs, np.cumsum(mine) - mine, first[k], (np.searchsorted(pairs, split[0]), split[1])))
        return words, train, counts, word, uses, parent, parts

    def seat_split(bucket: int, train: np.ndarray, heads: np.ndarray, parent: np.ndarray, words: np.ndarray, split: tuple, totals: list[np.ndarray], seed: int, begin: int, draws: int, averaged: bool = False):
        """Pairs of split words in a bucket. Draws are the same ones whenever they are made again, also without the pairs
        that have one customer or none and without the split pairs."""
        at = np.searchsorted(hot, words)
        rng = lambda step: np.random.default_rng([seed, bucket, 1, step])
        return seat(train, heads, parent, customers_of[at], [t[at] for t in totals], discount, rng, draws, averaged, split, begin)

    def tables_now(r: dict, totals: list[np.ndarray], seed: int) -> tuple[np.ndarray, np.ndarray]:
        """Tables that a bucket's split words, and the split pairs that count in it, have after the draw that follows totals."""
        words, number = _unpack(r["words"]), np.frombuffer(r["number"], "<i8")
        sure, runs, parent = from_planes(r["sure"], len(words)), from_planes(r["runs"], len(words)), np.frombuffer(r["parent"], "<f8")
        drawn, _ = seat_split(r["bucket"], from_planes(r["customers"], len(parent)), np.cumsum(runs) - runs, parent, words, ((), ()), totals, seed, len(totals) - 1, len(totals))
        of = np.frombuffer(r["of"], "<i8")
        opens = (STRENGTH + discount * totals[-1][np.searchsorted(hot, words)][of]) * np.frombuffer(r["split_parent"], "<f8")
        pairs = sample_tables(pair_customers[number], opens, discount, np.random.default_rng([seed, r["bucket"], 2, len(totals) - 1]))
        return sure + sum(np.bincount(k, x, len(words)).astype(np.int64) for k, x in ((np.repeat(np.arange(len(words)), runs), drawn), (of, pairs))), pairs

    def split_tables(joined: DataFrame, sums: tuple, seed: int, draws: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Tables of the split words over all buckets before the first draw and after each of the next ones, and tables of the
        split pairs after each: between two draws the buckets' tables are added up, so that each draw knows the restaurants'
        whole numbers. What the draws need is written once, with the tables after the first; a draw is made from it without
        those before. A split pair is drawn by the bucket that counts it."""
        totals, of_pairs = [tables_of], []
        if not len(hot):
            return totals * (draws + 1), [np.zeros(0, np.int64)] * draws

        def prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    _, train, counts, _, _, parent, (part, _) = opened(r, sums)
                    pairs, heads, words, (at, number) = part
                    if not len(pairs):
                        continue
                    train, parent, counts = train[pairs], parent[pairs], counts[pairs]
                    some, sure = train > 1, np.minimum(train, 1)
                    some[at], sure[at] = False, 0
                    sure[some] = 0
                    at, number = at[counts[at]], number[counts[at]]
                    one = {
                        "bucket": r["bucket"],
                        "words": _pack(words),
                        "sure": planes(np.add.reduceat(sure, heads)),
                        "runs": planes(np.add.reduceat(some.astype(np.int64), heads)),
                        "customers": planes(train[some]),
                        "parent": parent[some].astype("<f8").tobytes(),
                        "number": number.astype("<i8").tobytes(),
                        "of": (np.searchsorted(heads, at, "right") - 1).astype("<i8").tobytes(),
                        "split_parent": parent[at].astype("<f8").tobytes(),
                    }
                    one |= zip(("tables", "split_tables"), map(planes, tables_now(one, [tables_of], seed)))
                    yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32() if k == "bucket" else pa.binary()) for k, v in one.items()], list(one))

        kept = written(joined.mapInArrow(prepare, _SPLIT), "split")
        while len(totals) <= draws:

            def count(batches: Iterator[pa.RecordBatch], totals=tuple(totals)) -> Iterator[pa.RecordBatch]:
                for b in batches:
                    for r in b.to_pylist():
                        words, number = _unpack(r["words"]), np.frombuffer(r["number"], "<i8")
                        if len(totals) == 1:
                            got = from_planes(r["tables"], len(words)), from_planes(r["split_tables"], len(number))
                        else:
                            got = tables_now(r, totals, seed)
                        kind = np.repeat([0, 1], [len(words), len(number)])
                        yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(np.concatenate([words.view(np.int64), number])), pa.array(np.concatenate(got))], ["kind", "word", "tables"])

            read = kept.select("words", "number", "tables", "split_tables") if len(totals) == 1 else kept.drop("tables", "split_tables")
            got = read.mapInArrow(count, "kind int, word long, tables long").groupBy("kind", "word").agg(F.sum("tables").alias("t")).collect()
            release(spark)
            now, now_pairs = np.zeros(len(hot)), np.zeros(len(hot_pairs), np.int64)
            kind, word, t = (np.array([x[c] for x in got], np.int64) for c in ("kind", "word", "t"))
            now[np.searchsorted(hot, word[kind == 0].view(np.uint64))] = t[kind == 0]
            now_pairs[word[kind == 1]] = t[kind == 1]
            totals.append(now)
            of_pairs.append(now_pairs)
        discard(kept)
        return totals, of_pairs

    def seated(r: dict, sums: tuple, seed: int, totals: tuple[list[np.ndarray], list[np.ndarray]], averaged: bool = False):
        """Draws the seating of a bucket SWEEPS times: (distinct second words, place of each pair's among them, training
        counts, tables, mean probability of each pair, uses of its second word); a split pair has counts and tables in one
        bucket."""
        words, train, counts, word, uses, parent, (split, rest) = opened(r, sums)
        tables, mean = np.zeros(len(train), np.int64), np.zeros(len(train) if averaged else 0)
        k, heads, *_ = rest
        whole = np.add.reduceat(train[k], heads).astype(float) if len(k) else np.zeros(0)
        got = [seat(train[k], heads, parent[k], whole, None, discount, np.random.default_rng([seed, r["bucket"]]), SWEEPS, averaged)]
        k, heads, often, (at, number) = split
        known = (at, [t[number] for t in totals[1]])
        got.append(seat_split(r["bucket"], train[k], heads, parent[k], often, known, totals[0], seed, BURN_IN if averaged else SWEEPS - 1, SWEEPS, averaged))
        for (pairs, *_), (t, m) in zip((rest, split), got):
            tables[pairs] = t
            if averaged:
                mean[pairs] = m
        return words, word, train * counts, tables * counts, mean, uses[word]

    def again(sums: tuple, seed: int, totals: tuple[list[np.ndarray], list[np.ndarray]]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for r in b.to_pylist():
                    words, word, train, tables, *_ = seated(r, sums, seed, totals)
                    yield _words_out(r["bucket"], words, word, train, tables, n)

        return run

    replies, sums = answered(0, light.mapInArrow(seat_first, _WORDS))
    for i in range(1, ROUNDS):
        joined = light.join(replies, "bucket")
        replies, sums = answered(i, joined.mapInArrow(again(sums, i, split_tables(joined, sums, i, SWEEPS)), _WORDS))
    totals = split_tables(light.join(replies, "bucket"), sums, ROUNDS, SWEEPS)
    known, _, _, total = sums

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums over a bucket's pairs for every text of a portion: a row for each portion that it has pairs of."""
        for b in batches:
            for r in b.to_pylist():
                *_, mean, uses = seated(r, sums, ROUNDS, totals, True)
                log_p = np.log10(mean)
                log_base = np.log10((uses + 0.1) / (total + 0.1 * (known + 1)))
                seen = (uses > 0).astype(float)
                entries, times, texts = np.cumsum(np.frombuffer(r["entry"], "<i4").astype(np.int64)), np.frombuffer(r["uses"], "<u4"), np.frombuffer(r["texts"], "<u2")
                i = j = 0
                out = []
                for row, m, de, dt in np.frombuffer(r["size"], "<i8").reshape(-1, 4).tolist():
                    each, text = np.repeat(entries[i : i + de], times[i : i + de]), texts[j : j + dt]
                    out.append((row, *[np.bincount(text, x, m).astype(k).tobytes() for x, k in ((None, "<u4"), (seen[each], "<u4"), (log_base[each], "<f4"), (log_p[each], "<f4"))]))
                    i, j = i + de, j + dt
                for a in range(0, len(out), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if q == 0 else pa.binary()) for q, c in enumerate(zip(*out[a : a + 256]))], [x.split()[0] for x in _SUMS.split(", ")])

    def add_up(table: pa.Table) -> pa.Table:
        # A bucket's sums are sent in single precision (a relative error of 1e-8 of a text's score) and added in double.
        add = lambda c, k: sum(np.frombuffer(x, k).astype(float) for x in table[c].to_pylist())
        n = add("n_tokens", "<u4").astype(np.int64)
        row = table["row"][0].as_py() + np.arange(len(n))
        return pa.table({"row": row, "n_tokens": n, "n_known": add("n_known", "<u4").astype(np.int64), "base_score": add("base_score", "<f4"), "score": add("score", "<f4")})

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for x in b.column(0).to_pylist():
                who = np.frombuffer(x, _WHO)
                yield pa.RecordBatch.from_arrays([pa.array(who[c].copy()) for c in ("row", "id", "held")], ["row", "id", "held"])

    names = table.select("who").mapInArrow(named, "row long, id long, held boolean")
    partial = table.drop("who").join(replies, "bucket").mapInArrow(score, _SUMS)
    out = partial.groupBy("row").applyInArrow(add_up, "row long, n_tokens long, n_known long, base_score double, score double")
    out = out.join(names, "row")
    out = out.select(
        F.when(F.col("id") != -(2**63), F.col("id")).cast(kind).alias(id_column),
        F.col("held").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(sums[3]).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )
    return written(out, "scores")
