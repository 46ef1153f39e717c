"""N-gram Jaccard join: prefixes under several global orders of the tokens must all meet before a pair is verified.

All orders put rare tokens first and break ties by hashes of their own. Sets are dealt by the tokens of their prefix under
the first order. A token that many prefixes have is common, whatever its estimated count says: the sets that it holds
together are dealt once more among themselves, with such tokens moved to the end of every order. What then still meets
in large groups goes through a pivot, and what pivots leave apart is compared block by block inside tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import discard, doc_of, each_slice, from_planes, lowered, mixed, n_partitions, planes, release, signed, span_hashes, word_spans, written
from barloom.llm.components import components

#: Words of a shingle, and the least likeness in percent.
WORDS, PERCENT = 5, 80
#: log2 of the counters that estimate how many documents have a token, for each global order. Fixed sizes: the orders only
#: have to put what is common last, and a token's share shows against the others that fall into its counter at any size.
COUNTERS = (22, 18, 18)
#: Up to so many documents of one prefix token, each two are compared at once; larger groups are dealt again with their
#: token moved to the end of the orders, so many times, and what is left goes through a pivot.
SMALL, ROUNDS = 24, 1
#: Documents of a block, when those of a group that pivots leave apart are compared block by block.
BLOCK = 1024
#: log2 of the bits of the filters that tell common tokens and pick texts before anything is shuffled, from and to (32 MB
#: at most), and tokens of a bucket.
LEAST_BITS, MOST_BITS, BUCKET_TOKENS = 20, 28, 1 << 21
SLICE = 1 << 20
_SHORT = (1 << 40) - 1

_PLACE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


def shingle_sets(buf: np.ndarray, offs: np.ndarray, words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(tokens end to end, ascending and distinct within a text; tokens before each text).

    A token is a 64-bit hash of `words` words in a row, A-Z lower-cased; a text with fewer words has its whole sequence
    as one token, a text without words has none."""
    low = lowered(buf)
    s, e, before = word_spans(low, offs)
    h = span_hashes(low, s, e)
    n = np.diff(before)
    doc = doc_of(before)
    m = max(0, len(h) - words + 1)
    t = np.zeros(m, np.uint64)
    for k in range(words):
        t += h[k : k + m] * _PLACE[k % len(_PLACE)] * np.uint64(2 * (k // len(_PLACE)) + 1)
    whole = np.flatnonzero(doc[:m] == doc[words - 1 :]) if m else np.zeros(0, np.int64)
    tokens, owner = mixed(t[whole] if m else t), doc[whole]
    few = np.flatnonzero((n > 0) & (n < words))
    if len(few):
        at = np.concatenate([np.arange(before[i], before[i + 1]) for i in few])
        place = np.concatenate([np.arange(n[i]) for i in few])
        v = np.add.reduceat(h[at] * _PLACE[place % len(_PLACE)], np.cumsum(n[few]) - n[few])
        tokens = np.concatenate([tokens, mixed(v + n[few].astype(np.uint64) * np.uint64(0x2127599BF4325C37))])
        owner = np.concatenate([owner, few])
    order = np.lexsort((tokens, owner))
    tokens, owner = tokens[order], owner[order]
    if len(tokens):
        new = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])])
        tokens, owner = tokens[new], owner[new]
    return tokens, np.searchsorted(owner, np.arange(len(offs)))


def _salted(tokens: np.ndarray, order: int) -> np.ndarray:
    return mixed(tokens ^ _PLACE[order])


def _short(tokens: np.ndarray) -> np.ndarray:
    """The part of a token by which it is known within a range of tokens: the lower 40 of its upper 48 bits."""
    return ((tokens >> np.uint64(16)) & np.uint64(_SHORT)).astype(np.int64)


def prefixes(tokens: np.ndarray, before: np.ndarray, order: int, orders: list, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(first tokens of each set in the given global order end to end, tokens before each).

    Sets with |a and b| * 100 >= percent * |a or b| share one of the first n - ceil(n * percent / 100) + 1 tokens under
    any order. Tokens that are known as common (orders[3], a bit filter, if any) come last; before them the order is by
    estimated document count, then by hash."""
    n = np.diff(before)
    owner = doc_of(before)
    h = _salted(tokens, order)
    rank = orders[order][(h >> np.uint64(64 - COUNTERS[order])).astype(np.int64)].astype(np.int16)
    if orders[3] is not None:
        rank[passes(orders[3], _short(tokens))] += 256
    seq = np.lexsort((h, rank, owner))
    take = np.where(n > 0, n - -(-n * percent // 100) + 1, 0)
    place = np.arange(len(tokens)) - np.repeat(before[:-1], n)
    return tokens[seq[place < np.repeat(take, n)]], np.concatenate([[0], np.cumsum(take)])


def _blobs(values: np.ndarray, before: np.ndarray) -> pa.Array:
    """Rows of bytes or of numbers, cut into binary values."""
    raw, b = values.tobytes(), (before * (values.size * values.itemsize // max(1, len(values)))).tolist()
    return pa.array([raw[x:y] for x, y in zip(b[:-1], b[1:])], pa.binary())


def _six(values: np.ndarray) -> np.ndarray:
    """The upper 48 bits of tokens, as rows of six bytes."""
    return np.ascontiguousarray((values >> np.uint64(16)).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6])


def _from_six(raw: bytes) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.reshape(-1).view("<u8")


def _digests(tokens: np.ndarray, before: np.ndarray) -> list[np.ndarray]:
    """Sizes of sets, and the two halves of a digest of each."""
    n = np.diff(before)
    full = np.flatnonzero(n)
    digest = np.zeros((2, len(n)), np.uint64)
    for j in range(2):
        if len(full):
            digest[j, full] = np.add.reduceat(_salted(tokens, 3 + j), before[full])
    digest[1] += n.astype(np.uint64)
    return [n, signed(digest[0]), signed(digest[1])]


def _input(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text"))


def count_tokens(docs: DataFrame) -> list[np.ndarray]:
    """For each order, how many documents have a token that falls into each counter: over all documents, of fixed size."""
    blocks, width = 64, [1 << (b - 6) for b in COUNTERS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << b, np.uint32) for b in COUNTERS]
        for _, buf, offs in each_slice(batches, "text", SLICE):
            tokens, _ = shingle_sets(buf, offs)
            for k, c in enumerate(counts):
                np.add.at(c, (_salted(tokens, k) >> np.uint64(64 - COUNTERS[k])).astype(np.int64), np.uint32(1))
        # Bytes of one weight side by side: most high ones are 0 and compress away in the shuffle.
        rows = [(k * blocks + i, c[i * w : (i + 1) * w].view(np.uint8).reshape(-1, 4).T.tobytes()) for k, (c, w) in enumerate(zip(counts, width)) for i in range(blocks) if c.any()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum((np.frombuffer(x, np.uint8).reshape(4, -1).astype(np.int64) << np.array([[0], [8], [16], [24]])).sum(0) for x in table["counts"].to_pylist())
        # Only the order of sizes matters: rough steps keep it and make the broadcast a byte a counter.
        step = np.minimum(255, np.round(8 * np.log2(1 + total))).astype(np.uint8)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "counts": pa.array([step.tobytes()], pa.binary())})

    got = docs.select("text").mapInArrow(run, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, counts binary").collect()
    out = [np.zeros(1 << b, np.uint8) for b in COUNTERS]
    for r in got:
        k, i = divmod(r["block"], blocks)
        out[k][i * width[k] : (i + 1) * width[k]] = np.frombuffer(r["counts"], np.uint8)
    return out


# ---- bit filters of bounded size --------------------------------------------------------------------------------
def _places(values: np.ndarray, bits: int) -> np.ndarray:
    return (_salted(values.view(np.uint64), 5) >> np.uint64(64 - bits)).astype(np.int64)


def bit_filter(values: DataFrame, rows: int, of=lambda batch: batch.column(0).to_numpy()) -> np.ndarray:
    """Packed bits in which each value (one long column, or what `of` makes of a batch) has one set: 16 bits a value,
    2^MOST_BITS at most.

    What it lets by without being a value is dropped by a join later, or is only put later in the orders, so its size
    decides on work and never on results."""
    bits = min(MOST_BITS, max(LEAST_BITS, math.ceil(math.log2(16 * max(1, rows)))))

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, np.ndarray] = {}
        for b in batches:
            at = _places(of(b), bits)
            for i in np.unique(at >> 20).tolist():
                own.setdefault(i, np.zeros(1 << 20, bool))[at[at >> 20 == i] & ((1 << 20) - 1)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(own), pa.int32()), pa.array([np.packbits(x).tobytes() for x in own.values()], pa.binary())], ["block", "bits"])

    def merge(table: pa.Table) -> pa.Table:
        x = np.zeros(1 << 17, np.uint8)
        for b in table["bits"].to_pylist():
            x |= np.frombuffer(b, np.uint8)
        return pa.table({"block": pa.array([table["block"][0].as_py()], pa.int32()), "bits": pa.array([x.tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in values.mapInArrow(mark, "block int, bits binary").groupBy("block").applyInArrow(merge, "block int, bits binary").collect():
        out[r["block"] << 17 : (r["block"] + 1) << 17] = np.frombuffer(r["bits"], np.uint8)
    return out


def passes(filter_: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = _places(values, len(filter_).bit_length() + 2)
    return ((filter_[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).astype(bool)


def _scanned(docs: DataFrame, wanted: np.ndarray | None, schema: str, make, once: bool = False) -> DataFrame:
    """The id and what make(tokens, tokens before) gives, over the texts of docs whose id passes `wanted`, if it is given.

    That bit filter drops texts that are not wanted before they are cut into shingles; it lets a few of them by. With
    `once`, for tables where rows repeat an id, rows of one id with the same set give one row."""
    if once:
        whole = _scanned(docs, wanted, f"{schema}, set_n long, set_1 long, set_2 long", lambda t, b: [*make(t, b), *[pa.array(x, pa.int64()) for x in _digests(t, b)]])
        return whole.dropDuplicates(["id", "set_n", "set_1", "set_2"]).drop("set_n", "set_1", "set_2")
    filter_ = None if wanted is None else docs.sparkSession.sparkContext.broadcast(wanted)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def passing() -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
                yield b if filter_ is None else b.filter(pa.array(passes(filter_.value, ids)))

        for rows, buf, offs in each_slice(passing(), "text", SLICE):
            yield pa.RecordBatch.from_arrays([rows.column("id"), *make(*shingle_sets(buf, offs))], names)

    return docs.mapInArrow(run, schema)


# ---- candidates -------------------------------------------------------------------------------------------------
def _firsts(docs: DataFrame, wanted: np.ndarray | None, orders, percent: int) -> DataFrame:
    """(id, n, first): of each distinct set with a token the least id, its size and its prefix under the first order.

    Equal sets are merged by partial aggregates before they are sent."""

    def make(tokens: np.ndarray, before: np.ndarray) -> list[pa.Array]:
        first, fb = prefixes(tokens, before, 0, orders.value, percent)
        return [*[pa.array(x, pa.int64()) for x in _digests(tokens, before)], _blobs(_six(first), fb)]

    sets = _scanned(docs, wanted, "id long, n long, d1 long, d2 long, first binary", make).where("n > 0 and id is not null")
    return sets.groupBy("d1", "d2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("first").alias("first")).select("id", "n", "first")


def _deal(sets: DataFrame, buckets: int) -> DataFrame:
    """Prefix tokens with their sets, by ranges of the token: one row for each input batch and range that it has.

    Within a range a token is known by 40 bits; pairs that meet by confusion are told apart when they are verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            blobs = b.column(2).to_pylist()
            tokens = _from_six(b"".join(blobs))
            many = np.array([len(x) // 6 for x in blobs], np.int64)
            ids, n = b.column(0).to_numpy(), b.column(1).to_numpy()
            short = (tokens & np.uint64(_SHORT)).astype(np.int64)
            bucket = (((tokens >> np.uint64(16)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)
            order = np.lexsort((short, bucket))
            left = (np.repeat(n + np.cumsum(many) - many, many) - np.arange(len(tokens)))[order]
            short, owner = short[order], np.repeat(np.arange(len(ids)), many)[order]
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            k = np.flatnonzero(np.diff(cuts))
            part = lambda x: pa.array([planes(x[cuts[i] : cuts[i + 1]]) for i in k.tolist()], pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(k, pa.int32()), pa.array(np.diff(cuts)[k], pa.int32()), part(short), part(ids[owner]), part(n[owner]), part(left)], ["bucket", "many", "tokens", "ids", "n", "left"])

    return sets.mapInArrow(run, "bucket int, many int, tokens binary, ids binary, n binary, left binary")


def _meet(percent: int):
    """Within a range of tokens: the pairs that share a token at a fitting place, and the groups too large for all pairs.

    The first token that two sets share, in the order, stands where each has as many tokens from there on as the two must
    share; a token that stands later is not needed to find the pair.
    """

    def run(table: pa.Table) -> pa.Table:
        many = table["many"].to_pylist()
        join = lambda c: np.concatenate([from_planes(x, k) for x, k in zip(table[c].to_pylist(), many)])
        tokens, ids, n, left = join("tokens"), join("ids"), join("n"), join("left")
        order = np.lexsort((ids, tokens))
        tokens, ids, n, left = tokens[order], ids[order], n[order], left[order]
        heads = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
        size = np.diff(np.append(heads, len(tokens)))
        pa_, pb_ = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for d in range(1, SMALL):
            for k in range(SMALL - d):
                i = heads[(size <= SMALL) & (size > k + d)] + k
                j = i + d
                ok = (np.minimum(left[i], left[j]) * (100 + percent) >= percent * (n[i] + n[j])) & (ids[i] != ids[j])
                pa_.append(ids[i[ok]])
                pb_.append(ids[j[ok]])
        big = np.flatnonzero(size > SMALL)
        member = np.concatenate([np.arange(heads[i], heads[i] + size[i]) for i in big]) if len(big) else np.zeros(0, np.int64)
        a, b = np.concatenate(pa_), np.concatenate(pb_)
        a, b = np.minimum(a, b), np.maximum(a, b)
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]) if len(a) else np.zeros(0, bool)
        a, b = a[new], b[new]
        k = len(a)
        token = tokens[member] | (np.int64(table["bucket"][0].as_py()) << np.int64(40))
        return pa.table(
            {
                "token": pa.array(np.concatenate([np.zeros(k, np.int64), token]), mask=np.arange(k + len(member)) < k),
                "a": pa.array(np.concatenate([a, ids[member]])),
                "b": pa.array(np.concatenate([b, n[member]])),
                "left": pa.array(np.concatenate([np.zeros(k, np.int64), left[member]])),
            }
        )

    return run


def _candidates(docs: DataFrame, counters: list[np.ndarray], tokens: int, percent: int) -> tuple[DataFrame, DataFrame, list]:
    """(pairs, groups, orders): candidates, what is left in groups that are too large for all pairs, and the last orders.

    If two sets share an uncommon prefix token, they meet by it; else each has a common one in its prefix. So the sets of
    the large groups go once more, among themselves, with common tokens at the end of the orders, ROUNDS times at most:
    a prefix is then made of common tokens only where four fifths of the set are."""
    spark = docs.sparkSession
    orders, wanted, rounds, common = [*counters, None], None, [], None
    for step in range(ROUNDS + 1):
        sent = spark.sparkContext.broadcast(orders)
        buckets = max(n_partitions(spark), math.ceil(tokens / BUCKET_TOKENS))
        met = _deal(_firsts(docs, wanted, sent, percent), buckets).groupBy("bucket").applyInArrow(_meet(percent), "token long, a long, b long, left long")
        rounds.append(written(met, "met"))
        release(spark)
        groups = rounds[-1].where("token is not null").select("token", F.col("a").alias("id"), F.col("b").alias("n"), "left")
        if step == ROUNDS or groups.isEmpty():
            break
        sets = groups.groupBy("id").agg(F.max("n").alias("n")).agg(F.count("*").alias("sets"), F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1).alias("tokens")).head()
        tokens, wanted = sets["tokens"], bit_filter(groups.select("id"), sets["sets"])
        new = groups.select(F.col("token").bitwiseAND(_SHORT).alias("short"))
        common = new if common is None else common.unionByName(new)
        orders = [*counters, bit_filter(common, common.distinct().count())]
    pairs = rounds[0]
    for more in rounds[1:]:
        pairs = pairs.unionByName(more)
    pairs = pairs.where("token is null").select("a", "b")
    # In a group that is still too large all meet one of its sets; what that leaves apart is found block by block.
    pivot = F.min_by(F.struct("id", "n", "left"), F.xxhash64("id")).alias("p")
    met = groups.join(groups.groupBy("token").agg(pivot), "token").where(f"id <> p.id and least(left, p.left) * {100 + percent} >= {percent} * (n + p.n)")
    pairs = pairs.unionByName(met.select(F.least("id", "p.id").alias("a"), F.greatest("id", "p.id").alias("b")))
    return written(pairs.distinct(), "pairs"), groups, orders


# ---- verification -----------------------------------------------------------------------------------------------
def _both(pairs: DataFrame, values: DataFrame, *names: str) -> DataFrame:
    for side in "ab":
        pairs = pairs.join(values.select(F.col("id").alias(side), *[F.col(x).alias(f"{x}_{side}") for x in names]), side)
    return pairs


def _shared(a: np.ndarray, b: np.ndarray) -> int:
    both = np.sort(np.concatenate([a, b]))
    return int((both[1:] == both[:-1]).sum())


def _other_prefixes(docs: DataFrame, wanted: np.ndarray, orders, percent: int, once: bool) -> DataFrame:
    """(id, q1, q2): prefixes under the second and third order, 32 bits a token, which never hide a token that two share."""
    return _scanned(docs, wanted, "id long, q1 binary, q2 binary", lambda tokens, before: _others(tokens, before, orders.value, percent), once)


def _others(tokens: np.ndarray, before: np.ndarray, orders: list, percent: int) -> list[pa.Array]:
    out = [prefixes(tokens, before, k, orders, percent) for k in (1, 2)]
    return [_blobs((t >> np.uint64(32)).astype("<u4"), b) for t, b in out]


def _whole_sets(docs: DataFrame, wanted: np.ndarray, once: bool) -> DataFrame:
    """(id, tokens): all tokens of a set, 48 bits each."""
    return _scanned(docs, wanted, "id long, tokens binary", lambda tokens, before: [_blobs(_six(tokens), before)], once)


def _ends(pairs: DataFrame) -> np.ndarray:
    return bit_filter(pairs.select(F.explode(F.array("a", "b")).alias("id")), 2 * pairs.count())


def _verify(pairs: DataFrame, docs: DataFrame, orders, percent: int, once: bool = False) -> DataFrame:
    """The links among pairs, as a table: those that also meet under the other orders, by a count of shared tokens."""

    def meets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {x: [np.frombuffer(v, "<u4") for v in b.column(i).to_pylist()] for i, x in enumerate(b.schema.names) if x[0] == "q"}
            ok = [_shared(*x) > 0 and _shared(*y) > 0 for x, y in zip(zip(c["q1_a"], c["q1_b"]), zip(c["q2_a"], c["q2_b"]))]
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                both = _shared(_from_six(x), _from_six(y))
                ok.append(both > 0 and 100 * both >= percent * ((len(x) + len(y)) // 6 - both))
            yield b.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    near = _both(pairs, _other_prefixes(docs, _ends(pairs), orders, percent, once), "q1", "q2").select("a", "b", "q1_a", "q1_b", "q2_a", "q2_b")
    near = near.mapInArrow(meets, "a long, b long")
    near = written(near.distinct() if once else near, "near")
    release(docs.sparkSession)
    out = written(_both(near, _whole_sets(docs, _ends(near), once), "tokens").select("a", "b", "tokens_a", "tokens_b").mapInArrow(links, "a long, b long"), "links")
    release(docs.sparkSession)
    discard(near)
    return out


def _counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Shared tokens of each of a with each of b."""
    out = np.zeros((len(a), len(b)), np.int32)
    if not len(a) or not len(b):
        return out
    t = np.concatenate(b)
    owner = np.repeat(np.arange(len(b)), [len(x) for x in b])
    order = np.argsort(t, kind="stable")
    t, owner = t[order], owner[order]
    for i, v in enumerate(a):
        lo, hi = np.searchsorted(t, v, "left"), np.searchsorted(t, v, "right")
        n = hi - lo
        at = np.repeat(lo - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        out[i] = np.bincount(owner[at], minlength=len(b))
    return out


def _compare_blocks(percent: int):
    """A block of documents of a group that are outside its largest component, and a block of all of the group: links
    between components, as many as it takes to connect them.

    Pairs must fit in size and meet under the second and third order before whole sets are counted. A pair is left to the
    first token of all groups that it shares; those of one component are not compared."""

    def run(table: pa.Table) -> pa.Table:
        c = {x: table[x].to_pylist() for x in table.column_names}
        n, comp, ids, minor, first = (np.array(c[x]) for x in ("n", "component", "id", "minor", "first"))
        f, g = np.flatnonzero(first), np.flatnonzero(~first)
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while root.get(x, x) != x:
                x = root[x]
            return x

        def shared(column: str, f: np.ndarray, decode) -> np.ndarray:
            return _counts([decode(c[column][k]) for k in f.tolist()], [decode(c[column][k]) for k in g.tolist()])

        out = []
        if len(f) and len(g):
            fits = (100 * np.minimum(n[f][:, None], n[g][None]) >= percent * np.maximum(n[f][:, None], n[g][None])) & (comp[f][:, None] != comp[g][None])
            fits &= ~minor[g][None] | (ids[f][:, None] < ids[g][None])  # two that are both outside are compared once
            tests = [("earlier", lambda x: np.frombuffer(x, np.int64), False), *[(q, lambda x: np.frombuffer(x, "<u4"), True) for q in ("q1", "q2")]]
            for column, decode, wanted in tests:
                live = fits.any(1)
                f, fits = f[live], fits[live]
                if len(f):
                    fits &= (shared(column, f, decode) > 0) == wanted
            live = fits.any(1)
            f, fits = f[live], fits[live]
            if len(f):
                both = shared("tokens", f, _from_six)
                for x, y in zip(*np.nonzero(fits & (100 * both >= percent * (n[f][:, None] + n[g][None] - both)))):
                    a, b = f[x], g[y]
                    u, v = find(int(comp[a])), find(int(comp[b]))
                    if u != v:
                        root[max(u, v)] = min(u, v)
                        out.append((min(ids[a], ids[b]), max(ids[a], ids[b])))
        return pa.table({"a": pa.array([x for x, _ in out], pa.int64()), "b": pa.array([y for _, y in out], pa.int64())})

    return run


def _block_links(open_: DataFrame, docs: DataFrame, orders, percent: int, once: bool = False) -> DataFrame:
    """The links that are left between components of a token's documents, by pairs of blocks of bounded size.

    In a group only documents outside its largest component meet all others: a few of them cost one pass over the group."""
    parts = open_.groupBy("token", "component").agg(F.count("*").alias("m"))
    size = parts.groupBy("token").agg(F.sum("m").alias("all"), F.max("m").alias("most"), F.max_by("component", F.struct("m", "component")).alias("largest"))
    size = size.select("token", "largest", F.ceil(F.col("all") / BLOCK).cast("int").alias("blocks"), F.ceil((F.col("all") - F.col("most")) / BLOCK).cast("int").alias("minors"))
    earlier = F.collect_list("token").over(Window.partitionBy("id").orderBy("token").rowsBetween(Window.unboundedPreceding, -1))
    # Tokens before this one as bytes, as sets are.
    packed = F.unhex(F.array_join(F.transform("before", lambda x: F.concat_ws("", F.reverse(F.array(*[F.lpad(F.hex(F.shiftrightunsigned(x, 8 * k).bitwiseAND(255)), 2, "0") for k in range(7, -1, -1)])))), ""))
    rows = open_.withColumn("before", earlier).withColumn("earlier", packed).drop("before").join(size, "token").withColumn("minor", F.col("component") != F.col("largest"))
    block = F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks")).cast("int")
    mine = F.pmod(F.xxhash64("id", F.lit(2)), F.col("minors")).cast("int")
    each = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    second = F.transform(each("minors"), lambda i: F.struct(F.lit(False).alias("first"), i.alias("i"), block.alias("j")))
    first = F.when(F.col("minor"), F.transform(each("blocks"), lambda j: F.struct(F.lit(True).alias("first"), mine.alias("i"), j.alias("j")))).otherwise(F.array().cast("array<struct<first:boolean,i:int,j:int>>"))
    ids = bit_filter(open_.select("id"), open_.select("id").distinct().count())
    sets = _scanned(docs, ids, "id long, q1 binary, q2 binary, tokens binary", lambda tokens, before: [*_others(tokens, before, orders.value, percent), _blobs(_six(tokens), before)], once)
    rows = rows.join(sets, "id").withColumn("m", F.explode(F.concat(second, first)))
    return rows.select("token", "m.i", "m.j", "m.first", "id", "n", "component", "minor", "earlier", "q1", "q2", "tokens").groupBy("token", "i", "j").applyInArrow(_compare_blocks(percent), "a long, b long")


def _still_open(groups: DataFrame, comp: DataFrame) -> DataFrame:
    """Rows of groups, with components, of tokens whose documents are in more than one."""
    rows = groups.join(comp, "id", "left").withColumn("component", F.coalesce("component", "id"))
    apart = rows.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    return written(rows.join(apart, "token", "left_semi"), "open")


def jaccard_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) for each row of docs; see linked() for the links between different sets.

    A document's set is its distinct shingles of WORDS words; two documents link when 100 * |both| >= percent * |either|.
    component_id is the least id that links reach, the document's own included. Null and empty texts, and texts without
    words, have n_shingles 0 and link with nothing. Rows that repeat an id give a row each; if their texts differ, the id
    has the links of all of them. A null id is reported with the component of its set's other rows, else null.
    Empty tables give no rows; texts of any length are whole; columns other than the two are not read.
    """
    members, reps, comp = linked(docs, id_column, text_column, percent)
    rep_of = reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component_id"))
    out = members.join(rep_of, ["d1", "d2"], "left")
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def linked(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, representatives, components) of the sets of docs.

    members: (id, n, d1, d2) of each row; representatives: (d1, d2, rep), the least id of equal sets; components: (id,
    component) of representatives that link with another set. Candidates are found by _candidates(); every candidate must
    share prefix tokens under the second and third order as well, and is then verified on whole sets. Groups whose
    documents are still in different components are compared among themselves, in blocks of bounded size inside tasks
    that give back links alone; no link between components is lost.
    """
    spark = docs.sparkSession
    rows = _input(docs, id_column, text_column)
    counters = count_tokens(rows)
    members = written(_scanned(rows, None, "id long, n long, d1 long, d2 long", lambda t, b: [pa.array(x, pa.int64()) for x in _digests(t, b)]), "members")
    reps = written(members.where("n > 0 and id is not null").groupBy("d1", "d2").agg(F.min("id").alias("rep"), F.first("n").alias("n")), "reps")
    # Rows that repeat an id with the same set count once where sets meet.
    once = not members.where("n > 0 and id is not null").groupBy("id", "d1", "d2").agg(F.count("*").alias("rows")).where("rows > 1").isEmpty()
    tokens = reps.agg(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1)).head()[0] or 0
    pairs, groups, orders = _candidates(rows, counters, tokens, percent)
    orders = spark.sparkContext.broadcast(orders)
    comp = components(_verify(pairs, rows, orders, percent, once))
    open_ = _still_open(groups, comp)
    if not open_.isEmpty():
        more = written(_block_links(open_, rows, orders, percent, once), "links")
        release(spark)
        comp = components(comp.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))
    return members, reps.drop("n"), comp


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", percent: int = PERCENT) -> DataFrame:
    """docs with one document of each component, the one with the least id; documents without words all stay.

    Rows that repeat an id are told apart by their texts: a row goes if its own set belongs to a component with a smaller
    id. Rows that repeat the kept id with a text of the same component stay, as they cannot be told from it; so do rows
    with a null id, unless another row with the same set has an id. All columns of docs stay as they are, whatever
    their names; empty tables give no rows; texts of any length are compared whole."""
    names = [f"set_{k}_{'_'.join(docs.columns)}" for k in range(3)]  # longer than any name of docs
    members, reps, comp = linked(docs, id_column, text_column, percent)
    rep_of = reps.join(comp.withColumnRenamed("id", "rep"), "rep", "left").select("d1", "d2", F.coalesce("component", "rep").alias("component"))
    gone = members.where("n > 0").join(rep_of, ["d1", "d2"]).where(~F.col("id").eqNullSafe(F.col("component")))
    gone = gone.select(*[F.col(x).alias(y) for x, y in zip(("id", "d1", "d2"), names)]).distinct()
    place = docs.columns.index(text_column)
    told = T.StructType([*docs.schema.fields, *[T.StructField(x, T.LongType()) for x in names[1:]]])

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in each_slice(batches, place, SLICE):
            _, d1, d2 = _digests(*shingle_sets(buf, offs))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(d1), pa.array(d2)], told.names)

    rows = docs.mapInArrow(tell, told).withColumnRenamed(names[1], f"own_{names[1]}").withColumnRenamed(names[2], f"own_{names[2]}")
    same = F.col(id_column).cast("long").eqNullSafe(F.col(names[0])) & (F.col(f"own_{names[1]}") == F.col(names[1])) & (F.col(f"own_{names[2]}") == F.col(names[2]))
    return rows.join(gone, same, "left_anti").select(*docs.columns)
