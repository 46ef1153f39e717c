"""Phrase collocations by direct-address tiling of pairs of frequency-ranked ids, level by level.

Texts become chunks of ids: words that are frequent enough are numbered by falling count. A task takes some chunks at a
time. Their neighbouring ids are pairs; pairs of low ids fall into tiles that are counted in a dense array by their place,
what lies in thinly filled tiles is sorted as coordinates and counted in runs. For the next length, phrases that a filter of
the frequent ones lets through are numbered by falling count within what the task holds, so that pairs of pairs are phrases
of three words, and theirs phrases of four. Counts are dealt by hashes of the phrases, many phrases packed into one row,
and added up; a phrase is known everywhere by the ids of its words, so chunks need no new ids for it.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import discard, from_planes, mixed, n_partitions, planes, release, signed, span_hashes, written
from barloom.llm.jaccard import bit_filter, passes

#: Least count of a phrase, longest phrase, and phrases that are reported for each language.
LEAST, LONGEST, TOP = 30, 4, 2000
#: A candidate goes if a longer one holds it and has this share of its count, in percent.
SHARE = 80
#: The language of texts that have none.
NO_LANG = "und"
#: Bytes of text in a chunk; a longer text is a chunk of its own.
CHUNK = 2 << 20
#: Ids of words in which a task counts phrases at once, and ids at most whose phrases meet in one group.
ROOM, MEET = 1 << 21, 1 << 22
#: Ids along a tile's side, and the pairs of a chunk that make a tile worth a dense array.
SIDE, DENSE = 512, 512 * 512 // 16

#: Rows of chunks, each as large as a chunk, that are read and sent to Python at once.
_FEW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "2", "spark.sql.parquet.columnarReaderBatchSize": "4"}

#: A word, or a mark that ends a piece.
TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
_MARKS = frozenset(bytes([b]) for b in b".,;:!?\n\x0b\x0c\r")


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers in four bytes each where they fit, else in eight; the first byte says which."""
    kind = "<i4" if x.max(initial=0) < 1 << 31 else "<i8"
    return bytes([int(kind[2])]) * 8 + x.astype(kind).tobytes()


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    buf = raw.as_buffer()
    return np.frombuffer(buf, f"<i{buf[0]}", offset=8).astype(np.int64)


_CHUNK_ROW = "chunk long, ids binary, langs array<string>, sizes array<int>, words array<string>"


def chunks(docs: DataFrame, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """A row for each chunk of texts: ids are its words in order, -1 where a piece ends; word i stands at place i of `words`,
    which has those of each of `langs`, `sizes` of them, one language after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, seq, books, words = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 32, 0, [], {}, 0

        def row():
            place = np.full(words + 1, -1, np.int64)  # the last place is for what is -1
            place[np.array([i for book in books.values() for i in book.values()], np.int64)] = np.arange(words)
            cols = ([number], [_packed(place[np.array(seq, np.int64)])], [list(books)], [[len(b) for b in books.values()]], [[w.decode() for b in books.values() for w in b]])
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], [c.split()[0] for c in _CHUNK_ROW.split(", ")])

        for batch in batches:
            for text, lang in zip(batch.column("text"), batch.column("lang")):
                raw = (text.as_py() or "").encode().lower()
                book = books.setdefault(lang.as_py(), {})
                for t in TOKEN.findall(raw):
                    if t in _MARKS:
                        seq.append(-1)
                        continue
                    at = book.get(t)
                    if at is None:
                        at = book[t] = words
                        words += 1
                    seq.append(at)
                seq.append(-1)
                size += len(raw)
                if size >= CHUNK:
                    if words:
                        yield row()
                    number, size, seq, books, words = number + 1, 0, [], {}, 0
        if words:
            yield row()

    rows = docs.select(F.col(text_column).cast("string").alias("text"), F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANG)).alias("lang"))
    return rows.mapInArrow(run, _CHUNK_ROW)


def _word_hashes(langs: list[str], sizes: list[int], words: pa.Array) -> np.ndarray:
    """A number for each word of a chunk in its language, by which filters and first counts know it."""
    offs = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2], np.uint8)
    seeds = np.array([zlib.crc32(x.encode()) for x in langs], np.uint64)
    return signed(mixed(span_hashes(data, offs[:-1], offs[1:]) ^ np.repeat(mixed(seeds + np.uint64(1)), sizes)))


def _chunk_words(batches: Iterator[pa.RecordBatch]):
    """(chunk, languages, sizes, words, hashes and counts of the words) of each chunk."""
    for batch in batches:
        for i in range(batch.num_rows):
            words = batch.column("words")[i].values
            langs, sizes = batch.column("langs")[i].as_py(), batch.column("sizes")[i].as_py()
            ids = _unpacked(batch.column("ids")[i])
            yield batch.column("chunk")[i].as_py(), langs, sizes, words, _word_hashes(langs, sizes, words), np.bincount(ids[ids >= 0], minlength=len(words))


def hash_counts(read: DataFrame) -> DataFrame:
    """(lang, null, n): words of each language in each chunk; (null, hash, n): of each word, by its hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, langs, sizes, words, hashes, n in _chunk_words(batches):
            ends = np.cumsum(sizes)
            of = [int(n[e - k : e].sum()) for e, k in zip(ends, sizes)]
            yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.nulls(len(langs), pa.int64()), pa.array(of, pa.int64())], ["lang", "hash", "n"])
            yield pa.RecordBatch.from_arrays([pa.nulls(len(hashes), pa.string()), pa.array(hashes), pa.array(n)], ["lang", "hash", "n"])

    return read.mapInArrow(run, "lang string, hash long, n long")


def chunk_words(read: DataFrame, wanted: np.ndarray) -> DataFrame:
    """(chunk, local, lang, word, n) of the words of each chunk that a filter of hashes lets through."""
    filter_ = read.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, langs, sizes, words, hashes, n in _chunk_words(batches):
            at = np.flatnonzero(passes(filter_.value, hashes))
            lang = pa.array(langs, pa.string()).take(pa.array(np.repeat(np.arange(len(langs)), sizes)[at]))
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), chunk, np.int64)), pa.array(at), lang, words.take(pa.array(at)), pa.array(n[at])], ["chunk", "local", "lang", "word", "n"])

    return read.mapInArrow(run, "chunk long, local long, lang string, word string, n long")


def _written_by_chunks(df: DataFrame, name: str) -> DataFrame:
    """As written(), for what is made from rows of chunks: few of them are held at once."""
    conf = df.sparkSession.conf
    before = {k: conf.get(k) for k in _FEW}
    try:
        for k, v in _FEW.items():
            conf.set(k, v)
        return written(df, name)
    finally:
        for k, v in before.items():
            conf.set(k, v)


def ranked(counted: DataFrame, *keys: str) -> DataFrame:
    """counted (with a count f) and `id`: 0 for the highest f, ties by keys. A sort by ranges, no single task for the rank."""
    spark = counted.sparkSession
    part = counted.repartitionByRange(n_partitions(spark), F.desc("f"), *keys).sortWithinPartitions(F.desc("f"), *keys)
    # The number of a row is its partition, then its place there.
    part = written(part.withColumn("place", F.monotonically_increasing_id()), "ranked")
    sizes = part.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("n"))
    # A row for each partition.
    sizes = sizes.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).select("part", "before")
    numbered = part.withColumn("part", F.shiftright("place", 33)).join(sizes, "part")
    return numbered.withColumn("id", F.col("before") + F.col("place").bitwiseAND((1 << 33) - 1)).drop("part", "before", "place")


def _one(columns: list[np.ndarray]) -> np.ndarray:
    """A number for each row of columns of whole numbers from 0 on: equal where rows are, in the order of the rows."""
    out, high = columns[0], int(columns[0].max(initial=0)) + 1
    for c in columns[1:]:
        more = int(c.max(initial=0)) + 1
        if high * more >= 1 << 63:
            out, c = np.unique(out, return_inverse=True)[1], np.unique(c, return_inverse=True)[1]
            high, more = int(out.max(initial=0)) + 1, int(c.max(initial=0)) + 1
        out, high = out * more + c, high * more
    return out


def _added(columns: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows of columns, at least one, in order, and the sums of n over equal ones."""
    key = _one(columns)
    order = np.argsort(key)
    key = key[order]
    heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return [c[order[heads]] for c in columns], np.add.reduceat(n[order], heads)


def tiled_counts(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different pairs of ids and their counts: full tiles by bincount over places, the rest as sorted coordinates."""
    if not len(a):
        return a, b, a
    sides = int(max(a.max(), b.max())) // SIDE + 1
    tile = (a // SIDE) * sides + b // SIDE if sides < 1 << 31 else None
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    if tile is not None:
        order = np.argsort(tile, kind="stable")
        a, b, tile = a[order], b[order], tile[order]
        heads = np.flatnonzero(np.diff(tile, prepend=-1))
        size = np.diff(np.append(heads, len(tile)))
        thin = np.ones(len(a), bool)
        for h, m in zip(heads[size >= DENSE], size[size >= DENSE]):
            base_a, base_b = a[h] // SIDE * SIDE, b[h] // SIDE * SIDE
            n = np.bincount((a[h : h + m] - base_a) * SIDE + b[h : h + m] - base_b, minlength=SIDE * SIDE)
            place = np.flatnonzero(n)
            out.append((place // SIDE + base_a, place % SIDE + base_b, n[place]))
            thin[h : h + m] = False
        a, b = a[thin], b[thin]
    if len(a):
        (a, b), n = _added([a, b], np.ones(len(a), np.int64))
        out.append((a, b, n))
    return tuple(np.concatenate([x[i] for x in out]) for i in range(3))


def _pairs(ids: np.ndarray) -> np.ndarray:
    """Where an id and the one after it are both there."""
    return np.flatnonzero((ids[:-1] >= 0) & (ids[1:] >= 0))


def _keys(words: list[np.ndarray]) -> np.ndarray:
    """A number for each phrase, given by columns of the ids of its words, by which filters know it and it is dealt."""
    h = np.ones(len(words[0]), np.uint64)
    for w in words:
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w.astype(np.uint64))
    return signed(h)


def phrase_filter(phrases: DataFrame, length: int) -> np.ndarray:
    """A bit filter of bounded size that all phrases of a length pass, and few others."""
    return bit_filter(phrases.select("words"), phrases.count(), lambda x: _keys(list(x.column(0).flatten().to_numpy().reshape(-1, length).T)))


def phrases_in(ids: np.ndarray, length: int, wanted: np.ndarray | None = None) -> tuple[list[np.ndarray], np.ndarray]:
    """(columns of the ids of their words, counts) of the different phrases of a length in a row of ids, where -1 ends a
    piece. With a filter of phrases shorter by a word: of those whose two parts of that length pass it."""
    if length == 2:
        at = _pairs(ids)
        a, b, n = tiled_counts(ids[at], ids[at + 1])
        return [a, b], n
    part = length - 1
    whole = np.ones(max(0, len(ids) - part + 1), bool)
    for j in range(part):
        whole &= ids[j : j + len(whole)] >= 0
    here = np.flatnonzero(whole)
    if wanted is not None:
        here = here[passes(wanted, _keys([ids[here + j] for j in range(part)]))]
    # The parts numbered by falling count: pairs of neighbouring ones are the phrases.
    _, first, inverse, n = np.unique(_one([ids[here + j] for j in range(part)]), return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-n, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    number = np.full(len(ids), -1, np.int64)
    number[here] = rank[inverse]
    at = _pairs(number)
    a, b, n = tiled_counts(number[at], number[at + 1])
    start = here[first[order]]
    return [*[ids[start[a] + j] for j in range(part)], ids[start[b] + part - 1]], n


def _shut(columns: list[np.ndarray]) -> bytes:
    """Columns of whole numbers from 0 on, the first in rising order, in few bytes."""
    raw = [planes(c) for c in (np.diff(columns[0], prepend=0), *columns[1:])]
    return zlib.compress(np.array([len(columns[0]), *map(len, raw)], "<i4").tobytes() + b"".join(raw), 1)


def _opened(shut: bytes, width: int) -> list[np.ndarray]:
    raw = zlib.decompress(shut)
    rows, *sizes = np.frombuffer(raw, "<i4", width + 1).tolist()
    ends = 4 * (width + 1) + np.cumsum([0, *sizes])
    out = [from_planes(raw[a:b], rows) for a, b in zip(ends[:-1], ends[1:])]
    return [np.cumsum(out[0]), *out[1:]]


def phrase_counts(coded: DataFrame, length: int, least: int, ids: int, wanted: np.ndarray | None = None) -> DataFrame:
    """(words, f): the phrases of a length, as the ids of their words, that occur `least` times. ids: at least as many as all
    chunks have. With a filter of the frequent phrases shorter by a word, others are left out early."""
    spark = coded.sparkSession
    filter_ = None if wanted is None else spark.sparkContext.broadcast(wanted)
    parts = max(4 * n_partitions(spark), -(-ids // MEET))

    def dealt(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        words, n = phrases_in(np.concatenate(held), length, None if filter_ is None else filter_.value)
        if not len(n):
            return
        part = ((_keys(words).view(np.uint64) >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(_one([part, *words]))
        part, rows = part[order], [c[order] for c in (*words, n)]
        heads = np.flatnonzero(np.diff(part, prepend=-1))
        shut = [_shut([c[a:b] for c in rows]) for a, b in zip(heads, np.append(heads[1:], len(part)))]
        for x in range(0, len(heads), 256):
            yield pa.RecordBatch.from_arrays([pa.array(part[heads[x : x + 256]]), pa.array(shut[x : x + 256], pa.binary())], ["part", "shut"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, room = [], 0
        for batch in batches:
            for raw in batch.column("ids"):
                held += [_unpacked(raw), np.full(1, -1, np.int64)]
                room += len(held[-2])
                if room >= ROOM:
                    yield from dealt(held)
                    held, room = [], 0
        if held:
            yield from dealt(held)

    def add(group: pa.Table) -> pa.Table:
        opened = [_opened(x, length + 1) for x in group.column("shut").to_pylist()]
        columns = [np.concatenate([o.pop(0) for o in opened]) for _ in range(length + 1)]
        words, f = _added(columns[:-1], columns[-1])
        often = np.flatnonzero(f >= least)
        flat = pa.array(np.stack([c[often] for c in words], axis=1).reshape(-1))
        return pa.table({"words": pa.ListArray.from_arrays(pa.array(np.arange(len(often) + 1, dtype=np.int32) * length), flat), "f": pa.array(f[often])})

    return coded.mapInArrow(run, "part long, shut binary").groupBy("part").applyInArrow(add, "words array<long>, f long")


def _columns(group: pa.Table, *names: str) -> list[np.ndarray]:
    return [group.column(c).combine_chunks().to_numpy(zero_copy_only=False) if group.num_rows else np.zeros(0, np.int64) for c in names]


def _coded(chunk: int, ids: np.ndarray) -> pa.Table:
    # A chunk whose ids are all gone has nothing for later levels.
    some = bool((ids >= 0).any())
    return pa.table({"chunk": pa.array([chunk] * some, pa.int64()), "ids": pa.array([_packed(ids)] * some, pa.binary())})


def _recode_words(left: pa.Table, right: pa.Table) -> pa.Table:
    if not left.num_rows:
        return _coded(0, np.zeros(0, np.int64))
    ids = _unpacked(left.column("ids")[0])
    local, new = _columns(right, "local", "id")
    table = np.full(int(ids.max(initial=-1)) + 2, -1, np.int64)  # the last place is for what was -1
    table[local] = new
    return _coded(left.column("chunk")[0].as_py(), table[ids])


def _recode(read: DataFrame, book: DataFrame) -> DataFrame:
    """The chunks with the ids of words in place of their local numbers; each chunk meets only the words that it has itself."""
    mine = book.withColumnRenamed("chunk", "of").groupBy("of")
    return written(read.groupBy("chunk").cogroup(mine).applyInArrow(_recode_words, "chunk long, ids binary"), "coded")


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(2000000 * a / (left + right)) in whole numbers of up to 38 digits."""
    d = lambda c: c.cast("decimal(19,0)")
    top, both = d(a) * F.lit(2000000).cast("decimal(7,0)"), d(left) + d(right)
    return ((top - top % both) / both).cast("long")


def levels(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text_column: str = "text", lang_column: str = "lang") -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """(counts, words, frequent phrases by length). counts: (lang, n), all words. words: (id, word), the frequent ones. Phrases
    of length k, k from 1: words (their ids), lang, f, heads and tails (counts of its first and of its last 1 to k words,
    itself included)."""
    spark = docs.sparkSession
    read = written(chunks(docs, text_column, lang_column), "chunks")
    # Words are counted by hashes first: only those that may be frequent are sent as words.
    hashes = _written_by_chunks(hash_counts(read).groupBy("lang", "hash").agg(F.sum("n").alias("n")), "hashes")
    totals = written(hashes.where("lang is not null").select("lang", "n"), "totals")
    often = hashes.where(F.col("lang").isNull() & (F.col("n") >= least)).select("hash")
    words = _written_by_chunks(chunk_words(read, bit_filter(often, often.count())), "words")
    discard(hashes)
    release(spark)
    by_word = words.groupBy("lang", "word").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    named = written(ranked(by_word, "lang", "word").select("id", "lang", "word", "f"), "named")
    found = [named.select(F.array("id").alias("words"), "lang", "f", F.array("f").alias("heads"), F.array("f").alias("tails"))]
    book = words.join(named.select("lang", "word", "id"), ["lang", "word"]).select("chunk", "local", "id")
    coded = _recode(read.select("chunk", "ids"), book)
    discard(read, words)
    release(spark)
    ids, wanted = totals.agg(F.sum("n")).head()[0] or 0, None
    for length in range(2, longest + 1):
        frequent = _written_by_chunks(phrase_counts(coded, length, least, ids, wanted), "frequent")
        release(spark)
        if length < longest:
            wanted = phrase_filter(frequent, length)
        last, part = found[-1], F.lit(length - 1)
        left = last.select(F.col("words").alias("begin"), "lang", F.col("heads").alias("of_begin"))
        right = last.select(F.col("words").alias("end"), F.col("tails").alias("of_end"))
        parted = frequent.select("words", "f", F.slice("words", F.lit(1), part).alias("begin"), F.slice("words", F.lit(2), part).alias("end"))
        joined = parted.join(left, "begin").join(right, "end")
        found.append(written(joined.select("words", "lang", "f", F.concat("of_begin", F.array("f")).alias("heads"), F.concat("of_end", F.array("f")).alias("tails")), "phrases"))
        discard(frequent)
        release(spark)
    discard(coded)
    return totals, named.select("id", "word"), found


def collocations(docs: DataFrame, top: int = TOP, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, text_column: str = "text", lang_column: str = "lang") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the `top` phrases of each language by score, then count, then bytes.

    A phrase of 2 to `longest` words with count a >= least is a candidate. Cut after its first k words it has the counts l
    and r of its parts and the score floor(2000000 * a / (l + r)); the lowest score counts, of equal ones that of the
    smallest k. A candidate goes if a longer candidate holds its words and has `share` percent of its count. Null and
    empty texts have no words; a null language is `und`; a language with no candidate has no rows; repeated rows count
    each; empty tables give no rows; texts are whole; other columns are not read.
    """
    totals, named, found = levels(docs, least, longest, text_column, lang_column)
    out = None
    for k in range(1, longest):
        rows = found[k]
        cuts = F.array(*[F.struct(_score(F.col("f"), F.col("heads")[i], F.col("tails")[k - 1 - i]).alias("score"), F.lit(i).alias("k"), F.col("heads")[i].alias("l"), F.col("tails")[k - 1 - i].alias("r")) for i in range(k)])
        if k + 1 < longest:
            # A longer candidate that has the share passes it on to those between: the next length tells all.
            inside = F.explode(F.array(F.slice("words", 1, k + 1), F.slice("words", 2, k + 1))).alias("words")
            most = found[k + 1].select(inside, "f").groupBy("words").agg(F.max("f").alias("most"))
            rows = rows.join(most, "words", "left").where(F.col("most").isNull() | (100 * F.col("most") < share * F.col("f")))
        # Written one after the other, so that only the joins of one length are under way at a time.
        rows = written(rows.select("lang", "words", F.col("f").alias("a"), F.array_min(cuts).alias("cut")), "candidates")
        release(docs.sparkSession)
        out = rows if out is None else out.unionByName(rows)
    # Only what may be among the best, with all that tie with the last of them, gets its words as text.
    by_lang = Window.partitionBy("lang")
    best = out.select("lang", "words", "a", "cut.l", "cut.r", "cut.score").withColumn("rank", F.rank().over(by_lang.orderBy(F.desc("score"), F.desc("a")))).where(F.col("rank") <= top).drop("rank")
    each = best.select("*", F.posexplode("words").alias("place", "id")).join(named, "id")
    spelt = each.groupBy("lang", "words", "a", "l", "r", "score").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("spelt"))
    out = spelt.select("lang", F.array_join("spelt.word", " ").alias("phrase"), "a", "l", "r", "score")
    out = out.withColumn("rank", F.row_number().over(by_lang.orderBy(F.desc("score"), F.desc("a"), "phrase"))).where(F.col("rank") <= top)
    return out.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
