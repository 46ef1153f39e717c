"""Ranked lexical search by NRA: impact-sorted lists are read from the top, with lower and upper scores of documents.

Documents are searched in shards, any of which may hold the best. In a shard every term of the items has a list of its
documents by falling impact. A document's lower score is what its terms read so far give; its upper score adds, for each
term not met yet, the highest impact that is left in that list. A document that only the weakest lists hold, whose best
impacts together stay below the score to reach, cannot enter; so while an item may still get documents, only its other
lists are read. After that all lists are read on, and an item is done when no document outside can enter and no score
inside can change. The score to reach is that of the best documents of all shards that a task has searched.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import each_slice, written

#: Documents of an item's answer, and the first entries of a list that are read at once; each later read is as long as all before it.
BEST, FIRST = 10, 64
#: Postings of a shard, and terms of a block of items, beyond one item: what a task holds of documents and of the items.
SHARD_POSTINGS, BLOCK_TERMS = 1 << 19, 1 << 18
#: Bits of the filter of terms: a fixed size, whatever the items hold; what it lets by without being a term is dropped later.
FILTER_BITS = 1 << 24

#: A term: a maximal run of ASCII letters and digits and of all that is not ASCII; on UTF-8 bytes.
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BIT = FILTER_BITS - 1


def terms_of(text: bytes) -> list[bytes]:
    """Terms in order, only A-Z lower-cased."""
    return TERM.findall(text.lower())


def item_terms(items: DataFrame, id_column: str = "item_id", text_column: str = "text", most: int = BLOCK_TERMS) -> DataFrame:
    """(block, item, item_id, term, times) of each different row of items; `item` is a number of our own, as ids may repeat.
    A block has at most `most` terms beyond its first item."""
    rows = items.select(F.col(id_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text")).distinct()
    rows = written(rows.withColumn("item", F.monotonically_increasing_id()), "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            for item, item_id, text in zip(*(batch.column(c).to_pylist() for c in ("item", "item_id", "text"))):
                found = Counter(terms_of((text or "").encode()))
                if held and held + len(found) > most:
                    block, held = block + 1, 0
                held += len(found)
                k = len(found)
                yield pa.RecordBatch.from_arrays([pa.array([block] * k, pa.int64()), pa.array([item] * k, pa.int64()), pa.array([item_id] * k, pa.int64()), pa.array([t.decode() for t in found], pa.string()), pa.array(list(found.values()), pa.int64())], ["block", "item", "item_id", "term", "times"])

    return rows.mapInArrow(run, "block long, item long, item_id long, term string, times long")


def term_filter(terms: DataFrame) -> np.ndarray:
    """One bit for the checksum of each term, FILTER_BITS in all; at most that many places come to the driver."""
    places = terms.select(F.crc32(F.col("term").cast("binary")).bitwiseAND(_BIT).alias("place")).distinct()
    bits = np.zeros(FILTER_BITS, bool)
    bits[places.toArrow().column("place").to_numpy()] = True
    return np.packbits(bits, bitorder="little")


def postings(docs: DataFrame, terms: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc, doc_id, n, terms, tfs) of each row of docs that has a term: how many it has with repeats, and those that the
    filter of `terms` lets through with their counts. `doc` is a number of our own, as ids may repeat or be null."""
    bits = docs.sparkSession.sparkContext.broadcast(term_filter(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.unpackbits(bits.value, bitorder="little").tobytes()
        for rows, buf, offs in each_slice(batches, "text"):
            raw = buf.tobytes()
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, (doc, doc_id) in enumerate(zip(rows.column("doc").to_pylist(), rows.column("doc_id").to_pylist())):
                found = Counter(terms_of(raw[offs[i] : offs[i + 1]]))
                if found:
                    mine = [(t.decode(), tf) for t, tf in found.items() if held[zlib.crc32(t) & _BIT]]
                    for column, value in zip(out, (doc, doc_id, found.total(), [t for t, _ in mine], [tf for _, tf in mine])):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int64())))], ["doc", "doc_id", "n", "terms", "tfs"])

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.withColumn("doc", F.monotonically_increasing_id()).mapInArrow(run, "doc long, doc_id long, n long, terms array<string>, tfs array<long>")


def weight(n_docs: int, df: int) -> int:
    """A term's weight. The quotient and its logarithm are doubles, all else is in whole numbers."""
    return math.floor(1000 * math.log(float(2 * n_docs + 2) / float(2 * df + 1)))


def saturation(tf: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """What a term's occurrences in a document of n terms are worth, below 1,000,000."""
    m = 25 + 75 * n * n_docs // n_terms
    return 1000000000 * tf // (1000 * tf + 8 * m)


class Shard:
    """Impact-sorted lists of some documents: list t holds places start[t] to start[t + 1] of `doc` and `impact`."""

    def __init__(self, n_lists: int, n_docs: int, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        order = np.lexsort((doc, -impact, term))
        self.n_docs, self.doc, self.impact = n_docs, doc[order], impact[order]
        self.start = np.searchsorted(term[order], np.arange(n_lists + 1))

    def left(self, lists: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The highest impact from each list's place on, 0 at its end."""
        end = self.start[lists + 1]
        return np.where(at < end, self.impact[np.minimum(at, len(self.impact) - 1)], 0) if len(self.impact) else np.zeros(len(lists), np.int64)

    def best(self, lists: np.ndarray, times: np.ndarray, bar: int, best: int, first: int = FIRST) -> tuple[np.ndarray, np.ndarray]:
        """(documents, scores) that can be among the `best` of an item with these lists, if `bar` must be reached (1 at
        least); their scores are final. Ties at the bar are all there."""
        begin, at = self.start[lists], self.start[lists].copy()
        lower, met = np.zeros(self.n_docs, np.int64), np.zeros((len(lists), self.n_docs), bool)
        bound = self.left(lists, at) * times
        enterable = True
        while True:
            unseen = int(bound.sum())
            upper = lower + unseen - bound @ met
            if np.count_nonzero(lower) >= best:
                bar = max(bar, int(np.partition(lower, -best)[-best]))
            enterable = enterable and unseen >= bar
            inside = np.flatnonzero((lower > 0) & (upper >= bar))
            if not enterable and (upper[inside] == lower[inside]).all():
                return inside, lower[inside]
            reads = bound > 0
            if enterable:
                # Together the weakest lists must stay below the bar; of the others the strongest are read first.
                order = np.argsort(bound, kind="stable")
                weakest = np.empty(len(bound), np.int64)
                weakest[order] = np.cumsum(bound[order])
                reads &= (weakest >= bar) & (2 * bound >= bound.max())
            for i in np.flatnonzero(reads):
                a, b = at[i], min(at[i] + max(first, at[i] - begin[i]), self.start[lists[i] + 1])
                lower[self.doc[a:b]] += self.impact[a:b] * times[i]
                met[i, self.doc[a:b]] = True
                at[i] = b
            bound = self.left(lists, at) * times


def _search_block(wanted: dict, weights: dict, n_docs: int, n_terms: int, best: int, first: int, most: int):
    """The best documents of each item of a block: wanted is item -> [(term, times)], weights is term -> weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight_of = wanted.value, weights.value
        number = {t: i for i, t in enumerate(weight_of)}
        w = np.array(list(weight_of.values()), np.int64)
        lists = {item: (np.array([number[t] for t, _ in terms]), np.array([k for _, k in terms], np.int64)) for item, terms in items.items()}
        found: dict[int, list] = {item: [] for item in items}  # (-score, no id, id, doc), the best so far
        cols: tuple[list, ...] = ([], [], [], [], [], [])

        def flush():
            doc, doc_id, n, own, term, tf = (np.concatenate(c) for c in cols)
            if not len(term):
                return
            shard = Shard(len(w), len(doc), term, own, w[term] * saturation(tf, n[own], n_docs, n_terms))
            for item, (mine, times) in lists.items():
                top = found[item]
                inside, score = shard.best(mine, times, max(1, -top[-1][0]) if len(top) == best else 1, best, first)
                top += [(-int(s), doc_id[i] is None, doc_id[i] if doc_id[i] is not None else 0, int(doc[i])) for i, s in zip(inside, score)]
                found[item] = sorted(top)[:best]

        held = docs = 0
        for batch in batches:
            terms, tfs = batch.column("terms"), batch.column("tfs")
            flat, tf = terms.flatten(), tfs.flatten()
            size = np.diff(terms.offsets.to_numpy()) if batch.num_rows else np.zeros(0, np.int64)
            words = flat.dictionary_encode()
            to = np.array([number.get(t, -1) for t in words.dictionary.to_pylist()] + [-1], np.int64)[words.indices.to_numpy()] if len(flat) else np.zeros(0, np.int64)
            keep = to >= 0
            own = np.repeat(np.arange(batch.num_rows), size) + docs
            for c, v in zip(cols, (batch.column("doc").to_numpy(), np.array(batch.column("doc_id").to_pylist(), object), batch.column("n").to_numpy(), own[keep], to[keep], tf.to_numpy()[keep] if len(tf) else to)):
                c.append(v)
            held, docs = held + int(keep.sum()), docs + batch.num_rows
            if held >= most:
                flush()
                held = docs = 0
                for c in cols:
                    c.clear()
        if docs:
            flush()
        rows = [(item, None if none else i, doc, -s) for item, top in found.items() for s, none, i, doc in top]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.int64()) for k in range(4)], ["item", "doc_id", "doc", "score"])

    return run


def search(docs: DataFrame, items: DataFrame, best: int = BEST, doc_columns: tuple[str, str] = ("doc_id", "text"), item_columns: tuple[str, str] = ("item_id", "text"), first: int = FIRST, shard: int = SHARD_POSTINGS, block: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): the `best` rows of docs for each item, by score and then the smaller doc_id.

    Rows of docs count each, also those that repeat an id or a text; null ids come last among equal scores; null and empty
    texts have no terms and are never found. Items that repeat id and text count once, an id with two texts is two items
    with the same item_id; items without terms have no rows. Empty tables give no rows. Texts are read whole, once; other
    columns are not read. Items go to the tasks in blocks of bounded size, each against all documents.
    """
    spark = docs.sparkSession
    wanted = written(item_terms(items, *item_columns, block), "wanted")
    found = written(postings(docs, wanted, *doc_columns), "postings")
    whole = found.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).head()
    counts = written(found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).join(wanted.select("block", "term").distinct(), "term"), "counts")
    out = None
    for number in sorted(r[0] for r in counts.select("block").distinct().collect()):  # one for each block of items
        weights = {r["term"]: weight(whole["docs"], r["df"]) for r in counts.where(F.col("block") == number).toLocalIterator()}
        weights = {t: w for t, w in weights.items() if w > 0}
        terms: dict[int, list] = {}
        for r in wanted.where(F.col("block") == number).toLocalIterator():
            if r["term"] in weights:
                terms.setdefault(r["item"], []).append((r["term"], r["times"]))
        if terms:
            run = _search_block(spark.sparkContext.broadcast(terms), spark.sparkContext.broadcast(weights), whole["docs"], whole["terms"], best, first, shard)
            some = found.mapInArrow(run, "item long, doc_id long, doc long, score long")
            out = some if out is None else out.unionByName(some)
    if out is None:
        return wanted.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).where(F.lit(False))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), F.col("doc"))
    top = out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)
    return top.join(wanted.select("item", "item_id").distinct(), "item").select("item_id", "rank", "doc_id", "score")
