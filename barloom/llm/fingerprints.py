"""Context-triggered piecewise hashing: signatures whose chunks end where a rolling hash says so."""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import each_slice, mixed, n_partitions, powers, _VALUE

#: Bytes that the rolling hash sees, chunks that a signature may have, and log2 of the smallest block size.
WINDOW, MOST, SMALLEST = 7, 64, 2
SLICE = 1 << 20
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def signatures(buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, bytes, bytes]]:
    """(log2 of the block size, signature, signature at twice the block size) of each text, in texts laid end to end.

    A chunk ends at a byte where the hash of the last WINDOW bytes, all of this text, is 0 modulo the block size. The
    block size is the smallest power of two, from 2^SMALLEST, that gives at most MOST chunks. A chunk's letter is a hash
    of its bytes. An empty text has empty signatures.
    """
    n, docs = len(buf), len(offs) - 1
    p, q = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[buf] * p[:n], out=sums[1:])
    if n >= WINDOW:
        h = mixed((sums[WINDOW:] - sums[:-WINDOW]) * q[: n - WINDOW + 1])
        at = np.flatnonzero((h & np.uint64((1 << SMALLEST) - 1)) == 0)
        h = h[at]
        level = np.minimum(np.bitwise_count((h & (~h + np.uint64(1))) - np.uint64(1)), 62).astype(np.int64)
        cut = at + WINDOW  # where the next chunk begins
        doc = np.searchsorted(offs, at, "right") - 1
        inside = cut < offs[doc + 1]  # the window lies in one text, and something follows
        cut, level, doc = cut[inside], level[inside], doc[inside]
    else:
        cut = level = doc = np.zeros(0, np.int64)
    per = np.bincount(doc * 64 + level, minlength=docs * 64).reshape(docs, 64)
    at_least = per[:, ::-1].cumsum(1)[:, ::-1]
    size = SMALLEST + np.argmax(at_least[:, SMALLEST:] + 1 <= MOST, axis=1)
    out = []
    for more in (0, 1):
        keep = level >= size[doc] + more
        filled = np.flatnonzero(np.diff(offs) > 0)
        starts = np.sort(np.concatenate([cut[keep], offs[filled]]))
        ends = np.append(starts[1:], n)
        h = mixed((sums[ends] - sums[starts]) * q[starts] + (ends - starts).astype(np.uint64))
        letters = _ALPHABET[(h >> np.uint64(58)).astype(np.int64)].tobytes()
        bounds = np.searchsorted(starts, offs, "left")
        out.append([letters[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
    return list(zip(size.tolist(), out[0], out[1]))


def shown(s: tuple[int, bytes, bytes]) -> str:
    return f"{1 << s[0]}:{s[1].decode()}:{s[2].decode()}"


def distances(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Edit distances of pairs of signatures of at most 64 letters, all pairs at once, a column of the table in one word."""
    n = len(a)
    la, lb = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    code = np.full(256, 0, np.int64)
    code[_ALPHABET] = np.arange(64)
    where = np.zeros((n, 64), np.uint64)
    for i in range(int(la.max(initial=0))):
        k = np.flatnonzero(la > i)
        c = code[np.array([a[j][i] for j in k.tolist()], np.int64)]
        where[k, c] |= np.uint64(1 << i)
    wide = np.zeros((n, int(lb.max(initial=0))), np.int64)
    for j, x in enumerate(b):
        wide[j, : len(x)] = code[np.frombuffer(x, np.uint8)]
    one = np.uint64(1)
    up, down, score = np.full(n, ~np.uint64(0)), np.zeros(n, np.uint64), la.copy()
    top = np.maximum(la - 1, 0).astype(np.uint64)
    for j in range(wide.shape[1]):
        eq = where[np.arange(n), wide[:, j]]
        xv, xh = eq | down, (((eq & up) + up) ^ up) | eq
        ph, mh = down | ~(xh | up), up & xh
        live = lb > j
        score += np.where(live, ((ph >> top) & one).astype(np.int64) - ((mh >> top) & one).astype(np.int64), 0)
        ph, mh = (ph << one) | one, mh << one
        up, down = np.where(live, mh | ~(xv | ph), up), np.where(live, ph & xv, down)
    return np.where(la == 0, lb, score)


def likeness(a: list[tuple[int, bytes, bytes]], b: list[tuple[int, bytes, bytes]]) -> np.ndarray:
    """From 0 to 1, for pairs of fingerprints: 1 less the edit distance as a share of the longer signature.

    Signatures are compared at a block size that both have: the same one (the better of the two levels counts), or the
    smaller text's doubled one with the other's own. Otherwise 0. Equal fingerprints have 1."""
    out = np.zeros(len(a))
    todo = []
    for i, (x, y) in enumerate(zip(a, b)):
        if x == y:
            out[i] = 1.0
        elif x[0] == y[0]:
            todo += [(i, x[1], y[1]), (i, x[2], y[2])] if len(x[2]) > 3 and len(y[2]) > 3 else [(i, x[1], y[1])]
        elif x[0] == y[0] + 1:
            todo.append((i, x[1], y[2]))
        elif y[0] == x[0] + 1:
            todo.append((i, x[2], y[1]))
    if todo:
        i, s, t = zip(*todo)
        most = np.maximum(1, np.maximum([len(x) for x in s], [len(x) for x in t]))
        np.maximum.at(out, np.array(i), 1 - distances(list(s), list(t)) / most)
    return out


def _laid(texts: list[str]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), raw


def fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fingerprint) for each row. Null and empty texts have one fingerprint. No shuffle."""
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in each_slice(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array([shown(s) for s in signatures(buf, offs)])], schema.names)

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


_NULL = -(2**63)


def _ids(column: pa.Array) -> np.ndarray:
    return column.cast(pa.int64()).fill_null(_NULL).to_numpy(zero_copy_only=False)


def compare_with_next(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """For each row, in the order of ids: its text, its text with the tail replaced by the next one's head, and the next.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. The edited text has its
    last floor(n_chars / 4) codepoints replaced by the first as many (or all) of the next row's text; after the last row
    comes the first. Ids are integers; a null id comes before any other, rows of one id are ordered by their text, null
    text is empty. One row is its own next. No rows give no rows.

    Texts are shuffled once, to ranges of ids. The row that begins a range also goes to the range before it, as a guest,
    so that every range knows what follows its last row; there are as many guests as ranges. Within a range rows stream
    by in order.
    """
    spark = docs.sparkSession
    n = max(2, n_partitions(spark))
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    cuts = rows.select(F.percentile_approx("id", F.array(*[F.lit(i / n) for i in range(1, n)]), F.lit(100 * n))).head()[0] or []
    bounds = np.unique(np.array(cuts, np.int64))

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = _ids(b.column(0))
            which = np.searchsorted(bounds, ids, "right")
            order = np.lexsort((ids, which))
            k = order[np.concatenate([[True], np.diff(which[order]) > 0])] if len(order) else order
            yield pa.RecordBatch.from_arrays([pa.array(which[k], pa.int32()), pa.array(ids[k], pa.int64())], ["range", "least"])

    firsts = rows.select("id").mapInArrow(ranges, "range int, least long").groupBy("range").agg(F.min("least")).collect()
    firsts = sorted((r[0], r[1]) for r in firsts)  # a row for each range
    guest_of = {least: firsts[i - 1][0] for i, (_, least) in enumerate(firsts)}
    guests = np.array(sorted(guest_of), np.int64)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = _ids(b.column(0))
            which = np.searchsorted(bounds, ids, "right")
            also = np.flatnonzero(np.isin(ids, guests))
            take = pa.array(np.concatenate([np.arange(len(ids)), also]))
            to = np.concatenate([which, np.array([guest_of[i] for i in ids[also].tolist()], np.int64)])
            guest = np.arange(len(take)) >= len(ids)
            yield pa.RecordBatch.from_arrays([pa.array(to, pa.int32()), pa.array(guest), b.column(0).take(take), b.column(1).take(take)], ["range", "guest", "id", "text"])

    dealt = rows.mapInArrow(deal, "range int, guest boolean, id long, text string").repartitionById(len(bounds) + 1, F.col("range"))
    dealt = dealt.sortWithinPartitions("range", "guest", F.col("id").asc_nulls_first(), "text")
    schema = T.StructType(
        [T.StructField(id_column, T.LongType()), T.StructField("n_chars", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")]
        + [T.StructField(c, T.DoubleType()) for c in ("near_edited", "near_next")]
    )

    def compare(ids: list, texts: list[str], own: list[bool]) -> pa.RecordBatch:
        """Rows up to the one before the last; the last is only what follows."""
        n_chars = [len(t) for t in texts]
        edited = [t[: k - k // 4] + after[: k // 4] for t, k, after in zip(texts, n_chars, texts[1:])]
        buf, offs, _ = _laid(texts)
        mine = signatures(buf, offs)
        buf, offs, raw = _laid(edited)
        theirs = signatures(buf, offs)
        k = [i for i in range(len(edited)) if own[i]]
        pick = lambda x: [x[i] for i in k]
        a, e = pick(mine), pick(theirs)
        cols = [pa.array(pick(ids), pa.int64()), pa.array(pick(n_chars), pa.int64()), pa.array([hashlib.sha256(raw[i]).hexdigest() for i in k], pa.string())]
        cols += [pa.array([shown(s) for s in x], pa.string()) for x in (a, e)]
        cols += [pa.array(likeness(a, e)), pa.array(likeness(a, [mine[i + 1] for i in k]))]
        return pa.RecordBatch.from_arrays(cols, schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, own, many = [], [], [], 0
        for b in batches:
            for guest, i, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                ids.append(i)
                texts.append(t.as_py())
                own.append(not guest)
                many += len(texts[-1])
                if many > SLICE and len(ids) > 1:
                    yield compare(ids, texts, own)
                    ids, texts, own, many = ids[-1:], texts[-1:], own[-1:], len(texts[-1])
        if len(ids) > 1:
            yield compare(ids, texts, own)

    return dealt.mapInArrow(run, schema)
