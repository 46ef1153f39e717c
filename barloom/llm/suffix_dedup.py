"""Removal of repeated passages: equal 100-byte strings are found by suffix sorting of shards, wherever they stand.

Two equal strings of LENGTH bytes have their least GRAM-byte hash at the same place, their anchor. So anchors say which
strings may be equal: a scan deals anchors, with a digest of the text around them, to ranges of the hash. What stands
around an anchor in the same bytes as before is a repeat as it is; an anchor that stands alone needs no more; only where
one anchor has different surroundings are these read again, dealt to shards, and suffix-sorted (induced.py) to tell which
of their strings are equal.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm import induced
from barloom.llm.common import _VALUE, each_slice, mixed, n_partitions, powers, written

#: Bytes of a string that counts as repeated, and of the pieces whose hashes anchor it.
LENGTH, GRAM = 100, 32
#: Anchors that a task gathers before it merges and deals them, anchors and bytes of a range, and surroundings of one
#: anchor from which its strings are dealt one by one, so that no range is filled by one anchor.
GATHER, RANGE_ANCHORS, SHARD_BYTES, HOT = 250_000, 500_000, 1 << 19, 2000
SLICE = 1 << 20
_NULL = -(2**63)


def anchors(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash of the anchor, digest of the bytes its strings cover, first string, last string, text) for each anchor."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    p, q = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[buf] * p[:n], out=sums[1:])
    g = mixed((sums[GRAM:] - sums[:-GRAM]) * q[: n - GRAM + 1])
    bits = np.uint64(int(n).bit_length())
    least = (g >> bits << bits) | np.arange(len(g), dtype=np.uint64)
    width, want = 1, LENGTH - GRAM + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: width - want], least[want - width :])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[: len(at)]
    s = np.flatnonzero(np.arange(len(at)) + LENGTH <= offs[doc + 1])
    if not len(s):
        return none.astype(np.uint64), none.astype(np.uint64), none, none, none
    at, doc = at[s], doc[s]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (doc[1:] != doc[:-1])])
    heads = np.flatnonzero(new)
    lo, hi = s[heads], s[np.append(heads[1:], len(s)) - 1]
    around = mixed((sums[hi + LENGTH] - sums[lo]) * q[lo] + (hi - lo).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return g[at[heads]], around, lo, hi, doc[heads]


def _range_of(g: np.ndarray, n: int) -> np.ndarray:
    """One of n equal ranges. Anchors are the least hashes of their neighbourhood, so they are mixed anew to spread them."""
    return (((mixed(g ^ np.uint64(0xA0761D6478BD642F)) >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)).astype(np.int64)


def _merged(doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of bytes [lo, hi) of each text, joined where they touch."""
    if not len(doc):
        return doc, lo, hi
    order = np.lexsort((lo, doc))
    doc, lo, hi = doc[order], lo[order], hi[order]
    far = int(hi.max()) + 1
    reach = np.maximum.accumulate(hi + doc * far)  # no run of a text reaches into the next one's numbers
    new = np.concatenate([[True], (lo + doc * far)[1:] > reach[:-1]])
    heads = np.flatnonzero(new)
    last = np.append(heads[1:], len(doc)) - 1
    return doc[heads], lo[heads], reach[last] - doc[heads] * far


def _spread(ids: np.ndarray, n: int) -> np.ndarray:
    """One of n tasks for the marks of each text, by its id alone: copies of one text do not fill one task."""
    return (mixed(ids.astype(np.int64).view(np.uint64)) % np.uint64(n)).astype(np.int64)


_FOUND = "id long, hash long, ask boolean, data binary"
_SCAN = "range int, mark boolean, id long, hash long, data binary, anchors binary, around binary, text binary, start binary, more binary, ids binary, hashes binary"


def _marks(ids: np.ndarray, hashes: np.ndarray, doc: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> list[tuple]:
    """(id, hash, runs) of each text that has runs of repeated bytes."""
    doc, lo, hi = _merged(doc, lo, hi)
    cuts = np.append(np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])), len(doc)) if len(doc) else np.zeros(1, np.int64)
    both = np.stack([lo, hi], 1).astype("<i8")
    return [(int(ids[doc[a]]), int(hashes[doc[a]]), both[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]


def _scan(n: int):
    """Anchors by range. Surroundings that a task meets again are marked there and not sent."""

    def flush(got: list, ids: list, hashes: list) -> Iterator[pa.RecordBatch]:
        g, around, lo, hi, doc = (np.concatenate(x) for x in zip(*got))
        ids_, hashes_ = np.concatenate(ids), np.concatenate(hashes)
        rank = np.empty(len(ids_), np.int64)
        rank[np.lexsort((hashes_, ids_))] = np.arange(len(ids_))
        order = np.lexsort((lo, rank[doc], around, g))
        g, around, lo, hi, doc = g[order], around[order], lo[order], hi[order], doc[order]
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (around[1:] != around[:-1])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        itself = (ids_[doc] == ids_[doc[lead]]) & (hashes_[doc] == hashes_[doc[lead]]) & (lo == lo[lead])
        k = np.flatnonzero(~first & ~itself)
        marks = _marks(ids_, hashes_, doc[k], lo[k], hi[k] + LENGTH)
        rows = [(to, True, *m, *[None] * 7) for to, m in zip(_spread(np.array([m[0] for m in marks], np.int64), n).tolist(), marks)]
        k = np.flatnonzero(first)
        to = _range_of(g[k], n)
        k, to = k[np.argsort(to, kind="stable")], np.sort(to)
        cuts = np.searchsorted(to, np.arange(n + 1))
        for r in np.flatnonzero(np.diff(cuts)).tolist():
            j = k[cuts[r] : cuts[r + 1]]
            who, text = np.unique(doc[j], return_inverse=True)
            rows.append((r, False, None, None, None, g[j].tobytes(), around[j].tobytes(), text.astype("<u4").tobytes(), lo[j].astype("<i8" if len(j) and lo[j].max() >= 1 << 32 else "<u4").tobytes(), (hi[j] - lo[j]).astype("u1").tobytes(), ids_[who].tobytes(), hashes_[who].tobytes()))
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 8]
        names = [x.split()[0] for x in _SCAN.split(", ")]
        for a in range(0, len(rows), 512):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 512]), kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, ids, hashes, many, docs = [], [], [], 0, 0
        for rows, buf, offs in each_slice(batches, "text", SLICE):
            g, around, lo, hi, doc = anchors(buf, offs)
            got.append((g, around, lo - offs[doc], hi - offs[doc], doc + docs))
            ids.append(rows.column("id").to_numpy())
            hashes.append(rows.column("hash").to_numpy())
            docs += len(offs) - 1
            many += len(g)
            if many >= GATHER:
                yield from flush(got, ids, hashes)
                got, ids, hashes, many, docs = [], [], [], 0, 0
        if got:
            yield from flush(got, ids, hashes)

    return run


def _compare(table: pa.Table) -> pa.Table:
    """Of a range of anchors: marks for surroundings that stood before, and what must be read where they differ."""
    marks = table.filter(table["mark"])
    rows = [(i, h, False, d) for i, h, d in zip(*(marks[c].to_pylist() for c in ("id", "hash", "data")))]
    t = table.filter(pc.invert(table["mark"]))
    if len(t):
        join = lambda c, k: np.frombuffer(b"".join(t[c].to_pylist()), k)
        g, around, more, ids, hashes = join("anchors", np.uint64), join("around", np.uint64), join("more", np.uint8).astype(np.int64), join("ids", np.int64), join("hashes", np.int64)
        sizes = np.array([len(x) // 4 for x in t["text"].to_pylist()])
        texts = np.array([len(x) // 8 for x in t["ids"].to_pylist()])
        doc = join("text", "<u4").astype(np.int64) + np.repeat(np.cumsum(texts) - texts, sizes)
        lo = np.concatenate([np.frombuffer(x, "<i8" if len(x) == 8 * m else "<u4").astype(np.int64) for x, m in zip(t["start"].to_pylist(), sizes.tolist())])
        order = np.lexsort((lo, hashes[doc], ids[doc], around, g))
        g, around, more, doc, lo = g[order], around[order], more[order], doc[order], lo[order]
        first = np.ones(len(g), bool)
        first[1:] = (g[1:] != g[:-1]) | (around[1:] != around[:-1])
        lead = np.maximum.accumulate(np.where(first, np.arange(len(g)), 0))
        itself = (ids[doc] == ids[doc[lead]]) & (hashes[doc] == hashes[doc[lead]]) & (lo == lo[lead])
        k = np.flatnonzero(~first & ~itself)
        key = np.stack([ids, hashes], 1)
        _, same = np.unique(key, axis=0, return_inverse=True)  # portions may each have met the same text
        where = np.zeros(int(same.max()) + 1, np.int64)
        where[same.reshape(-1)] = np.arange(len(ids))
        doc = where[same.reshape(-1)[doc]]
        rows += [(i, h, False, d) for i, h, d in _marks(ids, hashes, doc[k], lo[k], lo[k] + more[k] + LENGTH)]
        k = np.flatnonzero(first)
        heads = np.flatnonzero(np.concatenate([[True], g[k][1:] != g[k][:-1]]))
        many = np.repeat(np.diff(np.append(heads, len(k))), np.diff(np.append(heads, len(k))))
        k, many = k[many > 1], many[many > 1]
        by = np.argsort(doc[k], kind="stable")
        k, many = k[by], many[by]
        ask = np.empty(len(k), [("g", "<u8"), ("lo", "<i8"), ("more", "u1"), ("hot", "u1")])
        ask["g"], ask["lo"], ask["more"], ask["hot"] = g[k], lo[k], more[k], many > HOT
        cuts = np.append(np.flatnonzero(np.concatenate([[True], doc[k][1:] != doc[k][:-1]])), len(k)) if len(k) else np.zeros(1, np.int64)
        rows += [(int(ids[doc[k[a]]]), int(hashes[doc[k[a]]]), True, ask[a:b].tobytes()) for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
    cols = list(zip(*rows)) if rows else [[]] * 4
    return pa.table([pa.array(c, k) for c, k in zip(cols, kinds)], ["id", "hash", "ask", "data"])


_ASK = np.dtype([("g", "<u8"), ("lo", "<i8"), ("more", "u1"), ("hot", "u1")])
_SEGMENTS = "shard int, mark boolean, id long, hash long, data binary, bytes binary, lens binary, ids binary, hashes binary, starts binary"


def _read(n: int):
    """The bytes that are asked for, by shard: all strings of an anchor go to one, those of a hot one each to its own.

    Strings of hot anchors that a task meets again are marked there and not sent."""

    def flush(parts: list, alone: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
        by: dict[int, list] = {}
        for p in parts:
            by.setdefault(p[0], []).append(p)
        again = []
        for piece, met in alone.items():
            met = sorted(set(met))  # a text that is read twice is one text
            again += met[1:]
            k = int.from_bytes(hashlib.blake2b(piece, digest_size=6).digest(), "big") * n >> 48
            by.setdefault(k, []).append((k, piece, LENGTH, *met[0]))
        rows = [(k, False, None, None, None, b"".join(x[1] for x in v), *[np.array([x[j] for x in v], t).tobytes() for j, t in ((2, "<u4"), (3, "<i8"), (4, "<i8"), (5, "<i8"))]) for k, v in sorted(by.items())]
        if again:
            i, h, at = np.array(again, np.int64).T
            who, doc = np.unique(np.stack([i, h], 1), axis=0, return_inverse=True)
            marks = _marks(who[:, 0], who[:, 1], doc.reshape(-1), at, at + LENGTH)
            rows += [(to, True, *m, *[None] * 5) for to, m in zip(_spread(np.array([m[0] for m in marks], np.int64), n).tolist(), marks)]
        kinds = [pa.int32(), pa.bool_(), pa.int64(), pa.int64(), *[pa.binary()] * 6]
        for a in range(0, len(rows), 512):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[a : a + 512]), kinds)], [x.split()[0] for x in _SEGMENTS.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, alone, many = [], {}, 0
        for b in batches:
            for i, h, text, asks in zip(*(b.column(c) for c in ("id", "hash", "text", "asks"))):
                raw = text.as_py().encode()
                ask = np.frombuffer(b"".join(asks.as_py()), _ASK)
                shard = _range_of(ask["g"], n).tolist()
                for k, lo, more, hot in zip(shard, ask["lo"].tolist(), ask["more"].tolist(), ask["hot"].tolist()):
                    if hot:
                        for s in range(lo, lo + more + 1):
                            alone.setdefault(raw[s : s + LENGTH], []).append((i.as_py(), h.as_py(), s))
                        many += (more + 1) * LENGTH
                    else:
                        parts.append((k, raw[lo : lo + more + LENGTH], more + LENGTH, i.as_py(), h.as_py(), lo))
                        many += more + LENGTH
                if many > 8 << 20:
                    yield from flush(parts, alone)
                    parts, alone, many = [], {}, 0
        if parts or alone:
            yield from flush(parts, alone)

    return run


def _repeated(raw: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first byte, byte after the last) of the runs of strings of LENGTH bytes whose hash stands in a shard at least
    twice. Strings of other hashes have no equal one in the shard, which has all strings of its anchors."""
    n = len(raw)
    p, q = powers(n + 1)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_VALUE[raw] * p[:n], out=sums[1:])
    segment, ends = np.repeat(np.arange(len(lens)), lens), np.cumsum(lens)
    at = np.flatnonzero(np.arange(n) + LENGTH <= ends[segment])
    g = mixed((sums[at + LENGTH] - sums[at]) * q[at])
    order = np.argsort(g)
    same = g[order[1:]] == g[order[:-1]]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = at[twice]
    return _merged(segment[at], at, at + LENGTH)


def _sort(table: pa.Table) -> pa.Table:
    """A shard: its suffixes in order, and marks for every string of LENGTH bytes that has an equal one before it, with
    the marks that came along. Bytes of no string whose hash stands twice are left out of the order."""
    came = table.filter(table["mark"]).select(["id", "hash", "data"])
    table = table.filter(pc.invert(table["mark"]))
    if not len(table):
        return came
    join = lambda c, k: np.frombuffer(b"".join(table[c].to_pylist()), k)
    raw, lens, ids, hashes, starts = join("bytes", np.uint8), join("lens", "<u4").astype(np.int64), join("ids", "<i8"), join("hashes", "<i8"), join("starts", "<i8")
    of, lo, hi = _repeated(raw, lens)
    if not len(of):
        return came
    starts = starts[of] + lo - (np.cumsum(lens) - lens)[of]
    ids, hashes, lens = ids[of], hashes[of], hi - lo
    raw = raw[np.repeat(lo - np.cumsum(lens) + lens, lens) + np.arange(int(lens.sum()))]
    begin = np.cumsum(lens + 1) - lens - 1
    text = np.zeros(int((lens + 1).sum()), np.int16)
    segment = np.repeat(np.arange(len(lens)), lens + 1)
    offset = np.arange(len(text)) - begin[segment]
    text[offset < lens[segment]] = raw.astype(np.int16) + 1
    order, lcp = induced.suffixes(text, LENGTH)
    group = np.cumsum(lcp < LENGTH)
    whole = offset[order] + LENGTH <= lens[segment[order]]
    order, group = order[whole], group[whole]
    _, doc = np.unique(np.stack([ids, hashes], 1), axis=0, return_inverse=True)  # in the order of ids, then of texts
    doc = doc.reshape(-1)
    d, at = doc[segment[order]], starts[segment[order]] + offset[order]
    by = np.lexsort((at, d, group))
    group, d, at = group[by], d[by], at[by]
    head = np.concatenate([[True], group[1:] != group[:-1]]) if len(group) else np.zeros(0, bool)
    lead = np.maximum.accumulate(np.where(head, np.arange(len(group)), 0))
    k = np.flatnonzero((d != d[lead]) | (at != at[lead]))
    one = np.zeros(int(doc.max()) + 1, np.int64)
    one[doc] = np.arange(len(doc))
    rows = _marks(ids[one], hashes[one], d[k], at[k], at[k] + LENGTH)
    cols = list(zip(*rows)) if rows else [[]] * 3
    return pa.concat_tables([came, pa.table([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.binary()))], ["id", "hash", "data"])])


def _kept(with_kept: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (x.slice(a, 256) for x in batches for a in range(0, x.num_rows, 256)):
            out = []
            for i, text, runs in zip(*(b.column(c) for c in ("id", "text", "runs"))):
                raw, spans, gone = text.as_py().encode(), 0, 0
                kept = raw
                if runs.as_py():
                    r = np.concatenate([np.frombuffer(x, "<i8").reshape(-1, 2) for x in runs.as_py()])
                    _, lo, hi = _merged(np.zeros(len(r), np.int64), r[:, 0], r[:, 1])
                    spans, gone = len(lo), int((hi - lo).sum())
                    kept = b"".join([raw[a:z] for a, z in zip([0, *hi.tolist()], [*lo.tolist(), len(raw)])])
                out.append((i.as_py(), len(raw), gone, spans, hashlib.sha256(kept).hexdigest(), kept if with_kept else None))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return run


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", with_kept: bool = True) -> DataFrame:
    """For each row of docs: id, n_bytes, n_removed, n_spans, kept_sha256 and, with_kept, the bytes that stay (kept).

    Texts count as UTF-8 bytes, null as empty. Every byte is removed that lies in a string of LENGTH bytes which also
    starts earlier: in a text with a smaller id, or earlier in the same text; strings never cross texts, they may overlap
    and are judged on the input. Ids are integers; a null id is smaller than any other. Texts that share an id are ordered
    by a hash of theirs; rows that repeat id and text are one text and give a row each. No rows give no rows. Texts of any
    length are whole, columns other than the two are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(F.col(id_column).cast("long"), F.lit(_NULL)).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    size = docs.agg(F.sum(F.octet_length(text))).head()[0] or 0
    n = max(n_partitions(spark), math.ceil(size * 2 / (LENGTH - GRAM + 2) / RANGE_ANCHORS))
    found = written(rows.where(F.octet_length("text") >= LENGTH).mapInArrow(_scan(n), _SCAN).groupBy("range").applyInArrow(_compare, _FOUND), "found")
    asked = found.where("ask")
    bytes_ = asked.agg(F.sum(F.octet_length("data"))).head()[0] or 0
    shards = max(n_partitions(spark), math.ceil(bytes_ / _ASK.itemsize * 1.4 * LENGTH / SHARD_BYTES))
    asks = asked.groupBy("id", "hash").agg(F.collect_list("data").alias("asks"))
    segments = rows.join(asks, ["id", "hash"]).mapInArrow(_read(shards), _SEGMENTS)
    sorted_ = segments.groupBy("shard").applyInArrow(_sort, "id long, hash long, data binary")
    marks = found.where("not ask").select("id", "hash", "data").unionByName(sorted_).groupBy("id", "hash").agg(F.collect_list("data").alias("runs"))
    out = rows.join(marks, ["id", "hash"], "left").mapInArrow(_kept(with_kept), "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
    own = F.when(F.col("id") != _NULL, F.col("id")).cast(docs.schema[id_column].dataType).alias(id_column)
    return out.select(own, "n_bytes", "n_removed", "n_spans", "kept_sha256", *["kept"] * with_kept)
