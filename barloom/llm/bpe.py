"""Byte-level BPE encoding and decoding: pre-tokens from a scan over codepoint classes, merged by rank, each distinct one once."""

from __future__ import annotations

import base64
import heapq
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import each_slice, span_hashes

#: Bytes of text in a slice, pre-tokens whose ids a worker remembers, and bytes from which a pre-token is merged alone.
SLICE, REMEMBERED, LONG = 1 << 20, 1 << 20, 192

# ---- pre-tokens -------------------------------------------------------------------------------------------------
# Symbols of the scan: what a codepoint is, with what its neighbours say about it.
_LETTER, _NUMBER, _OTHER, _WHITE, _WHITE_ALONE, _SPACE_BEFORE, _QUOTE1, _QUOTE2 = range(8)
# States: the kind of pre-token that the last codepoint belongs to. AFTER: a contraction has just ended.
_IN_L, _IN_N, _IN_O, _IN_W, _IN_P, _IN_C1, _IN_C2, _AFTER = range(8)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, whether a pre-token starts at this codepoint)."""
    if symbol == _LETTER:
        if state in (_IN_C1, _IN_C2):
            return (_AFTER if state == _IN_C1 else _IN_C1), False
        return _IN_L, state not in (_IN_L, _IN_P)
    if symbol == _NUMBER:
        return _IN_N, state not in (_IN_N, _IN_P)
    if symbol == _OTHER or state in (_IN_O, _IN_P) and symbol in (_QUOTE1, _QUOTE2):
        return _IN_O, state not in (_IN_O, _IN_P)
    if symbol in (_QUOTE1, _QUOTE2):
        return (_IN_C1 if symbol == _QUOTE1 else _IN_C2), True
    if symbol == _WHITE:
        return _IN_W, state != _IN_W
    return (_IN_W if symbol == _WHITE_ALONE else _IN_P), True


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All transition functions that symbols generate, as numbers: of each symbol, of each symbol at the start of a
    text, the product of any two (second after first), which are constant, and the value of the constant ones."""
    own = [tuple(_step(s, x)[0] for s in range(8)) for x in range(8)]
    first = [(f[_IN_W],) * 8 for f in own]
    ids: dict[tuple, int] = {}
    todo = [*own, *first]
    while todo:
        f = todo.pop()
        if f not in ids:
            ids[f] = len(ids)
            todo += [tuple(g[x] for x in f) for g in own]
    while True:
        new = {tuple(b[x] for x in a) for a in ids for b in ids} - ids.keys()
        if not new:
            break
        for f in sorted(new):
            ids[f] = len(ids)
    product = np.zeros((len(ids), len(ids)), np.uint8)
    for a, i in ids.items():
        for b, j in ids.items():
            product[i, j] = ids[tuple(b[x] for x in a)]
    constant = np.array([len(set(f)) == 1 for f in ids])
    return np.array([ids[f] for f in own], np.uint8), np.array([ids[f] for f in first], np.uint8), product, constant, np.array([f[0] for f in ids], np.uint8)


_OWN, _FIRST, _PRODUCT, _CONSTANT, _VALUE_OF = _monoid()
_STARTS = np.array([[_step(s, x)[1] for x in range(8)] for s in range(8)])

_CLASSES: np.ndarray | None = None


def classes() -> np.ndarray:
    """For each codepoint: letter, number, other or white space."""
    global _CLASSES
    if _CLASSES is None:
        c = np.full(0x110000, _OTHER, np.uint8)
        for i in range(0x110000):
            kind = unicodedata.category(chr(i))[0]
            if kind == "L":
                c[i] = _LETTER
            elif kind == "N":
                c[i] = _NUMBER
        white = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
        c[white] = _WHITE
        _CLASSES = c
    return _CLASSES


def codepoints(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(codepoints of UTF-8 bytes, the byte at which each starts)."""
    lead = np.flatnonzero((buf & 0xC0) != 0x80)
    b = buf[lead].astype(np.int32)
    if len(lead) == len(buf):
        return b, lead
    cp = b.copy()
    wide = np.concatenate([buf, np.zeros(3, np.uint8)])
    for low, high, n, mask in ((0xC0, 0xE0, 1, 0x1F), (0xE0, 0xF0, 2, 0x0F), (0xF0, 0x100, 3, 0x07)):
        k = np.flatnonzero((b >= low) & (b < high))
        if len(k):
            v = b[k] & mask
            for j in range(1, n + 1):
                v = (v << 6) | (wide[lead[k] + j] & 0x3F)
            cp[k] = v
    return cp, lead


def pre_tokens(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The bytes at which pre-tokens start, in texts laid end to end; each ends where the next one starts.

    The pattern is a machine of eight states over symbols that a codepoint and its neighbours give. Its transition
    functions form a small monoid; their running products come from doubling steps (x[i] takes x[i - d] before it),
    which stop as soon as every product is constant, that is, no longer depends on what came before.
    """
    if not len(buf):
        return np.zeros(0, np.int64)
    cp, at = codepoints(buf)
    sym = classes()[cp]
    n = len(cp)
    bounds = np.searchsorted(at, offs)
    first = np.zeros(n + 1, bool)
    first[bounds] = True
    last = first[1:]  # the codepoint after it begins another text
    white = sym == _WHITE
    before_solid = np.zeros(n, bool)
    before_solid[:-1] = ~white[1:]
    before_solid &= ~last
    k = np.flatnonzero(white & before_solid)
    sym[k] = np.where(cp[k] == 0x20, _SPACE_BEFORE, _WHITE_ALONE)
    q = np.flatnonzero(cp == 0x27)
    q = q[q + 1 < n]
    q = q[~last[q]]
    if len(q):
        one = np.isin(cp[q + 1], [ord(x) for x in "stmd"])
        two = np.zeros(len(q), bool)
        r = np.flatnonzero(q + 2 < n)
        r = r[~last[q[r] + 1]]
        a, b = cp[q[r] + 1], cp[q[r] + 2]
        two[r] = ((a == ord("r")) & (b == ord("e"))) | ((a == ord("v")) & (b == ord("e"))) | ((a == ord("l")) & (b == ord("l")))
        sym[q[one]] = _QUOTE1
        sym[q[two & ~one]] = _QUOTE2
    x = _OWN[sym]
    start = bounds[bounds < n]
    x[start] = _FIRST[sym[start]]
    d = 1
    while not _CONSTANT[x].all():
        x[d:] = _PRODUCT[x[:-d], x[d:]]
        d *= 2
    state = np.empty(n, np.uint8)
    state[0] = _IN_W
    state[1:] = _VALUE_OF[x[:-1]]
    state[start] = _IN_W
    begins = _STARTS[state, sym]
    begins[start] = True
    return at[begins]


# ---- merges -----------------------------------------------------------------------------------------------------
class Ranks:
    """The vocabulary: bytes of each id, and for two ids that stand side by side the id of their joined bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        size = max(ranks.values()) + 1
        by_id = [b""] * size
        for word, i in ranks.items():
            by_id[i] = word
        self.ends = np.cumsum([len(w) for w in by_id])
        self.lens = np.array([len(w) for w in by_id], np.int64)
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        pairs = {}
        for word, i in ranks.items():
            for k in range(1, len(word)):
                a, b = ranks.get(word[:k]), ranks.get(word[k:])
                if a is not None and b is not None:
                    pairs[(a << 32) | b] = i
        self.keys = np.array(sorted(pairs), np.int64)
        self.values = np.array([pairs[k] for k in self.keys.tolist()] or [0], np.int32)
        # An exact table by hash: a slot holds the key that it answers for; keys whose slot was taken are looked up in order.
        self.bits = 22
        self.slot = np.full(1 << self.bits, -1, np.int64)
        self.slot_value = np.zeros(1 << self.bits, np.int32)
        if len(self.keys):
            h = self._slot(self.keys)
            self.slot[h] = self.keys
            self.slot_value[h] = self.values
        mine = self.slot[self._slot(self.keys)] == self.keys
        self.over, self.over_value = self.keys[~mine], self.values[: len(self.keys)][~mine]
        self.crowded = np.zeros(1 << self.bits, bool)
        self.crowded[self._slot(self.over)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    NONE = np.int32(2**31 - 1)

    def joined(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The id of the two joined, or NONE."""
        keys = (a.astype(np.int64) << 32) | b
        h = self._slot(keys)
        out = np.where(self.slot[h] == keys, self.slot_value[h], self.NONE)
        k = np.flatnonzero((out == self.NONE) & self.crowded[h])
        if len(k) and len(self.over):
            j = np.minimum(np.searchsorted(self.over, keys[k]), len(self.over) - 1)
            out[k] = np.where(self.over[j] == keys[k], self.over_value[j], self.NONE)
        return out

    def merge_alone(self, word: bytes) -> list[int]:
        """Ids of one long pre-token: the lowest rank first, the leftmost of equal ones, by a heap over a linked list."""
        ids = [self.ranks[bytes([c])] for c in word]
        n = len(ids)
        after, before, text = list(range(1, n + 1)), list(range(-1, n - 1)), [bytes([c]) for c in word]
        heap = []

        def offer(i: int) -> None:
            j = after[i]
            if j < n and (r := self.ranks.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (r, i, len(text[i]), len(text[j])))

        for i in range(n - 1):
            offer(i)
        while heap:
            r, i, la, lb = heapq.heappop(heap)
            j = after[i]
            if not text[i] or j >= n or len(text[i]) != la or len(text[j]) != lb:
                continue
            text[i], ids[i] = text[i] + text[j], r
            text[j] = b""
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(i)
            if before[i] >= 0:
                offer(before[i])
        return [ids[i] for i in range(n) if text[i]]

    def merge(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all spans end to end, how many each has): every round joins in each span its leftmost pair of lowest rank."""
        n = len(starts)
        lens = ends - starts
        done_word: list[np.ndarray] = []
        done_id: list[np.ndarray] = []
        for w in np.flatnonzero(lens > LONG).tolist():
            ids = self.merge_alone(buf[starts[w] : ends[w]].tobytes())
            done_word.append(np.full(len(ids), w))
            done_id.append(np.array(ids, np.int32))
        short = np.flatnonzero(lens <= LONG)
        total = int(lens[short].sum())
        word = np.repeat(short, lens[short])
        begin = np.cumsum(lens[short]) - lens[short]
        ids = self.single[buf[np.repeat(starts[short] - begin, lens[short]) + np.arange(total)]]
        rank = np.full(total, self.NONE)
        if total:
            inner = np.flatnonzero(word[1:] == word[:-1])
            rank[inner] = self.joined(ids[inner], ids[inner + 1])
        while len(ids):
            heads = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
            size = np.diff(np.append(heads, len(ids)))
            least = np.minimum.reduceat(rank, heads)
            each = np.repeat(least, size)
            over = each == self.NONE
            if over.any():
                done_word.append(word[over])
                done_id.append(ids[over])
                keep = ~over
                word, ids, rank, each = word[keep], ids[keep], rank[keep], each[keep]
                if not len(ids):
                    break
            hit = np.flatnonzero(rank == each)
            hit = hit[np.concatenate([[True], word[hit[1:]] != word[hit[:-1]]])]
            ids[hit] = rank[hit]
            keep = np.ones(len(ids), bool)
            keep[hit + 1] = False
            place = hit - np.arange(len(hit))  # of each joined symbol, when the right halves are gone
            word, ids, rank = word[keep], ids[keep], rank[keep]
            m = len(ids)
            for k in (place, place - 1):
                k = k[(k >= 0)]
                inside = np.zeros(len(k), bool)
                ok = k + 1 < m
                inside[ok] = word[k[ok]] == word[k[ok] + 1]
                rank[k[~inside]] = self.NONE
                k = k[inside]
                rank[k] = self.joined(ids[k], ids[k + 1])
        if not done_word:
            return np.zeros(0, np.int32), np.zeros(n, np.int64)
        words, out = np.concatenate(done_word), np.concatenate(done_id)
        order = np.argsort(words, kind="stable")
        return out[order], np.bincount(words, minlength=n)


class Encoder:
    """Ids of texts laid end to end. Equal pre-tokens are merged once and remembered."""

    def __init__(self, ranks: Ranks):
        self.ranks = ranks
        self.forget()

    def forget(self) -> None:
        self.keys, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, the number of ids before each text).

        What is remembered is found by hashes; the ids stand for bytes, so they are compared with the texts. If two
        pre-tokens have one hash, those of this call are told apart by their bytes instead."""
        starts = pre_tokens(buf, offs)
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(len(offs), np.int64)
        ends = np.append(starts[1:], len(buf))
        out, before = self._encode(buf, starts, ends, span_hashes(buf, starts, ends))
        if not np.array_equal(decode(self.ranks, out, before)[0], buf):
            raw, numbers = buf.tobytes(), {}
            own = np.array([numbers.setdefault(raw[a:b], len(numbers)) for a, b in zip(starts.tolist(), ends.tolist())], np.uint64)
            self.forget()
            out, before = self._encode(buf, starts, ends, own)
            self.forget()
        return out, before[np.searchsorted(starts, offs, "left")]

    def _encode(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids end to end, the number of ids before each pre-token and in all)."""
        distinct, where, which = np.unique(h, return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self.forget()
        k = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = k < len(self.keys)
        known[inside] = self.keys[k[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new):
            ids, counts = self.ranks.merge(buf, starts[where[new]], ends[where[new]])
            begin = np.cumsum(counts) - counts + len(self.ids)
            self.keys = np.insert(self.keys, k[new], distinct[new])
            self.start = np.insert(self.start, k[new], begin)
            self.count = np.insert(self.count, k[new], counts)
            self.ids = np.concatenate([self.ids, ids])
            k = np.searchsorted(self.keys, distinct)
        at, many = self.start[k][which], self.count[k][which]
        total = np.cumsum(many)
        out = self.ids[np.repeat(at - (total - many), many) + np.arange(total[-1])]
        return out, np.concatenate([[0], total])


def decode(ranks: Ranks, ids: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of the ids end to end, bytes before each text)."""
    lens = ranks.lens[ids]
    total = np.cumsum(lens)
    if not len(ids):
        return np.zeros(0, np.uint8), np.zeros(len(before), np.int64)
    out = ranks.bytes[np.repeat(ranks.ends[ids] - lens - (total - lens), lens) + np.arange(total[-1])]
    return out, np.concatenate([[0], total])[before]


# ---- on DataFrames ----------------------------------------------------------------------------------------------
def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


_READY: dict[int, Encoder] = {}


def _encoder(ranks: dict[bytes, int]) -> Encoder:
    """One for each worker process and vocabulary."""
    key = hash((len(ranks), tuple(list(ranks.items())[-3:])))
    if key not in _READY:
        _READY.clear()
        _READY[key] = Encoder(Ranks(ranks))
    return _READY[key]


def _binary(values: np.ndarray, before: np.ndarray) -> pa.Array:
    """Slices of an array as binary values."""
    offs = pa.py_buffer((before * values.itemsize).astype(np.int64).tobytes())
    return pa.Array.from_buffers(pa.large_binary(), len(before) - 1, [None, offs, pa.py_buffer(np.ascontiguousarray(values))]).cast(pa.binary())


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None, decoded: bool = False) -> DataFrame:
    """(id, n_tokens, ids[, decoded]) for each row; ids are little-endian unsigned 32-bit integers end to end.

    The ids are those of the vocabulary at `path` for each pre-token by itself, without special tokens. With decoded,
    the bytes that the ids stand for come along. Null and empty texts have no ids. Rows are independent, so repeated
    rows, ties and extra columns change nothing; an empty table gives an empty one. Needs no shuffle.
    """
    spark = docs.sparkSession
    table = spark.sparkContext.broadcast(read_ranks(path or default_path()))
    kind = docs.schema[id_column].dataType
    fields = [T.StructField(id_column, kind), T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
    fields += [T.StructField("decoded", T.BinaryType())] * decoded

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(table.value)
        for rows, buf, offs in each_slice(batches, "text", SLICE):
            ids, before = own.encode(buf, offs)
            cols = [rows.column("id"), pa.array(np.diff(before)), _binary(ids.astype("<u4"), before)]
            if decoded:
                cols.append(_binary(*decode(own.ranks, ids, before)))
            yield pa.RecordBatch.from_arrays(cols, [f.name for f in fields])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, T.StructType(fields))


def lengths(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens): as encode(), without the ids."""
    table = docs.sparkSession.sparkContext.broadcast(read_ranks(path or default_path()))
    schema = T.StructType([T.StructField(id_column, docs.schema[id_column].dataType), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = _encoder(table.value)
        for rows, buf, offs in each_slice(batches, "text", SLICE):
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(np.diff(own.encode(buf, offs)[1]))], schema.names)

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, id_column: str = "doc_id", ids_column: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) from ids as encode() returns them; bytes that are no UTF-8 become U+FFFD. Null ids give null."""
    table = encoded.sparkSession.sparkContext.broadcast(read_ranks(path or default_path()))
    schema = T.StructType([T.StructField(id_column, encoded.schema[id_column].dataType), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = _encoder(table.value).ranks
        for batch in batches:
            out = []
            for x in batch.column("ids").to_pylist():
                ids = np.frombuffer(x or b"", "<u4").astype(np.int64)
                out.append(None if x is None else decode(ranks, ids, np.array([0, len(ids)]))[0].tobytes().decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(out, pa.string())], schema.names)

    return encoded.select(F.col(id_column).alias("id"), F.col(ids_column).alias("ids")).mapInArrow(run, schema)
