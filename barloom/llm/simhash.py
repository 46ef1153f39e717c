"""SimHash near-dedup: pigeonring filtering of fingerprints before the full Hamming check.

A fingerprint is a ring of BOXES boxes. If two differ in at most MOST bits, then from some box on every run of l boxes
differs in at most l * MOST / BOXES bits (the strong form of the pigeonring principle): 0, 0, 1, 1, 1, 2, 2, 3 bits for
eight boxes. Two fingerprints with such a chain agree in its first two boxes and in two of the next three, so those 32
bits are the keys under which they meet. What meets is compared inside tasks along the chain, and as a whole at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.llm.common import doc_of, each_slice, lowered, n_partitions, word_spans, written
from barloom.llm.components import components

#: Words of a shingle, seed of its hash, bits of a fingerprint, bits in which linked fingerprints may differ, boxes.
WORDS, SEED, BITS, MOST, BOXES = 3, 42, 64, 3, 8
BUDGETS = [MOST * length // BOXES for length in range(1, BOXES + 1)]
#: Fingerprints of one key that are compared in a task; more are dealt again with longer keys. After three such rounds
#: 14 bits at most are free, so a key cannot have more.
GROUP, ROUNDS = 1 << 14, 3
#: Rows that share a fingerprint with this share of all rows meet it by a broadcast of at most 1 / HOT_SHARE rows.
HOT_SHARE = 1 / 512
#: Shingles whose bits are spread out at once.
BLOCK = 1 << 15

_WIDTH = BITS // BOXES


def joined_words(buf: np.ndarray, offs: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words of texts as bytes with one space after each; their starts and ends there; the words before each text."""
    s, e, before = word_spans(buf, offs)
    size = e - s
    ends = np.cumsum(size + 1)
    starts = ends - size - 1
    out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, np.uint8)
    inside = np.ones(len(out), bool)
    inside[ends - 1] = False
    edge = np.zeros(len(buf) + 1, np.int8)
    edge[s] += 1
    np.add.at(edge, e, -1)
    out[inside] = buf[np.cumsum(edge[:-1]).astype(bool)]
    return out.tobytes(), starts, ends - 1, before


def fingerprints_of(buf: np.ndarray, offs: np.ndarray, n_words: int = WORDS) -> np.ndarray:
    """The fingerprint of each text as an unsigned 64-bit number: a bit is 1 if over half of the shingles' hashes have it."""
    raw, s, e, before = joined_words(lowered(buf), offs)
    words = np.diff(before)
    n = np.where(words > 0, np.maximum(words - n_words + 1, 1), 0)
    # Shingle k of a text goes from its word k to the word n_words - 1 later, or to the last one of a short text.
    upto = np.concatenate([[0], np.cumsum(n)])
    text = doc_of(upto)
    first = np.arange(upto[-1]) - upto[text] + before[text]
    last = np.minimum(first + n_words - 1, before[text + 1] - 1)
    sums = np.zeros((len(n), BITS), np.int64)
    view, digest = memoryview(raw), xxhash.xxh64_intdigest
    for a in range(0, int(upto[-1]), BLOCK):
        b = min(a + BLOCK, int(upto[-1]))
        h = np.array([digest(view[x:y], SEED) for x, y in zip(s[first[a:b]].tolist(), e[last[a:b]].tolist())], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = text[a:b]
        heads = np.flatnonzero(np.diff(own, prepend=-1))
        sums[own[heads]] += np.add.reduceat(bits, heads, axis=0, dtype=np.int64)
    return np.packbits(2 * sums > n[:, None], axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, fp) of every row: fp is the fingerprint as a signed number. Null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, offs in each_slice(batches, "text"):
            yield pa.RecordBatch.from_arrays([rows.column("id"), pa.array(fingerprints_of(buf, offs).view(np.int64))], ["id", "fp"])

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).cast("string").alias("text")).mapInArrow(run, "id long, fp long")


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def _ring(start: int, boxes: list[int]) -> list[int]:
    """The bits of boxes counted from `start` on around the ring, box 0 being the most significant one."""
    return [BITS - 1 - ((start + x) % BOXES) * _WIDTH - k for x in boxes for k in range(_WIDTH)]


def key_masks() -> list[np.ndarray]:
    """For each round, the bits that its keys compare. Key 3 * start + j of the first round leaves box 2 + j of the chain
    free; key 4 * k + p of a later one adds the p-th quarter of the bits that key k leaves free: of four quarters that
    differ in three bits at most, one is equal."""
    held = [_ring(start, [0, 1] + [x for x in (2, 3, 4) if x != 2 + j]) for start in range(BOXES) for j in range(3)]
    out = [held]
    for _ in range(ROUNDS):
        free = [[b for b in range(BITS - 1, -1, -1) if b not in set(h)] for h in held]
        held = [h + list(part) for h, f in zip(held, free) for part in np.array_split(f, 4)]
        out.append(held)
    return [np.array([_mask([int(b) for b in h]) for h in held], np.uint64) for held in out]


MASKS = key_masks()


def _deal(level: int):
    """(k, v, fp): fingerprints under every key of a round; later rounds deal the rows (k, fp) of the round before."""
    fan = len(MASKS[0]) if level == 0 else 4

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            k = np.zeros(len(fp), np.int64) if level == 0 else batch.column("k").to_numpy(zero_copy_only=False).astype(np.int64)
            for j in range(fan):
                key = k * fan + j
                yield pa.RecordBatch.from_arrays([pa.array(key.astype(np.int32)), pa.array((fp & MASKS[level][key]).view(np.int64)), pa.array(fp.view(np.int64))], ["k", "v", "fp"])

    return run


def _chained(diff: np.ndarray, start) -> np.ndarray:
    """Which differences keep within the budgets of the chain that begins at `start`, shorter runs first; the first two
    boxes are equal, as in all that share a key."""
    turn = (np.asarray(start) * _WIDTH).astype(np.uint64)
    ring = (diff << turn) | (diff >> ((np.uint64(BITS) - turn) & np.uint64(BITS - 1)))
    good = np.flatnonzero(np.bitwise_count(ring >> np.uint64(BITS - 5 * _WIDTH)) <= BUDGETS[4])
    for length in (6, 7, 8):
        good = good[np.bitwise_count(ring[good] >> np.uint64(BITS - length * _WIDTH)) <= BUDGETS[length - 1]]
    return good


def spanning_links(fps: np.ndarray, start: int) -> list[tuple[int, int]]:
    """Links that connect what the fingerprints of one key connect: at most one for each fingerprint but the first.

    Each fingerprint is compared once with those that nothing has reached yet, so no list of pairs is made."""
    left, out = fps, []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            at = todo.pop()
            diff = left ^ at
            near = _chained(diff, start)
            near = near[np.bitwise_count(diff[near]) <= MOST]
            if len(near):
                out += [(at, x) for x in left[near]]
                todo += left[near].tolist()
                left = np.delete(left, near)
            todo = [np.uint64(x) for x in todo]
    return out


#: Runs of at most so many fingerprints are compared pair by pair, all runs of a batch side by side.
_SHORT = 16


def _meet(level: int, group: int):
    """Links (a, b, null), and (fp, null, k) for rows of keys with over `group` fingerprints. Rows come sorted by key."""
    per_start = len(MASKS[level]) // BOXES

    def runs_of(k: np.ndarray, v: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (v[1:] != v[:-1])]))

    def table(a, b, k):
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(k, pa.int32())], ["a", "b", "k"])

    def compare(k, v, fp):
        heads = runs_of(k, v)
        size = np.diff(np.append(heads, len(k)))
        small = np.repeat(size <= _SHORT, size)
        for far in range(1, _SHORT):
            i = np.flatnonzero(small[:-far] & (k[:-far] == k[far:]) & (v[:-far] == v[far:]))
            if not len(i):
                break
            diff = fp[i] ^ fp[i + far]
            good = _chained(diff, k[i] // per_start)
            good = good[np.bitwise_count(diff[good]) <= MOST]
            if len(good):
                yield table(fp[i[good]].view(np.int64), fp[i[good] + far].view(np.int64), [None] * len(good))
        for a in np.flatnonzero(size > _SHORT):
            links = spanning_links(fp[heads[a] : heads[a] + size[a]], int(k[heads[a]]) // per_start)
            if links:
                pairs = np.array(links, np.uint64).view(np.int64)
                yield table(pairs[:, 0], pairs[:, 1], [None] * len(pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, v, fp = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        over = None  # the key whose rows are all dealt again
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("k", "v", "fp")]
            k, v, fp = np.concatenate([k, new[0].astype(np.int64)]), np.concatenate([v, new[1]]), np.concatenate([fp, new[2].view(np.uint64)])
            if over is not None:
                same = int(np.argmin(np.append((k == over[0]) & (v == over[1]), False)))
                if same:
                    yield table(fp[:same].view(np.int64), [None] * same, k[:same])
                k, v, fp = k[same:], v[same:], fp[same:]
                if not len(k):
                    continue
                over = None
            last = int(runs_of(k, v)[-1])
            if last:
                yield from compare_or_again(k[:last], v[:last], fp[:last])
            k, v, fp = k[last:], v[last:], fp[last:]
            if len(k) > group:
                over = (k[0], v[0])
                yield table(fp.view(np.int64), [None] * len(k), k)
                k, v, fp = k[:0], v[:0], fp[:0]
        if len(k):
            yield from compare_or_again(k, v, fp)

    def compare_or_again(k, v, fp):
        heads = runs_of(k, v)
        size = np.diff(np.append(heads, len(k)))
        again = np.repeat(size > group, size)
        if again.any():
            yield table(fp[again].view(np.int64), [None] * int(again.sum()), k[again])
        if not again.all():
            yield from compare(k[~again], v[~again], fp[~again])

    return run


def links_between(prints: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b): enough links between different fingerprints (fp, distinct) to connect all that differ in MOST bits or fewer."""
    rows, found = prints.select("fp"), []
    for level in range(ROUNDS + 1):
        dealt = rows.mapInArrow(_deal(level), "k int, v long, fp long").repartition(n_partitions(prints.sparkSession), "k", "v").sortWithinPartitions("k", "v")
        met = written(dealt.mapInArrow(_meet(level, group if level < ROUNDS else 1 << BITS), "a long, b long, k int"), "met")
        found.append(met.where("b is not null").select("a", "b"))
        rows = met.where("b is null").select(F.col("a").alias("fp"), "k")
        if rows.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", group: int = GROUP) -> DataFrame:
    """(id, fingerprint, component_id) for each row of docs.

    fingerprint: 16 hexadecimal digits over the text's shingles of three words, repeats counted; texts of one or two words
    are one shingle; null and empty texts, and texts without words, have fingerprint zero, which links like any other.
    Fingerprints that differ in MOST bits or fewer link; component_id is the least id reached, the row's own included. Rows
    that repeat an id give a row each; a row with a null id has the component of the others, or null where none has an id.
    Empty tables give no rows; texts of any length are whole; columns other than the two are not read.
    """
    prints = written(fingerprints(docs, id_column, text_column), "prints")
    classes = written(prints.groupBy("fp").agg(F.min("id").alias("least"), F.count("*").alias("n")), "classes")
    comp = components(links_between(classes, group))
    held = classes.join(comp.withColumnRenamed("id", "fp"), "fp", "left")
    least = held.where("component is not null").groupBy("component").agg(F.min("least").alias("reached"))
    of = held.join(least, "component", "left").select("fp", "n", F.coalesce("reached", "least").alias("component_id"))
    of = written(of, "component_of")
    total = classes.agg(F.sum("n")).head()[0] or 0
    hot = of.where(F.col("n") >= max(2, total * HOT_SHARE)).select("fp", "component_id")
    rest = of.where(F.col("n") < max(2, total * HOT_SHARE)).select("fp", "component_id")
    busy = prints.join(F.broadcast(hot), "fp")
    out = busy.unionByName(prints.join(F.broadcast(hot.select("fp")), "fp", "left_anti").join(rest, "fp"))
    return out.select(F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), BITS // 4, "0")).alias("fingerprint"), "component_id")
