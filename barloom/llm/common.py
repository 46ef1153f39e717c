"""What the operators share: tables in the shared folder, and array helpers for texts as bytes."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Texts are worked on in slices of about this many bytes and at most this many rows, so that a task's memory does not
#: follow the batch size, whatever spark.sql.execution.arrow.maxRecordsPerBatch is.
SLICE_BYTES, SLICE_ROWS = 2 << 20, 1 << 14

WORD = "[^\\x20\\x09-\\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; one of our own only where none is set and all run on one machine."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="spark-shared-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """df written as a table in the shared folder and read back: it cuts the lineage, and lost executors cost nothing done so far."""
    path = new_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path) if partition_by else df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(*tables: DataFrame) -> None:
    """Removes the files of tables from written() that no later step reads."""
    for t in tables:
        remove(t.sparkSession, t.written_to)


def release(spark: SparkSession) -> None:
    """Lets Spark remove the shuffle files of steps whose results are written: its cleaner follows the driver's garbage
    collector, which has no reason of its own to run. Changes no result."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def n_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes of their texts end to end, offsets) for runs of at most SLICE_ROWS rows of about `limit`
    bytes; null is empty.

    A text longer than the limit is a slice of its own and is kept whole."""
    col = batch.column(column)
    if col.null_count:
        col = col.fill_null("")
    col = col.cast(pa.large_binary())
    n = len(col)
    if not n:
        return
    offs = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None and offs[-1] > offs[0] else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(offs, offs[a] + limit, "right")) - 1)
        b = min(b, n, a + SLICE_ROWS)
        yield a, b, data[offs[a] : offs[b]], offs[a : b + 1] - offs[a]
        a = b


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def lowered(buf: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte as it is."""
    return _LOWER[buf]


def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in texts laid end to end, and the words before each text (len(offs) of them)."""
    n = len(buf)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offs), np.int64)
    solid = ~_SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[offs] = True
    starts = solid.copy()
    starts[1:] &= ~solid[:-1] | edge[1:n]
    ends = solid.copy()
    ends[:-1] &= ~solid[1:] | edge[1:n]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return s, e, np.searchsorted(s, offs, "left")


_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_VALUE = (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)) ^ np.uint64(0xA5A5A5A5F00DFACE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse, modulo 2^64; kept for texts of usual length."""
    if len(_POWERS[0]) < n:
        m = max(n, SLICE_BYTES + 1)
        out = []
        for b in (_BASE, _INVERSE):
            p = np.full(m, b, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if m > 8 * SLICE_BYTES:
            return out[0], out[1]
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them over all bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes: equal spans have equal hashes, wherever they stand.

    A sum over blocks of eight bytes, each mixed with its place in the span by itself, so that no two texts agree because
    of how their letters are arranged. Where equality of spans decides a result, callers compare bytes as well."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    many = np.maximum(1, -(-size // 8))
    upto = np.cumsum(many)
    out = np.zeros(len(starts), np.uint64)
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(buf) + 1,), "<u8", padded, 0, (1,))
    a = 0
    while a < len(starts):
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + (1 << 20), "right")))
        each = many[a:b]
        place = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
        at = np.repeat(starts[a:b], each) + 8 * place
        v = eights[at] & _LOW_BYTES[np.clip(np.repeat(ends[a:b], each) - at, 0, 8)]
        key = mixed(place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0xA5A5A5A5F00DFACE))
        out[a:b] = np.add.reduceat(mixed((v ^ key) * np.uint64(0xA0761D6478BD642F) + key), np.cumsum(each) - each)
        a = b
    return mixed(out ^ (size.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)))


def planes(x: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs, bytes of one weight side by side so that they compress."""
    width = max(1, -(-int(x.max(initial=0)).bit_length() // 8)) if x.min(initial=0) >= 0 else 8
    return x.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def from_planes(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    if n:
        out[:, : len(raw) // n] = np.frombuffer(raw, np.uint8).reshape(-1, n).T
    return out.reshape(-1).view("<i8")


def doc_of(counts_before: np.ndarray) -> np.ndarray:
    """For each item, the text it stands in, from the number of items before each text."""
    return np.repeat(np.arange(len(counts_before) - 1), np.diff(counts_before))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def each_slice(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES):
    """(the rows as a batch, their bytes, offsets) over all batches."""
    for batch in batches:
        for a, b, buf, offs in slices(batch, column, limit):
            yield batch.slice(a, b - a), buf, offs
