"""What becomes of each event of a stream, by keyed state: messages as a whole, ids met once, revisions of bars, heads of shards.

Each question has a key of its own, so that state is small and spread: an id, a bar, a message, a shard. Ids, bars and
messages lie in buckets, as every question to the state is a message of its own: a bucket is read once a batch, and what a
batch adds to it is one value. State lies in RocksDB; what belongs to a session of New York is removed when the stream's
event time is `retention` sessions further on."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barloom.functions.keys import session_date_et, stable_shard

#: Sessions for which ids and bars are remembered.
RETENTION = 2
#: Buckets of ids, of bars and of messages: a task holds one at a time.
BUCKETS = 512
#: Settings that a query with these operators starts with.
STATE_CONF = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}

_EVENT = "arrival bigint, eventId string, instrumentId string, at bigint, revision int, sequence bigint, correction boolean, shard int, session int"
_NAMES = [x.split()[0] for x in _EVENT.split(", ")]
_NUMBERS = {"arrival": np.int64, "at": np.int64, "revision": np.int32, "sequence": np.int64, "correction": np.bool_}
_TEXTS = ("instrumentId", "eventId", "decision")
#: Rows that leave a shard at once.
_PORTION = 100_000
_DAY = 86_400_000


class _Remembered(StatefulProcessor):
    """State of a bucket of keys. Every entry ends with its session and is dropped `retention` sessions after that; None
    keeps all. A bucket's timer is that of its earliest session."""

    def __init__(self, retention: int | None):
        self.retention = retention

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open_state()

    def due(self, session: int) -> int:
        return (session + self.retention + 1) * _DAY

    def wake(self, new: list[tuple], held: list[tuple] | None = None) -> None:
        """Sees to it that the bucket is looked at when the first entry is due; held entries have been seen to."""
        if new and self.retention is not None:
            first = min(e[-1] for e in new)
            if not held or first < min(e[-1] for e in held):
                self.handle.registerTimer(self.due(first))

    def outlived(self, entries: list[tuple], timerValues) -> tuple[list[tuple], list[tuple]]:
        """(entries that are due, entries that stay) now that a timer has gone off."""
        now = timerValues.getCurrentWatermarkInMs()
        gone = [e for e in entries if self.due(e[-1]) < now]
        return gone, [e for e in entries if self.due(e[-1]) >= now]

    def close(self) -> None:
        pass


class _Log(_Remembered):
    """A bucket whose state is only added to: one value of columns for each batch."""

    columns: str

    def open_state(self) -> None:
        self.log = self.handle.getListState("log", self.columns)

    def held(self) -> list[tuple]:
        return [e for columns in self.log.get() for e in zip(*columns)]

    def remember(self, new: list[tuple], held: list[tuple]) -> None:
        if new:
            self.log.appendValue(tuple(map(list, zip(*new))))
            self.wake(new, held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone, left = self.outlived(self.held(), timerValues)
        if gone:
            self.log.clear()
            self.remember(left, [])
        return iter([])


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    return pd.concat(list(rows), ignore_index=True).sort_values("arrival", kind="stable", ignore_index=True)


class Ids(_Log):
    """An id belongs to the first bar that it names; under another bar it is a repeat."""

    columns = "eventId array<string>, instrumentId array<string>, at array<bigint>, session array<int>"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.held()
        bar_of = {e[0]: e[1:3] for e in held}
        d = _in_order(rows)
        new, elsewhere = [], []
        for event, instrument, at, session in zip(*(d[c].tolist() for c in ("eventId", "instrumentId", "at", "session"))):
            bar = (instrument, at)
            first = bar_of.setdefault(event, bar)
            if first is bar:
                new.append((event, instrument, at, session))
            elsewhere.append(first != bar)
        self.remember(new, held)
        d["elsewhere"] = elsewhere
        yield d[[*_NAMES, "elsewhere"]]


class Bars(_Log):
    """The revision of a bar that counts, and the ids of the events that were taken for it: all that were taken, in order."""

    columns = "instrumentId array<string>, at array<bigint>, revision array<int>, eventId array<string>, session array<int>"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.held()
        bars: dict[tuple, tuple[int, set]] = {}
        for instrument, at, revision, event, _ in held:
            bars[instrument, at] = (revision, bars.get((instrument, at), (0, set()))[1] | {event})
        d = _in_order(rows)
        new, decisions = [], []
        for event, instrument, at, revision, session, elsewhere in zip(*(d[c].tolist() for c in ("eventId", "instrumentId", "at", "revision", "session", "elsewhere"))):
            counts, taken = bars.get((instrument, at), (None, None))
            if elsewhere or (taken is not None and event in taken):
                decision = "DUPLICATE_EVENT"
            elif counts is not None and revision < counts:
                decision = "SUPERSEDED_REVISION"
            elif counts == revision:
                decision = "REVISION_CONFLICT"
            else:
                decision = None
                taken = set() if taken is None else taken
                taken.add(event)
                bars[instrument, at] = (revision, taken)
                new.append((instrument, at, revision, event, session))
            decisions.append(decision)
        self.remember(new, held)
        d["decision"] = pd.Series(decisions, dtype=object)
        yield d[[*_NAMES, "decision"]]


class Heads(StatefulProcessor):
    """The newest position of a shard. What was taken is compared with all that was taken before it, a batch at a time.

    A shard's rows of a batch are columns of numbers and Arrow text; they leave in portions."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.head = handle.getValueState("head", "at bigint, sequence bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.head.get()
        parts: dict[str, list] = {c: [] for c in (*_NUMBERS, *_TEXTS)}
        for d in rows:
            for c, kind in _NUMBERS.items():
                parts[c].append(d[c].to_numpy(kind))
            for c in _TEXTS:
                parts[c].append(pa.array(d[c], pa.string()))
        n = {c: np.concatenate(parts.pop(c)) for c in _NUMBERS}
        texts = {c: pa.chunked_array(parts.pop(c)) for c in _TEXTS}
        by = np.argsort(n["arrival"], kind="stable")
        taken = pc.is_null(texts["decision"]).to_numpy()[by]
        at, sequence = (np.append(n[c][by][taken], held[i] if held else np.iinfo(np.int64).min) for i, c in enumerate(("at", "sequence")))
        # Positions by their order, then the largest so far; the head before this batch comes first.
        order = np.lexsort((sequence, at))
        place = np.empty(len(at), np.int64)
        place[order] = np.cumsum(np.concatenate([[0], (np.diff(at[order]) != 0) | (np.diff(sequence[order]) != 0)]))
        so_far = np.maximum.accumulate(np.concatenate([place[-1:], place[:-1]]))
        newer = place[:-1] > so_far[:-1]
        if newer.any():
            top = order[-1]
            self.head.update((int(at[top]), int(sequence[top])))
        is_newer = np.zeros(len(by), bool)
        is_newer[taken] = newer
        for a in range(0, len(by), _PORTION):
            k = by[a : a + _PORTION]
            out = pd.DataFrame({c: texts[c].take(pa.array(k)).to_pandas() if c in texts else n[c][k] for c in ("instrumentId", "at", "eventId", "revision", "sequence", "decision")})
            own = np.where(n["correction"][k], "CORRECTION_APPLIED", np.where(is_newer[a : a + _PORTION], "ACCEPTED_NEW", "ACCEPTED_LATE"))
            yield out.assign(decision=np.where(taken[a : a + _PORTION], own, out["decision"]))

    def close(self) -> None:
        pass


class Messages(_Log):
    """The events of a message wait until all of them are there; one that is refused refuses all. What is not complete when
    its session is forgotten is refused as a whole. Of a message that waits, the latest session of its first events counts."""

    columns = "message_id array<string>, refused array<boolean>, body array<string>, session array<int>"

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.held()
        have, new, size = {}, {}, {}
        for e in held:
            have.setdefault(e[0], []).append(e)
        for d in rows:
            for message, events, *e in zip(*(d[c].tolist() for c in ("message_id", "events", "refused", "body", "session"))):
                new.setdefault(message, []).append((message, *e))
                size[message] = max(events, size.get(message, 0))
        done = {m for m in new if len(have.get(m, [])) + len(new[m]) >= size[m]}
        wait = []
        for m in new.keys() - done:
            until = have[m][0][-1] if m in have else max(e[-1] for e in new[m])
            wait += [(*e[:-1], until) for e in new[m]]
        left = [e for e in held if e[0] not in done]
        if len(left) < len(held):
            self.log.clear()
            self.remember(left + wait, [])
        else:
            self.remember(wait, held)
        yield from self._out((e, all(not x[1] for x in (*have.get(m, []), *new[m]))) for m in done for e in (*have.get(m, []), *new[m]))

    def _out(self, events) -> Iterator[pd.DataFrame]:
        rows = [(e[2], ok) for e, ok in events]
        if rows:
            yield pd.DataFrame(rows, columns=["body", "message_ok"])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        gone, left = self.outlived(self.held(), timerValues)
        if gone:
            self.log.clear()
            self.remember(left, [])
        yield from self._out((e, False) for e in gone)


def session_number(ts: str):
    """The New York date of an instant as days since 1970."""
    return F.datediff(session_date_et(ts), F.lit("1970-01-01").cast("date"))


def _in_buckets(rows: DataFrame, buckets: int, *keys: str) -> GroupedData:
    return rows.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")).groupBy("bucket")


def _text(f: T.StructField) -> Column:
    """A column as text that _typed() turns into the same value again."""
    c, t = F.col(f.name), f.dataType
    if isinstance(t, T.TimestampType):
        return F.unix_micros(c).cast("string")
    return F.base64(c) if isinstance(t, T.BinaryType) else F.to_json(c) if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else c.cast("string")


def _typed(f: T.StructField, c: Column) -> Column:
    t = f.dataType
    if isinstance(t, T.TimestampType):
        return F.timestamp_micros(c.cast("bigint"))
    return F.unbase64(c) if isinstance(t, T.BinaryType) else F.from_json(c, t) if isinstance(t, (T.ArrayType, T.MapType, T.StructType)) else c.cast(t)


def whole_messages(events: DataFrame, retention: int | None = RETENTION, buckets: int = BUCKETS) -> DataFrame:
    """events (message_id, events: how many the message has, refusal, occurredAt and others) once their message is complete,
    with `message_ok`: whether none of its events is refused. They may come in several batches."""
    fields = events.schema.fields
    # An event is one text while it waits. Its instant is in there too: rows older than the event time would be left out.
    body = F.to_json(F.struct(*[_text(f).alias(f"c{i}") for i, f in enumerate(fields)])).alias("body")
    session = F.coalesce(session_number("occurredAt"), F.lit(0)).alias("session")
    rows = events.withWatermark("occurredAt", "0 seconds").select(F.col("message_id").cast("string").alias("message_id"), F.col("events").cast("int").alias("events"), F.col("refusal").isNotNull().alias("refused"), body, session)
    whole = _in_buckets(rows, buckets, "message_id").transformWithStateInPandas(Messages(retention), "body string, message_ok boolean", "append", "eventTime")
    # As a row of a list of one, so that a text is parsed once.
    read = F.explode(F.array(F.from_json("body", ", ".join(f"c{i} string" for i in range(len(fields)))))).alias("_e")
    return whole.select("message_ok", read).select(*[_typed(f, F.col(f"_e.c{i}")).alias(f.name) for i, f in enumerate(fields)], "message_ok")


def decide(bars: DataFrame, shards: int = 16, retention: int | None = RETENTION, timed: bool = True, buckets: int = BUCKETS) -> DataFrame:
    """(instrumentId, occurredAt, eventId, revision, sequence, decision) for each bar event of a stream.

    An id that was met under another bar, in any shard, or that was taken for this one is a DUPLICATE_EVENT. A lower
    revision of a bar than the one held is SUPERSEDED_REVISION, an equal one of another event REVISION_CONFLICT; others are
    taken: CORRECTION_APPLIED, ACCEPTED_NEW if they are the newest of the shard, else ACCEPTED_LATE. `arrival` orders
    events within a batch. Ids and bars are forgotten `retention` sessions after theirs; an event that comes later still is
    taken as if it were the first of its bar. With timed False the stream has its event time already."""
    rows = (bars.withWatermark("occurredAt", "0 seconds") if timed else bars).select(
        "arrival", "eventId", "instrumentId", F.unix_micros("occurredAt").alias("at"), "revision", "sequence", F.col("correctionOfEventId").isNotNull().alias("correction"),
        stable_shard("instrumentId", shards).alias("shard"), session_number("occurredAt").alias("session"),
    )
    once = _in_buckets(rows, buckets, "eventId").transformWithStateInPandas(Ids(retention), f"{_EVENT}, elsewhere boolean", "append", "eventTime")
    judged = _in_buckets(once, buckets, "instrumentId", "at").transformWithStateInPandas(Bars(retention), f"{_EVENT}, decision string", "append", "eventTime")
    out = judged.groupBy("shard").transformWithStateInPandas(Heads(), "instrumentId string, at bigint, eventId string, revision int, sequence bigint, decision string", "append", "none")
    return out.select("instrumentId", F.timestamp_micros("at").alias("occurredAt"), "eventId", "revision", "sequence", "decision")
