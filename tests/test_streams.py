"""Streams that stop and go on: decisions with keyed state, messages over batches, publication with a ledger."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.streaming import decisions, flush
from barloom.streaming import events as ev

MONDAY = 1767625200  # 2026-01-05 10:00 in New York


def bar_events(spark, rows):
    """rows: (arrival, eventId, instrument, day, revision)."""
    e = spark.createDataFrame(rows, "arrival long, eventId string, instrumentId string, day int, revision int")
    return e.withColumn("occurredAt", F.timestamp_seconds(F.lit(MONDAY) + F.col("day") * 86400)).withColumn("sequence", F.col("arrival")).withColumn("correctionOfEventId", F.when(F.col("revision") > 0, F.lit("x")))


def source_of(spark, frames, path):
    for f in frames:
        f.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(frames[0].schema).option("maxFilesPerTrigger", 1).parquet(path)


def test_decisions_go_on_where_the_stream_stopped(spark, tmp_path):
    rows = [(1, "a", "A", 0, 0), (2, "a", "A", 1, 0), (3, "b", "A", 1, 0), (4, "c", "A", 1, 0), (5, "d", "A", 1, 2), (6, "e", "A", 1, 1), (7, "f", "A", 0, 1)]
    more = [(8, "a", "A", 0, 0), (9, "g", "A", 2, 0), (10, "d", "A", 1, 2), (11, "b", "B", 2, 0), (12, "h", "A", 0, 2)]
    later = [(13, "i", "A", 8, 0)]
    last = [(14, "a", "A", 0, 0), (15, "i", "B", 8, 0)]
    want = {1: "ACCEPTED_NEW", 2: "DUPLICATE_EVENT", 3: "ACCEPTED_NEW", 4: "REVISION_CONFLICT", 5: "CORRECTION_APPLIED", 6: "SUPERSEDED_REVISION", 7: "CORRECTION_APPLIED"}
    # An id is a repeat in every shard, and a correction of a past bar does not move the shard's head.
    want |= {8: "DUPLICATE_EVENT", 9: "ACCEPTED_NEW", 10: "DUPLICATE_EVENT", 11: "DUPLICATE_EVENT", 12: "CORRECTION_APPLIED", 13: "ACCEPTED_NEW"}
    # The first session is forgotten by now: its bar is taken anew, and is late.
    want |= {14: "ACCEPTED_LATE", 15: "DUPLICATE_EVENT"}
    path = str(tmp_path / "out")
    for part in ([rows], [more, later], [last]):
        stream = source_of(spark, [bar_events(spark, p) for p in part], str(tmp_path / "in"))
        got = {r.sequence: r.decision for r in ev.run_to_table(decisions.decide(stream), "d", path=path).collect()}
        assert got == {k: v for k, v in want.items() if k <= max(got)}
    assert len(got) == len(want)


def test_heads_are_kept_over_batches_and_never_go_back(spark, tmp_path):
    parts = [[(1, "a", "A", 3, 0)], [(2, "b", "A", 2, 0), (3, "c", "A", 4, 0), (4, "d", "A", 3, 1)], [(5, "e", "A", 3, 2), (6, "f", "B", 1, 0), (7, "g", "A", 5, 0)]]
    stream = source_of(spark, [bar_events(spark, p) for p in parts], str(tmp_path / "in"))
    got = {r.sequence: r.decision for r in ev.run_to_table(decisions.decide(stream, shards=1), "d", path=str(tmp_path / "out")).collect()}
    assert got == {1: "ACCEPTED_NEW", 2: "ACCEPTED_LATE", 3: "ACCEPTED_NEW", 4: "CORRECTION_APPLIED", 5: "CORRECTION_APPLIED", 6: "ACCEPTED_LATE", 7: "ACCEPTED_NEW"}


def test_state_does_not_grow_with_sessions(spark, tmp_path):
    parts = [[(100 * d + i, f"e{d}-{i}", f"I{i}", d, 0) for i in range(30)] for d in range(0, 40, 4)]
    stream = source_of(spark, [bar_events(spark, p) for p in parts], str(tmp_path / "in"))
    query = ev.run_batches(decisions.decide(stream), lambda batch, number: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/{number}"), str(tmp_path / "state"))
    rows = [[o["numRowsTotal"] for o in p["stateOperators"]] for p in query.recentProgress if p["numInputRows"]]
    assert len(rows) == 10 and all(max(r[k] for r in rows[5:]) <= max(r[k] for r in rows[:5]) for k in range(3))


def test_messages_are_whole_or_refused(spark, tmp_path):
    kind = "message_id long, events int, eventId string, refusal string, occurredAt timestamp"
    at = lambda day: dt.datetime(2026, 1, 5, 15) + dt.timedelta(days=day)
    parts = [
        [(1, 2, "a", None, at(0)), (1, 2, "b", None, at(0)), (2, 3, "c", None, at(0)), (3, 2, "d", "MALFORMED_EVENT:x", at(0)), (4, 2, "lost", None, at(0))],
        [(2, 3, "e", None, at(1)), (3, 2, "f", None, at(1))],
        [(2, 3, "g", "UNSUPPORTED_EVENT_VERSION", at(1)), (5, 1, "h", None, at(9))],
        [(6, 1, "i", None, at(9))],
    ]
    stream = source_of(spark, [spark.createDataFrame(p, kind) for p in parts], str(tmp_path / "in"))
    got = {r.eventId: r.message_ok for r in ev.run_to_table(decisions.whole_messages(stream), "m", path=str(tmp_path / "out")).collect()}
    assert got == {"a": True, "b": True, "c": False, "e": False, "g": False, "d": False, "f": False, "h": True, "i": True, "lost": False}


# ---- publication ------------------------------------------------------------------------------------------------
def bars(spark, rows):
    """rows: (instrument, day, hour, revision, close)."""
    e = spark.createDataFrame(rows, "instrument_id string, day int, hour int, revision long, close double")
    at = F.timestamp_seconds(F.lit(MONDAY) + F.col("day") * 86400 + F.col("hour") * 3600)
    return e.select("instrument_id", at.alias("bar_start_at"), F.to_date(at).alias("session_date_et"), *[F.col("close").alias(c) for c in ("open", "high", "low", "close")], F.lit(1).cast("long").alias("volume"), F.lit(1).cast("long").alias("trade_count"), "revision")


PARTS = [
    [("A", 0, 0, 1, 10.0), ("A", 0, 1, 1, 11.0), ("B", 0, 0, 1, 20.0), ("A", 1, 0, 1, 12.0), ("A", 2, 0, 1, 13.0)],
    [("A", 0, 0, 2, 15.0), ("A", 0, 1, 0, 99.0), ("C", 30, 0, 1, 30.0)],
    [("B", 1, 0, 1, 21.0)],
]
WANT = {("A", 0, 0): 15.0, ("A", 0, 1): 11.0, ("B", 0, 0): 20.0, ("A", 1, 0): 12.0, ("A", 2, 0): 13.0, ("C", 30, 0): 30.0, ("B", 1, 0): 21.0}


def held(store):
    return {(r.instrument_id, (int(r.t) - MONDAY) // 86400, (int(r.t) - MONDAY) % 86400 // 3600): r.close for r in store.rows().select("instrument_id", F.unix_timestamp("bar_start_at").alias("t"), "close").collect()}


def seen(store):
    objects = sorted(tuple(r) for r in store.objects().select("id", "row_count", "content_hash").collect())
    manifests = sorted(tuple(r) for r in store.manifests().collect())
    return objects, manifests, sorted(tuple(r) for r in store.ledger().collect()), held(store)


@pytest.mark.parametrize("granularity, partitions", [("DAY", 4), ("WEEK", 2), ("MONTH", 2), ("YEAR", 1)])
def test_flush_merges_into_partitions(spark, tmp_path, granularity, partitions):
    store = flush.flush_stream(source_of(spark, [bars(spark, p) for p in PARTS], str(tmp_path / "in")), str(tmp_path / "out"), granularity)
    assert held(store) == WANT
    assert store.objects().select("partition_start").distinct().count() == partitions
    assert [(r.batch, r.revision, r.status, r.row_count) for r in store.ledger().orderBy("batch").collect()] == [(0, 1, "AVAILABLE", 5), (1, 2, "AVAILABLE", 3), (2, 3, "AVAILABLE", 1)]
    # Partitions that a batch does not touch keep the object of the revision before.
    if granularity == "DAY":
        assert {r.data_revision for r in store.objects().collect()} == {1, 2, 3}


def test_flush_that_is_killed_before_its_ledger_ends_alike(spark, tmp_path):
    whole = flush.flush_stream(source_of(spark, [bars(spark, p) for p in PARTS], str(tmp_path / "in1")), str(tmp_path / "out1"))

    def die(number):
        if number == 1:
            raise RuntimeError("killed between manifest and ledger")

    source, path = str(tmp_path / "in2"), str(tmp_path / "out2")
    with pytest.raises(Exception, match="killed"):
        flush.flush_stream(source_of(spark, [bars(spark, p) for p in PARTS], source), path, before_ledger=die)
    stream = spark.readStream.schema(bars(spark, PARTS[0]).schema).option("maxFilesPerTrigger", 1).parquet(source)
    again = flush.flush_stream(stream, path)
    assert seen(again) == seen(whole)
    # Nothing new: no batch, no revision.
    assert seen(flush.flush_stream(stream, path)) == seen(whole)


def test_flush_of_nothing_and_of_bad_bars(spark, tmp_path):
    store = flush.Store(spark, str(tmp_path), bars(spark, PARTS[0]).schema)
    store.publish(bars(spark, PARTS[0]).limit(0), 0)
    store.publish(bars(spark, PARTS[0]), 1)
    store.publish(bars(spark, [("A", 1, 0, 5, -1.0)]), 2)
    store.publish(bars(spark, [("A", 0, 0, 3, 16.0)]), 3)
    store.publish(bars(spark, [("A", 0, 0, 9, 99.0)]), 3)  # a batch that is in the ledger is not taken twice
    assert [(r.batch, r.revision, r.status) for r in store.ledger().orderBy("batch").collect()] == [(0, None, "NO_CHANGE"), (1, 2, "AVAILABLE"), (2, 3, "QUARANTINED"), (3, 4, "AVAILABLE")]
    assert held(store) == {("A", 0, 0): 16.0, ("A", 0, 1): 11.0, ("B", 0, 0): 20.0, ("A", 1, 0): 12.0, ("A", 2, 0): 13.0}
    assert isinstance(store.schema, T.StructType)
