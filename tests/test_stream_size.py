"""Streams of many keys, and of events whose time goes back from one batch to the next."""

import datetime as dt

from pyspark.sql import functions as F

from barloom.streaming import decisions
from barloom.streaming import events as ev
from test_odd_tables import events, same_as_sql

AGAIN = [(i, dt.datetime(2024, 1, 1, 15) + dt.timedelta(hours=7 * (i % 60)), i % 5, "view" if i % 2 else "click", float(i)) for i in range(240)]


def test_ledger_of_events_whose_time_goes_back(spark, tmp_path):
    same_as_sql(spark, tmp_path, "stream_ledger", events=events(spark, AGAIN))


def test_resumed_decisions_of_events_whose_time_goes_back(spark, tmp_path):
    same_as_sql(spark, tmp_path, "stream_resume", events=events(spark, AGAIN))


def test_questions_to_the_state_do_not_grow_with_ids_and_bars(spark, tmp_path):
    e = spark.range(3000).select(F.col("id").alias("arrival"), F.concat(F.lit("e"), "id").alias("eventId"), F.concat(F.lit("I"), "id").alias("instrumentId"), F.lit(0).alias("revision"), F.timestamp_seconds(F.lit(1767625200)).alias("occurredAt"), F.col("id").alias("sequence"), F.lit(None).cast("string").alias("correctionOfEventId"))
    e.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(e.schema).parquet(str(tmp_path / "in"))
    query = ev.run_batches(decisions.decide(stream), lambda batch, number: batch.write.mode("overwrite").parquet(f"{tmp_path}/out/{number}"), str(tmp_path / "state"))
    (rows,) = [[o["numRowsTotal"] for o in p["stateOperators"]] for p in query.recentProgress if p["numInputRows"]]
    assert max(rows) <= 512 and spark.read.parquet(f"{tmp_path}/out/0").where("decision = 'ACCEPTED_NEW'").count() > 0


def test_waiting_events_come_back_as_they_were(spark, tmp_path):
    kind = "message_id long, events int, refusal string, occurredAt timestamp, big long, price decimal(20,9), share double, day date, raw binary, tags array<string>, flag boolean"
    at = dt.datetime(2026, 1, 5, 15, 0, 0, 123457)
    from decimal import Decimal

    one = (1, 2, None, at, 2**62 + 1, Decimal("12345678901.123456789"), 0.1 + 0.2, dt.date(2026, 1, 5), bytearray(b"\x00\xff"), ["a", None, 'b"'], True)
    two = (1, 2, None, None, None, None, None, None, None, None, None)
    for k, r in enumerate((one, two)):
        spark.createDataFrame([r], kind).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(spark.createDataFrame([], kind).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    got = ev.run_to_table(decisions.whole_messages(stream), "m", path=str(tmp_path / "out")).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[3] is None) == [(*one, True), (*two, True)]
