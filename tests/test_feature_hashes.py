"""Hashes that other readers of the published features rely on."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import features
from barloom.sources import files

# One instrument, five bars, a definition, its inputs, and the hashes that must come out.
INSTRUMENT = "aaaaaaaa-0000-4000-8000-000000000001"
CLOSES = (100, 104, 108, 111, 107)
CATALOG = "0e5a1c9e-1111-4a11-8a11-000000000001"
INPUT = "3966c424f160c212f4ed4444ff3baeaeacbac732a49a023ffed576a1143937ca"
PERIOD = ("2026-01-05T14:30:00Z", "2026-01-05T21:00:00Z")
WATERMARKS = ("ALPACA_SIP_RAW_30M@2026-01-05T14:30:00Z", "ALPACA_SIP_RAW_30M@2026-01-05T21:00:00Z")
RESULT = "b8eaa7fc0de55a162b6bdc86c224bc6a411cb72578f21433f5f9cf1e1e11a3c8"
FEATURE_SET = "41bc5718b77de675e135717fd03f5b885e869821a747b7f7d720d513ce0e6e48"
MARKET_SET = "dd251bdd35146ee5b49661c6ca817927ff1456979158a8496008834ebc101064"
BATCH_ID = "6bab1c6d-4510-5c9d-adea-a2da1d50b70a"
BATCH = "50edd8597f1845718eeef0cc7f4dac1dd5fe1bf78888438858fecee96601adfb"


@pytest.fixture(scope="module")
def sma():
    return features.definition("SMA", "30m", CATALOG, price_field="close", window=3)


def test_result_and_batch_hashes_are_the_fixed_ones(spark, sma):
    start = dt.datetime(2026, 1, 5, 14, 30)
    bars = spark.createDataFrame([(INSTRUMENT, start + dt.timedelta(minutes=30 * k), c - 1.0, c + 1.0, c - 2.0, float(c), 1000 + k) for k, c in enumerate(CLOSES)], "instrument_id string, bar_start_at timestamp, open double, high double, low double, close double, volume long")
    made = features.materialize(bars.withColumn("session_date_et", F.to_date("bar_start_at")), [sma], INPUT, *PERIOD)
    r = made.head()
    assert (r.status, r.row_count, r.result_hash, r.definition_hash) == ("SUCCEEDED", 3, RESULT, sma.hash)
    planned = spark.createDataFrame([(sma.hash, INSTRUMENT, INPUT)], "definition_hash string, instrument_id string, input_dataset_set_hash string")
    b = features.snapshot_batch(planned, made, *PERIOD, *WATERMARKS).head()
    assert b.idempotency_key == f"fsb1:{FEATURE_SET[:16]}:{MARKET_SET[:16]}:20260105T143000Z:20260105T210000Z"
    assert (b.id, b.members, b.sealed, b.row_count, b.batch_hash) == (BATCH_ID, 1, True, 3, BATCH)


def test_a_batch_is_sealed_only_when_all_members_succeeded(spark, sma):
    planned = spark.createDataFrame([(sma.hash, i, INPUT) for i in "ab"], "definition_hash string, instrument_id string, input_dataset_set_hash string")
    made = spark.createDataFrame([(sma.hash, "a", "SUCCEEDED", 3, "h"), (sma.hash, "b", "FAILED", None, None)], "definition_hash string, instrument_id string, status string, row_count long, result_hash string")
    b = features.snapshot_batch(planned, made, *PERIOD, *WATERMARKS).head()
    assert (b.members, b.unready, b.sealed, b.row_count, b.batch_hash) == (2, 1, False, None, None)


def test_members_are_digested_in_order_over_many_partitions(spark):
    import hashlib

    names = sorted(f"m{k:05d}" for k in range(5000))
    rows = spark.createDataFrame([(n,) for n in reversed(names)], "n string").repartition(7)
    got = features._hash_of_all(rows, F.col("n"), F.lit("["), "]").head()[0]
    assert got == hashlib.sha256(f"[{','.join(names)}]".encode()).hexdigest()
    assert features._hash_of_all(rows.limit(0), F.col("n"), F.lit("["), "]").count() == 0


def test_columns_and_rows_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "bars")
    b = spark.range(200).select(F.concat(F.lit("I"), (F.col("id") % 5).cast("string")).alias("instrument_id"), F.lit("p").alias("provider_symbol"), F.timestamp_seconds(F.col("id") * 86400).alias("bar_start_at"), F.to_date(F.timestamp_seconds(F.col("id") * 86400)).alias("session_date_et"), *[F.lit(1.0).alias(c) for c in ("open", "high", "low", "close")], F.col("id").alias("volume"), F.lit(1).cast("long").alias("trade_count"), F.lit(1.0).alias("vwap"))
    files.write_bars(b.select(*files.BAR_SCHEMA.names), path, 2)
    df = files.projected_scan(spark, [path], ["close", "volume"], (F.col("instrument_id") == "I3") & (F.col("volume") > 50))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(instrument_id,I3)" in plan and "GreaterThan(volume,50)" in plan
    assert "ReadSchema: struct<instrument_id:string,close:double,volume:bigint>" in plan
    assert df.count() == 30 and files.bar_scan(spark, path).count() == 200
