"""Operators on small tables whose results are written by hand."""

import datetime as dt
import hashlib
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barloom.functions import keys, values
from barloom.operators import actions, catalog, features, jobs, merge, quality, reference, resample
from barloom.operators.sessions import completed_sessions, nth_last_session, session_calendar
from barloom.sources import files
from barloom.streaming import events as ev

UTC = dt.timezone.utc


def at(text):
    return dt.datetime.fromisoformat(text)


def bars(spark, rows, minutes=1):
    """rows: (instrument, start, open, high, low, close, volume, trade_count, vwap)."""
    df = spark.createDataFrame(rows, "instrument_id string, bar_start_at timestamp, open double, high double, low double, close double, volume long, trade_count long, vwap double")
    return df.withColumn("session_date_et", keys.session_date_et("bar_start_at"))


FIVE = [("A", at(f"2026-01-05 14:{30 + i}:00"), 10.0 + i, [11.0, 13.0, 13.0, 15.0, 15.0][i], 9.0 + i, [10.5, 12.0, 12.5, 14.0, 14.5][i], 100 * (i + 1), i + 1, 10.0 + i) for i in range(5)]


def sessions(spark):
    return session_calendar(spark, "2026-01-01", "2026-12-31")


def test_five_minute_bar(spark):
    r = resample.derive_bars(bars(spark, FIVE), sessions(spark), "5m", label="bucket_start", source_minutes=1, minutes=5).head()
    assert (r.open, r.high, r.low, r.close, r.volume, r.trade_count, round(r.vwap, 10), r.source_minutes) == (10, 15, 9, 14.5, 1500, 15, 12.6666666667, 5)


def test_gap_in_a_bar_stays(spark):
    r = resample.derive_bars(bars(spark, FIVE[:1] + FIVE[2:]), sessions(spark), "5m", source_minutes=1, minutes=5).head()
    assert (r.source_minutes, r.volume) == (4, 1300)


def test_label_is_first_observed_or_bucket_start(spark):
    b = bars(spark, FIVE[2:])
    first = resample.derive_bars(b, sessions(spark), "1h", source_minutes=1).head().bar_start_at
    start = resample.derive_bars(b, sessions(spark), "1h", label="bucket_start", source_minutes=1).head().bar_start_at
    assert (first, start) == (at("2026-01-05 14:32:00"), at("2026-01-05 14:30:00"))


def test_null_counts_and_weightless_vwap(spark):
    b = bars(spark, [("A", at("2026-01-05 14:30:00"), 1.0, 1.0, 1.0, 1.0, 0, None, 5.0), ("A", at("2026-01-05 15:00:00"), 1.0, 1.0, 1.0, 1.0, 0, None, None)])
    r = resample.derive_bars(b, sessions(spark), "1h").head()
    assert r.trade_count is None and r.vwap is None
    assert resample.derive_bars(b, sessions(spark), "1h", trade_count_or_zero=True).head().trade_count == 0


def test_calendar(spark):
    kinds = {str(r.session_date): (r.session_type, r.opens_at, r.closes_at) for r in session_calendar(spark, "2024-01-01", "2026-12-31").collect()}
    for day in ("2024-01-01", "2024-01-15", "2024-03-29", "2024-06-19", "2024-07-04", "2025-01-09", "2025-04-18", "2026-07-03", "2026-04-03", "2024-01-06"):
        assert kinds[day][0] == "CLOSED", day
    for day in ("2024-11-29", "2024-12-24", "2024-07-03"):
        assert kinds[day][0] == "EARLY_CLOSE", day
    assert kinds["2024-01-02"] == ("REGULAR", at("2024-01-02 14:30:00"), at("2024-01-02 21:00:00"))
    assert kinds["2024-07-02"][1:] == (at("2024-07-02 13:30:00"), at("2024-07-02 20:00:00"))
    assert kinds["2024-07-03"][2] == at("2024-07-03 17:00:00")


def test_completed_sessions(spark):
    s = session_calendar(spark, "2024-01-01", "2024-01-12")
    done = [str(r.session_date) for r in completed_sessions(s, "2024-01-03 21:00:00", "2024-01-05 21:00:00").orderBy("session_date").collect()]
    assert done == ["2024-01-04", "2024-01-05"]
    assert str(nth_last_session(s, 3, "2024-01-08 12:00:00").head()[0]) == "2024-01-03"
    assert nth_last_session(s, 30, "2024-01-08 12:00:00").count() == 0


def test_close_is_outside_the_session(spark):
    from barloom.operators.sessions import regular_session_filter

    b = bars(spark, [("A", at(t), 1.0, 1.0, 1.0, 1.0, v, 1, 1.0) for t, v in (("2026-01-05 14:29:00", 1), ("2026-01-05 14:30:00", 1), ("2026-01-05 20:59:00", 0), ("2026-01-05 20:58:00", 1), ("2026-01-05 21:00:00", 1))])
    assert [str(r.bar_start_at)[11:16] for r in regular_session_filter(b, sessions(spark)).orderBy("bar_start_at").collect()] == ["14:30", "20:58"]


def test_indicators(spark):
    days = [("A", at(f"2026-01-{5 + i:02d} 05:00:00"), c, c, c, c, 1, 1, c) for i, c in enumerate([50.0, 53.0, 49.0, 58.0, 60.0])]
    b = bars(spark, days)
    shown = lambda df: [str(r.value) for r in df.orderBy("bar_start_at").collect()]
    assert shown(features.sma(b, "close", 3)) == ["50.66666667", "53.33333333", "55.66666667"]
    assert shown(features.return_pct(b, "close")) == ["6.00000000", "-7.54716981", "18.36734694", "3.44827586"]
    ema = shown(features.compute(b, [features.definition("EMA", price_field="close", window=3)]))
    assert ema == ["50.66666667", "54.33333333", "57.16666667"]  # steps of a half, ties to the even last place
    rsi = features.compute(b, [features.definition("RSI", price_field="close", period=3)]).orderBy("bar_start_at").collect()
    gain, loss = Decimal("4.00000000"), Decimal("1.33333333")
    assert rsi[0].value == (100 * gain / (gain + loss)).quantize(Decimal("1e-8"))
    gain += ((2 - gain) / 3).quantize(Decimal("1e-8"))
    loss += ((0 - loss) / 3).quantize(Decimal("1e-8"))
    assert rsi[1].value == (100 * gain / (gain + loss)).quantize(Decimal("1e-8"))
    assert features.rsi_units([5, 5, 5, 5], 2) == [50 * 10**8] * 2
    defs = [features.definition("SMA", price_field="close", window=w) for w in (3, 9)]
    period = ("2026-01-05T05:00:00Z", "2026-01-10T05:00:00Z")
    out = features.materialize(b, defs, "f" * 64, *period).orderBy("status").collect()
    assert [(r.status, r.row_count) for r in out] == [("FAILED", 0), ("SUCCEEDED", 3)]
    rows = ",".join(f'{{"at":"2026-01-{7 + i:02d}T05:00:00Z","value":"{v}"}}' for i, v in enumerate(["50.66666667", "53.33333333", "55.66666667"]))
    payload = f'{{"definition_hash":"{defs[0].hash}","input_dataset_set_hash":"{"f" * 64}","instrument_id":"A","period_end":"{period[1]}","period_start":"{period[0]}","result_schema_version":1,"rows":[{rows}]}}'
    digest = hashlib.sha256(payload.encode()).hexdigest()
    assert out[1].result_hash == digest and out[1].materialization_version == f"fmv1:m:{defs[0].hash[:16]}:{'f' * 16}:{digest[:16]}"
    with pytest.raises(KeyError):
        features.definition("NONE", price_field="close")


def test_definition_is_hashed_over_its_canonical_payload():
    d = features.definition("SMA", "30m", "0a000000-0000-4000-8000-000000000009", price_field="close", window=4)
    assert d.payload == (
        '{"calculator_version":"1.0.0","element_catalog_version_id":"0a000000-0000-4000-8000-000000000009","feature_code":"SMA",'
        '"normalized_parameters":{"price_field":"close","window":4},"output_value_type":"DECIMAL","required_history_points":4,"resolution":"30m","schema_version":1}'
    )
    assert d.hash == hashlib.sha256(d.payload.encode()).hexdigest() and d.definition_version == f"fdv1:SMA:1.0.0:{d.hash[:16]}"
    assert d.id == str(uuid.uuid5(uuid.UUID(keys.UUID_NAMESPACE), f"feature-definition|{d.hash}"))
    assert {x.code: x.resolution for x in features.official_definitions()} == {"SMA": "1d", "EMA": "1d", "RSI": "1m", "MACD": "1d"}


def test_batch_is_sealed_only_when_whole(spark):
    planned = spark.createDataFrame([("d1", "A", "x"), ("d1", "B", "x")], "definition_hash string, instrument_id string, input_dataset_set_hash string")
    done = lambda *rows: spark.createDataFrame(rows, "definition_hash string, instrument_id string, status string, row_count long, result_hash string")
    period = ("2026-01-05T14:30:00Z", "2026-01-05T21:00:00Z", "w1", "w2")
    half = features.snapshot_batch(planned, done(("d1", "A", "SUCCEEDED", 3, "h1")), *period).head()
    assert (half.members, half.unready, half.sealed, half.batch_hash) == (2, 1, False, None)
    whole = features.snapshot_batch(planned, done(("d1", "A", "SUCCEEDED", 3, "h1"), ("d1", "B", "SUCCEEDED", 4, "h2")), *period).head()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    fs = sha('{"definition_hashes":["d1"],"feature_set_schema_version":1}')
    ms = sha('{"market_inputs":[' + ",".join(f'{{"input_dataset_set_hash":"x","instrument_id":"{i}"}}' for i in "AB") + '],"market_set_schema_version":1}')
    assert whole.idempotency_key == f"fsb1:{fs[:16]}:{ms[:16]}:20260105T143000Z:20260105T210000Z"
    members = ",".join(f'{{"definition_hash":"d1","input_dataset_set_hash":"x","instrument_id":"{i}","result_hash":"{h}"}}' for i, h in (("A", "h1"), ("B", "h2")))
    want = f'{{"batch_schema_version":1,"feature_set_hash":"{fs}","input_market_set_hash":"{ms}","members":[{members}],"period_end":"{period[1]}","period_start":"{period[0]}","source_end_watermark":"w2","source_start_watermark":"w1"}}'
    assert whole.sealed and whole.row_count == 7 and whole.batch_hash == sha(want)


def test_input_fingerprint(spark):
    rows = [("b", "m", "h2", "2026-01-06", "2026-01-07", 2), ("a", "m", "h1", "2026-01-05", "2026-01-06", 1)]
    o = lambda r: spark.createDataFrame(r, "id string, manifest_id string, content_hash string, partition_start string, partition_end string, row_count long").withColumn("g", F.lit(1))
    entry = lambda i, h, a, z, n: f'{{"content_hash":"{h}","dataset_manifest_id":"m","dataset_object_id":"{i}","partition_end":"{z}","partition_start":"{a}","row_count":{n}}}'
    text = ",".join([entry("a", "h1", "2026-01-05", "2026-01-06", 1), entry("b", "h2", "2026-01-06", "2026-01-07", 2)])
    want = hashlib.sha256(f'{{"bundle_schema_version":1,"objects":[{text}]}}'.encode()).hexdigest()
    assert [r.fingerprint for r in catalog.input_fingerprint(o(rows), ["g"]).collect()] == [want] == [r.fingerprint for r in catalog.input_fingerprint(o(rows[::-1]), ["g"]).collect()]
    assert catalog.input_fingerprint(o([]), ["g"]).count() == 0
    with pytest.raises(Exception, match="stands twice"):
        catalog.input_fingerprint(o(rows + rows[:1]), ["g"]).collect()


def test_macd_lines():
    lines = features.macd_units([10**8 * x for x in (1, 2, 4, 7, 11, 16, 22)], 2, 3, 2)
    assert [len(lines[k]) for k in ("MACD", "SIGNAL", "HISTOGRAM")] == [5, 4, 4]
    assert [a - b for a, b in zip(lines["MACD"][1:], lines["SIGNAL"])] == lines["HISTOGRAM"]


def test_half_even_of_ties():
    assert [features._half_even(n, 2) for n in (1, 3, 5, -1, -3)] == [0, 2, 2, 0, -2]


def test_findings(spark):
    t = lambda i: at("2026-01-05 14:30:00") + dt.timedelta(minutes=30 * i)
    rows = [("A", t(0), 10.0, 10.0, 10.0, 10.0, 1, 1, 10.0), ("A", t(1), 14.0, 14.0, 14.0, 14.0, 0, 1, 14.0), ("A", t(2), 14.0, 14.0, 14.0, 14.0, 0, 1, 14.0), ("A", t(4), 14.0, 17.0, 14.0, 14.0, -1, 1, 14.0), ("B", t(0), -1.0, 5.0, 4.0, 6.0, 1, 1, 5.0), ("B", t(0), 5.0, 5.0, 5.0, 5.0, 1, 1, 5.0)]
    b = bars(spark, rows)
    found = {(r.incident_code, r.instrument_id, str(r.period_start)[11:16], str(r.period_end)[11:16], r.affected_rows) for r in quality.base_findings(b, sessions(spark)).collect()}
    assert ("PRICE_OUTLIER_RETURN", "A", "15:00", "15:30", 1) in found
    assert ("ZERO_VOLUME", "A", "15:00", "16:00", 2) in found
    assert ("PRICE_OUTLIER_RANGE", "A", "16:30", "17:00", 1) in found
    assert ("NEGATIVE_ACTIVITY", "A", "16:30", "17:00", 1) in found
    assert ("DUPLICATE_BAR", "B", "14:30", "15:00", 2) in found
    assert ("INVALID_PRICE", "B", "14:30", "15:00", 1) in found and ("INVALID_OHLC", "B", "14:30", "15:00", 1) in found
    assert ("MISSING_BARS", "A", "16:00", "16:30", 1) in found
    good, bad = quality.quality_gate(b, quality.contiguous_spans(quality.invalid_values(b), 30))
    assert good.count() == 0 and bad.count() == 2


def test_median_spike_is_strict(spark):
    rows = [("A", at("2026-01-05 14:30:00") + dt.timedelta(minutes=30 * i), 1.0, 1.0, 1.0, 1.0, v, 1, 1.0) for i, v in enumerate([10] * 20 + [500, 501])]
    assert [r.bar_start_at for r in quality.volume_spikes(bars(spark, rows)).collect()] == [rows[-1][1]]
    assert quality.volume_spikes(bars(spark, rows[5:])).count() == 0


def test_row_reasons(spark):
    df = spark.createDataFrame([(float("nan"), 1.0, 1.0, 1.0, 1), (1.0, 0.5, 1.0, 1.0, -1), (1.0, 1.0, 1.0, 1.0, 1)], "open double, high double, low double, close double, volume long")
    got = [r[0] for r in df.select(quality.invalid_row_reasons()).collect()]
    assert got[0].startswith("missing_or_non_numeric_price") and got[1] == "high_below_ohlc,low_above_ohlc,negative_or_invalid_volume" and got[2] is None


def test_keys(spark):
    import hashlib
    import uuid

    df = spark.createDataFrame([(" brk/b ", at("2026-01-05 04:59:59"), "6f9619ff-8b86-d011-b42d-00c04fc964ff")], "s string, t timestamp, u string")
    r = df.select(keys.canonical_symbol("s").alias("c"), keys.safe_symbol("s").alias("f"), keys.session_date_et("t").alias("d"), keys.iso_utc("t").alias("i"), keys.deterministic_uuid(F.lit("a"), F.lit(None), F.lit(3)).alias("x"), keys.shard_key("u", 16).alias("k")).head()
    assert (r.c, r.f, str(r.d), r.i) == ("BRK.B", "BRK-B", "2026-01-04", "2026-01-05T04:59:59Z")
    assert r.x == str(uuid.uuid5(uuid.UUID(keys.UUID_NAMESPACE), "a|None|3"))
    n = int.from_bytes(hashlib.sha256(b"6f9619ff-8b86-d011-b42d-00c04fc964ff").digest()[:8], "big") % 16
    assert r.k == f"s{n:02d}-of-16"


def test_exact_numbers(spark):
    df = spark.createDataFrame([('{"a": 0.12345678901234567}',), ('{"a": "2"}',), ('{"a": true}',), ("{}",), (None,)], "j string")
    got = [r[0] for r in df.select(values.decimal_map("j")).collect()]
    assert got[0]["a"] == Decimal("0.123456789012345670") and got[1:] == [None] * 4
    x = spark.createDataFrame([("0.000000005",), ("0.000000015",), ("-0.000000001",)], "x string").select(values.render("x")).collect()
    assert [r[0] for r in x] == ["0.00000000", "0.00000002", "0.00000000"]
    j = spark.range(1).select(values.canonical_json(b=F.lit(None).cast("string"), a=F.lit("é"))).head()[0]
    assert j == '{"a":"é","b":null}'


def test_terms(spark):
    df = spark.createDataFrame([("SPLIT", '{"from_shares":1,"to_shares":2}'), ("SPLIT", '{"from_shares":2,"to_shares":2}'), ("CASH_DIVIDEND", '{"amount":"0.5","currency":"USD"}'), ("CASH_DIVIDEND", '{"amount":"0","currency":"USD"}')], "e string, t string")
    assert [r[0] is None for r in df.select(values.parse_terms(F.col("e"), F.col("t"))).collect()] == [False, True, False, True]


def test_adjustment_of_stacked_actions(spark):
    days = [("A", at(f"2026-0{m}-10 14:30:00"), 100.0, 100.0, 100.0, 100.0, 10, 1, 100.0) for m in (7, 8, 9)]
    rows = [("A", at("2026-08-01 04:00:00"), "SPLIT", 1, 2, None), ("A", at("2026-09-01 04:00:00"), "CASH_DIVIDEND", None, None, Decimal(2)), ("A", at("2026-09-05 04:00:00"), "SPLIT", 1, 3, None), ("B", at("2026-12-01 05:00:00"), "SPLIT", 1, 2, None)]
    acts = spark.createDataFrame(rows, "instrument_id string, effective_at timestamp, action_type string, from_shares long, to_shares long, amount decimal(18,8)")
    out = actions.adjust_bars(bars(spark, days), acts).orderBy("bar_start_at").collect()
    third = Decimal("0.33333333")
    want = [Decimal(100) * Decimal("0.5") * Decimal("0.98") * third, Decimal(100) * Decimal("0.98") * third, Decimal(100)]
    assert [r.close for r in out] == [w.quantize(Decimal("1e-8")) for w in want]
    assert [r.volume for r in out] == [60, 30, 10]


def test_effective_instant_is_strict(spark):
    b = bars(spark, [("A", at("2026-08-03 04:00:00"), 10.0, 10.0, 10.0, 10.0, 1, 1, 10.0)])
    acts = spark.createDataFrame([("A", at("2026-08-03 04:00:00"), "SPLIT", 1, 2, None)], "instrument_id string, effective_at timestamp, action_type string, from_shares long, to_shares long, amount decimal(18,8)")
    assert actions.adjust_bars(b, acts).head().close == 10


def test_merge(spark):
    old = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k long, v double")
    new = spark.createDataFrame([(2, 3.0), (3, 4.0)], "k long, v double")
    twice = new.withColumn("n", F.lit(1)).unionByName(new.withColumn("v", F.col("v") + 10).withColumn("n", F.lit(2)))
    later = merge.upsert_keep_last(old.withColumn("n", F.lit(0)), twice, ["k"], arrival="n")
    assert {r.k: r.n for r in later.collect()} == {1: 0} | {r.k: 2 for r in new.collect()}
    assert sorted(map(tuple, merge.upsert_keep_last(old, new, ["k"]).collect())) == [(1, 1.0), (2, 3.0), (3, 4.0)]
    assert {r.k: r.action for r in merge.snapshot_diff(new, old, ["k"]).collect()} == {1: "conflict", 2: "conflict", 3: "append"}
    assert merge.snapshot_diff(new, old, ["k"], allow_extra=True).where("k = 1").head().action == "extra"
    spans = spark.createDataFrame([("a", 0, 5), ("a", 4, 9), ("b", 0, 3), ("b", 5, 9), ("c", 2, 9)], "k string, period_start long, period_end long")
    assert {r.k: r.first_gap for r in merge.first_gap(spans, "k", F.lit(0).cast("long"), F.lit(9).cast("long")).collect()} == {"a": None, "b": 3, "c": 0}
    left = spark.createDataFrame([("a", 5), ("a", 1), ("b", 5)], "k string, t long")
    right = spark.createDataFrame([("a", 1, 10.0), ("a", 4, 40.0), ("a", 5, 50.0)], "k string, t long, v double")
    assert {(r.k, r.t): r.p for r in merge.asof_before(left, right, "k", "t", "t", "v", "p").collect()} == {("a", 5): 40.0, ("a", 1): None, ("b", 5): None}


def test_catalog_steps(spark):
    assert catalog.contracts(spark).count() == 9 and catalog.contracts(spark, "raw", "1h").count() == 1
    span = "id string, period_start timestamp, period_end timestamp"
    o = spark.createDataFrame([("a", at("2025-11-01"), at("2026-01-05")), ("b", at("2026-01-05"), at("2026-01-09")), ("c", at("2024-01-01"), at("2024-02-01"))], span)
    gone = spark.createDataFrame([("x", at("2026-01-04"), at("2026-01-05"))], span).drop("id")
    none = spark.createDataFrame([], "severity string")
    objects, status = catalog.publish_revision(o, o.where("id = 'x'"), gone, none)
    assert sorted(r.id for r in objects.collect()) == ["b", "c"] and status.head().status == "AVAILABLE"
    bad = spark.createDataFrame([("ERROR",)], "severity string")
    assert catalog.publish_revision(o, o.where("id = 'x'"), gone, bad)[1].head().status == "QUARANTINED"
    empty = o.where("id = 'x'")
    assert catalog.publish_revision(empty, empty, gone, none)[1].head().status == "QUARANTINED"
    f = spark.createDataFrame([], "path string, sha256 string, byte_size long")
    assert catalog.resume_check(f, f).head().resumable is False


def test_files(spark, tmp_path):
    epoch = spark.createDataFrame([("1767623400",), ("1767623460",)], "timestamp string")
    assert str(files.parse_mixed_timestamp(epoch, "timestamp").head().bar_start_at) == "2026-01-05 14:30:00"
    text = spark.createDataFrame([("2026-01-05T14:30:00Z",), ("oops",)], "timestamp string")
    assert [r.bar_start_at is None for r in files.parse_mixed_timestamp(text, "timestamp").collect()] == [False, True]
    raw = spark.createDataFrame([("A", "2026-01-05 14:30:00", "1", "1", "1", "1", "5", "x", 1), ("A", "2026-01-05 14:30:00", "1", "1", "1", "2", "5", "7", 2), ("Z", "2026-01-05 14:30:00", "1", "1", "1", "1", "5", "7", 1)], "symbol string, timestamp string, open string, high string, low string, close string, volume string, trade_count string, n long")
    names = spark.createDataFrame([("A", "i1")], "provider_symbol string, instrument_id string")
    out = files.normalize(raw, names, "n")
    assert files.schema_mismatch(out) == [] and [(r.close, r.trade_count, r.vwap) for r in out.collect()] == [(2.0, 7, None)]
    files.write_bars(out, str(tmp_path / "bars"), 2)
    assert files.bar_scan(spark, str(tmp_path / "bars")).count() == 1
    assert files.schema_mismatch(out.drop("vwap").withColumn("open", F.lit("x"))) == ["open", "vwap"]
    with pytest.raises(ValueError):
        files.legacy_scan(spark, "x.csv", "symbol string, open double")
    odd = str(tmp_path / "csv-files" / "bars.parquet")  # the folder's name says nothing of the format
    spark.createDataFrame([("A", at("2026-01-05"), 1.0)], "symbol string, timestamp timestamp, open double").write.parquet(odd)
    assert files.legacy_scan(spark, odd, "symbol string, timestamp timestamp, open double").head().open == 1.0
    mixed = spark.createDataFrame([("1767623400",), ("1767623400000",), ("1767623460000",), ("-5",)], "timestamp string")
    assert str(files.parse_mixed_timestamp(mixed, "timestamp").where("timestamp = '1767623400000'").head().bar_start_at) == "2026-01-05 14:30:00"
    moved, lost = files.migrate_legacy(spark.createDataFrame([("/d/BRK-B_1.parquet",), ("/d/NO.parquet",)], "path string"), spark.createDataFrame([("BRK.B", "i2")], "provider_symbol string, instrument_id string"))
    assert [r.instrument_id for r in moved.collect()] == ["i2"] and [r.symbol for r in lost.collect()] == ["NO"]


def test_symbols(spark):
    names = spark.createDataFrame([("i1", "OLD", dt.date(2020, 1, 1)), ("i1", "NEW", dt.date(2022, 1, 1))], "instrument_id string, symbol string, effective_from date")
    q = spark.createDataFrame([("i1", dt.date(2021, 12, 31)), ("i1", dt.date(2022, 1, 1)), ("i1", dt.date(2019, 1, 1))], "instrument_id string, d date")
    assert [r.symbol for r in reference.symbol_at(q, reference.symbol_periods(names), "d").orderBy("d").collect()] == [None, "OLD", "NEW"]


def test_stream_refusals(spark):
    good = '{"eventId":"e","schemaVersion":1,"instrumentId":"A","provider":"p","feed":"f","eventType":"BAR_1M","providerEventId":"1","occurredAt":"2026-01-05T14:30:00Z","receivedAt":"2026-01-05T14:31:00Z","sequence":1,"revision":0,"values":{"close":1.5}}'
    rows = [good, good.replace('"schemaVersion":1', '"schemaVersion":9'), good.replace('"revision":0', '"revision":1'), good.replace("14:31", "14:29"), good.replace('{"close":1.5}', "{}"), "nonsense", good.replace('"sequence":1', '"sequence":-1')]
    got = [r.refusal for r in ev.parse(spark.createDataFrame([(r,) for r in rows], "body string")).collect()]
    assert got == [None, "UNSUPPORTED_EVENT_VERSION", "MALFORMED_EVENT:revision_without_correction", "MALFORMED_EVENT:received_before_occurred", "MALFORMED_EVENT:no_values", "MALFORMED_EVENT:missing_field", "MALFORMED_EVENT:negative_sequence"]


def test_second_flush_keeps_the_first(spark):
    schema = "instrument_id string, bar_start_at timestamp, revision int, close double"
    a = spark.createDataFrame([("A", at("2026-01-05 14:30:00"), 0, 1.0), ("A", at("2026-01-05 15:00:00"), 1, 2.0)], schema)
    b = spark.createDataFrame([("A", at("2026-01-05 15:00:00"), 0, 9.0), ("A", at("2026-01-05 15:30:00"), 0, 3.0)], schema)
    assert sorted(r.close for r in ev.flush_bars(a, b).collect()) == [1.0, 2.0, 3.0]


def test_results_do_not_depend_on_partitions(spark):
    b = bars(spark, [("A", at("2026-01-05 14:30:00") + dt.timedelta(minutes=i), 1.0 + i, 2.0 + i, 1.0, 1.5, i, 1, 1.0) for i in range(90)])
    one = sorted(map(tuple, resample.derive_bars(b.coalesce(1), sessions(spark), "1h", source_minutes=1).collect()))
    many = sorted(map(tuple, resample.derive_bars(b.repartition(7, "open"), sessions(spark), "1h", source_minutes=1).collect()))
    assert one == many


def test_universe_and_instrument_map(spark):
    one = lambda *s: spark.createDataFrame([(x,) for x in s], "symbol string")
    assert sorted(r.symbol for r in reference.universe_resolve(one("A", "B"), one("C"), one("X"), 2).collect()) == ["A", "B", "X"]
    assert sorted(r.symbol for r in reference.universe_resolve(one("A"), one("C", "D"), one("X"), 2).collect()) == ["C", "D", "X"]
    with pytest.raises(ValueError):
        reference.universe_resolve(one("A"), one("C"), one("X"), 2)
    good = [(" brk/b", "6F9619FF-8B86-D011-B42D-00C04FC964FF")]
    m = spark.createDataFrame(good, "provider_symbol string, instrument_id string")
    assert tuple(reference.instrument_map(m).head()) == ("BRK.B", "6f9619ff-8b86-d011-b42d-00c04fc964ff")
    with pytest.raises(Exception, match="not an instrument"):
        reference.instrument_map(m.unionByName(m)).collect()


def test_exported_instruments(spark):
    rows = spark.createDataFrame([("m1", "i1"), ("m2", "i1"), ("m1", "i2")], "manifest_id string, instrument_id string")
    names = spark.createDataFrame([("i1", "OLD", dt.date(2020, 1, 1)), ("i1", "NEW", dt.date(2022, 1, 1))], "instrument_id string, symbol string, effective_from date")
    assert [tuple(r) for r in files.instrument_export(rows, reference.symbol_periods(names), "2021-06-01").collect()] == [("OLD", "i1")]


def test_definitions_and_spans(spark):
    table = features.definition_table(spark, features.official_definitions())
    same, refused = features.register(table, table)
    assert same.count() == table.count() == 7 and refused.count() == 0
    changed = table.limit(1).withColumn("payload", F.lit("{}"))
    assert features.register(table, changed)[1].count() == 1
    r = spark.createDataFrame([("30m",), ("1d",), ("2h",)], "r string").select(keys.bar_span("r")).collect()
    assert [x[0] for x in r] == [30, 390, None]
    e = spark.createDataFrame([("A",), ("Z",)], "instrumentId string")
    assert {x.instrumentId: x.mapped for x in ev.map_instruments(e, spark.createDataFrame([("A",)], "instrument_id string")).collect()} == {"A": True, "Z": False}


# ---- streams that stop and go on --------------------------------------------------------------------------------
def test_last_observation_over_two_batches(spark, tmp_path):
    source, path = str(tmp_path / "in"), str(tmp_path / "out")
    for k, event in enumerate(("old", "new")):
        e = spark.createDataFrame([("A", "TRADE", event, at(f"2026-01-0{5 + k}"), k), ("B", "TRADE", "b", at("2026-01-05"), 0)][: 2 - k], "instrumentId string, eventType string, eventId string, occurredAt timestamp, sequence long")
        e.coalesce(1).write.mode("append").parquet(source)
        out = ev.run_to_table(ev.latest_observation(spark.readStream.schema(e.schema).parquet(source)), "l", "update", path, ["instrumentId", "eventType"])
    assert sorted((r.instrumentId, r.eventId) for r in out.collect()) == [("A", "new"), ("B", "b")]


def test_incident_without_a_scope_is_refused(spark):
    new = spark.createDataFrame([("i", None, None)], "id string, period_start timestamp, period_end timestamp")
    with pytest.raises(Exception, match="no scope"):
        jobs.record_incidents(new.limit(0), new).collect()


@pytest.mark.parametrize("width", [1, 3, 1000])
def test_last_value_before_is_carried_over_buckets(spark, width):
    rng = random.Random(width)
    rows = [(rng.choice("AB"), t, rng.choice([None, None, t * 10])) for t in rng.sample(range(60), 40)]
    df = spark.createDataFrame(rows, "k string, t long, v long")
    want, last = {}, {}
    for k, t, v in sorted(rows, key=lambda r: (r[0], r[1])):
        want[k, t] = last.get(k)
        last[k] = v if v is not None else last.get(k)
    got = merge.last_before(df, "k", ["t"], F.floor(F.col("t") / width), "v", "before").collect()
    assert {(r.k, r.t): r.before for r in got} == want and len(got) == len(rows)


def test_no_task_orders_all_rows_of_a_key(spark):
    left = spark.range(4000).select(F.lit("A").alias("k"), F.timestamp_seconds(F.col("id") * 3600 + 1).alias("at"))
    right = spark.range(4000).select(F.lit("A").alias("k"), F.timestamp_seconds(F.col("id") * 3600).alias("s"), F.col("id").alias("v"))
    out = merge.asof_before(left, right, "k", "at", "s", "v", "before")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert all("_bucket" in line for line in plan.splitlines() if "Window [" in line and "_v" in line)
    assert out.where("before = (unix_timestamp(at) - 1) / 3600").count() == 4000


@pytest.mark.parametrize("most", [1, 4, 7, 1000])
def test_parts_are_cut_as_by_walking(spark, most, monkeypatch):
    monkeypatch.setattr(catalog, "PART_RANGE", 9)
    rng = random.Random(most)
    rows = [(rng.choice("ABC"), rng.randrange(120) * 7200) for _ in range(300)] + [("A", 7200)] * 9
    df = spark.createDataFrame(rows, "instrument_id string, t long").select("instrument_id", F.timestamp_seconds("t").alias("bar_start_at"), "t")
    got = catalog.time_boundary_parts(df, 2, most).groupBy("shard", "t").agg(F.min("part_number").alias("a"), F.max("part_number").alias("b"), F.count("*").alias("n")).collect()
    for shard in {r.shard for r in got}:
        held = part = 0
        for r in sorted((r for r in got if r.shard == shard), key=lambda r: r.t):
            part += bool(held) and held + r.n > most
            held = r.n if held + r.n > most else held + r.n
            assert r.a == r.b == part
    assert sum(r.n for r in got) == len(rows)
    assert catalog.time_boundary_parts(df.limit(0), 2, most).count() == 0


def test_latest_published_of_every_year(spark):
    """Each year of the table and the one after it; a year without bars falls back on the year before, and no further."""
    days = {"a": ["2001-03-01", "2001-11-02", "2000-05-05"], "b": ["1997-01-02"], "c": ["1998-02-03", "2000-12-29"]}
    bars = spark.createDataFrame([(i, dt.date.fromisoformat(d), at(d)) for i, ds in days.items() for d in ds] + [("d", None, at("2001-01-01"))], "instrument_id string, session_date_et date, bar_start_at timestamp")
    got = {(r.instrument_id, r.year): str(r.latest)[:10] for r in files.latest_published(bars).collect()}
    assert got == {
        ("a", 2000): "2000-05-05", ("a", 2001): "2001-11-02", ("a", 2002): "2001-11-02", ("b", 1997): "1997-01-02", ("b", 1998): "1997-01-02",
        ("c", 1998): "1998-02-03", ("c", 1999): "1998-02-03", ("c", 2000): "2000-12-29", ("c", 2001): "2000-12-29",
    }
