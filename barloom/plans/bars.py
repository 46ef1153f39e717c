"""Queries over bars: scan, sessions, resampling, quality, merging."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import keys
from barloom.operators import merge, quality, resample
from barloom.operators import sessions as ses
from barloom.plans.registration import new_registry
from barloom.sources import files
from barloom.sources.market import bars_30m, daily_bars, secs, sessions, table, ticks
from barloom.sources.shared import shared_path

QUERIES, ORACLE_SQL, query = new_registry()


# The inputs again, as SQL.
BARS = """WITH bars AS (
  SELECT event_type AS instrument_id, CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS s,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close,
         count(*) AS volume, count(*) AS trade_count, avg(value) AS vwap
  FROM events GROUP BY ALL),
ses AS (
  SELECT d, CAST(epoch(d) AS BIGINT) + 52200 AS o, CAST(epoch(d) AS BIGINT) + 75600 AS c
  FROM (SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS d)
  WHERE isodow(d) < 6 AND d NOT IN (DATE '2024-01-01', DATE '2024-01-15')),
ib AS (SELECT b.*, d, o, c FROM bars b JOIN ses ON s >= o AND s < c)"""
DAILY = """WITH t AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS instrument_id, CAST(l_shipdate AS DATE) AS d, floor(l_extendedprice / l_quantity * 100 + 0.5) / 100 AS p,
         CAST(l_quantity AS BIGINT) AS q, (l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS o FROM lineitem),
daily AS (
  SELECT instrument_id, d, arg_min(p, o) AS open, max(p) AS high, min(p) AS low, arg_max(p, o) AS close, CAST(sum(q) AS BIGINT) AS volume,
         count(*) AS trade_count, sum(p * q) / sum(q) AS vwap FROM t GROUP BY ALL)"""

_OHLC = ["open", "high", "low", "close"]


def shown(b: DataFrame, *more: str) -> DataFrame:
    return b.select("instrument_id", secs("bar_start_at"), *_OHLC, "volume", "trade_count", F.round("vwap", 6).alias("vwap"), *more)


_SHOWN = "instrument_id, s AS bar_start_at, open, high, low, close, volume, trade_count, round(vwap, 6) AS vwap"


def _stored(spark: SparkSession, sf_dir: str) -> str:
    """Bars written as files of the fixed schema."""
    path = shared_path(spark, "bars")
    files.write_bars(bars_30m(spark, sf_dir).withColumn("provider_symbol", F.col("instrument_id")).select(*files.BAR_SCHEMA.names), path, 4)
    return path


@query(f"{BARS} SELECT {_SHOWN} FROM bars")
def bars_30m_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(files.bar_scan(spark, _stored(spark, sf_dir)))


@query(f"{BARS} SELECT {_SHOWN} FROM bars WHERE instrument_id = 'click' AND s >= epoch(DATE '2024-01-08') AND s < epoch(DATE '2024-01-15')")
def bars_one_instrument_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.col("bar_start_at")
    one = (F.col("instrument_id") == "click") & (at >= F.lit("2024-01-08").cast("timestamp")) & (at < F.lit("2024-01-15").cast("timestamp"))
    columns = ["instrument_id", "bar_start_at", *_OHLC, "volume", "trade_count", "vwap"]
    return shown(files.projected_scan(spark, [_stored(spark, sf_dir)], columns, one))


@query(f"{BARS} SELECT {_SHOWN} FROM ib")
def session_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(ses.regular_session_filter(bars_30m(spark, sf_dir), sessions(spark)))


def _derived_sql(seconds: int, label: str) -> str:
    start = "min(s)" if label == "first_observed" else f"o + k * {seconds}"
    return f"""{BARS}, k AS (SELECT *, (s - o) // {seconds} AS k FROM ib)
    SELECT instrument_id, CAST({start} AS BIGINT) AS bar_start_at, arg_min(open, s) AS open, max(high) AS high, min(low) AS low,
           arg_max(close, s) AS close, CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(trade_count) AS BIGINT) AS trade_count,
           round(sum(vwap * volume) / sum(volume), 6) AS vwap, CAST(30 * count(*) AS SMALLINT) AS source_minutes
    FROM k GROUP BY instrument_id, d, o, k"""


@query(_derived_sql(3600, "first_observed"))
def derive_1h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1h"), "source_minutes")


@query(_derived_sql(14400, "first_observed"))
def derive_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "4h"), "source_minutes")


@query(_derived_sql(86400, "first_observed"))
def derive_1d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1d"), "source_minutes")


@query(_derived_sql(3600, "bucket_start"))
def resample_1h_bucket_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1h", label="bucket_start"), "source_minutes")


@query(_derived_sql(14400, "bucket_start").replace("source_minutes\n", "source_minutes, CAST(count(*) AS SMALLINT) AS source_bar_count\n"))
def resample_loader_4h(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "4h", label="bucket_start", weigh_zero_volume=False)
    return shown(out, "source_minutes", "source_bar_count")


@query(
    f"""{BARS}, r AS (SELECT unnest(['1h', '4h', '1d']) AS resolution, unnest([3600, 14400, 86400]) AS n),
    k AS (SELECT *, (s - o) // n AS k FROM ib, r WHERE volume > 0)
    SELECT resolution, instrument_id, CAST(o + k * n AS BIGINT) AS bar_start_at, arg_min(open, s) AS open, max(high) AS high, min(low) AS low, arg_max(close, s) AS close,
           CAST(sum(volume) AS BIGINT) AS volume, CAST(sum(trade_count) AS BIGINT) AS trade_count, round(sum(vwap * volume) / sum(volume), 6) AS vwap
    FROM k GROUP BY resolution, n, instrument_id, d, o, k"""
)
def long_term_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(resample.long_term_outputs(bars_30m(spark, sf_dir), sessions(spark)), "resolution")


@query(
    f"""{BARS}, h AS (SELECT instrument_id, min(s) AS s, arg_max(close, s) AS close FROM (SELECT *, (s - o) // 3600 AS k FROM ib) GROUP BY instrument_id, o, k),
    w AS (SELECT instrument_id, s, close, row_number() OVER u AS n, sum(CAST(round(close * 100) AS BIGINT)) OVER (u ROWS 2 PRECEDING) AS c
          FROM h WINDOW u AS (PARTITION BY instrument_id ORDER BY s))
    SELECT instrument_id, s AS bar_start_at, close, round(c / 300.0, 6) AS sma_3 FROM w WHERE n >= 3"""
)
def sma_3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barloom.operators.features import sma

    h = resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1h")
    return sma(h, "close", 3).select("instrument_id", secs("bar_start_at"), "close", F.round(F.col("value").cast("double"), 6).alias("sma_3"))


@query(
    """WITH d AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS d),
    e AS (SELECT *, year(d) % 19 AS a, year(d) // 100 AS b, year(d) % 100 AS c FROM d),
    f AS (SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM e),
    g AS (SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS k FROM f),
    i AS (SELECT *, h + k - 7 * ((a + 11 * h + 22 * k) // 451) + 114 AS n FROM g),
    j AS (SELECT d, isodow(d) AS w, month(d) AS m, day(d) AS x, year(d) AS y, make_date(CAST(year(d) AS BIGINT), n // 31, n % 31 + 1) - 2 AS good FROM i),
    z AS (SELECT d, w, m, x, w >= 6 OR d = good
        OR (m = 1 AND (x = 1 OR x = 2 AND w = 1)) OR (m = 1 AND w = 1 AND x BETWEEN 15 AND 21 AND y >= 1998) OR (m = 2 AND w = 1 AND x BETWEEN 15 AND 21)
        OR (m = 5 AND w = 1 AND x >= 25) OR (m = 7 AND (x = 4 OR x = 5 AND w = 1 OR x = 3 AND w = 5)) OR (m = 9 AND w = 1 AND x <= 7)
        OR (m = 11 AND w = 4 AND x BETWEEN 22 AND 28) OR (m = 12 AND (x = 25 OR x = 26 AND w = 1 OR x = 24 AND w = 5))
        OR d IN ('2001-09-11', '2001-09-12', '2001-09-13', '2001-09-14') AS shut FROM j),
    s AS (SELECT d AS session_date, CASE WHEN shut THEN 'CLOSED' WHEN m = 11 AND w = 5 AND x BETWEEN 23 AND 29 OR (m = 12 AND x = 24 OR m = 7 AND x = 3) AND w <= 4 THEN 'EARLY_CLOSE' ELSE 'REGULAR' END AS session_type FROM z)
    SELECT CAST(s.session_date AS VARCHAR) AS session_date, s.session_type, count(o.o_orderkey) AS orders FROM s LEFT JOIN orders o ON CAST(o.o_orderdate AS DATE) = s.session_date GROUP BY ALL"""
)
def session_calendar_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = sessions(spark, "1995-01-01", "2001-12-31")
    o = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("session_date")).agg(F.count("*").alias("n"))
    return s.join(o, "session_date", "left").select(F.col("session_date").cast("string"), "session_type", F.coalesce("n", F.lit(0)).cast("long").alias("orders"))


# ---- quality ----------------------------------------------------------------------------------------------------
def findings(df: DataFrame) -> DataFrame:
    return df.select("incident_code", "severity", "instrument_id", secs("period_start"), secs("period_end"), F.col("affected_rows").cast("long").alias("affected_rows"))


def _spans_sql(prelude: str, offending: str, span: int) -> str:
    """offending: SELECT incident_code, severity, instrument_id, s, n."""
    return f"""{prelude}, bad AS ({offending}),
    r AS (SELECT *, CASE WHEN s - lag(s) OVER w IN (0, {span}) THEN 0 ELSE 1 END AS g FROM bad WINDOW w AS (PARTITION BY incident_code, instrument_id ORDER BY s)),
    u AS (SELECT *, sum(g) OVER (PARTITION BY incident_code, instrument_id ORDER BY s ROWS UNBOUNDED PRECEDING) AS k FROM r)
    SELECT incident_code, severity, instrument_id, min(s) AS period_start, max(s) + {span} AS period_end, CAST(sum(n) AS BIGINT) AS affected_rows
    FROM u GROUP BY incident_code, severity, instrument_id, k"""


def _marred(b: DataFrame) -> DataFrame:
    """Bars with faults put in by their position, for the checks to find."""
    k = F.pmod(F.unix_timestamp("bar_start_at") / 1800, F.lit(101)).cast("int")
    v = F.pmod(F.unix_timestamp("bar_start_at") / 1800, F.lit(103)).cast("int")
    return b.withColumn("low", F.when(k == 0, F.col("high") + 1).otherwise(F.col("low"))).withColumn("volume", F.when(v == 0, -F.col("volume")).when(v == 1, F.lit(0)).otherwise(F.col("volume"))).withColumn(
        "open", F.when(k == 1, F.lit(0.0)).otherwise(F.col("open"))
    )


_MARRED = f"""{BARS}, bars2 AS (SELECT instrument_id, s, CASE WHEN s // 1800 % 101 = 1 THEN 0 ELSE open END AS open, high, CASE WHEN s // 1800 % 101 = 0 THEN high + 1 ELSE low END AS low, close,
    CASE s // 1800 % 103 WHEN 0 THEN -volume WHEN 1 THEN 0 ELSE volume END AS volume, trade_count FROM bars)"""


@query(_spans_sql(_MARRED, """SELECT unnest(list_filter([CASE WHEN least(open, high, low, close) <= 0 THEN 'INVALID_PRICE' END, CASE WHEN high < greatest(open, low, close) OR low > least(open, high, close) THEN 'INVALID_OHLC' END,
    CASE WHEN volume < 0 THEN 'NEGATIVE_ACTIVITY' END], lambda x: x IS NOT NULL)) AS incident_code, 'ERROR' AS severity, instrument_id, s, 1 AS n FROM bars2""", 1800))  # fmt: skip
def quality_invalid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(quality.contiguous_spans(quality.invalid_values(_marred(bars_30m(spark, sf_dir))), 30))


@query(_spans_sql(_MARRED, "SELECT 'ZERO_VOLUME' AS incident_code, 'WARNING' AS severity, instrument_id, s, 1 AS n FROM bars2 WHERE volume = 0", 1800))
def quality_zero_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(quality.contiguous_spans(quality.zero_volume(_marred(bars_30m(spark, sf_dir))), 30))


@query(_spans_sql(BARS, "SELECT 'DUPLICATE_BAR' AS incident_code, 'ERROR' AS severity, instrument_id, s, 2 AS n FROM bars WHERE s // 1800 % 7 = 0 OR s // 1800 % 7 = 1", 1800))
def quality_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir)
    again = b.where(F.pmod(F.floor(F.unix_timestamp("bar_start_at") / 1800), F.lit(7)).isin(0, 1))
    return findings(quality.contiguous_spans(quality.duplicate_bars(b.unionByName(again)), 30))


@query(
    _spans_sql(
        BARS,
        """SELECT 'PRICE_OUTLIER_RETURN' AS incident_code, 'WARNING' AS severity, instrument_id, s, 1 AS n FROM (
        SELECT *, lag(close) OVER w AS p, lag((s - 18000) // 86400) OVER w AS q FROM bars WINDOW w AS (PARTITION BY instrument_id ORDER BY s))
        WHERE q = (s - 18000) // 86400 AND abs(ln(close / p)) > 0.30""",
        1800,
    )
)
def quality_return_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(quality.contiguous_spans(quality.return_outliers(bars_30m(spark, sf_dir)), 30))


@query(_spans_sql(BARS, "SELECT 'PRICE_OUTLIER_RANGE' AS incident_code, 'WARNING' AS severity, instrument_id, s, 1 AS n FROM bars WHERE (high - low) / low > 0.20", 1800))
def quality_range_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(quality.contiguous_spans(quality.range_outliers(bars_30m(spark, sf_dir), zero_low=True), 30))


@query(
    f"""{DAILY}, m AS (SELECT instrument_id, median(volume) AS m, count(*) AS n FROM daily GROUP BY instrument_id)
    SELECT instrument_id, CAST(d AS VARCHAR) AS day, volume FROM daily JOIN m USING (instrument_id) WHERE n >= 20 AND m > 0 AND volume > 3 * m"""
)
def quality_volume_spikes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = daily_bars(spark, sf_dir)
    spikes = quality.volume_spikes(b, multiple=3.0).select("instrument_id", "bar_start_at")
    return b.join(spikes, ["instrument_id", "bar_start_at"]).select("instrument_id", F.col("session_date_et").cast("string").alias("day"), "volume")


@query(_spans_sql(BARS, "SELECT 'SESSION_DATE_MISMATCH' AS incident_code, 'ERROR' AS severity, instrument_id, s, 1 AS n FROM bars WHERE s % 86400 < 18000", 1800))
def quality_session_date_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir).withColumn("session_date_et", F.to_date("bar_start_at"))
    return findings(quality.contiguous_spans(quality.session_date_mismatch(b), 30))


@query(f"""{BARS} SELECT 'PARTITION_BOUNDARY_VIOLATION' AS incident_code, 'ERROR' AS severity, CAST(NULL AS VARCHAR) AS instrument_id, CAST(epoch(DATE '2024-01-05') + 18000 AS BIGINT) AS period_start,
    CAST(epoch(DATE '2024-01-29') + 18000 AS BIGINT) AS period_end, count(*) AS affected_rows FROM bars WHERE s - 18000 < epoch(DATE '2024-01-05') OR s - 18000 >= epoch(DATE '2024-01-29')""")  # fmt: skip
def quality_partition_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return findings(quality.partition_boundary_violation(bars_30m(spark, sf_dir), "2024-01-05", "2024-01-29"))


@query(
    """WITH t AS (SELECT event_type AS instrument_id, CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS s, event_id + CASE WHEN event_id % 11 = 0 THEN 25 ELSE 0 END AS a, event_id FROM events),
    w AS (SELECT *, lag(s) OVER (PARTITION BY instrument_id ORDER BY a, event_id) AS p FROM t)
    SELECT 'OUT_OF_ORDER' AS incident_code, 'WARNING' AS severity, instrument_id, s AS period_start, p + 1800 AS period_end, CAST(2 AS BIGINT) AS affected_rows FROM w WHERE s < p"""
)
def quality_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir)
    late = F.struct((F.col("event_id") + F.when(F.col("event_id") % 11 == 0, 25).otherwise(0)).alias("a"), "event_id")
    rows = t.select(F.col("event_type").alias("instrument_id"), keys.bucket_start("ts", 30).alias("bar_start_at"), late.alias("arrival"))
    return findings(quality.out_of_order(rows, bucket=F.floor(F.col("arrival.a") / 1000)))


_EXPECTED = f"{BARS}, x AS (SELECT d, o + 1800 * unnest(generate_series(0, 12)) AS s FROM ses)"


@query(
    f"""{_EXPECTED}, i AS (SELECT instrument_id, min(s) AS lo, max(s) AS hi FROM bars GROUP BY ALL HAVING count(DISTINCT s) > 1),
    m AS (SELECT i.instrument_id, x.d, x.s FROM i JOIN x ON x.s BETWEEN lo AND hi WHERE NOT EXISTS (FROM bars b WHERE b.instrument_id = i.instrument_id AND b.s = x.s)),
    a AS (SELECT m.*, (SELECT max(b.s) FROM bars b WHERE b.instrument_id = m.instrument_id AND b.s < m.s) AS p, (SELECT min(b.s) FROM bars b WHERE b.instrument_id = m.instrument_id AND b.s > m.s) AS q FROM m)
    SELECT instrument_id, CAST(d AS VARCHAR) AS session_date, min(s) AS start_at, max(s) AS last_start, count(*) AS bar_count, p AS previous_observed, q AS next_observed FROM a GROUP BY instrument_id, d, p, q"""
)
def missing_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = quality.missing_intervals(bars_30m(spark, sf_dir), sessions(spark))
    return m.select("instrument_id", F.col("session_date").cast("string"), secs("start", "start_at"), secs("last_start"), "bar_count", secs("previous_observed"), secs("next_observed"))


@query(
    f"""{_EXPECTED}, e AS (SELECT count(*) AS e FROM x), i AS (SELECT DISTINCT instrument_id FROM bars),
    m AS (SELECT instrument_id, count(*) AS m FROM i, x WHERE NOT EXISTS (FROM bars b WHERE b.instrument_id = i.instrument_id AND b.s = x.s) GROUP BY ALL),
    u AS (SELECT instrument_id, count(*) AS u FROM bars WHERE s NOT IN (SELECT s FROM x) GROUP BY ALL)
    SELECT b.instrument_id, count(*) AS rows, count(DISTINCT s) AS distinct_starts, any_value(e) AS expected, any_value(m) AS missing, any_value(u) AS unexpected, count(*) - count(DISTINCT s) AS duplicates,
           count(*) FILTER (least(open, high, low, close) <= 0 OR high < greatest(open, low, close) OR low > least(open, high, close) OR volume < 0) AS invalid_rows, count(*) FILTER (volume = 0) AS zero_volume_rows, round((any_value(e) - any_value(m)) / any_value(e) * 100, 6) AS coverage_pct, min(s) AS first_at, max(s) AS last_at, 'warning' AS status
    FROM bars b, e, m, u WHERE m.instrument_id = b.instrument_id AND u.instrument_id = b.instrument_id GROUP BY b.instrument_id"""
)
def coverage_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = quality.coverage_audit(bars_30m(spark, sf_dir), sessions(spark))
    return a.select("instrument_id", "rows", "distinct_starts", "expected", "missing", "unexpected", "duplicates", "invalid_rows", "zero_volume_rows", "coverage_pct", secs("first_at"), secs("last_at"), "status")


@query(f"""{BARS}, i AS (SELECT DISTINCT event_type AS instrument_id FROM events UNION ALL SELECT 'ABSENT'), two AS (SELECT * FROM bars UNION ALL SELECT * FROM bars WHERE instrument_id = 'view' AND s % 7200 = 0)
    SELECT i.instrument_id, count(s) AS observed_rows, count(DISTINCT s) AS unique_timestamps, count(s) - count(DISTINCT s) AS duplicates, count(s) FILTER (least(open, high, low, close) <= 0 OR high < greatest(open, low, close) OR low > least(open, high, close) OR volume < 0) AS invalid_rows,
      count(s) FILTER (volume = 0) AS zero_volume_rows, min(s) AS first_at, max(s) AS last_at, 'fast' AS quality_mode, CASE WHEN count(s) = 0 THEN 'empty' WHEN count(s) > count(DISTINCT s) OR count(s) FILTER (least(open, high, low, close) <= 0) > 0 THEN 'warning' ELSE 'ok' END AS status
    FROM i LEFT JOIN two b ON b.instrument_id = i.instrument_id GROUP BY ALL""")  # fmt: skip
def structural_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some bars of one instrument stand twice, and one instrument has no bars."""
    b = bars_30m(spark, sf_dir)
    twice = b.unionByName(b.where((F.col("instrument_id") == "view") & (F.unix_timestamp("bar_start_at") % 7200 == 0)))
    listed = b.select("instrument_id").unionByName(spark.createDataFrame([("ABSENT",)], "instrument_id string"))
    out = quality.structural_snapshot(twice, listed)
    return out.select("instrument_id", "observed_rows", "unique_timestamps", "duplicates", "invalid_rows", "zero_volume_rows", secs("first_at"), secs("last_at"), "quality_mode", "status")


@query(
    f"""{_EXPECTED}, m AS (SELECT instrument_id, d, s FROM (SELECT DISTINCT instrument_id FROM bars) i, x WHERE NOT EXISTS (FROM bars b WHERE b.instrument_id = i.instrument_id AND b.s = x.s)),
    w AS (SELECT instrument_id, d, min(s) AS lo, max(s) + 1800 AS hi FROM m GROUP BY ALL)
    SELECT instrument_id, CAST(d AS VARCHAR) AS session_date, CAST(greatest(lo, epoch(TIMESTAMP '2024-01-10 16:00:00')) AS BIGINT) AS start_at, hi AS end_at FROM w WHERE hi > epoch(TIMESTAMP '2024-01-10 16:00:00')"""
)
def repair_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    missing, _ = quality.missing_and_unexpected(bars_30m(spark, sf_dir), sessions(spark))
    w = quality.repair_windows(missing, "2024-01-10 16:00:00")
    return w.select("instrument_id", F.col("session_date").cast("string"), secs("start_at"), secs("end_at"))


@query(
    f"""{_MARRED}, bad AS (SELECT DISTINCT instrument_id, (s - 18000) // 86400 AS g FROM bars2 WHERE least(open, high, low, close) <= 0 OR high < greatest(open, low, close) OR low > least(open, high, close) OR volume < 0)
    SELECT instrument_id, CAST((s - 18000) // 86400 AS BIGINT) AS day, count(*) AS bars FROM bars2 b WHERE NOT EXISTS (FROM bad WHERE bad.instrument_id = b.instrument_id AND bad.g = (b.s - 18000) // 86400) GROUP BY ALL"""
)
def quality_gate_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.datediff("session_date_et", F.lit("1970-01-01").cast("date")).cast("long")
    b = _marred(bars_30m(spark, sf_dir)).withColumn("grp", F.concat_ws("|", "instrument_id", day.cast("string"))).withColumn("day", day)
    bad = quality.invalid_values(b).select(F.concat_ws("|", "instrument_id", F.datediff(keys.session_date_et("bar_start_at"), F.lit("1970-01-01").cast("date")).cast("string")).alias("grp"), "severity")
    good, _ = quality.quality_gate(b, bad, "grp")
    return good.groupBy("instrument_id", "day").agg(F.count("*").alias("bars"))


# ---- merging ----------------------------------------------------------------------------------------------------
@query(
    """SELECT event_type AS instrument_id, CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS bar_start_at, arg_max(value, event_id) AS value, max(event_id) AS event_id FROM events GROUP BY ALL"""
)
def dedup_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).select(F.col("event_type").alias("instrument_id"), F.unix_timestamp(keys.bucket_start("ts", 30)).alias("bar_start_at"), "value", "event_id")
    return merge.keep_last(t, ["instrument_id", "bar_start_at"], "event_id")


def _second(b: DataFrame) -> DataFrame:
    """A later version of the same bars, some closes changed."""
    k = F.pmod(F.floor(F.unix_timestamp("bar_start_at") / 1800), F.lit(97)) == 0
    return b.withColumn("close", F.when(k, F.round(F.col("close") * 1.01, 4)).otherwise(F.col("close")))


@query(f"{BARS} SELECT instrument_id, count(*) AS bars, count(*) FILTER (s // 1800 % 97 = 0 AND round(close * 1.01, 4) <> close) AS revised FROM bars GROUP BY instrument_id")
def revision_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir)
    return merge.revised(b, _second(b)).groupBy("instrument_id").agg(F.count("*").alias("bars"), F.count_if("revised").alias("revised"))


@query(f"{BARS} SELECT instrument_id, min(s) AS changed_from FROM bars WHERE s // 1800 % 97 = 0 AND abs(round(close * 1.01, 4) - close) > 1e-10 * greatest(abs(close), 1) GROUP BY instrument_id")
def earliest_changed(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir)
    return merge.earliest_change(b, _second(b), ["open", "close", "vwap"]).select("instrument_id", secs("changed_from"))


@query(f"{BARS} SELECT instrument_id, s AS bar_start_at, CASE WHEN s // 1800 % 97 = 0 THEN round(close * 1.01, 4) ELSE close END AS close FROM bars WHERE s >= epoch(DATE '2024-01-10')")
def upsert_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir).select("instrument_id", "bar_start_at", "close")
    new = _second(b).where(F.pmod(F.floor(F.unix_timestamp("bar_start_at") / 1800), F.lit(97)) == 0)
    return merge.upsert_keep_last(b, new, ["instrument_id", "bar_start_at"], "bar_start_at", "2024-01-10").select("instrument_id", secs("bar_start_at"), "close")


@query(
    f"""{BARS} SELECT instrument_id, s AS bar_start_at, CASE WHEN s // 1800 % 3 = 0 THEN 'append' WHEN s // 1800 % 5 = 0 THEN 'conflict' WHEN s // 1800 % 97 = 0 AND round(close * 1.01, 4) <> close THEN 'conflict' ELSE 'same' END AS action
    FROM bars WHERE NOT (s // 1800 % 3 = 0 AND s // 1800 % 5 = 0)"""
)
def snapshot_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir).select("instrument_id", "bar_start_at", "close")
    k = F.floor(F.unix_timestamp("bar_start_at") / 1800)
    source, target = b.where(F.pmod(k, F.lit(5)) != 0), _second(b).where(F.pmod(k, F.lit(3)) != 0)
    return merge.snapshot_diff(source, target, ["instrument_id", "bar_start_at"]).select("instrument_id", secs("bar_start_at"), "action")


@query(f"{BARS} SELECT instrument_id, s AS bar_start_at, close FROM bars QUALIFY row_number() OVER (PARTITION BY instrument_id ORDER BY s DESC) <= 5")
def latest_n_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest_n(bars_30m(spark, sf_dir), "instrument_id", 5).select("instrument_id", secs("bar_start_at"), "close")


@query(
    f"""{BARS} SELECT q.event_id, q.event_type AS instrument_id, b.close AS previous_close FROM (SELECT event_id, event_type, epoch(ts) AS e FROM events) q ASOF LEFT JOIN bars b ON b.instrument_id = q.event_type AND q.e > b.s"""
)
def asof_previous_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = ticks(spark, sf_dir).select("event_id", F.col("event_type").alias("instrument_id"), "ts")
    return merge.asof_before(q, bars_30m(spark, sf_dir), "instrument_id", "ts", "bar_start_at", "close", "previous_close").select("event_id", "instrument_id", "previous_close")


@query(f"""{DAILY}, p AS (SELECT instrument_id, d, d + CAST(1 + trade_count * 9 AS INTEGER) AS e FROM daily),
    w AS (SELECT *, greatest(DATE '1996-01-01', max(e) OVER (PARTITION BY instrument_id ORDER BY d, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS c FROM p),
    g AS (SELECT instrument_id, min(CASE WHEN d > coalesce(c, DATE '1996-01-01') THEN coalesce(c, DATE '1996-01-01') END) AS g, max(e) AS e FROM w WHERE e > DATE '1996-01-01' AND d < DATE '2000-01-01' GROUP BY ALL)
    SELECT instrument_id, CAST(coalesce(g, CASE WHEN e < DATE '2000-01-01' THEN e END) AS VARCHAR) AS first_gap FROM g""")  # fmt: skip
def coverage_first_gap(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = daily_bars(spark, sf_dir).select("instrument_id", F.col("session_date_et").alias("period_start"), F.date_add("session_date_et", (F.col("trade_count") * 9 + 1).cast("int")).alias("period_end"))
    day = lambda x: F.lit(x).cast("date")
    return merge.first_gap(p, "instrument_id", day("1996-01-01"), day("2000-01-01")).select("instrument_id", F.col("first_gap").cast("string"))
