"""Bars from ticks and from smaller bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.keys import bucket_start, session_date_et
from barloom.operators.sessions import in_session

DURATIONS = {"1h": 60, "4h": 240, "1d": 24 * 60}


def bars_from_ticks(ticks: DataFrame, minutes: int, instrument: str, ts: str, price: str, tie: str, volume: str | None = None) -> DataFrame:
    """OHLCV bars of `minutes` from single trades; of equal instants the smaller `tie` is first.

    One aggregate with partial sums per task, so an instrument with most of the trades is no more than a row a bar and task."""
    order = F.struct(ts, tie)
    size = F.col(volume) if volume else F.lit(1)
    return (
        ticks.withColumn("_start", bucket_start(ts, minutes))
        .groupBy(F.col(instrument).alias("instrument_id"), F.col("_start").alias("bar_start_at"))
        .agg(
            F.min_by(price, order).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, order).alias("close"),
            F.sum(size).cast("long").alias("volume"),
            F.count("*").cast("long").alias("trade_count"),
            (F.sum(F.col(price) * size) / F.sum(size)).alias("vwap"),
        )
        .withColumn("session_date_et", session_date_et("bar_start_at"))
    )


def derive_bars(
    bars: DataFrame,
    sessions: DataFrame,
    resolution: str,
    label: str = "first_observed",
    source_minutes: int = 30,
    weigh_zero_volume: bool = True,
    trade_count_or_zero: bool = False,
    minutes: int | None = None,
) -> DataFrame:
    """Session bars of a resolution (1h, 4h, 1d, or any number of minutes) from smaller bars; gaps stay gaps.

    Buckets begin at the session's open. label: the start of the first bar observed, or `bucket_start`. vwap is weighted
    by volume over bars that have one, null without weight; trade_count is null if no bar has one, or 0 on request.
    """
    b = in_session(bars, sessions).withColumn("_minutes", F.lit(minutes or DURATIONS[resolution]))
    return _grouped(b, [], label, source_minutes, weigh_zero_volume, trade_count_or_zero)


def _grouped(b: DataFrame, keys: list[str], label: str, source_minutes: int = 30, weigh_zero_volume: bool = True, trade_count_or_zero: bool = False) -> DataFrame:
    """Bars with their session and the length of their bucket (_minutes) as one bar for each bucket, instrument and keys."""
    bucket = F.floor((F.unix_timestamp("bar_start_at") - F.unix_timestamp("opens_at")) / (F.col("_minutes") * 60))
    weight = F.when(F.col("vwap").isNotNull() & (F.lit(weigh_zero_volume) | (F.col("volume") > 0)), F.col("volume"))
    count = F.sum("trade_count")
    out = b.groupBy(*keys, "instrument_id", session_date_et("bar_start_at").alias("session_date_et"), "opens_at", "_minutes", bucket.alias("bucket")).agg(
        F.min("bar_start_at").alias("first_at"),
        F.min_by("open", "bar_start_at").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bar_start_at").alias("close"),
        F.sum("volume").alias("volume"),
        (F.coalesce(count, F.lit(0)) if trade_count_or_zero else count).alias("trade_count"),
        F.try_divide(F.sum(F.col("vwap") * weight), F.nullif(F.sum(weight), F.lit(0))).alias("vwap"),
        (F.count("*") * source_minutes).cast("smallint").alias("source_minutes"),
        F.count("*").cast("smallint").alias("source_bar_count"),
    )
    start = F.col("first_at") if label == "first_observed" else F.timestamp_seconds(F.unix_timestamp("opens_at") + F.col("bucket") * F.col("_minutes") * 60)
    return out.withColumn("bar_start_at", start).drop("first_at", "opens_at", "bucket", "_minutes")


def derive_all(bars: DataFrame, sessions: DataFrame, resolutions: tuple[str, ...], keys: list[str] | None = None, label: str = "first_observed") -> DataFrame:
    """The bars of several resolutions, by resolution and by further keys, in one pass: each bar is looked up in its session
    once and counts in one bucket of each resolution; partial sums keep what is shuffled small."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("resolution"), F.lit(DURATIONS[r]).alias("minutes")) for r in resolutions]))
    b = in_session(bars, sessions).withColumn("_each", each)
    return _grouped(b.withColumn("resolution", F.col("_each.resolution")).withColumn("_minutes", F.col("_each.minutes")).drop("_each"), ["resolution", *(keys or [])], label)


def long_term_outputs(bars: DataFrame, sessions: DataFrame) -> DataFrame:
    """The 1h, 4h and 1d bars of bars with volume, by resolution."""
    return derive_all(bars.where("volume > 0"), sessions, tuple(DURATIONS), label="bucket_start")
