"""Bar tables, sessions and events laid over the TPC-H-like test tables: the inputs of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.keys import et_midnight
from barloom.operators.resample import bars_from_ticks
from barloom.operators.sessions import session_calendar


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")


def bars_30m(spark: SparkSession, sf_dir: str) -> DataFrame:
    """30-minute bars of events: an instrument for each type, a trade of one share for each event."""
    return bars_from_ticks(ticks(spark, sf_dir), 30, "event_type", "ts", "value", "event_id")


def sessions(spark: SparkSession, start: str = "2024-01-01", end: str = "2024-01-31") -> DataFrame:
    return session_calendar(spark, start, end)


def daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of line items: an instrument for each supplier, a trade for each line, in order of its keys."""
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5) / 100  # cents, the same in every engine
    order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("string").alias("instrument_id"), F.to_date("l_shipdate").alias("session_date_et"), price.alias("price"), F.col("l_quantity").cast("long").alias("q"), order.alias("o"))
    out = lines.groupBy("instrument_id", "session_date_et").agg(
        F.min_by("price", "o").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", "o").alias("close"),
        F.sum("q").alias("volume"), F.count("*").alias("trade_count"), (F.sum(F.col("price") * F.col("q")) / F.sum("q")).alias("vwap"),
    )
    return out.withColumn("bar_start_at", et_midnight("session_date_et"))


def secs(c: str, name: str | None = None):
    """Epoch seconds of an instant, which every engine prints alike."""
    return F.unix_timestamp(c).alias(name or c)
