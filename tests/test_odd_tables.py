"""Queries against their SQL on small tables with odd values."""

import collections
import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from barloom.operators import catalog
from barloom.plans import registry
from barloom.sources import files
from test_queries import norm


def event_rows(values, start="2024-01-03 15:00:00", minutes=5):
    """An event of one type for each value, some minutes apart."""
    t = dt.datetime.fromisoformat(start)
    return [(i, t + dt.timedelta(minutes=minutes * i), i % 7, "view", v) for i, v in enumerate(values)]


def same_as_sql(spark, folder, name, **tables):
    """Whether a query gives the rows of its SQL over tables that are written to folder as DataFrames; gives the rows."""
    con = pytest.importorskip("duckdb").connect()
    for t, df in tables.items():
        df.coalesce(1).write.parquet(f"{folder}/{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet/*.parquet'")
    df = registry.QUERIES[name](spark, str(folder))
    got = collections.Counter(tuple(norm(r[c]) for c in sorted(df.columns)) for r in df.collect())
    cur = con.execute(registry.ORACLE_SQL[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert got == collections.Counter(tuple(norm(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    return got


def events(spark, rows):
    return spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double").withColumn("props", F.lit("{}"))


def test_a_low_of_zero_has_a_range_without_limit(spark, tmp_path):
    e = events(spark, event_rows([10.0, 10.5, 10.0, 10.0, 10.0, 10.0, 0.0, 9.0, 9.0, 9.0, 9.0, 9.0, 0.0]))
    assert len(same_as_sql(spark, tmp_path, "quality_range_outliers", events=e)) == 1


def test_findings_of_a_low_of_zero_are_scoped(spark, tmp_path):
    e = events(spark, event_rows([10.0, 10.5, 10.0, 10.0, 10.0, 10.0, 0.0, 9.0, 9.0, 9.0, 9.0, 9.0, 9.0]))
    assert len(same_as_sql(spark, tmp_path, "scope_findings", events=e)) == 1


def test_a_backfill_takes_bars_at_zero(spark, tmp_path):
    # A Tuesday, so that the adjusted bars have the negative volume that the query puts in.
    e = events(spark, event_rows([10.0, 0.0, 3.0, 4.0, 5.0, 6.0, 7.0, 0.0, 5.0, 5.0, 5.0, 0.0, 9.0, 9.0], start="2024-01-09 15:00:00"))
    got = same_as_sql(spark, tmp_path, "backfill_job", events=e)
    assert {k[-2] for k in got} == {"SUCCEEDED", "FAILED"}


def test_files_of_series_do_not_grow_with_instruments(spark, tmp_path):
    v = spark.range(600).select(F.lit("sma").alias("definition_id"), F.concat(F.lit("I"), (F.col("id") % 200).cast("string")).alias("instrument_id"), F.timestamp_seconds(F.col("id") * 60).alias("bar_start_at"), F.col("id").cast("decimal(38,8)").alias("value"))
    files.write_series(v, f"{tmp_path}/series")
    back = spark.read.schema(v.schema).parquet(f"{tmp_path}/series").select(*v.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, v.collect()))
    assert len(list(tmp_path.rglob("*.parquet"))) <= 64


def test_files_are_read_in_portions(spark, tmp_path):
    """A file that is larger than one row of Spark may be is hashed; only its first and last bytes are on the disk."""
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate((1 << 31) + 5)
    (r,) = catalog.parquet_files(spark, str(tmp_path)).collect()
    digest = hashlib.sha256()
    for _ in range(1 << 11):
        digest.update(bytes(1 << 20))
    digest.update(bytes(5))
    assert (r["byte_size"], r["rows"], r["sha256"]) == ((1 << 31) + 5, None, digest.hexdigest())
