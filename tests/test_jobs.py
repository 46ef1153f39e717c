"""Jobs over stored days and real files: what they change, what they leave alone, and what they read."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import catalog, jobs, quality
from barloom.operators.sessions import session_calendar
from barloom.sources.files import DayStore

DAY = dt.date(2026, 1, 5)


def bars(spark, rows):
    """rows: (price_type, instrument, day, half-hour of the session, close)."""
    b = spark.createDataFrame(rows, "price_type string, instrument_id string, day int, k int, close double")
    at = F.timestamp_seconds(F.lit(1767623400) + F.col("day") * 86400 + F.col("k") * 1800)
    return b.select("price_type", "instrument_id", at.alias("bar_start_at"), F.to_date(at).alias("session_date_et"), *[F.col("close").alias(c) for c in ("open", "high", "low", "close")], F.lit(10).cast("long").alias("volume"), F.lit(1).cast("long").alias("trade_count"), F.col("close").alias("vwap"))


@pytest.fixture
def store(spark, tmp_path):
    shape = bars(spark, [("raw", "A", 0, 0, 1.0)]).withColumns({"source_minutes": F.lit(30).cast("smallint"), "source_bar_count": F.lit(1).cast("smallint")})
    s = DayStore(spark, str(tmp_path / "days"), shape.schema)
    jobs.incremental(s, bars(spark, [(k, i, d, j, 10.0 + d) for k in ("raw", "adjusted") for i in "AB" for d in range(4) for j in range(13)]), asked(spark, 0, 3), sessions(spark), "2026-01-08 22:00:00")
    return s


def sessions(spark):
    return session_calendar(spark, "2026-01-01", "2026-01-31")


def asked(spark, *days):
    return spark.createDataFrame([(DAY + dt.timedelta(days=d),) for d in range(days[0], days[-1] + 1)], "session_date date")


def held(store, price_type):
    return {(r.resolution, r.instrument_id, (r.session_date_et - DAY).days): (r.n, r.close) for r in store.read(price_type).groupBy("resolution", "instrument_id", "session_date_et").agg(F.count("*").alias("n"), F.max_by("close", "bar_start_at").alias("close")).collect()}


def statuses(df):
    return {(r.price_type, r.resolution, (r.session_date - DAY).days): r.status for r in df.collect()}


def test_increment_replaces_fetched_days_in_all_resolutions(spark, store):
    before = {k: held(store, k) for k in ("raw", "adjusted")}
    assert {k: v[0] for k, v in before["raw"].items() if k[1] == "A" and k[2] == 2} == {("30m", "A", 2): 13, ("1h", "A", 2): 7, ("4h", "A", 2): 2, ("1d", "A", 2): 1}
    new = bars(spark, [("raw", "A", 3, j, 50.0) for j in range(3)])
    got = statuses(jobs.incremental(store, new, asked(spark, 3, 5), sessions(spark), "2026-01-09 22:00:00"))
    assert {(k[0], k[2]): v for k, v in got.items()} == {("raw", 3): "PUBLISHED", ("adjusted", 3): "NO_BARS", ("raw", 4): "NO_BARS", ("adjusted", 4): "NO_BARS", ("raw", 5): "NOT_A_SESSION", ("adjusted", 5): "NOT_A_SESSION"}
    # The day is what was fetched and nothing else; days before it are as they were.
    want = {k: v for k, v in before["raw"].items() if k[2] < 3} | {("30m", "A", 3): (3, 50.0), ("1h", "A", 3): (2, 50.0), ("4h", "A", 3): (1, 50.0), ("1d", "A", 3): (1, 50.0)}
    assert held(store, "raw") == want and held(store, "adjusted") == {k: v for k, v in before["adjusted"].items() if k[2] < 3}


def test_an_adjusted_revision_takes_the_history_anew(spark, store):
    fetched = bars(spark, [("adjusted", i, 3, j, 6.5) for i in "AB" for j in range(13)] + [("adjusted", "A", 1, 0, 5.5)])
    before = {k: held(store, k) for k in ("raw", "adjusted")}
    got = statuses(jobs.incremental(store, fetched, asked(spark, 3), sessions(spark), "2026-01-09 22:00:00"))
    assert set(got.values()) == {"ADJUSTMENT_REVISION_BACKFILL_FAILED"} and {k: held(store, k) for k in before} == before
    years = []

    def history(of):
        years.extend(of)
        return bars(spark, [("adjusted", i, d, j, (10.0 + d) / 2) for i in "AB" for d in range(3) for j in range(13)])

    got = statuses(jobs.incremental(store, fetched, asked(spark, 3), sessions(spark), "2026-01-09 22:00:00", history=history))
    assert years == [2026] and {k[2]: v for k, v in got.items() if k[0] == "adjusted"} == {0: "CORRECTED", 1: "CORRECTED", 2: "CORRECTED", 3: "PUBLISHED"}
    now = held(store, "adjusted")
    assert now[("1d", "A", 1)] == (1, 5.5) and now[("30m", "B", 2)] == (13, 6.0) and now[("1h", "A", 3)] == (7, 6.5)
    assert held(store, "raw") == {k: v for k, v in before["raw"].items() if k[2] < 3}
    # The same prices again are no revision.
    again = statuses(jobs.incremental(store, fetched.where("close = 5.5 OR close = 6.5"), asked(spark, 3), sessions(spark), "2026-01-09 22:00:00"))
    assert set(v for k, v in again.items() if k[0] == "adjusted") == {"PUBLISHED"}


def test_only_the_folders_of_a_day_are_read(spark, store):
    df = store.read("adjusted", "30m", [DAY])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "session_date_et" in plan.split("PartitionFilters: [")[1].split("]")[0] and "resolution" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert all("resolution=30m/session_date_et=2026-01-05" in f for f in df.inputFiles()) or df.count() == 26


def test_footers_of_damaged_files(spark, tmp_path):
    path = str(tmp_path / "files")
    for k, n in enumerate((10, 0, 25)):
        spark.range(n).coalesce(1).write.parquet(f"{path}/{k}")
    names = {k: next(p for p in (tmp_path / "files" / str(k)).iterdir() if p.name.endswith(".parquet")) for k in range(3)}
    raw = names[0].read_bytes()
    for name, left in (("cut", raw[:-20]), ("short", raw[:7]), ("mark", raw[:-4] + b"XXXX"), ("length", raw[:-8] + b"\xff\xff\xff\x7fPAR1"), ("inside", raw[:-12] + b"\xff\xff\xff\xff" + raw[-8:])):
        (tmp_path / "files" / f"{name}.parquet").write_bytes(left)
    got = {r.path.split("/")[-1]: r for r in catalog.parquet_files(spark, path).where("path LIKE '%.parquet'").collect()}
    assert [got[names[k].name].rows for k in range(3)] == [10, 0, 25]
    assert all(got[f"{x}.parquet"].rows is None for x in ("cut", "short", "mark", "length"))
    import hashlib

    assert got["cut.parquet"].sha256 == hashlib.sha256(raw[:-20]).hexdigest()


def test_snapshot_without_a_calendar(spark):
    b = bars(spark, [("raw", "A", 0, 0, 1.0), ("raw", "A", 0, 0, 1.0), ("raw", "B", 0, 1, -1.0), ("raw", "C", 0, 0, 1.0)])
    got = {r.instrument_id: (r.observed_rows, r.duplicates, r.invalid_rows, r.status) for r in quality.structural_snapshot(b, spark.createDataFrame([("A",), ("B",), ("C",), ("D",)], "instrument_id string")).collect()}
    assert got == {"A": (2, 1, 0, "warning"), "B": (1, 0, 1, "warning"), "C": (1, 0, 0, "ok"), "D": (0, 0, 0, "empty")}
