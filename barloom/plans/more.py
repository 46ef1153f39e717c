"""Further queries over quality, catalog and gate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import keys
from barloom.operators import catalog, merge, quality, resample
from barloom.plans.analytics import uuid_sql
from barloom.plans.bars import BARS, DAILY, findings
from barloom.plans.catalogs import QUERIES as CATALOGS, ORACLE_SQL as CATALOG_SQL
from barloom.plans.registration import new_registry
from barloom.sources import files
from barloom.sources.market import bars_30m, daily_bars, secs, sessions, table, ticks

QUERIES, ORACLE_SQL, query = new_registry()


@query(f"""{BARS}, h AS (SELECT instrument_id, o, c, k, min(s) AS s, 30 * count(*) AS m FROM (SELECT *, (s - o) // 3600 AS k FROM ib) GROUP BY ALL),
    g AS (SELECT *, CASE WHEN s // 1800 % 7 = 0 THEN m + 1 WHEN s // 1800 % 11 = 0 THEN 0 ELSE m END AS x FROM h)
    SELECT instrument_id, s AS bar_start_at, CASE WHEN x <= 0 OR x % 30 <> 0 OR x > 60 THEN 'INVALID_SOURCE_MINUTES' ELSE 'UNEXPECTED_MISSING_SOURCE_BARS' END AS incident_code FROM g
    WHERE x <= 0 OR x % 30 <> 0 OR x > 60 OR x < least(60, (c - s) / 60)""")  # fmt: skip
def quality_derived_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1h")
    k = F.floor(F.unix_timestamp("bar_start_at") / 1800)
    m = F.when(k % 7 == 0, F.col("source_minutes") + 1).when(k % 11 == 0, F.lit(0)).otherwise(F.col("source_minutes"))
    return quality.derived_session_checks(h.withColumn("source_minutes", m), sessions(spark), 60).select("instrument_id", secs("bar_start_at"), "incident_code")


@query(f"""{DAILY} SELECT instrument_id, CAST(d AS VARCHAR) AS day, 'open_outside_range' AS violations FROM daily WHERE volume % 5 = 0 AND open + 100 > high""")
def bar_value_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = daily_bars(spark, sf_dir).withColumn("open", F.when(F.col("volume") % 5 == 0, F.col("open") + 100).otherwise(F.col("open"))).withColumn("source_minutes", F.lit(30)).withColumn("source_bar_count", F.lit(1))
    out = b.select("instrument_id", F.col("session_date_et").cast("string").alias("day"), quality.bar_value_violations().alias("violations"))
    return out.where("violations IS NOT NULL")


@query(f"""{DAILY}, o AS (SELECT CAST(date_trunc('month', d) AS DATE) AS p, instrument_id, count(*) AS n FROM daily GROUP BY ALL) SELECT 'MONTH' AS partition_granularity, count(*) AS objects, count(DISTINCT n % 5) AS parts, CAST(sum(n) AS BIGINT) AS row_count, min(n * 10) AS min_bytes, round(avg(n * 10), 6) AS mean_bytes, max(n * 10) AS max_bytes FROM o""")
def storage_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = daily_bars(spark, sf_dir).groupBy("instrument_id", F.trunc("session_date_et", "month")).agg(F.count("*").alias("row_count"))
    o = o.select(F.lit("MONTH").alias("partition_granularity"), (F.col("row_count") % 5).alias("part_number"), "row_count", (F.col("row_count") * 10).alias("byte_size"))
    return files.storage_profile(o).withColumn("mean_bytes", F.round("mean_bytes", 6))


@query("""WITH m AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders) SELECT k AS manifest_id, count(*) AS objects, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS row_count FROM m JOIN lineitem ON l_orderkey = k JOIN part ON p_partkey = l_partkey GROUP BY k""")
def manifest_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    o = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("manifest_id"), F.col("l_partkey").alias("object_id"), F.col("l_quantity").cast("long").alias("row_count"))
    s = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("object_id"), F.col("p_name").alias("object_key"))
    return catalog.manifest_objects(m, o, s).groupBy("manifest_id").agg(F.count("*").alias("objects"), F.sum("row_count").alias("row_count"))


@query("""SELECT s_name AS name, nullif(array_to_string(list_filter([CASE WHEN s_suppkey % 3 = 0 THEN 'provider' END, CASE WHEN s_suppkey % 4 = 0 THEN 'resolution' END], lambda x: x IS NOT NULL), ','), '') AS mismatch FROM supplier""")
def feed_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    raw = s.select(F.col("s_name").alias("name"), F.lit("p").alias("provider"), F.lit("30m").alias("resolution"), F.lit(None).cast("string").alias("timezone"))
    adj = s.select(F.col("s_name").alias("name"), F.when(F.col("s_suppkey") % 3 == 0, "q").otherwise("p").alias("provider"), F.when(F.col("s_suppkey") % 4 == 0, "1h").otherwise("30m").alias("resolution"), F.lit(None).cast("string").alias("timezone"))
    return catalog.feed_mismatches(raw, adj, ["provider", "resolution", "timezone"])


@query("""WITH d AS (SELECT unnest(['x', 'y']) AS definition_id) SELECT definition_id, s_suppkey AS instrument_id, CASE WHEN s_suppkey % 5 = 0 THEN 'ABSENT' ELSE 'NOT_SUCCEEDED' END AS matter FROM d, supplier WHERE definition_id = 'x' AND (s_suppkey % 5 = 0 OR s_suppkey % 7 = 0)""")
def planned_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("instrument_id"))
    d = i.limit(1).select(F.explode(F.array(F.lit("x"), F.lit("y"))).alias("definition_id"))
    m = i.select("instrument_id", F.explode(F.array(F.lit("x"), F.lit("y"))).alias("definition_id")).where("definition_id = 'y' OR instrument_id % 5 <> 0")
    m = m.withColumn("status", F.when((F.col("definition_id") == "x") & (F.col("instrument_id") % 7 == 0), "FAILED").otherwise("SUCCEEDED"))
    return catalog.planned_members(d, i, m)


@query("""SELECT o_orderpriority AS feed_id, CAST(max(o_orderdate) AS DATE)::VARCHAR AS head FROM orders WHERE o_orderkey % 4 <> 0 AND o_orderpriority[1] IN ('1', '2', '4') GROUP BY ALL""")
def manifest_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    feeds = o.select(F.col("o_orderpriority").alias("feed_id")).distinct().withColumn("feed_active", F.substring("feed_id", 1, 1).isin("1", "2", "4", "5")).withColumn("provider_active", F.substring("feed_id", 1, 1) != "5")
    m = o.select(F.col("o_orderpriority").alias("feed_id"), F.to_date("o_orderdate").alias("period_end"), F.when(F.col("o_orderkey") % 4 == 0, "QUARANTINED").otherwise("AVAILABLE").alias("status"))
    return catalog.watermark_projection(feeds, m).select("feed_id", F.col("last_source_event_at").cast("string").alias("head"))


@query(f"""WITH g AS ({CATALOG_SQL['readiness_gate']}) SELECT {uuid_sql("('readiness|' || feed_id || '|' || session_date || '|' || reason || '|' || CASE WHEN reason = 'DAILY_OBJECT_MISSING' THEN first_missing_shard ELSE 'None' END)")} AS id, feed_id, session_date, reason AS incident_code, CASE WHEN reason = 'DAILY_OBJECT_MISSING' THEN 'PARTITION' ELSE 'MANIFEST' END AS breadth, CASE WHEN reason = 'DAILY_OBJECT_MISSING' THEN first_missing_shard END AS shard_key FROM g WHERE state = 'BLOCKED'""")
def readiness_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.readiness_incidents(CATALOGS["readiness_gate"](spark, sf_dir)).select("id", "feed_id", "session_date", "incident_code", "breadth", "shard_key")


@query("""SELECT event_type AS instrument_id, CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800 AS bar_start_at, count(*) AS n FROM events WHERE event_id % 10 <> 0 GROUP BY ALL
    UNION ALL SELECT event_type, CAST(floor(epoch(ts) / 1800) AS BIGINT) * 1800, 0 FROM events GROUP BY ALL HAVING count(*) FILTER (event_id % 10 <> 0) = 0""")  # fmt: skip
def gap_repair_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).select("event_id", F.col("event_type").alias("instrument_id"), keys.bucket_start("ts", 30).alias("bar_start_at"))
    have = t.where("event_id % 10 <> 0").groupBy("instrument_id", "bar_start_at").agg(F.count("*").alias("n"))
    fetched = t.join(have, ["instrument_id", "bar_start_at"], "left_anti").select("instrument_id", "bar_start_at", F.lit(0).cast("long").alias("n"))
    return merge.upsert_keep_last(have, fetched, ["instrument_id", "bar_start_at"]).select("instrument_id", secs("bar_start_at"), "n")


@query(f"""{BARS}, d AS (SELECT instrument_id, o, c, min(s) AS s, 30 * count(*) AS m FROM ib GROUP BY ALL) SELECT 'UNEXPECTED_MISSING_SOURCE_BARS' AS incident_code, 'WARNING' AS severity, instrument_id, s AS period_start, s + 23400 AS period_end, CAST(1 AS BIGINT) AS affected_rows FROM d WHERE m < (c - s) / 60""")
def quality_daily_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = resample.derive_bars(bars_30m(spark, sf_dir), sessions(spark), "1d")
    return findings(quality.contiguous_spans(quality.derived_session_checks(d, sessions(spark), 390), 390))
