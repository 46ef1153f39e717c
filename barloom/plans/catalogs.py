"""Queries over keys, objects, manifests and revisions."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions import keys, values
from barloom.operators import catalog, merge
from barloom.plans.analytics import MIDNIGHT, uuid_sql
from barloom.plans.bars import BARS, DAILY
from barloom.plans.registration import new_registry
from barloom.sources.market import bars_30m, daily_bars, secs, sessions, table

QUERIES, ORACLE_SQL, query = new_registry()


def shard_sql(x: str, n: int) -> str:
    return f"CAST(CAST('0x' || substr(sha256({x}), 1, 16) AS UBIGINT) % {n} AS INTEGER)"


def shard_key_sql(x: str, n: int) -> str:
    return f"('s' || lpad(CAST({shard_sql(x, n)} AS VARCHAR), 2, '0') || '-of-{n}')"


@query(f"SELECT s_suppkey, {uuid_sql('''('instrument|' || s_name)''')} AS instrument_id, {shard_sql('s_name', 16)} AS shard, {shard_key_sql('s_name', 8)} AS shard_key FROM (SELECT s_suppkey, lower(s_name) AS s_name FROM supplier)")
def instrument_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.lower("s_name").alias("n"))
    return s.select("s_suppkey", keys.deterministic_uuid(F.lit("instrument"), "n").alias("instrument_id"), keys.stable_shard("n", 16).alias("shard"), keys.shard_key("n", 8).alias("shard_key"))


@query("""SELECT o_orderkey, CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS week_start, CAST(CAST(date_trunc('week', d) AS DATE) + 7 AS VARCHAR) AS week_end, CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start,
    CAST(CAST(date_trunc('month', d) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS month_end, CAST(make_date(year(d), 1, 1) AS VARCHAR) AS year_start, CAST(make_date(year(d) + 1, 1, 1) AS VARCHAR) AS year_end FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)""")  # fmt: skip
def partition_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("d"))
    out = [f(F.col("d"), g).cast("string").alias(f"{g.lower()}_{n}") for g in ("WEEK", "MONTH", "YEAR") for f, n in ((keys.partition_start, "start"), (keys.partition_end, "end"))]
    return o.select("o_orderkey", *out)


@query("SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || strftime(ts, '%f') END || 'Z' AS iso, strftime(ts, '%Y%m%dT%H%M%SZ') AS compact FROM events")
def render_instants(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    return e.select("event_id", keys.iso_utc("ts").alias("iso"), keys.compact_utc("ts").alias("compact"))


@query("""SELECT c_custkey, upper(trim(n)) AS raw, replace(upper(trim(n)), '/', '.') AS symbol, replace(replace(upper(trim(n)), '/', '.'), '.', '-') AS safe FROM (SELECT c_custkey, ' ' || c_mktsegment[1:3] || '/' || c_name[10:] || ' ' AS n FROM customer)""")
def symbol_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.concat(F.lit(" "), F.substring("c_mktsegment", 1, 3), F.lit("/"), F.expr("substring(c_name, 10)"), F.lit(" "))
    c = table(spark, sf_dir, "customer").select("c_custkey", n.alias("n"))
    return c.select("c_custkey", F.upper(F.trim("n")).alias("raw"), keys.canonical_symbol("n").alias("symbol"), keys.safe_symbol("n").alias("safe"))


@query("""WITH h AS (SELECT o_orderkey, sha256('i' || o_custkey) AS a, sha256('n' || o_orderkey) AS b, sha256('r' || o_orderstatus) AS c FROM orders)
    SELECT o_orderkey, 'fmv1:m:' || a[1:16] || ':' || b[1:16] || ':' || c[1:16] AS version, 'm' AS scope, b[1:16] AS inputs FROM h""")  # fmt: skip
def version_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    h = lambda p, c: values.sha256(F.concat(F.lit(p), F.col(c).cast("string")))
    v = o.select("o_orderkey", values.version_string("m", h("i", "o_custkey"), F.concat(F.lit("sha256:"), h("n", "o_orderkey")), h("r", "o_orderstatus")).alias("version"))
    return v.withColumn("p", values.parse_version("version")).select("o_orderkey", "version", "p.scope", "p.inputs")


@query("""SELECT event_id, CAST(props->>'$.k' AS DECIMAL(38,18)) AS k FROM events""")
def decode_decimal_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", values.decimal_map("props")["k"].alias("k"))


# ---- objects ----------------------------------------------------------------------------------------------------
def midnight(c: str, plus: int = 0) -> str:
    """The instant of New York's midnight of day c, `plus` days of 24 hours later, as ISO text."""
    return f"(strftime({c} + {plus}, '%Y-%m-%d') || 'T0' || ({re.sub(r'\bd\b', c, MIDNIGHT)}) || ':00:00Z')"


_ROW = f"""sha256(instrument_id || '|' || (CAST(epoch(d) AS BIGINT) + 3600 * ({MIDNIGHT})) || '|' || CAST(round(open * 1000000) AS BIGINT) || '|' || CAST(round(high * 1000000) AS BIGINT) || '|' || CAST(round(low * 1000000) AS BIGINT) || '|' || CAST(round(close * 1000000) AS BIGINT) || '|' || volume || '|' || trade_count)"""
_OBJECTS = f"""{DAILY}, o AS (SELECT CAST(date_trunc('month', d) AS DATE) AS ps, {shard_key_sql('instrument_id', 8)} AS shard_key, count(*) AS row_count,
    min(instrument_id) AS min_i, max(instrument_id) AS max_i, min(d) AS a, max(d) AS b, sha256(count(*) || ':' || sum(CAST(CAST('0x' || {_ROW}[1:15] AS BIGINT) AS HUGEINT))) AS content_hash FROM daily GROUP BY ALL)"""


def objects(spark: SparkSession, sf_dir: str, granularity: str = "MONTH") -> DataFrame:
    o = catalog.object_stats(daily_bars(spark, sf_dir), granularity, 8, 24 * 60)
    o = o.withColumn("object_kind", F.lit("MARKET_DATA")).withColumn("part_number", F.lit(1)).withColumn("schema_version", F.lit("market-bars-v2"))
    return o.withColumn("id", F.concat_ws("/", F.col("partition_start").cast("string"), "shard_key"))


@query(f"{_OBJECTS} SELECT CAST(ps AS VARCHAR) AS partition_start, CAST(CAST(ps + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS partition_end, shard_key, row_count, min_i AS min_instrument_id, max_i AS max_instrument_id, {midnight('a')} AS period_start, {midnight('b', 1)} AS period_end, content_hash FROM o")
def object_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    return o.select(F.col("partition_start").cast("string"), F.col("partition_end").cast("string"), "shard_key", "row_count", "min_instrument_id", "max_instrument_id", keys.iso_utc("period_start").alias("period_start"), keys.iso_utc("period_end").alias("period_end"), "content_hash")


@query(
    f"""{_OBJECTS}, j AS (SELECT ps, '{{"content_hash":"' || content_hash || '","object_kind":"MARKET_DATA","part_number":1,"partition_end":"' || CAST(ps + INTERVAL 1 MONTH AS DATE) || '","partition_granularity":"MONTH","partition_start":"' || ps ||
      '","period_end":"' || {midnight('b', 1)} || '","period_start":"' || {midnight('a')} || '","row_count":' || row_count || ',"schema_version":"market-bars-v2","shard_key":"' || shard_key || '"}}' AS j FROM o)
    SELECT CAST(ps AS VARCHAR) AS partition_start, sha256('[' || string_agg(j, ',' ORDER BY j) || ']') AS dataset_hash FROM j GROUP BY ps"""
)
def dataset_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.dataset_hash(objects(spark, sf_dir), ["partition_start"]).withColumn("partition_start", F.col("partition_start").cast("string"))


@query(f"""{_OBJECTS}, w AS (SELECT CAST(date_trunc('year', d) AS DATE) AS ys, {shard_key_sql('instrument_id', 8)} AS shard_key, min(d) AS a, max(d) AS b FROM daily GROUP BY ALL)
    SELECT w.ys || '/' || w.shard_key AS derived_id, o.ps || '/' || o.shard_key AS source_id FROM w JOIN o ON w.shard_key = o.shard_key AND w.a <= o.b AND o.a <= w.b""")  # fmt: skip
def lineage_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.lineage(objects(spark, sf_dir, "YEAR"), objects(spark, sf_dir))


_MANIFESTS = """WITH m AS (SELECT year(o_orderdate) AS y, o_orderpriority[1] AS feed, o_orderkey AS revision_number, CASE WHEN o_orderkey % 4 = 0 THEN 'QUARANTINED' ELSE 'AVAILABLE' END AS status FROM orders)"""


def manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(F.year("o_orderdate").cast("long").alias("year"), F.substring("o_orderpriority", 1, 1).alias("feed"), F.col("o_orderkey").alias("revision_number"), F.when(F.col("o_orderkey") % 4 == 0, "QUARANTINED").otherwise("AVAILABLE").alias("status"), "o_totalprice")


@query(f"{_MANIFESTS} SELECT y AS year, feed, max(revision_number) AS revision_number FROM m WHERE status = 'AVAILABLE' GROUP BY ALL")
def latest_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.latest_available(manifests(spark, sf_dir), ["year", "feed"]).select("year", "feed", "revision_number")


@query(f"{_MANIFESTS} SELECT y AS year, count(*) AS manifests, count(*) FILTER (status = 'AVAILABLE') AS available, count(*) FILTER (status = 'QUARANTINED') AS quarantined FROM m GROUP BY y")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifests(spark, sf_dir).groupBy("year").agg(F.count("*").alias("manifests"), F.count_if(F.col("status") == "AVAILABLE").alias("available"), F.count_if(F.col("status") == "QUARANTINED").alias("quarantined"))


@query(f"""{_OBJECTS}, k AS (SELECT ps || '/' || shard_key AS id, row_count FROM o WHERE b < DATE '1998-03-01' OR a >= DATE '1998-06-01'), x AS (SELECT ps || '/' || shard_key AS id, row_count + 1 AS row_count FROM o WHERE ps = DATE '1998-04-01')
    SELECT id, row_count, 'AVAILABLE' AS status FROM k UNION ALL SELECT id, row_count, 'AVAILABLE' FROM x""")  # fmt: skip
def publish_revision(spark: SparkSession, sf_dir: str) -> DataFrame:
    prev = objects(spark, sf_dir)
    new = prev.where("partition_start = DATE'1998-04-01'").withColumn("row_count", F.col("row_count") + 1)
    gone = spark.range(1).select(keys.et_midnight(F.lit("1998-03-01").cast("date")).alias("period_start"), keys.et_midnight(F.lit("1998-06-01").cast("date")).alias("period_end"))
    findings = bars_30m(spark, sf_dir).where("high < low").select(F.lit("ERROR").alias("severity"))
    out, status = catalog.publish_revision(prev, new, gone, findings)
    return out.crossJoin(F.broadcast(status.select("status"))).select("id", "row_count", "status")


@query(f"""{_OBJECTS}, e AS (SELECT ps || '/' || shard_key AS id, shard_key, a, CASE WHEN row_count % 3 = 0 THEN b + 40 ELSE b END AS b FROM o),
    w AS (SELECT *, lag(b) OVER (PARTITION BY shard_key ORDER BY a, b) AS p FROM e) SELECT id, CAST(p AS VARCHAR) AS previous_end FROM w WHERE a < p""")  # fmt: skip
def active_object_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir)
    day = keys.session_date_et(F.timestamp_seconds(F.unix_timestamp("period_end") - 7200))
    o = o.select("id", "shard_key", F.lit("m").alias("manifest_id"), keys.session_date_et("period_start").alias("period_start"), F.when(F.col("row_count") % 3 == 0, F.date_add(day, 40)).otherwise(day).alias("period_end"))
    return catalog.overlapping_objects(o).select("id", F.col("previous_end").cast("string"))


_WEEKDAYS = "(SELECT CAST(unnest(generate_series(DATE '2024-01-01', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS d)"


@query(f"""{BARS}, i AS (SELECT {shard_key_sql('instrument_id', 4)} AS shard_key, CAST(to_timestamp(s - 18000) AT TIME ZONE 'UTC' AS DATE) AS d, count(*) AS n FROM bars WHERE s // 86400 % 9 <> 0 GROUP BY ALL),
    z AS (SELECT DISTINCT shard_key FROM i), j AS (SELECT z.shard_key, ses.d, i.n FROM z CROSS JOIN ses LEFT JOIN i ON i.shard_key = z.shard_key AND i.d = ses.d),
    g AS (SELECT shard_key, CAST(date_trunc('week', d) AS DATE) AS a, count(n) AS inputs, CAST(coalesce(sum(n), 0) AS BIGINT) AS row_count, count(*) - count(n) AS missing_days FROM j GROUP BY ALL)
    SELECT shard_key, CAST(a AS VARCHAR) AS target_start, inputs, row_count, missing_days, CASE WHEN month(a) <> month(a + 6) THEN 'SKIPPED' WHEN missing_days > 0 THEN 'COMPACTION_INPUT_INCOMPLETE' ELSE 'READY' END AS status FROM g""")  # fmt: skip
def compaction_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = bars_30m(spark, sf_dir).where(F.floor(F.unix_timestamp("bar_start_at") / 86400) % 9 != 0)
    inputs = b.groupBy(keys.shard_key("instrument_id", 4).alias("shard_key"), F.col("session_date_et").alias("partition_start")).agg(F.count("*").alias("row_count"))
    p = catalog.compaction_plan(inputs, sessions(spark), "WEEK")
    return p.select("shard_key", F.col("target_start").cast("string"), "inputs", "row_count", "missing_days", "status")


@query(f"{DAILY} SELECT instrument_id FROM daily GROUP BY instrument_id HAVING count(DISTINCT date_trunc('month', d)) = (SELECT count(DISTINCT date_trunc('month', d)) FROM daily)")
def instrument_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.instruments_in_all(daily_bars(spark, sf_dir).select("instrument_id", F.trunc("session_date_et", "month").alias("manifest_id")))


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey % 7 AS v, o_orderstatus AS h FROM orders), a AS (SELECT k, CASE WHEN k % 11 = 0 THEN v + 1 ELSE v END AS v, CASE WHEN k % 13 = 0 THEN 'x' ELSE h END AS h FROM e WHERE k % 17 <> 0)
    SELECT k AS object_key, 'S3_OBJECT_MISSING' AS code FROM e WHERE k NOT IN (SELECT k FROM a) UNION ALL SELECT e.k, 'VERSION_MISMATCH' FROM e JOIN a USING (k) WHERE a.v <> e.v UNION ALL SELECT e.k, 'SHA256_MISMATCH' FROM e JOIN a USING (k) WHERE a.h <> e.h""")  # fmt: skip
def object_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("object_key"), (F.col("o_custkey") % 7).alias("version_id"), F.col("o_orderstatus").alias("content_hash"))
    a = e.where("object_key % 17 <> 0").withColumn("version_id", F.when(F.col("object_key") % 11 == 0, F.col("version_id") + 1).otherwise(F.col("version_id"))).withColumn("content_hash", F.when(F.col("object_key") % 13 == 0, "x").otherwise(F.col("content_hash")))
    return catalog.reconcile(e, a)


@query("""WITH e AS (SELECT o_orderkey AS k, o_custkey AS n, o_orderstatus AS h FROM orders), a AS (SELECT k, CASE WHEN k % 29 = 0 THEN 0 WHEN k % 11 = 0 THEN n + 1 ELSE n END AS n, CASE WHEN k % 13 = 0 THEN 'x' ELSE h END AS h FROM e WHERE k % 17 <> 0),
    p AS (SELECT CASE WHEN a.n IS NULL THEN 1 WHEN a.n = 0 THEN 2 WHEN a.n < 5 THEN 3 WHEN a.n <> e.n THEN 4 WHEN a.h <> e.h THEN 5 END AS p FROM e LEFT JOIN a USING (k))
    SELECT count(*) AS files, count(*) FILTER (p = 1) AS missing, count(*) FILTER (p = 2) AS empty, count(*) FILTER (p = 3) AS too_small, count(*) FILTER (p = 4) AS size_mismatch, count(*) FILTER (p = 5) AS hash_mismatch, count(p) AS problems, false AS resumable FROM p""")  # fmt: skip
def resume_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_custkey").alias("byte_size"), F.col("o_orderstatus").alias("sha256"))
    size = F.when(F.col("path") % 29 == 0, 0).when(F.col("path") % 11 == 0, F.col("byte_size") + 1).otherwise(F.col("byte_size"))
    a = e.where("path % 17 <> 0").withColumn("sha256", F.when(F.col("path") % 13 == 0, "x").otherwise(F.col("sha256"))).withColumn("byte_size", size)
    return catalog.resume_check(e, a, 5)


@query(
    f"""WITH RECURSIVE {DAILY[5:]}, c0 AS (SELECT {shard_sql('instrument_id', 4)} AS shard, d, count(*) AS n FROM daily GROUP BY ALL), c AS (SELECT *, row_number() OVER (PARTITION BY shard ORDER BY d) AS k FROM c0),
    r AS (SELECT shard, CAST(1 AS BIGINT) AS k, n AS rows, 0 AS part FROM c WHERE k = 1 UNION ALL
      SELECT c.shard, c.k, CASE WHEN r.rows + c.n > 500 THEN c.n ELSE r.rows + c.n END, CASE WHEN r.rows + c.n > 500 THEN part + 1 ELSE part END FROM r JOIN c ON c.shard = r.shard AND c.k = r.k + 1)
    SELECT r.shard, r.part AS part_number, CAST(sum(c.n) AS BIGINT) AS rows, CAST(min(c.d) AS VARCHAR) AS first_day, CAST(max(c.d) AS VARCHAR) AS last_day FROM r JOIN c USING (shard, k) GROUP BY r.shard, r.part"""
)
def time_boundary_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = catalog.time_boundary_parts(daily_bars(spark, sf_dir), 4, 500)
    return p.groupBy("shard", "part_number").agg(F.count("*").alias("rows"), F.min("session_date_et").cast("string").alias("first_day"), F.max("session_date_et").cast("string").alias("last_day"))


@query(f"""{_OBJECTS} SELECT CAST(s_suppkey AS VARCHAR) AS instrument_id, o.ps || '/' || o.shard_key AS id FROM supplier JOIN o ON o.shard_key = {shard_key_sql('CAST(s_suppkey AS VARCHAR)', 8)}""")
def shard_theta_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("instrument_id"))
    return catalog.shard_join(i, objects(spark, sf_dir))


@query(f"""{_OBJECTS}, c AS (SELECT shard_key, count(*) AS n FROM o GROUP BY ALL), d AS (SELECT unnest(['a', 'b']) AS definition_id), w AS (SELECT definition_id, CAST(s_suppkey AS VARCHAR) AS instrument_id FROM d, supplier WHERE NOT (definition_id = 'a' AND s_suppkey % 3 = 0))
    SELECT definition_id, instrument_id, coalesce(n, 0) AS objects, CAST(coalesce((n + 15) // 16, 0) AS BIGINT) AS chunks, CASE WHEN n IS NULL THEN 'NO_SOURCE_OBJECTS' WHEN n > 16 THEN 'PERIOD_SPLIT' END AS warning
    FROM w LEFT JOIN c ON c.shard_key = {shard_key_sql('instrument_id', 8)}""")  # fmt: skip
def feature_backfill_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("instrument_id"))
    wanted = s.withColumn("definition_id", F.explode(F.array(F.lit("a"), F.lit("b"))))
    done = wanted.where("definition_id = 'a' AND instrument_id % 3 = 0")
    return catalog.backfill_plan(wanted, objects(spark, sf_dir), done, 16)


@query(
    """WITH f AS (SELECT unnest(['click', 'view', 'error', 'signup']) AS feed_id), d AS (SELECT CAST(unnest(generate_series(DATE '2024-01-02', DATE '2024-01-30', INTERVAL 1 DAY)) AS DATE) AS d),
    o AS (SELECT DISTINCT event_type AS feed_id, CAST(ts AS DATE) AS d, 's' || (user_id % 8) AS s FROM events), m AS (SELECT event_type AS feed_id, CAST(ts AS DATE) AS d, bool_or(value > 150) AS ok FROM events GROUP BY ALL),
    w AS (SELECT event_type AS feed_id, max(ts) AS head FROM events WHERE event_type <> 'signup' GROUP BY ALL), b AS (SELECT event_type AS feed_id, CAST(ts AS DATE) AS d, bool_and(value < 200) AS sealed FROM events WHERE event_id % 3 = 0 GROUP BY ALL),
    j AS (SELECT f.feed_id, d.d, list_sort(list_filter(['s0', 's1', 's2', 's3', 's4', 's5', 's6', 's7'], lambda x: NOT coalesce(list_contains(any_value(q.l), x), false))) AS lack, any_value(ok) AS ok, any_value(head) AS head, any_value(sealed) AS sealed
      FROM f CROSS JOIN d LEFT JOIN (SELECT feed_id, d, list(s) AS l FROM o GROUP BY ALL) q ON q.feed_id = f.feed_id AND q.d = d.d LEFT JOIN m ON m.feed_id = f.feed_id AND m.d = d.d LEFT JOIN w ON w.feed_id = f.feed_id LEFT JOIN b ON b.feed_id = f.feed_id AND b.d = d.d GROUP BY f.feed_id, d.d),
    r AS (SELECT *, CASE WHEN len(lack) > 0 THEN 'DAILY_OBJECT_MISSING' WHEN NOT coalesce(ok, false) THEN 'MANIFEST_NOT_AVAILABLE' WHEN head IS NULL THEN 'WATERMARK_MISSING' WHEN epoch(TIMESTAMP '2024-01-31 00:00:00') - floor(epoch(head)) > 3600 THEN 'WATERMARK_STALE'
      WHEN CAST(head AS DATE) < d THEN 'WATERMARK_BEHIND_SESSION' WHEN sealed IS NULL THEN 'FEATURE_BATCH_MISSING' WHEN NOT sealed THEN 'FEATURE_BATCH_INCOMPLETE' END AS reason FROM j)
    SELECT feed_id, CAST(d AS VARCHAR) AS session_date, CASE WHEN reason IS NULL THEN 'READY' ELSE 'BLOCKED' END AS state, reason, lack[1] AS first_missing_shard FROM r"""
)
def readiness_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select(F.col("event_type").alias("feed_id"), F.to_date("ts").alias("session_date"), F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_id", "value")
    names, shards = ["click", "view", "error", "signup"], [f"s{i}" for i in range(8)]
    days = spark.sql("SELECT explode(sequence(DATE'2024-01-02', DATE'2024-01-30')) AS session_date")
    feeds = days.select(F.explode(F.array(*[F.lit(x) for x in names])).alias("feed_id"), "session_date", F.lit("2024-01-31 00:00:00").cast("timestamp").alias("now"), F.array(*[F.lit(x) for x in shards]).alias("required_shards"))
    o = e.select("feed_id", "session_date", F.concat(F.lit("s"), (F.col("user_id") % 8).cast("string")).alias("shard_key"))
    m = e.select("feed_id", "session_date", F.when(F.col("value") > 150, "AVAILABLE").otherwise("BUILDING").alias("status"))
    w = e.where("feed_id <> 'signup'").select("feed_id", F.col("ts").alias("last_source_event_at"))
    b = e.where("event_id % 3 = 0").select("feed_id", "session_date", (F.col("value") < 200).alias("sealed"))
    return catalog.readiness(feeds, o, m, w, b).withColumn("session_date", F.col("session_date").cast("string"))


@query(
    """SELECT event_id, CASE WHEN event_id % 7 = 0 THEN 'missing:id' WHEN event_id % 5 = 0 THEN 'hash:dataset_hash' WHEN event_id % 3 = 0 THEN 'count:row_count' END AS violation,
    CASE WHEN event_id % 7 = 0 OR event_id % 5 = 0 OR event_id % 3 = 0 THEN 'REJECTED' ELSE 'ACCEPTED' END AS result FROM events"""
)
def document_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    ident = F.when(F.col("event_id") % 7 != 0, keys.deterministic_uuid("event_id"))
    digest = F.when(F.col("event_id") % 5 == 0, F.lit("abc")).otherwise(values.sha256(F.col("event_id").cast("string")))
    doc = F.to_json(F.struct(ident.alias("id"), digest.alias("dataset_hash"), keys.iso_utc("ts").alias("created_at"), F.when(F.col("event_id") % 3 == 0, 0).otherwise(5).alias("row_count")))
    out = catalog.validate_documents(e.select("event_id", doc.alias("document")), ["id", "dataset_hash", "created_at", "row_count"], ["id"], ["dataset_hash"], ["created_at"], ["row_count"])
    return out.drop("document")


@query(f"""{_OBJECTS}, j AS (SELECT ps, '{{"content_hash":"' || content_hash || '","dataset_manifest_id":"m-' || year(ps) || '","dataset_object_id":"' || ps || '/' || shard_key || '","partition_end":"' || CAST(ps + INTERVAL 1 MONTH AS DATE) || '","partition_start":"' || ps || '","row_count":' || row_count || '}}' AS j FROM o)
    SELECT CAST(ps AS VARCHAR) AS partition_start, count(*) AS objects, sha256('{{"bundle_schema_version":1,"objects":[' || string_agg(j, ',' ORDER BY j) || ']}}') AS fingerprint FROM j GROUP BY ps""")  # fmt: skip
def input_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = objects(spark, sf_dir).withColumn("manifest_id", F.concat(F.lit("m-"), F.year("partition_start").cast("string")))
    return catalog.input_fingerprint(o, ["partition_start"]).withColumn("partition_start", F.col("partition_start").cast("string"))


@query(
    """WITH s AS (SELECT s_suppkey, s_nationkey, y FROM supplier, (SELECT unnest(generate_series(1995, 2000)) AS y)), p AS (SELECT s_suppkey, 'S' || s_suppkey || '-' || y AS symbol, make_date(CAST(y AS BIGINT), 1 + s_nationkey % 12, 1) AS a FROM s),
    w AS (SELECT *, lead(a) OVER (PARTITION BY s_suppkey ORDER BY a) AS b FROM p)
    SELECT l_orderkey, l_linenumber, l_partkey, w.symbol FROM lineitem LEFT JOIN w ON l_suppkey = s_suppkey AND CAST(l_shipdate AS DATE) >= a AND (b IS NULL OR CAST(l_shipdate AS DATE) < b)"""
)
def temporal_symbol_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from barloom.operators.reference import symbol_at, symbol_periods

    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey", F.explode(F.sequence(F.lit(1995), F.lit(2000))).alias("y"))
    names = s.select(F.col("s_suppkey").alias("instrument_id"), F.concat_ws("", F.lit("S"), F.col("s_suppkey").cast("string"), F.lit("-"), F.col("y").cast("string")).alias("symbol"), F.make_date("y", F.col("s_nationkey") % 12 + 1, F.lit(1)).alias("effective_from"))
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_suppkey").alias("instrument_id"), F.to_date("l_shipdate").alias("day"))
    return symbol_at(li, symbol_periods(names), "day").select("l_orderkey", "l_linenumber", "l_partkey", "symbol")
