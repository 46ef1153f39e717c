"""Queries over small parts: files in older forms, universes, keys, rounding, canonical text, definitions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions import keys, values
from barloom.operators import catalog, features, merge, quality, reference
from barloom.operators import sessions as ses
from barloom.plans.analytics import MIDNIGHT, _he, uuid_sql
from barloom.plans.bars import BARS, DAILY
from barloom.plans.catalogs import shard_key_sql
from barloom.plans.registration import new_registry
from barloom.sources import files
from barloom.sources.market import bars_30m, daily_bars, secs, sessions, table, ticks
from barloom.sources.shared import shared_path
from barloom.streaming import events as ev

QUERIES, ORACLE_SQL, query = new_registry()


def _symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as instruments: a canonical symbol and an id."""
    s = table(spark, sf_dir, "supplier")
    return s.select("s_suppkey", F.concat(F.lit("S."), F.col("s_suppkey").cast("string")).alias("provider_symbol"), keys.deterministic_uuid(F.lit("i"), "s_suppkey").alias("instrument_id"))


_ID = uuid_sql("('i|' || s_suppkey)")


# ---- files and universes ----------------------------------------------------------------------------------------
@query("SELECT event_type AS symbol, event_id, CAST(floor(epoch(ts)) AS BIGINT) AS at, value AS close FROM events")
def legacy_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "legacy") + ".csv"
    e = ticks(spark, sf_dir).select(F.col("event_type").alias("symbol"), F.col("ts").alias("timestamp"), "event_id", F.col("value").alias("close"))
    e.write.option("header", True).csv(path)
    back = files.legacy_scan(spark, path, "symbol string, timestamp timestamp, event_id bigint, close double")
    return back.select("symbol", "event_id", secs("timestamp", "at"), "close")


@query(f"SELECT 'S.' || s_suppkey AS provider_symbol, {_ID} AS instrument_id, s_name AS name FROM supplier")
def instrument_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    raw = s.select(F.concat(F.lit("  s/"), F.col("s_suppkey").cast("string"), F.lit(" ")).alias("provider_symbol"), F.upper(keys.deterministic_uuid(F.lit("i"), "s_suppkey")).alias("instrument_id"), "name")
    return reference.instrument_map(raw)


@query("""WITH f AS (SELECT DISTINCT 'C' || c_custkey % 40 AS symbol FROM customer WHERE c_custkey % 2 = 0), g AS (SELECT DISTINCT 'C' || c_custkey % 40 AS symbol FROM customer), x AS (SELECT DISTINCT 'X' || s_suppkey % 5 AS symbol FROM supplier)
    SELECT 'fetched' AS taken, symbol FROM f UNION SELECT 'fetched', symbol FROM x UNION SELECT 'cached', symbol FROM g UNION SELECT 'cached', symbol FROM x""")  # fmt: skip
def universe_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit("C"), (F.col("c_custkey") % 40).cast("string")).alias("symbol"))
    extras = table(spark, sf_dir, "supplier").select(F.concat(F.lit("X"), (F.col("s_suppkey") % 5).cast("string")).alias("symbol"))
    half, cached = c.where("c_custkey % 2 = 0").select("symbol").distinct(), c.select("symbol").distinct()
    enough = reference.universe_resolve(half, cached, extras, 10).withColumn("taken", F.lit("fetched"))
    short = reference.universe_resolve(half, cached, extras, 30).withColumn("taken", F.lit("cached"))  # 20 symbols are too few
    return enough.unionByName(short)


_KEY = "'market-data/provider=p/feed=daily/dataset=' || ps || '/revision=2/layer=RAW/resolution=1d/granularity=MONTH/partition_start=' || ps || '/partition_end=' || CAST(ps + INTERVAL 1 MONTH AS DATE) || '/shard=' || sk || '/part-' || lpad(CAST(1 + n % 3 AS VARCHAR), 5, '0') || '.parquet'"


@query(f"{DAILY}, o AS (SELECT CAST(date_trunc('month', d) AS DATE) AS ps, {shard_key_sql('instrument_id', 8)} AS sk, count(*) AS n FROM daily GROUP BY ALL) SELECT {_KEY} AS object_key, n AS row_count FROM o")
def object_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = catalog.object_stats(daily_bars(spark, sf_dir), "MONTH", 8, 24 * 60)
    named = {"feed": F.lit("daily"), "dataset": F.col("partition_start"), "layer": F.lit("RAW"), "resolution": F.lit("1d"), "granularity": F.col("partition_granularity"), "shard": F.col("shard_key")}
    key = catalog.object_key("p", F.lit(2), F.col("row_count") % 3 + 1, partition_start=F.col("partition_start"), partition_end=F.col("partition_end"), **named)
    return o.select(key.alias("object_key"), "row_count")


@query(f"""SELECT 'S-' || s_suppkey AS symbol, CASE WHEN s_suppkey % 7 > 0 THEN {_ID} END AS instrument_id, CASE WHEN s_suppkey % 7 = 0 THEN 'UNMAPPED_INSTRUMENT' END AS code, (SELECT count(*) FROM lineitem WHERE l_suppkey = s_suppkey) AS rows FROM supplier WHERE s_suppkey IN (SELECT l_suppkey FROM lineitem)""")
def legacy_migrate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by symbol, with - for the dot; every seventh symbol is not in the map."""
    li = table(spark, sf_dir, "lineitem").select(F.concat(F.lit("bars/S-"), F.col("l_suppkey").cast("string"), F.lit("_30m.parquet")).alias("path"), "l_orderkey")
    moved, lost = files.migrate_legacy(li, _symbol(spark, sf_dir).where("s_suppkey % 7 > 0"))
    n = li.groupBy("path").agg(F.count("*").alias("rows"))
    out = moved.select("path", "symbol", "instrument_id").distinct().withColumn("code", F.lit(None).cast("string")).unionByName(lost.select("path", "symbol", F.lit(None).cast("string").alias("instrument_id"), "code"))
    return out.join(n, "path").select("symbol", "instrument_id", "code", "rows")


@query(f"""{DAILY}, m AS (SELECT count(DISTINCT year(d)) AS n FROM daily) SELECT 'S.' || instrument_id || CASE WHEN CAST(instrument_id AS INTEGER) % 2 = 0 THEN '-new' ELSE '' END AS symbol, instrument_id FROM daily GROUP BY instrument_id HAVING count(DISTINCT year(d)) = (SELECT n FROM m)""")
def instrument_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments of every year; every second one was renamed before the cutoff, and another after it."""
    b = daily_bars(spark, sf_dir).select("instrument_id", F.year("session_date_et").alias("manifest_id"))
    i = b.select("instrument_id").distinct()
    name = lambda suffix, day: i.where("instrument_id % 2 = 0" if suffix else "true").select("instrument_id", F.concat(F.lit("S."), F.col("instrument_id"), F.lit(suffix)).alias("symbol"), F.lit(day).cast("date").alias("effective_from"))
    names = name("", "1990-01-01").unionByName(name("-new", "1998-01-01")).unionByName(name("-later", "2005-01-01"))
    return files.instrument_export(b, reference.symbol_periods(names), "2001-01-01")


@query("""SELECT event_type AS instrument_id, CAST(epoch(date_trunc('hour', ts)) AS BIGINT) AS bar_start_at, arg_max(value, event_id) AS close, arg_max(user_id, event_id) AS volume, max(event_id) % 3 = 0 AS no_count FROM events WHERE event_type <> 'signup' GROUP BY ALL""")
def normalize_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Provider rows as text; the count of every third is no number, one symbol is not mapped."""
    t = ticks(spark, sf_dir)
    count = F.when(F.col("event_id") % 3 == 0, "n/a").otherwise(F.col("event_id").cast("string"))
    raw = t.select(F.col("event_type").alias("symbol"), F.date_trunc("hour", "ts").alias("timestamp"), *[F.col("value").cast("string").alias(c) for c in ("open", "high", "low", "close")], F.col("user_id").cast("string").alias("volume"), count.alias("trade_count"), "event_id")
    known = t.where("event_type <> 'signup'").select(F.col("event_type").alias("provider_symbol"), F.col("event_type").alias("instrument_id")).distinct()
    return files.normalize(raw, known, "event_id").select("instrument_id", secs("bar_start_at"), "close", "volume", F.col("trade_count").isNull().alias("no_count"))


@query("""SELECT s_suppkey, ['raw', 'adjusted'][1 + s_suppkey % 2] AS price_type, ['1m', '30m', '1h', '4h', '1d'][1 + s_suppkey % 5] AS resolution,
    CASE WHEN s_suppkey % 5 >= 2 THEN 'DERIVED' WHEN s_suppkey % 2 = 0 THEN 'RAW' WHEN s_suppkey % 5 = 1 THEN 'ADJUSTED' END AS layer FROM supplier""")  # fmt: skip
def contract_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    pick = lambda options, of: F.element_at(F.array(*[F.lit(x) for x in options]), (F.col("s_suppkey") % of + 1).cast("int"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", pick(["raw", "adjusted"], 2).alias("price_type"), pick(["1m", "30m", "1h", "4h", "1d"], 5).alias("resolution"))
    return s.join(F.broadcast(catalog.contracts(spark)), ["price_type", "resolution"], "left")  # nine contracts


# ---- rows -------------------------------------------------------------------------------------------------------
@query(f"""{DAILY}, m AS (SELECT instrument_id, d, CASE WHEN volume % 7 = 0 THEN -open WHEN volume % 11 = 0 THEN NULL ELSE open END AS open, CASE WHEN volume % 5 = 0 THEN low - 1 ELSE high END AS high, low, close, CASE WHEN volume % 3 = 0 THEN -1 ELSE volume END AS v FROM daily),
    r AS (SELECT instrument_id, d, list_filter([CASE WHEN open IS NULL THEN 'missing_or_non_numeric_price' END, CASE WHEN coalesce(open, 1) <= 0 OR high <= 0 OR low <= 0 OR close <= 0 THEN 'non_positive_price' END, CASE WHEN high < greatest(coalesce(open, low), low, close) THEN 'high_below_ohlc' END,
      CASE WHEN low > least(coalesce(open, low), high, close) THEN 'low_above_ohlc' END, CASE WHEN v < 0 THEN 'negative_or_invalid_volume' END], lambda x: x IS NOT NULL) AS r FROM m)
    SELECT instrument_id, CAST(d AS VARCHAR) AS day, array_to_string(r, ',') AS reasons FROM r WHERE len(r) > 0""")  # fmt: skip
def invalid_row_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("volume")
    b = daily_bars(spark, sf_dir).withColumn("open", F.when(v % 7 == 0, -F.col("open")).when(v % 11 == 0, F.lit(None)).otherwise(F.col("open"))).withColumn("high", F.when(v % 5 == 0, F.col("low") - 1).otherwise(F.col("high")))
    b = b.withColumn("volume", F.when(v % 3 == 0, F.lit(-1)).otherwise(v))
    return b.select("instrument_id", F.col("session_date_et").cast("string").alias("day"), quality.invalid_row_reasons().alias("reasons")).where("reasons IS NOT NULL")


@query("SELECT event_id, event_type AS \"instrumentId\", event_type IN (SELECT event_type FROM events GROUP BY ALL HAVING min(event_id) % 2 = 0) AS mapped FROM events")
def events_instrument_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).select("event_id", F.col("event_type").alias("instrumentId"))
    known = t.groupBy("instrumentId").agg(F.min("event_id").alias("k")).where("k % 2 = 0").select(F.col("instrumentId").alias("instrument_id"))
    return ev.map_instruments(t, known)


@query(f"""{BARS}, h AS (SELECT max(s) AS head FROM bars) SELECT CAST(d AS VARCHAR) AS session_date, CAST(o AS BIGINT) AS opens_at, CAST(c AS BIGINT) AS closes_at FROM ses, h WHERE c > head - 864000 AND c <= head""")
def completed_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions that closed in the ten days before the last bar."""
    head = bars_30m(spark, sf_dir).agg(F.max(F.unix_timestamp("bar_start_at"))).head()[0]
    at = lambda x: spark.sql(f"SELECT CAST(timestamp_seconds({x}) AS STRING)").head()[0]
    out = ses.completed_sessions(sessions(spark), at(head - 864000), at(head))
    return out.select(F.col("session_date").cast("string"), secs("opens_at"), secs("closes_at"))


@query(f"{DAILY} SELECT CAST(year(d) AS INTEGER) AS year, {shard_key_sql('instrument_id', 4)} AS shard, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM daily GROUP BY ALL")
def sort_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of bars as they lie: rows that come before one that should come first. A file is read in one piece."""
    path = shared_path(spark, "sorted")
    files.write_bars(daily_bars(spark, sf_dir).withColumn("provider_symbol", F.col("instrument_id")), path, 4, most=1000)
    back = spark.read.parquet(path).select("year", "shard", "instrument_id", "bar_start_at", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("k"))
    order = F.struct("instrument_id", "bar_start_at")
    before = F.lag(order).over(Window.partitionBy("year", "shard", "file").orderBy("k"))
    return back.withColumn("bad", before > order).groupBy("year", "shard").agg(F.count("*").alias("rows"), F.count_if("bad").alias("out_of_order"))


@query("SELECT o_custkey, max(o_orderkey) AS o_orderkey, arg_max(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY ALL")
def latest_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.latest(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_totalprice"), ["o_custkey"], "o_orderkey")


_REFRESH = f"""{DAILY}, new AS (SELECT instrument_id, d, CASE WHEN CAST(instrument_id AS INTEGER) % 4 = 0 AND d >= DATE '1999-05-01' THEN close * 2 ELSE close END AS close FROM daily WHERE d >= DATE '1999-03-01'),
    c AS (SELECT n.instrument_id, min(n.d) AS changed FROM new n JOIN daily o USING (instrument_id, d) WHERE o.d < DATE '2000-01-01' AND abs(n.close - o.close) > greatest(abs(o.close), 1.0) * 1e-10 GROUP BY ALL)"""


@query(f"""{_REFRESH}, u AS (SELECT o.instrument_id, o.d, coalesce(n.close, o.close) AS close FROM daily o LEFT JOIN new n USING (instrument_id, d))
    SELECT u.instrument_id, CAST(u.d AS VARCHAR) AS day, close, CAST(changed AS VARCHAR) AS changed_from FROM u LEFT JOIN c USING (instrument_id)""")  # fmt: skip
def legacy_symbol_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored bars up to 2000, a fetch that overlaps them, and from where an adjusted price was found changed."""
    b = daily_bars(spark, sf_dir).select("instrument_id", "bar_start_at", "session_date_et", "close")
    new = b.where("session_date_et >= '1999-03-01'").withColumn("close", F.when((F.col("instrument_id") % 4 == 0) & (F.col("session_date_et") >= "1999-05-01"), F.col("close") * 2).otherwise(F.col("close")))
    stored = b.where("session_date_et < '2000-01-01'")
    changed = merge.earliest_change(stored, new, ["close"])
    out = merge.upsert_keep_last(stored, new, ["instrument_id", "bar_start_at"]).join(changed, "instrument_id", "left")
    return out.select("instrument_id", F.col("session_date_et").cast("string").alias("day"), "close", keys.session_date_et("changed_from").cast("string").alias("changed_from"))


@query("""WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT DISTINCT l_suppkey AS k FROM lineitem WHERE l_returnflag = 'R')
    SELECT 'union' AS form, k FROM (SELECT k FROM a UNION SELECT k FROM b) UNION ALL SELECT 'intersect', k FROM (SELECT k FROM a INTERSECT SELECT k FROM b) UNION ALL SELECT 'except', k FROM (SELECT k FROM a EXCEPT SELECT k FROM b)""")  # fmt: skip
def set_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    a, b = (li.where(F.col("l_returnflag") == m).select(F.col("l_suppkey").alias("k")) for m in ("A", "R"))
    forms = {"union": a.unionByName(b).distinct(), "intersect": a.intersect(b), "except": a.subtract(b)}
    out = [df.select(F.lit(name).alias("form"), "k") for name, df in forms.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


# ---- values -----------------------------------------------------------------------------------------------------
@query(f"""WITH u AS (SELECT l_orderkey, l_linenumber, l_partkey, (CAST(round(l_extendedprice * 100) AS HUGEINT) - 3000000) * CAST(l_partkey % 1000 AS HUGEINT) * 5 AS n FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(CAST({_he('n', '10')} AS DECIMAL(28,0)) * 0.00000001 AS DECIMAL(38,8)) AS VARCHAR) AS rendered FROM u""")  # fmt: skip
def quantize_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ninth places that are 5 or 0, of either sign: halves go to the even neighbour."""
    li = table(spark, sf_dir, "lineitem")
    n = (F.round(F.col("l_extendedprice") * 100).cast("decimal(20,0)") - F.lit(3000000).cast("decimal(7,0)")).cast("decimal(20,0)") * (F.col("l_partkey") % 1000 * 5).cast("decimal(5,0)")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", values.render((n.cast("decimal(26,0)") * F.lit("0.000000001").cast("decimal(9,9)")).cast("decimal(38,9)").cast("decimal(38,18)")).alias("rendered"))


@query("""WITH j AS (SELECT o_orderkey, '{"customer":' || o_custkey || ',"priority":"' || o_orderpriority || '","status":' || CASE WHEN o_orderstatus = 'P' THEN 'null' ELSE '"' || o_orderstatus || '"' END || '}' AS document FROM orders) SELECT o_orderkey, document, sha256(document) AS digest FROM j""")
def canonical_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    doc = values.canonical_json(status=F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")), customer=F.col("o_custkey"), priority=F.col("o_orderpriority"))
    return o.select("o_orderkey", doc.alias("document")).withColumn("digest", values.sha256(F.col("document")))


@query(f"SELECT o_orderkey, CAST(epoch(d) AS BIGINT) + 3600 * ({MIDNIGHT}) AS effective_at FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders)")
def effective_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_timestamp(keys.et_midnight(F.to_date("o_orderdate"))).alias("effective_at"))


@query("SELECT s_suppkey, [1, 30, 60, 240, 390, NULL][1 + s_suppkey % 6] AS minutes FROM supplier")
def bar_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = F.element_at(F.array(*[F.lit(x) for x in ("1m", "30m", "1h", "4h", "1d", "2w")]), (F.col("s_suppkey") % 6 + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", keys.bar_span(r).alias("minutes"))


_WINDOW = f"""SELECT d AS day, CAST(epoch(d) AS BIGINT) + 3600 * ({MIDNIGHT}) AS at FROM (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders UNION SELECT DISTINCT CAST(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH AS DATE) FROM orders)"""


@query(f"WITH w AS ({_WINDOW}) SELECT o_orderkey, a.at AS start_at, b.at AS end_at FROM orders JOIN w a ON a.day = date_trunc('month', o_orderdate) JOIN w b ON b.day = date_trunc('month', o_orderdate) + INTERVAL 1 MONTH")
def partition_utc_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = keys.partition_utc_window(F.to_date("o_orderdate"), "MONTH")
    return table(spark, sf_dir, "orders").select("o_orderkey", F.unix_timestamp(a).alias("start_at"), F.unix_timestamp(b).alias("end_at"))


@query("""WITH t AS (SELECT o_orderkey AS k, o_orderkey % 2 = 0 AS split, o_custkey % 4 AS a, o_custkey % 5 AS b, ['USD', 'usd', 'EUR'][1 + o_orderkey % 3] AS c FROM orders)
    SELECT k, CASE WHEN split AND a > 0 AND b > 0 AND a <> b THEN a END AS from_shares, CASE WHEN split AND a > 0 AND b > 0 AND a <> b THEN b END AS to_shares, CASE WHEN NOT split AND a > 0 AND c <> 'usd' THEN a + 0.5 END AS amount, CASE WHEN NOT split AND a > 0 AND c <> 'usd' THEN c END AS currency,
    CASE WHEN split THEN a > 0 AND b > 0 AND a <> b ELSE a > 0 AND c <> 'usd' END AS valid FROM t""")  # fmt: skip
def parse_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, a, b = F.col("o_orderkey"), F.col("o_custkey") % 4, F.col("o_custkey") % 5
    split = k % 2 == 0
    currency = F.element_at(F.array(F.lit("USD"), F.lit("usd"), F.lit("EUR")), (k % 3 + 1).cast("int"))
    amount = F.when(a > 0, F.concat(a.cast("string"), F.lit(".5"))).otherwise(F.lit("0"))
    doc = F.when(split, F.to_json(F.struct(a.alias("from_shares"), b.alias("to_shares")))).otherwise(F.to_json(F.struct(amount.alias("amount"), currency.alias("currency"))))
    t = table(spark, sf_dir, "orders").select(k.alias("k"), values.parse_terms(F.when(split, "SPLIT").otherwise("CASH_DIVIDEND"), doc).alias("t"))
    return t.select("k", "t.from_shares", "t.to_shares", F.col("t.amount").cast("double").alias("amount"), "t.currency", F.col("t").isNotNull().alias("valid"))


# ---- definitions ------------------------------------------------------------------------------------------------
@query(f"""{DAILY}, c AS (SELECT unnest(['SMA', 'EMA', 'RETURN_PCT', 'RSI', 'MACD']) AS code, unnest([5, 7, 4, 10, 8]) AS need), i AS (SELECT instrument_id, count(*) AS n FROM daily GROUP BY ALL) SELECT code, '1.0.0' AS version, instrument_id, need AS required_history_points, n - need + 1 AS values FROM c, i WHERE n >= need""")
def calculator_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One definition of every registered calculator, computed in one pass; each has a value from its required rows on."""
    chosen = {"SMA": {"window": 5}, "EMA": {"window": 7}, "RETURN_PCT": {"lag": 3}, "RSI": {"period": 9}, "MACD": {"fast_period": 3, "slow_period": 6, "signal_period": 3, "output_line": "SIGNAL"}}
    defs = [features.definition(code, price_field="close", **chosen[code]) for code, _ in features.CALCULATORS]
    n = features.compute(daily_bars(spark, sf_dir), defs).groupBy("definition_id", "instrument_id").agg(F.count("*").alias("values"))
    t = features.definition_table(spark, defs).select("definition_id", "code", "version", "required_history_points")
    return n.join(F.broadcast(t), "definition_id").drop("definition_id")


@query("""SELECT o_custkey AS definition_id, CASE WHEN o_custkey % 3 = 0 THEN 'new' WHEN o_custkey % 5 = 0 THEN 'refused' ELSE 'same' END AS outcome, count(*) AS n FROM (SELECT DISTINCT o_custkey FROM orders) GROUP BY ALL""")
def definition_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Definitions published again: unknown ones are added, the same payload changes nothing, another one is refused."""
    d = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("definition_id"), F.col("o_custkey").cast("string").alias("payload")).distinct()
    again = d.withColumn("payload", F.when(F.col("definition_id") % 5 == 0, "other").otherwise(F.col("payload")))
    have = d.where("definition_id % 3 > 0")
    known, refused = features.register(have, again)
    fresh = known.join(have.select("definition_id"), "definition_id", "left_anti").select("definition_id", F.lit("new").alias("outcome"))
    bad = refused.select("definition_id", F.lit("refused").alias("outcome"))
    same = have.join(bad.select("definition_id"), "definition_id", "left_anti").select("definition_id", F.lit("same").alias("outcome"))
    return fresh.unionByName(bad).unionByName(same).groupBy("definition_id", "outcome").agg(F.count("*").alias("n"))
