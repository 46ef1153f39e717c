"""Queries over indicators and corporate actions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.keys import et_midnight, session_date_et
from barloom.operators import actions, features
from barloom.plans.bars import DAILY
from barloom.plans.registration import new_registry
from barloom.sources.market import daily_bars, table
from barloom.sources.shared import written

QUERIES, ORACLE_SQL, query = new_registry()


def _he(n: str, d: str) -> str:
    """Half-even whole quotient in SQL; d is positive."""
    r = f"((({n}) % ({d}) + ({d})) % ({d}))"
    q = f"((({n}) - {r}) // ({d}))"
    return f"({q} + CASE WHEN 2 * {r} > ({d}) OR (2 * {r} = ({d}) AND {q} % 2 <> 0) THEN 1 ELSE 0 END)"


_N = f"""{DAILY}, n AS (SELECT instrument_id, d, close, CAST(round(close * 100) AS HUGEINT) * 1000000 AS u, row_number() OVER (PARTITION BY instrument_id ORDER BY d) AS n FROM daily)"""
_REC = _N.replace("WITH t AS", "WITH RECURSIVE t AS", 1)


def _ema_cte(name: str, source: str, w: int) -> str:
    seed = f"(SELECT instrument_id, sum(u) AS c FROM {source} WHERE n <= {w} GROUP BY ALL HAVING count(*) = {w})"
    return f"""{name} AS (SELECT z.instrument_id, CAST({w} AS BIGINT) AS n, CAST({_he('z.c', str(w))} AS HUGEINT) AS e FROM {seed} z
    UNION ALL SELECT x.instrument_id, x.n, CAST({name}.e + {_he(f'2 * (x.u - {name}.e)', str(w + 1))} AS HUGEINT) FROM {name} JOIN {source} x ON x.instrument_id = {name}.instrument_id AND x.n = {name}.n + 1)"""


def series(df: DataFrame) -> DataFrame:
    units = (F.col("value").cast("decimal(28,8)") * F.lit(100000000).cast("decimal(9,0)")).cast("bigint")
    return df.select("instrument_id", session_date_et("bar_start_at").cast("string").alias("day"), units.alias("value_units"))


@query(f"""{_N}, w AS (SELECT *, sum(u) OVER (PARTITION BY instrument_id ORDER BY d ROWS 19 PRECEDING) AS c FROM n)
    SELECT instrument_id, CAST(d AS VARCHAR) AS day, CAST({_he('c', '20')} AS BIGINT) AS value_units FROM w WHERE n >= 20""")  # fmt: skip
def feature_sma_20(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(features.sma(daily_bars(spark, sf_dir), "close", 20))


@query(f"""{_N}, w AS (SELECT *, lag(u, 5) OVER (PARTITION BY instrument_id ORDER BY d) AS b FROM n)
    SELECT instrument_id, CAST(d AS VARCHAR) AS day, CAST({_he('(u - b) * 10000000000', 'b')} AS BIGINT) AS value_units FROM w WHERE b IS NOT NULL""")  # fmt: skip
def feature_return_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(features.return_pct(daily_bars(spark, sf_dir), "close", 5))


@query(f"""{_REC}, {_ema_cte('ema', 'n', 12)} SELECT e.instrument_id, CAST(n.d AS VARCHAR) AS day, CAST(e.e AS BIGINT) AS value_units FROM ema e JOIN n USING (instrument_id, n)""")
def feature_ema_12(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(features.compute(daily_bars(spark, sf_dir), [features.definition("EMA", price_field="close", window=12)]))


_RSI = f"""{_REC}, m AS (SELECT *, u - lag(u) OVER (PARTITION BY instrument_id ORDER BY n) AS c FROM n),
    z AS (SELECT instrument_id, sum(greatest(c, 0)) AS g, sum(greatest(-c, 0)) AS l FROM m WHERE n BETWEEN 2 AND 15 GROUP BY ALL HAVING count(*) = 14),
    r AS (SELECT instrument_id, CAST(15 AS BIGINT) AS n, CAST({_he('g', '14')} AS HUGEINT) AS g, CAST({_he('l', '14')} AS HUGEINT) AS l FROM z
      UNION ALL SELECT m.instrument_id, m.n, CAST(r.g + {_he('greatest(m.c, 0) - r.g', '14')} AS HUGEINT), CAST(r.l + {_he('greatest(-m.c, 0) - r.l', '14')} AS HUGEINT)
      FROM r JOIN m ON m.instrument_id = r.instrument_id AND m.n = r.n + 1)
    SELECT r.instrument_id, CAST(n.d AS VARCHAR) AS day,
      CAST(CASE WHEN g = 0 AND l = 0 THEN 5000000000 WHEN l = 0 THEN 10000000000 ELSE {_he('10000000000 * g', '(g + l)')} END AS BIGINT) AS value_units
    FROM r JOIN n USING (instrument_id, n)"""


@query(_RSI)
def feature_rsi_14(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series(features.compute(daily_bars(spark, sf_dir), [features.definition("RSI", price_field="close", period=14)]))


_MACD = f"""{_REC}, {_ema_cte('fast', 'n', 12)}, {_ema_cte('slow', 'n', 26)},
    line AS (SELECT s.instrument_id, s.n AS k, s.n - 25 AS n, f.e - s.e AS u FROM slow s JOIN fast f ON f.instrument_id = s.instrument_id AND f.n = s.n), {_ema_cte('sig', 'line', 9)},
    o AS (SELECT instrument_id, k AS n, 'MACD' AS line, u AS v FROM line UNION ALL SELECT instrument_id, n + 25, 'SIGNAL', e FROM sig
      UNION ALL SELECT l.instrument_id, l.k, 'HISTOGRAM', l.u - g.e FROM line l JOIN sig g USING (instrument_id, n))
    SELECT o.line, o.instrument_id, CAST(n.d AS VARCHAR) AS day, CAST(o.v AS BIGINT) AS value_units FROM o JOIN n USING (instrument_id, n)"""


@query(_MACD)
def feature_macd(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = {x: features.definition("MACD", price_field="close", fast_period=12, slow_period=26, signal_period=9, output_line=x) for x in ("MACD", "SIGNAL", "HISTOGRAM")}
    out = features.compute(daily_bars(spark, sf_dir), list(lines.values()))
    name = F.coalesce(*[F.when(F.col("definition_id") == d.id, F.lit(x)) for x, d in lines.items()])
    units = (F.col("value").cast("decimal(28,8)") * F.lit(100000000).cast("decimal(9,0)")).cast("bigint")
    return out.select(name.alias("line"), "instrument_id", session_date_et("bar_start_at").cast("string").alias("day"), units.alias("value_units"))


# ---- results with their hashes ----------------------------------------------------------------------------------
INPUT = "c0" * 32  # the fingerprint of the input, as it would be handed over
PERIOD = ("1995-01-01T05:00:00Z", "2002-01-01T05:00:00Z")


_NS = "unhex('05a27d5a75d84d57bc9a31cedf90d791')"


def uuid_sql(name: str) -> str:
    h = f"sha1({_NS} || encode({name}))"
    return f"{h}[1:8] || '-' || {h}[9:12] || '-5' || {h}[14:16] || '-' || substr('89ab', CAST(CAST('0x' || {h}[17] AS INTEGER) % 4 + 1 AS BIGINT), 1) || {h}[18:20] || '-' || {h}[21:32]"


def _payload_sql(code: str, parameters: str, points: int) -> str:
    return (
        f"""'{{"calculator_version":"1.0.0","element_catalog_version_id":"' || (SELECT {uuid_sql("'feature-catalog|1'")}) || '","feature_code":"{code}","normalized_parameters":{{{parameters}}},"""
        f""""output_value_type":"DECIMAL","required_history_points":{points},"resolution":"1d","schema_version":1}}'"""
    )


def _macd_sql(line: str, points: int) -> str:
    return _payload_sql("MACD", f'"fast_period":12,"output_line":"{line}","price_field":"close","signal_period":9,"slow_period":26', points)


# New York's offset by the rules of 1987 to 2006: summer time from the first Sunday of April to the last of October.
MIDNIGHT = """CASE WHEN d > make_date(year(d), 4, 1) + CAST((7 - isodow(make_date(year(d), 4, 1))) % 7 AS INTEGER) AND d <= make_date(year(d), 10, 31) - CAST(isodow(make_date(year(d), 10, 31)) % 7 AS INTEGER) THEN 4 ELSE 5 END"""

# Every official series of days: feature, instrument, row, day, value in units of 1e-8; then its canonical JSON and its hash.
RESULTS = f"""{_REC}, {_ema_cte('ema12', 'n', 12)}, {_ema_cte('ema26', 'n', 26)},
    m AS (SELECT *, u - lag(u) OVER (PARTITION BY instrument_id ORDER BY n) AS c FROM n),
    z AS (SELECT instrument_id, sum(greatest(c, 0)) AS g, sum(greatest(-c, 0)) AS l FROM m WHERE n BETWEEN 2 AND 15 GROUP BY ALL HAVING count(*) = 14),
    rsi AS (SELECT instrument_id, CAST(15 AS BIGINT) AS n, CAST({_he('g', '14')} AS HUGEINT) AS g, CAST({_he('l', '14')} AS HUGEINT) AS l FROM z
      UNION ALL SELECT m.instrument_id, m.n, CAST(rsi.g + {_he('greatest(m.c, 0) - rsi.g', '14')} AS HUGEINT), CAST(rsi.l + {_he('greatest(-m.c, 0) - rsi.l', '14')} AS HUGEINT) FROM rsi JOIN m ON m.instrument_id = rsi.instrument_id AND m.n = rsi.n + 1),
    line AS (SELECT s.instrument_id, s.n AS k, s.n - 25 AS n, f.e - s.e AS u FROM ema26 s JOIN ema12 f ON f.instrument_id = s.instrument_id AND f.n = s.n), {_ema_cte('sig', 'line', 9)},
    w AS (SELECT *, sum(u) OVER (PARTITION BY instrument_id ORDER BY d ROWS 19 PRECEDING) AS c FROM n),
    v AS (SELECT 'SMA_20' AS feature, instrument_id, n, {_he('c', '20')} AS v FROM w WHERE n >= 20 UNION ALL SELECT 'EMA_12', instrument_id, n, e FROM ema12 UNION ALL SELECT 'EMA_26', instrument_id, n, e FROM ema26
      UNION ALL SELECT 'RSI_14', instrument_id, n, CASE WHEN g = 0 AND l = 0 THEN 5000000000 WHEN l = 0 THEN 10000000000 ELSE {_he('10000000000 * g', '(g + l)')} END FROM rsi
      UNION ALL SELECT 'MACD_MACD', instrument_id, k, u FROM line UNION ALL SELECT 'MACD_SIGNAL', instrument_id, n + 25, e FROM sig UNION ALL SELECT 'MACD_HISTOGRAM', l.instrument_id, l.k, l.u - g.e FROM line l JOIN sig g USING (instrument_id, n)),
    f AS (SELECT unnest(['SMA_20', 'EMA_12', 'EMA_26', 'RSI_14', 'MACD_MACD', 'MACD_SIGNAL', 'MACD_HISTOGRAM']) AS feature, unnest([{', '.join(f"sha256({x})" for x in (
        _payload_sql('SMA', '"price_field":"close","window":20', 20), _payload_sql('EMA', '"price_field":"close","window":12', 12), _payload_sql('EMA', '"price_field":"close","window":26', 26), _payload_sql('RSI', '"period":14,"price_field":"close"', 15),
        _macd_sql('MACD', 26), _macd_sql('SIGNAL', 34), _macd_sql('HISTOGRAM', 34)))}]) AS definition_hash),
    t1 AS (SELECT v.feature, v.instrument_id, count(*) AS row_count, string_agg('{{"at":"' || strftime(d, '%Y-%m-%d') || 'T0' || {MIDNIGHT} || ':00:00Z","value":"' || CAST(CAST(CAST(v.v AS DECIMAL(28,0)) * 0.00000001 AS DECIMAL(38,8)) AS VARCHAR) || '"}}', ',' ORDER BY v.n) AS rows FROM v JOIN n USING (instrument_id, n) GROUP BY ALL),
    h AS (SELECT feature, definition_hash, instrument_id, row_count, sha256('{{"definition_hash":"' || definition_hash || '","input_dataset_set_hash":"{INPUT}","instrument_id":"' || instrument_id || '","period_end":"{PERIOD[1]}","period_start":"{PERIOD[0]}","result_schema_version":1,"rows":[' || rows || ']}}') AS result_hash FROM t1 JOIN f USING (feature)),
    i AS (SELECT DISTINCT instrument_id FROM daily)"""


@query(f"""{RESULTS} SELECT feature, f.definition_hash, {uuid_sql("('feature-definition|' || f.definition_hash)")} AS definition_id, i.instrument_id, CASE WHEN result_hash IS NULL THEN 'FAILED' ELSE 'SUCCEEDED' END AS status, coalesce(row_count, 0) AS row_count, result_hash,
    'fmv1:m:' || f.definition_hash[1:16] || ':{INPUT[:16]}:' || result_hash[1:16] AS materialization_version FROM f CROSS JOIN i LEFT JOIN h USING (feature, instrument_id)""")  # fmt: skip
def feature_materialize(spark: SparkSession, sf_dir: str) -> DataFrame:
    defs = features.official_definitions("1d")
    names = ["SMA_20", "EMA_12", "EMA_26", "RSI_14", "MACD_MACD", "MACD_SIGNAL", "MACD_HISTOGRAM"]
    out = features.materialize(written(daily_bars(spark, sf_dir), "daily"), defs, INPUT, *PERIOD)
    name = F.coalesce(*[F.when(F.col("definition_id") == d.id, F.lit(n)) for d, n in zip(defs, names)])
    return out.select(name.alias("feature"), "definition_hash", "definition_id", "instrument_id", "status", "row_count", "result_hash", "materialization_version")


_BATCH = f"""{RESULTS}, p AS (SELECT f.definition_hash, i.instrument_id, row_count, result_hash FROM f CROSS JOIN i LEFT JOIN h USING (feature, instrument_id) WHERE f.feature IN ('SMA_20', 'EMA_12')),
    s AS (SELECT sha256('{{"definition_hashes":[' || (SELECT string_agg('"' || definition_hash || '"', ',' ORDER BY definition_hash) FROM (SELECT DISTINCT definition_hash FROM p)) || '],"feature_set_schema_version":1}}') AS fs,
      sha256('{{"market_inputs":[' || (SELECT string_agg('{{"input_dataset_set_hash":"{INPUT}","instrument_id":"' || instrument_id || '"}}', ',' ORDER BY '{{"input_dataset_set_hash":"{INPUT}","instrument_id":"' || instrument_id || '"}}') FROM i) || '],"market_set_schema_version":1}}') AS ms),
    y AS (SELECT '{{"definition_hash":"' || definition_hash || '","input_dataset_set_hash":"{INPUT}","instrument_id":"' || instrument_id || '","result_hash":"' || result_hash || '"}}' AS y, row_count, result_hash FROM p),
    g AS (SELECT count(*) AS members, count(*) FILTER (result_hash IS NULL) AS unready, CAST(sum(row_count) AS BIGINT) AS row_count, string_agg(y, ',' ORDER BY y) AS ys FROM y),
    k AS (SELECT *, 'fsb1:' || fs[1:16] || ':' || ms[1:16] || ':19950101T050000Z:20020101T050000Z' AS idempotency_key FROM g, s)"""


@query(f"""{_BATCH} SELECT {uuid_sql("('feature-snapshot-batch|' || idempotency_key)")} AS id, idempotency_key, members, unready, unready = 0 AS sealed, CASE WHEN unready = 0 THEN row_count END AS row_count,
    CASE WHEN unready = 0 THEN sha256('{{"batch_schema_version":1,"feature_set_hash":"' || fs || '","input_market_set_hash":"' || ms || '","members":[' || ys || '],"period_end":"{PERIOD[1]}","period_start":"{PERIOD[0]}","source_end_watermark":"daily@2","source_start_watermark":"daily@1"}}') END AS batch_hash FROM k""")  # fmt: skip
def feature_snapshot_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    defs = [features.definition("SMA", price_field="close", window=20), features.definition("EMA", price_field="close", window=12)]
    b = written(daily_bars(spark, sf_dir), "daily")
    planned = features.definition_table(spark, defs).select("definition_hash").crossJoin(b.select("instrument_id").distinct()).withColumn("input_dataset_set_hash", F.lit(INPUT))
    return features.snapshot_batch(planned, features.materialize(b, defs, INPUT, *PERIOD), *PERIOD, "daily@1", "daily@2")


@query(f"""{DAILY} SELECT instrument_id, 'OUTSIDE_PERIOD' AS reason FROM daily WHERE d < DATE '1995-02-01' OR d >= DATE '2001-06-01' GROUP BY ALL""")
def feature_series_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return features.validate_series(daily_bars(spark, sf_dir), "1995-02-01 05:00:00", "2001-06-01 04:00:00")


# ---- corporate actions ------------------------------------------------------------------------------------------
def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every seventh supplier a split of 1 to 2 in mid-1998, of every fifth a dividend a year later."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey")
    day = lambda x: et_midnight(F.lit(x).cast("date"))
    split = s.where("s_suppkey % 7 = 0").select(F.col("s_suppkey").cast("string").alias("instrument_id"), day("1998-07-01").alias("effective_at"), F.lit("SPLIT").alias("action_type"), F.lit(1).cast("long").alias("from_shares"), F.lit(2).cast("long").alias("to_shares"), F.lit(None).cast("decimal(18,8)").alias("amount"))
    paid = s.where("s_suppkey % 5 = 0").select(F.col("s_suppkey").cast("string").alias("instrument_id"), day("1999-07-01").alias("effective_at"), F.lit("CASH_DIVIDEND").alias("action_type"), F.lit(None).cast("long").alias("from_shares"), F.lit(None).cast("long").alias("to_shares"), F.lit(2).cast("decimal(18,8)").alias("amount"))
    return split.unionByName(paid)


_FACTORS = f"""{DAILY}, c AS (SELECT instrument_id, CAST(round(arg_max(close, d) * 100) AS HUGEINT) * 1000000 AS c FROM daily WHERE d < DATE '1999-07-01' AND CAST(instrument_id AS INTEGER) % 5 = 0 GROUP BY ALL),
    f AS (SELECT instrument_id, {_he('(c - 200000000) * 100000000', 'c')} AS f FROM c)"""


@query(f"""{_FACTORS}, a AS (SELECT b.*, CASE WHEN CAST(b.instrument_id AS INTEGER) % 7 = 0 AND d < DATE '1998-07-01' THEN 2 ELSE 1 END AS k, CASE WHEN d < DATE '1999-07-01' THEN coalesce(f, 100000000) ELSE 100000000 END AS f
      FROM daily b LEFT JOIN f USING (instrument_id))
    SELECT instrument_id, CAST(d AS VARCHAR) AS day, CAST({_he('CAST(round(close * 100) AS HUGEINT) * 1000000 * f', '100000000 * k')} AS BIGINT) AS close_units, volume * k AS volume, trade_count FROM a""")  # fmt: skip
def adjust_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = actions.adjust_bars(daily_bars(spark, sf_dir), _actions(spark, sf_dir))
    units = (F.col("close").cast("decimal(28,8)") * F.lit(100000000).cast("decimal(9,0)")).cast("bigint")
    return out.select("instrument_id", F.col("session_date_et").cast("string").alias("day"), units.alias("close_units"), "volume", "trade_count")


@query(f"""{_FACTORS} SELECT instrument_id, 'CASH_DIVIDEND' AS action_type, CAST(f AS BIGINT) AS price_units, CAST(100000000 AS BIGINT) AS volume_units FROM f
    UNION ALL SELECT CAST(s_suppkey AS VARCHAR), 'SPLIT', 50000000, 200000000 FROM supplier WHERE s_suppkey % 7 = 0""")  # fmt: skip
def action_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = actions.factors(_actions(spark, sf_dir), daily_bars(spark, sf_dir))
    units = lambda c: (F.col(c).cast("decimal(20,8)") * F.lit(100000000).cast("decimal(9,0)")).cast("bigint")
    return out.select("instrument_id", "action_type", units("price_factor").alias("price_units"), units("volume_factor").alias("volume_units"))


def _found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Findings of actions, from orders: several sources may tell of one action, in the same or other terms."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.concat(F.lit("C"), (F.col("o_custkey") % 200).cast("string")).alias("ticker"),
        F.lit("CASH_DIVIDEND").alias("event_type"),
        F.trunc("o_orderdate", "year").alias("effective_date"),
        F.concat(F.lit("src"), (F.col("o_orderkey") % 3).cast("string")).alias("source_id"),
        F.substring("o_orderpriority", 1, 1).alias("terms"),
    )


_FOUND = """WITH f AS (SELECT 'C' || (o_custkey % 200) AS ticker, CAST(date_trunc('year', o_orderdate) AS DATE) AS d, 'src' || (o_orderkey % 3) AS source_id, o_orderpriority[1] AS terms FROM orders),
    g AS (SELECT ticker, d, source_id, count(DISTINCT terms) AS n, min(terms) AS terms FROM f GROUP BY ALL)"""


@query(f"{_FOUND} SELECT ticker, CAST(d AS VARCHAR) AS effective_date, source_id, CASE WHEN n = 1 THEN terms END AS terms, CASE WHEN n > 1 THEN n END AS versions FROM g")
def action_dedup_conflict(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = actions.dedup_conflicts(_found(spark, sf_dir))
    both = good.unionByName(bad, allowMissingColumns=True)
    return both.select("ticker", F.col("effective_date").cast("string"), "source_id", "terms", "versions")


@query(
    f"""{_FOUND}, k AS (SELECT *, source_id || ':CASH_DIVIDEND:' || ticker || ':' || d AS key FROM g WHERE n = 1)
    SELECT key AS provider_event_key, {uuid_sql("'corporate-action|' || key")} AS id,
      sha256('{{"effective_date":"' || d || '","event_type":"CASH_DIVIDEND","terms":"' || terms || '","ticker":"' || ticker || '"}}') AS terms_hash FROM k"""
)
def action_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _ = actions.dedup_conflicts(_found(spark, sf_dir))
    return actions.candidates(good).select("provider_event_key", "id", "terms_hash")


@query(
    """WITH c AS (SELECT 'p' || (l_orderkey % 500) AS candidate_id, ['amount', 'currency', 'date'][1 + l_linenumber % 3] AS field, l_discount + 0.5 AS confidence, l_returnflag <> 'R' AS cited, l_linestatus = 'F' AS agrees FROM lineitem)
    SELECT candidate_id, CAST(min(confidence) AS DECIMAL(10,4)) AS confidence, array_to_string(list_sort(list_filter(['amount', 'currency', 'date'], lambda x: NOT list_contains(list(CASE WHEN cited AND agrees THEN field END), x) OR NOT coalesce(list_contains(list(CASE WHEN cited AND agrees THEN field END), x), false))), ',') AS unclaimed
    FROM c GROUP BY candidate_id"""
)
def action_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    field = F.element_at(F.array(*[F.lit(x) for x in ("amount", "currency", "date")]), (F.col("l_linenumber") % 3 + 1).cast("int"))
    claims = li.select(F.concat(F.lit("p"), (F.col("l_orderkey") % 500).cast("string")).alias("candidate_id"), field.alias("field"), (F.col("l_discount") + 0.5).alias("confidence"), (F.col("l_returnflag") != "R").alias("cited"), (F.col("l_linestatus") == "F").alias("agrees"))
    out = actions.confidence(claims, ["amount", "currency", "date"])
    return out.select("candidate_id", F.col("confidence").cast("decimal(10,4)"), F.array_join("unclaimed", ",").alias("unclaimed"))


_MOVES = "CASE WHEN s = 'REVIEW_REQUIRED' AND d = 'APPROVE' THEN 'APPROVED' WHEN s = 'REVIEW_REQUIRED' AND d = 'REJECT' THEN 'REJECTED' WHEN s = 'APPROVED' AND d = 'WITHDRAW' THEN 'WITHDRAWN' WHEN s = 'APPROVED' AND d = 'SUPERSEDE' THEN 'SUPERSEDED' END"


@query(
    f"""WITH RECURSIVE e AS (SELECT o_custkey % 300 AS candidate_id, o_orderkey AS q, ['APPROVE', 'REJECT', 'WITHDRAW', 'SUPERSEDE'][1 + CAST(o_orderkey * 7 // 5 % 4 AS BIGINT)] AS d, o_orderkey % 9 <> 0 AS fresh FROM orders),
    n AS (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY q) AS n FROM e),
    r AS (SELECT candidate_id, CAST(0 AS BIGINT) AS n, 'REVIEW_REQUIRED' AS state, CAST('' AS VARCHAR) AS log FROM (SELECT DISTINCT candidate_id FROM n)
      UNION ALL SELECT x.candidate_id, x.n, CASE WHEN fresh AND x.m IS NOT NULL THEN x.m ELSE x.s END,
        x.log || CASE WHEN NOT fresh THEN ',' || q || ':STALE_CONTENT_HASH' WHEN x.m IS NOT NULL THEN '' WHEN d = 'WITHDRAW' THEN ',' || q || ':WITHDRAWAL_STATE_CONFLICT'
          WHEN d = 'SUPERSEDE' THEN ',' || q || ':SUPERSEDED_CANDIDATE_NOT_APPROVED' ELSE ',' || q || ':CONFLICTING_REDECISION' END
      FROM (SELECT *, {_MOVES} AS m FROM (SELECT n.candidate_id, n.n, n.q, n.d, n.fresh, r.state AS s, r.log FROM r JOIN n ON n.candidate_id = r.candidate_id AND n.n = r.n + 1)) x)
    SELECT candidate_id, arg_max(state, n) AS state, substr(arg_max(log, n), 2) AS refusals FROM r GROUP BY candidate_id"""
)
def action_review_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    which = F.element_at(F.array(*[F.lit(x) for x in ("APPROVE", "REJECT", "WITHDRAW", "SUPERSEDE")]), (F.expr("o_orderkey * 7 div 5") % 4 + 1).cast("int"))
    d = o.select((F.col("o_custkey") % 300).alias("candidate_id"), F.col("o_orderkey").alias("aggregate_sequence"), which.alias("decision"), F.when(F.col("o_orderkey") % 9 == 0, "old").otherwise("new").alias("content_hash"), F.lit("new").alias("expected_hash"), F.col("o_orderkey").cast("string").alias("delivery_id"))
    return actions.review_fold(d)
