"""Indicators over an instrument's bars, with results of eight decimal places."""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.keys import UUID_NAMESPACE, deterministic_uuid, iso_utc
from barloom.functions.values import canonical_json, half_even_ratio, quantize, sha256
from barloom.sources.shared import written

#: Prices in units of 1e-8, so that sums are exact.
_UNITS = "decimal(30,0)"


def _by_time():
    return Window.partitionBy("instrument_id").orderBy("bar_start_at")


def units(price: str):
    return (F.col(price).cast("decimal(28,8)") * F.lit(100000000).cast("decimal(9,0)")).cast(_UNITS)


def sma(bars: DataFrame, price: str, window: int) -> DataFrame:
    """bars with value: the mean of the last `window` prices; rows before the window is full are left out."""
    total = F.sum(units(price)).over(_by_time().rowsBetween(-(window - 1), 0))
    out = bars.withColumn("_n", F.row_number().over(_by_time())).withColumn("_sum", total).where(F.col("_n") >= window)
    mean = half_even_ratio(F.col("_sum").cast("decimal(36,0)"), F.lit(window).cast("decimal(9,0)"))
    return out.withColumn("value", (mean.cast("decimal(28,0)") * F.lit("0.00000001").cast("decimal(8,8)")).cast("decimal(38,8)")).drop("_n", "_sum")


def return_pct(bars: DataFrame, price: str, lag: int = 1) -> DataFrame:
    """bars with value: the change from the price `lag` rows before, in percent; rows without one are left out.

    A base of zero raises an error when its row is used."""
    base = F.lag(price, lag).over(_by_time())
    out = bars.withColumn("_base", base).where(F.col("_base").isNotNull())
    p, b = F.col(price).cast("decimal(18,8)"), F.col("_base").cast("decimal(18,8)")
    safe = F.when(b == 0, F.raise_error(F.lit("a return from a price of zero"))).otherwise(b)
    return out.withColumn("value", quantize(((p - b) * 100).cast("decimal(25,8)").cast("decimal(28,18)") / safe)).drop("_base")


# ---- recursive indicators -----------------------------------------------------------------------------------------
# Every step rounds to eight places, so a value follows from the one before and from nothing shorter: one ordered pass
# over each instrument, in whole numbers of 1e-8. A group is one instrument's bars of one resolution.
def _half_even(n: int, d: int) -> int:
    q, r = divmod(n, d)
    return q + (2 * r > d or (2 * r == d and q & 1))


def ema_units(x: list[int], window: int) -> list[int]:
    """From row `window` on: the mean of the first `window` values, then steps of 2 / (window + 1) of the distance."""
    if len(x) < window:
        return []
    out = [_half_even(sum(x[:window]), window)]
    for p in x[window:]:
        out.append(out[-1] + _half_even(2 * (p - out[-1]), window + 1))
    return out


def rsi_units(x: list[int], period: int) -> list[int]:
    """From row period + 1 on: Wilder's index of gains and losses; 50 where nothing moved, 100 without losses."""
    if len(x) <= period:
        return []
    moves = [b - a for a, b in zip(x, x[1:])]
    gain = _half_even(sum(m for m in moves[:period] if m > 0), period)
    loss = _half_even(-sum(m for m in moves[:period] if m < 0), period)
    out = []
    for i in range(period - 1, len(moves)):
        if i >= period:
            gain += _half_even(max(moves[i], 0) - gain, period)
            loss += _half_even(max(-moves[i], 0) - loss, period)
        out.append(50 * 10**8 if gain == loss == 0 else 100 * 10**8 if loss == 0 else _half_even(100 * 10**8 * gain, gain + loss))
    return out


def macd_units(x: list[int], fast: int, slow: int, signal: int) -> dict[str, list[int]]:
    """MACD from row `slow` on, SIGNAL and HISTOGRAM from row slow + signal - 1 on."""
    line = [a - b for a, b in zip(ema_units(x, fast)[slow - fast :], ema_units(x, slow))]
    smooth = ema_units(line, signal)
    return {"MACD": line, "SIGNAL": smooth, "HISTOGRAM": [a - b for a, b in zip(line[signal - 1 :], smooth)]}


@dataclass(frozen=True)
class Calculator:
    """A calculator of one version: its parameters in order, the rows it needs, and its series in units of 1e-8."""

    code: str
    version: str
    parameters: tuple[str, ...]
    rows_needed: Callable[[dict], int]
    series: Callable[[list[int], dict], list[int]]


def _line_rows(p: dict) -> int:
    return p["slow_period"] if p["output_line"] == "MACD" else p["slow_period"] + p["signal_period"] - 1


def _return_units(x: list[int], p: dict) -> list[int]:
    n = p["lag"]
    if any(v == 0 for v in x[:-n]):
        raise ValueError("a return from a price of zero")
    return [_signed_half_even(100 * 10**8 * (b - a), a) for a, b in zip(x, x[n:])]


def _signed_half_even(n: int, d: int) -> int:
    return _half_even(n, d) if d > 0 else _half_even(-n, -d)


# Codes and versions of calculators, and the names of their parameters.
CALCULATORS = {
    (c.code, c.version): c
    for c in (
        Calculator("SMA", "1.0.0", ("price_field", "window"), lambda p: p["window"], lambda x, p: [_half_even(sum(x[i - p["window"] : i]), p["window"]) for i in range(p["window"], len(x) + 1)]),
        Calculator("EMA", "1.0.0", ("price_field", "window"), lambda p: p["window"], lambda x, p: ema_units(x, p["window"])),
        Calculator("RETURN_PCT", "1.0.0", ("lag", "price_field"), lambda p: p["lag"] + 1, _return_units),
        Calculator("RSI", "1.0.0", ("period", "price_field"), lambda p: p["period"] + 1, lambda x, p: rsi_units(x, p["period"])),
        Calculator("MACD", "1.0.0", ("fast_period", "output_line", "price_field", "signal_period", "slow_period"), _line_rows, lambda x, p: macd_units(x, p["fast_period"], p["slow_period"], p["signal_period"])[p["output_line"]]),
    )
}
# What the hashed payloads of definitions, results and batches hold besides their content.
OUTPUT_TYPE, SCHEMA_VERSION = "DECIMAL", 1


def _uuid(*values: str) -> str:
    return str(uuid.uuid5(uuid.UUID(UUID_NAMESPACE), "|".join(values)))


#: The version of the catalog of definitions that is taken where none is named.
CATALOG_VERSION = _uuid("feature-catalog", "1")


@dataclass(frozen=True)
class Definition:
    code: str
    parameters: tuple[tuple[str, object], ...]
    resolution: str = "1d"
    version: str = "1.0.0"
    catalog_version: str = CATALOG_VERSION

    @property
    def calculator(self) -> Calculator:
        found = CALCULATORS.get((self.code, self.version))
        if found is None:
            raise KeyError(f"unknown calculator: {self.code} {self.version}")
        if tuple(sorted(k for k, _ in self.parameters)) != found.parameters:
            raise ValueError(f"{self.code} takes {found.parameters}")
        return found

    @property
    def rows_needed(self) -> int:
        return self.calculator.rows_needed(dict(self.parameters))

    @property
    def payload(self) -> str:
        """The canonical JSON that is hashed."""
        content = {
            "calculator_version": self.version,
            "element_catalog_version_id": self.catalog_version,
            "feature_code": self.code,
            "normalized_parameters": dict(self.parameters),
            "output_value_type": OUTPUT_TYPE,
            "required_history_points": self.rows_needed,
            "resolution": self.resolution,
            "schema_version": SCHEMA_VERSION,
        }
        return json.dumps(content, sort_keys=True, separators=(",", ":"))

    @property
    def hash(self) -> str:
        return hashlib.sha256(self.payload.encode()).hexdigest()

    @property
    def id(self) -> str:
        """The version 5 UUID of the hash."""
        return _uuid("feature-definition", self.hash)

    @property
    def definition_version(self) -> str:
        return f"fdv1:{self.code}:{self.version}:{self.hash[:16]}"


def definition(code: str, resolution: str = "1d", catalog_version: str = CATALOG_VERSION, **parameters) -> Definition:
    d = Definition(code, tuple(sorted(parameters.items())), resolution, catalog_version=catalog_version)
    d.calculator
    return d


def official_definitions(resolution: str | None = None) -> list[Definition]:
    """The published set, all of the close: SMA 20, EMA 12 and 26, the three lines of MACD 12/26/9 of days and RSI 14 of
    minutes; with a resolution, all of that one."""
    day, minute = resolution or "1d", resolution or "1m"
    macd = [definition("MACD", day, price_field="close", fast_period=12, slow_period=26, signal_period=9, output_line=x) for x in ("MACD", "SIGNAL", "HISTOGRAM")]
    return [definition("SMA", day, price_field="close", window=20), definition("EMA", day, price_field="close", window=12), definition("EMA", day, price_field="close", window=26), definition("RSI", minute, price_field="close", period=14), *macd]


def definition_table(spark: SparkSession, definitions: list[Definition]) -> DataFrame:
    rows = [(d.id, d.hash, d.code, d.version, d.resolution, d.payload, d.rows_needed) for d in definitions]
    return spark.createDataFrame(rows, "definition_id string, definition_hash string, code string, version string, resolution string, payload string, required_history_points int")


def register(existing: DataFrame, new: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table with new definitions, refused ones): the same payload under the same id is no change, another is refused."""
    e = existing.select("definition_id", F.col("payload").alias("_old"))
    j = new.join(e, "definition_id", "left")
    refused = j.where(F.col("_old").isNotNull() & (F.col("_old") != F.col("payload"))).drop("_old")
    return existing.unionByName(j.where(F.col("_old").isNull()).drop("_old")), refused


def compute(bars: DataFrame, definitions: list[Definition]) -> DataFrame:
    """(definition_id, instrument_id, bar_start_at, value decimal(38,8)): all definitions in one pass over each instrument.

    Rows before a definition is warm are left out; an instrument that is too short for it has none."""
    prices = sorted({str(dict(d.parameters)["price_field"]) for d in definitions})
    rows = bars.select("instrument_id", F.unix_micros("bar_start_at").alias("t"), *[units(p).cast("bigint").alias(p) for p in prices])
    plan = [(d.id, d.code, d.version, dict(d.parameters)) for d in definitions]

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("t")
        t, out = table["t"], []
        for ident, code, version, p in plan:
            got = CALCULATORS[code, version].series(table[p["price_field"]].to_pylist(), p)
            if got:
                n = len(got)
                out.append(pa.table({"definition_id": pa.array([ident] * n), "instrument_id": table["instrument_id"][-n:].cast(pa.string()), "t": t[len(t) - n :], "v": pa.array(got, pa.int64())}))
        empty = pa.table({"definition_id": pa.array([], pa.string()), "instrument_id": pa.array([], pa.string()), "t": pa.array([], pa.int64()), "v": pa.array([], pa.int64())})
        return pa.concat_tables([x.combine_chunks() for x in out]) if out else empty

    found = rows.groupBy("instrument_id").applyInArrow(run, "definition_id string, instrument_id string, t long, v long")
    value = (F.col("v").cast("decimal(20,0)") * F.lit("0.00000001").cast("decimal(8,8)")).cast("decimal(38,8)")
    return found.select("definition_id", "instrument_id", F.timestamp_micros("t").alias("bar_start_at"), value.alias("value"))


def validate_series(bars: DataFrame, start: str | None = None, end: str | None = None) -> DataFrame:
    """Instruments whose series may not be used, with the reason: an instant met twice, outside the period, or a null price."""
    w = Window.partitionBy("instrument_id").orderBy("bar_start_at")
    b = bars.withColumn("_prev", F.lag("bar_start_at").over(w))
    outside = F.lit(False)
    if start:
        outside = outside | (F.col("bar_start_at") < F.lit(start).cast("timestamp"))
    if end:
        outside = outside | (F.col("bar_start_at") >= F.lit(end).cast("timestamp"))
    reason = F.when(F.col("bar_start_at") == F.col("_prev"), "NOT_INCREASING").when(outside, "OUTSIDE_PERIOD").when(F.col("close").isNull(), "MISSING_PRICE")
    return b.withColumn("reason", reason).where("reason IS NOT NULL").groupBy("instrument_id").agg(F.min("reason").alias("reason"))


def materialize(bars: DataFrame, definitions: list[Definition], input_hash: str, period_start: str, period_end: str) -> DataFrame:
    """One row for each definition and instrument: SUCCEEDED with row count and result hash, or FAILED if it is too short.

    The hash is SHA-256 of canonical JSON with the definition's hash, the fingerprint of the input, the instrument, the
    period (ISO instants) and the rows in order, so a second run gives the same one. A series is one text for its hash,
    as it is in its file; an instrument's bars bound it."""
    spark = bars.sparkSession
    asked = definition_table(spark, definitions).select("definition_id", "definition_hash")
    done = result_hashes(compute(bars, definitions).join(F.broadcast(asked), "definition_id"), input_hash, period_start, period_end)
    pairs = asked.crossJoin(bars.select("instrument_id").distinct())  # definitions times instruments is what is asked for
    out = pairs.join(done.drop("definition_hash"), ["definition_id", "instrument_id"], "left")
    status = F.when(F.col("result_hash").isNull(), "FAILED").otherwise("SUCCEEDED")
    version = F.concat_ws(":", F.lit("fmv1:m"), F.substring("definition_hash", 1, 16), F.lit(input_hash[:16]), F.substring("result_hash", 1, 16))
    version = F.when(F.col("result_hash").isNotNull(), version).alias("materialization_version")
    return out.select("definition_id", "definition_hash", "instrument_id", status.alias("status"), F.coalesce("row_count", F.lit(0)).alias("row_count"), F.lit(input_hash).alias("input_dataset_set_hash"), "result_hash", version)


def result_hashes(values: DataFrame, input_hash: str, period_start: str, period_end: str) -> DataFrame:
    """(definition_id, definition_hash, instrument_id, row_count, result_hash) of series with those three keys, bar_start_at and value."""
    row = canonical_json(at=iso_utc("bar_start_at"), value=F.col("value").cast("string"))
    rows = F.transform(F.array_sort(F.collect_list(F.struct("bar_start_at", row.alias("row")))), lambda x: x["row"])
    done = values.groupBy("definition_id", "definition_hash", "instrument_id").agg(F.count("*").alias("row_count"), F.array_join(rows, ",").alias("_rows"))
    text = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('",'))
    head = F.concat(text("definition_hash", F.col("definition_hash")), text("input_dataset_set_hash", F.lit(input_hash)), text("instrument_id", F.col("instrument_id")), text("period_end", F.lit(period_end)), text("period_start", F.lit(period_start)))
    payload = F.concat(F.lit("{"), head, F.lit(f'"result_schema_version":{SCHEMA_VERSION},"rows":['), F.col("_rows"), F.lit("]}"))
    return done.select("definition_id", "definition_hash", "instrument_id", "row_count", sha256(payload).alias("result_hash"))


def _hash_of_all(rows: DataFrame, text: Column, before: Column, after: str) -> DataFrame:
    """One row: SHA-256 of before, the texts in order joined by commas, and after; of no rows there is no row.

    Texts are sorted by ranges and go by one task in this order, which digests them as they come and holds none of them.
    before may be a column, the same one in all rows."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        so_far, sep = None, b""
        for b in batches:
            for head, x in zip(b.column("before"), b.column("text")):
                if so_far is None:
                    so_far = hashlib.sha256(head.as_py().encode())
                so_far.update(sep + x.as_py().encode())
                sep = b","
        if so_far is not None:
            so_far.update(after.encode())
            yield pa.RecordBatch.from_arrays([pa.array([so_far.hexdigest()])], ["hash"])

    return rows.select(before.alias("before"), text.alias("text")).orderBy("text").coalesce(1).mapInArrow(digest, "hash string")


def snapshot_batch(planned: DataFrame, materialized: DataFrame, period_start: str, period_end: str, start_watermark: str, end_watermark: str) -> DataFrame:
    """One row: the batch's id and key, members, whether every planned one succeeded, and if so rows and hash of the batch.

    planned: definition_hash, instrument_id, input_dataset_set_hash. The hashes are over canonical JSON of sets in order:
    of definitions, of inputs, and of members, which are digested as streams: no row holds all of them."""
    j = planned.join(materialized.select("definition_hash", "instrument_id", "status", "row_count", "result_hash"), ["definition_hash", "instrument_id"], "left")
    ok = F.coalesce(F.col("status") == "SUCCEEDED", F.lit(False))
    quoted = F.concat(F.lit('"'), F.col("definition_hash"), F.lit('"'))
    feature_set = _hash_of_all(planned.select("definition_hash").distinct(), quoted, F.lit('{"definition_hashes":['), f'],"feature_set_schema_version":{SCHEMA_VERSION}}}')
    market = canonical_json(input_dataset_set_hash=F.col("input_dataset_set_hash"), instrument_id=F.col("instrument_id"))
    market_set = _hash_of_all(planned.select("input_dataset_set_hash", "instrument_id").distinct(), market, F.lit('{"market_inputs":['), f'],"market_set_schema_version":{SCHEMA_VERSION}}}')
    member = canonical_json(definition_hash=F.col("definition_hash"), input_dataset_set_hash=F.col("input_dataset_set_hash"), instrument_id=F.col("instrument_id"), result_hash=F.col("result_hash"))
    sets = written(feature_set.withColumnRenamed("hash", "feature_set_hash").crossJoin(market_set.withColumnRenamed("hash", "input_market_set_hash")), "sets")  # one row each
    counts = j.groupBy().agg(F.count("*").alias("members"), F.count_if(~ok).alias("unready"), F.sum("row_count").alias("row_count"))
    pair = lambda name, value: F.concat(F.lit(f'"{name}":"'), value, F.lit('"'))
    period = (("period_end", period_end), ("period_start", period_start), ("source_end_watermark", end_watermark), ("source_start_watermark", start_watermark))
    head = F.concat(F.lit(f'{{"batch_schema_version":{SCHEMA_VERSION},'), pair("feature_set_hash", F.col("feature_set_hash")), F.lit(","), pair("input_market_set_hash", F.col("input_market_set_hash")), F.lit(',"members":['))
    tail = "]," + ",".join(f'"{k}":"{v}"' for k, v in period) + "}"
    batch = _hash_of_all(j.where(ok).crossJoin(F.broadcast(sets)), member, head, tail).withColumnRenamed("hash", "_batch")
    out = counts.join(sets, F.lit(True), "left").join(batch, F.lit(True), "left")  # one row each
    compact = lambda x: "".join(c for c in x if c not in "-:")
    key = F.concat_ws(":", F.lit("fsb1"), F.substring("feature_set_hash", 1, 16), F.substring("input_market_set_hash", 1, 16), F.lit(compact(period_start)), F.lit(compact(period_end)))
    sealed = (F.col("members") > 0) & (F.col("unready") == 0)
    out = out.withColumn("idempotency_key", key).withColumn("id", deterministic_uuid(F.lit("feature-snapshot-batch"), "idempotency_key"))
    return out.select("id", "idempotency_key", "members", "unready", sealed.alias("sealed"), F.when(sealed, F.col("row_count")).alias("row_count"), F.when(sealed, F.col("_batch")).alias("batch_hash"))
