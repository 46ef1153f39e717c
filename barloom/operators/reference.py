"""Instruments, their symbols over time, universes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.keys import canonical_symbol

# What makes a fund eligible.
STRUCTURES = ["ETF"]


def symbol_periods(names: DataFrame) -> DataFrame:
    """(instrument_id, symbol, effective_from, effective_to): a name holds until the instrument's next one begins."""
    w = Window.partitionBy("instrument_id").orderBy("effective_from")
    return names.withColumn("effective_to", F.lead("effective_from").over(w))


def overlapping_symbols(periods: DataFrame) -> DataFrame:
    """Periods of one symbol that begin before an earlier one, of any instrument, has ended."""
    w = Window.partitionBy("symbol").orderBy("effective_from")
    far = F.coalesce("effective_to", F.lit("9999-12-31").cast("date"))
    before = F.max(far).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return periods.withColumn("_before", before).where(F.col("effective_from") < F.col("_before")).drop("_before")


def symbol_at(rows: DataFrame, periods: DataFrame, time: str) -> DataFrame:
    """rows with the symbol in force at their time, null where none is."""
    p = periods.select(F.col("instrument_id").alias("_i"), "symbol", "effective_from", "effective_to")
    on = (F.col("instrument_id") == F.col("_i")) & (F.col(time) >= F.col("effective_from")) & (F.col("effective_to").isNull() | (F.col(time) < F.col("effective_to")))
    return rows.join(p, on, "left").drop("_i", "effective_from", "effective_to")


def index_membership(current: DataFrame, changes: DataFrame, as_of: str, years: int) -> DataFrame:
    """(symbol): current members and those removed within the years before as_of; at most six characters.

    current: symbol. changes: removed, changed_on."""
    gone = changes.where(F.col("changed_on") >= F.add_months(F.lit(as_of).cast("date"), -12 * years)).select(F.col("removed").alias("symbol"))
    both = current.select("symbol").unionByName(gone).select(F.translate(F.upper(F.trim("symbol")), ".", "/").alias("symbol"))
    return both.where("symbol <> '' AND length(symbol) <= 6").distinct()


def universe_resolve(fetched: DataFrame, cached: DataFrame, extras: DataFrame, least: int) -> DataFrame:
    """Symbols of the fetch, or of the cache where the fetch is short, and extras; both short is an error. Nothing is collected but two counts."""
    source = fetched if fetched.count() >= least else cached
    if source is cached and cached.count() < least:
        raise ValueError(f"fewer than {least} symbols, fetched and cached")
    return source.select("symbol").unionByName(extras.select("symbol")).distinct()


def etf_universe(table: DataFrame, as_of: str, years: int) -> DataFrame:
    """(ticker, reasons): each row of the table with what makes it ineligible, null for an eligible one."""
    flag = lambda c: F.lower(F.trim(c)).isin("true", "yes", "1", "y")
    need = ["ticker", "name", "asset_class", "category", "issuer", "structure", "inception_date"]
    n = F.count("*").over(Window.partitionBy(F.upper(F.trim("ticker"))))
    blank = F.exists(F.array(*[F.coalesce(F.trim(F.col(c).cast("string")), F.lit("")) for c in need]), lambda x: x == "")
    rules = {
        "blank_metadata": blank,
        "bad_ticker": ~F.upper(F.trim("ticker")).rlike("^[A-Z][A-Z0-9./-]{0,9}$"),
        "repeated_ticker": F.col("_n") > 1,
        "structure": ~F.upper(F.trim("structure")).isin(STRUCTURES),
        "disabled": ~flag("enabled"),
        "leveraged_or_inverse": flag("leveraged") | flag("inverse"),
        "bad_date": F.col("inception_date").try_cast("date").isNull(),
        "too_young": F.col("inception_date").try_cast("date") > F.add_months(F.lit(as_of).cast("date"), -12 * years),
    }
    found = F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))
    return table.withColumn("_n", n).select(F.upper(F.trim("ticker")).alias("ticker"), F.when(F.size(found) > 0, F.array_join(found, ",")).alias("reasons"))


def instrument_map(table: DataFrame) -> DataFrame:
    """provider_symbol as the canonical symbol and instrument_id checked; a bad id or a repeated symbol raises an error."""
    ok = F.col("instrument_id").rlike("^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")
    n = F.count("*").over(Window.partitionBy("provider_symbol"))
    bad = F.raise_error(F.concat(F.lit("not an instrument: "), F.col("provider_symbol")))
    t = table.withColumn("provider_symbol", canonical_symbol("provider_symbol"))
    return t.withColumn("_n", n).withColumn("instrument_id", F.when(ok & (F.col("_n") == 1), F.lower("instrument_id")).otherwise(bad)).drop("_n")


def reference_load(existing: DataFrame, new: DataFrame, identity: list[str], facts: list[str]) -> tuple[DataFrame, DataFrame]:
    """(merged rows, refused rows): a row whose identity changed is refused, facts are taken from the new row."""
    e = existing.select("instrument_id", F.struct(*identity).alias("_old"))
    j = new.join(e, "instrument_id", "left")
    changed = F.col("_old").isNotNull() & ~F.col("_old").eqNullSafe(F.struct(*identity))
    good = j.where(~changed).select("instrument_id", *identity, *facts)
    kept = existing.join(good.select("instrument_id"), "instrument_id", "left_anti").select("instrument_id", *identity, *facts)
    return kept.unionByName(good), j.where(changed).drop("_old")
