"""Keys and instants as column expressions. All stay in the JVM; the session time zone is taken to be UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NEW_YORK = "America/New_York"

# The namespace of derived identifiers, and the length of a bar of each resolution in minutes.
UUID_NAMESPACE = "05a27d5a-75d8-4d57-bc9a-31cedf90d791"
BAR_MINUTES = {"1m": 1, "30m": 30, "1h": 60, "4h": 240, "1d": 390}


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def session_date_et(ts: Column | str) -> Column:
    """The New York calendar date of a UTC instant."""
    return F.to_date(F.from_utc_timestamp(col(ts), NEW_YORK))


def et_midnight(day: Column | str) -> Column:
    """The UTC instant at which a New York date begins; also the instant a corporate action takes effect."""
    return F.to_utc_timestamp(col(day).cast("timestamp"), NEW_YORK)


def canonical_symbol(symbol: Column | str) -> Column:
    return F.translate(F.upper(F.trim(col(symbol))), "/", ".")


def safe_symbol(symbol: Column | str) -> Column:
    """A symbol as it stands in a file name."""
    return F.translate(canonical_symbol(symbol), ".", "-")


def partition_start(day: Column | str, granularity: str) -> Column:
    """DAY, WEEK (from Monday), MONTH or YEAR."""
    if granularity == "DAY":
        return col(day)
    if granularity not in ("WEEK", "MONTH", "YEAR"):
        raise ValueError(f"unknown granularity: {granularity}")
    return F.to_date(F.trunc(col(day), granularity.lower()))


def partition_end(day: Column | str, granularity: str) -> Column:
    start = partition_start(day, granularity)
    return {"DAY": F.date_add(start, 1), "WEEK": F.date_add(start, 7), "MONTH": F.add_months(start, 1), "YEAR": F.add_months(start, 12)}[granularity]


def partition_utc_window(day: Column | str, granularity: str) -> tuple[Column, Column]:
    """[start, end) of a partition at New York midnights, in UTC."""
    return et_midnight(partition_start(day, granularity)), et_midnight(partition_end(day, granularity))


def stable_shard(instrument_id: Column | str, count: int | Column) -> Column:
    """First 64 bits of SHA-256 of the lower-case id, as an unsigned number, modulo count."""
    n = F.lit(count) if isinstance(count, int) else count
    head = F.conv(F.substring(F.sha2(F.lower(col(instrument_id)).cast("binary"), 256), 1, 16), 16, 10).cast("decimal(20,0)")
    return (head % n.cast("decimal(20,0)")).cast("int")


def shard_key(instrument_id: Column | str, count: int) -> Column:
    width = max(2, len(str(count - 1)))
    return F.concat(F.lit("s"), F.lpad(stable_shard(instrument_id, count).cast("string"), width, "0"), F.lit(f"-of-{count}"))


def deterministic_uuid(*values: Column | str) -> Column:
    """Version 5 UUID of the values joined by a bar; a null reads None."""
    name = F.concat_ws("|", *[F.coalesce(col(v).cast("string"), F.lit("None")) for v in values])
    digest = F.sha1(F.concat(F.unhex(F.lit(UUID_NAMESPACE.replace("-", ""))), name.cast("binary")))
    variant = F.lower(F.hex(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws(
        "-", F.substring(digest, 1, 8), F.substring(digest, 9, 4), F.concat(F.lit("5"), F.substring(digest, 14, 3)), F.concat(variant, F.substring(digest, 18, 3)), F.substring(digest, 21, 12)
    )


def interval_overlap(a: Column, b: Column, c: Column, d: Column) -> Column:
    """Whether [a, b) and [c, d) meet; an end of null is open."""
    return (d.isNull() | (a < d)) & (b.isNull() | (c < b))


def iso_utc(ts: Column | str) -> Column:
    """2026-01-05T14:30:00Z, with microseconds only where there are some."""
    t = col(ts)
    whole = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(t, "SSSSSS")
    return F.concat(whole, F.when(part != "000000", F.concat(F.lit("."), part)).otherwise(F.lit("")), F.lit("Z"))


def compact_utc(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyyMMdd'T'HHmmss'Z'")


def bar_span(resolution: Column | str) -> Column:
    """Minutes of a bar; null for an unknown resolution."""
    return F.coalesce(*[F.when(col(resolution) == r, F.lit(m)) for r, m in BAR_MINUTES.items()])


def bucket_start(ts: Column | str, minutes: int) -> Column:
    """The UTC instant at which the bucket of `minutes` that holds ts begins."""
    seconds = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(col(ts)) / seconds) * seconds)
