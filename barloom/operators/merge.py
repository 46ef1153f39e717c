"""Versions of rows: keep the last, merge, compare, replace."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VALUES = ["open", "high", "low", "close", "volume", "trade_count", "vwap"]


def keep_last(df: DataFrame, keys: list[str], arrival: str | Column) -> DataFrame:
    """The row that arrived last of each key: an aggregate of whole rows, so repeats are dropped before the shuffle too."""
    rest = [c for c in df.columns if c not in keys]
    order = F.col(arrival) if isinstance(arrival, str) else arrival
    out = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_row"))
    return out.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)


def upsert_keep_last(existing: DataFrame, new: DataFrame, keys: list[str], time: str | None = None, since: str | None = None, arrival: str | None = None) -> DataFrame:
    """Rows of both; of one key the new one, of several the last by `arrival`, of equal ones the one that is largest as a
    row, so that the same input gives the same output. Older than `since` goes."""
    both = existing.withColumn("_rank", F.lit(0)).unionByName(new.withColumn("_rank", F.lit(1)))
    rest = [c for c in existing.columns if c not in keys]
    out = keep_last(both, keys, F.struct("_rank", *[arrival] * bool(arrival), F.xxhash64(*rest), *[F.col(c).cast("string") for c in rest])).drop("_rank")
    return out.where(F.col(time) >= F.lit(since).cast("timestamp")) if since else out


def revised(old: DataFrame, new: DataFrame, values: list[str] = VALUES, keys: tuple[str, ...] = ("instrument_id", "bar_start_at")) -> DataFrame:
    """Keys of both sides with, for each, whether any value differs; nulls are equal."""
    a, b = old.select(*keys, F.struct(*values).alias("_a")), new.select(*keys, F.struct(*values).alias("_b"))
    return a.join(b, list(keys)).select(*keys, (~F.col("_a").eqNullSafe(F.col("_b"))).alias("revised"))


def earliest_change(old: DataFrame, new: DataFrame, values: list[str], tolerance: float = 1e-10) -> DataFrame:
    """For each instrument the first bar in which a value changed by more than the tolerance, relative to at least 1."""
    keys = ["instrument_id", "bar_start_at"]
    j = old.select(*keys, *[F.col(v).alias(f"{v}_a") for v in values]).join(new.select(*keys, *[F.col(v).alias(f"{v}_b") for v in values]), keys)

    def differs(v: str) -> Column:
        a, b = F.col(f"{v}_a"), F.col(f"{v}_b")
        close = F.abs(a - b) <= F.greatest(F.abs(a), F.lit(1.0)) * tolerance
        return ~(a.eqNullSafe(b) | F.coalesce(close, F.lit(False)))

    changed = reduce(lambda x, y: x | y, [differs(v) for v in values])
    return j.where(changed).groupBy("instrument_id").agg(F.min("bar_start_at").alias("changed_from"))


def snapshot_diff(source: DataFrame, target: DataFrame, keys: list[str], allow_extra: bool = False) -> DataFrame:
    """(keys, action): append for rows that the target lacks, conflict for different ones and, unless allowed, extra ones."""
    rest = [c for c in source.columns if c not in keys]
    pack = lambda df, n: df.select(*keys, F.struct(*rest).alias(n), F.lit(True).alias(f"{n}_is"))
    j = pack(source, "_s").join(pack(target, "_t"), keys, "full_outer")
    action = (
        F.when(F.col("_t_is").isNull(), "append")
        .when(F.col("_s_is").isNull(), F.lit("extra" if allow_extra else "conflict"))
        .when(F.col("_s").eqNullSafe(F.col("_t")), "same")
        .otherwise("conflict")
    )
    return j.select(*keys, action.alias("action"))


def replace_rows(previous: DataFrame, current: DataFrame, keys: list[str], replaced: DataFrame | None = None) -> DataFrame:
    """Current rows, and previous ones whose key is neither among them nor in `replaced`."""
    gone = current.select(*keys).distinct()
    if replaced is not None:
        gone = gone.unionByName(replaced.select(*keys)).distinct()
    return previous.join(gone, keys, "left_anti").unionByName(current)


def incremental_recompute(old: DataFrame, recomputed: DataFrame, cut: Column, time: str = "bar_start_at") -> DataFrame:
    """Old output before the cut, and what was recomputed from it on."""
    return old.where(F.col(time) < cut).unionByName(recomputed.where(F.col(time) >= cut))


def latest(df: DataFrame, identity: list[str], by: str) -> DataFrame:
    """The row with the largest `by` of each identity."""
    return keep_last(df, identity, by)


def latest_n(df: DataFrame, key: str, n: int, time: str = "bar_start_at", since: str | None = None) -> DataFrame:
    """The last n rows of each key, none older than `since`."""
    df = df.where(F.col(time) >= F.lit(since).cast("timestamp")) if since else df
    w = Window.partitionBy(key).orderBy(F.desc(time))
    return df.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= n).drop("_n")


def first_gap(intervals: DataFrame, key: str, start: Column, end: Column, lo: str = "period_start", hi: str = "period_end") -> DataFrame:
    """(key, first_gap): the first instant of [start, end) that the key's intervals leave open; null if they cover it all."""
    w = Window.partitionBy(key).orderBy(lo, hi)
    cursor = F.coalesce(F.max(hi).over(w.rowsBetween(Window.unboundedPreceding, -1)), start)
    seen = intervals.where((F.col(hi) > start) & (F.col(lo) < end)).withColumn("_cursor", F.greatest(cursor, start))
    gap = F.min(F.when(F.col(lo) > F.col("_cursor"), F.col("_cursor")))
    covered = seen.groupBy(key).agg(gap.alias("_gap"), F.max(hi).alias("_end"))
    out = intervals.select(key).distinct().join(covered, key, "left")
    none = F.when(F.col("_end").isNull(), start).when(F.col("_end") < end, F.greatest("_end", start))
    return out.select(key, F.coalesce("_gap", none).alias("first_gap"))


def last_before(df: DataFrame, key: str, order: list[str], bucket: Column, value: str, out: str) -> DataFrame:
    """df with `out`: the key's last value that is not null in the rows before this one, in the given order.

    Rows are ordered within (key, bucket) alone, where buckets must follow the order; what the buckets before a bucket end
    with is one row for each bucket, so that no task orders all rows of a key."""
    b = df.withColumn("_bucket", bucket)
    w = Window.partitionBy(key, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)
    ends = b.groupBy(key, "_bucket").agg(F.max_by(value, F.when(F.col(value).isNotNull(), place)).alias("_end"))
    carried = ends.select(F.col(key).alias("_key"), F.col("_bucket").alias("_of"), F.last("_end", ignorenulls=True).over(before).alias("_carried"))
    same = F.col(key).eqNullSafe(F.col("_key")) & F.col("_bucket").eqNullSafe(F.col("_of"))
    own = b.withColumn("_own", F.last(value, ignorenulls=True).over(w)).join(carried, same, "left")
    return own.withColumn(out, F.coalesce("_own", "_carried")).drop("_bucket", "_own", "_key", "_of", "_carried")


def asof_before(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, value: str, out: str) -> DataFrame:
    """left with `out`: the value of the key's last right row strictly before left_time.

    Both sides are laid into one order and the last value carried on, by days, so rows are not multiplied and a key with very
    many rows is spread over its days."""
    l = left.withColumn("_t", F.col(left_time)).withColumn("_side", F.lit(0)).withColumn("_v", F.lit(None).cast(right.schema[value].dataType))
    pad = [F.lit(None).cast(f.dataType).alias(f.name) for f in left.schema if f.name != key]
    r = right.select(key, *pad, F.col(right_time).alias("_t"), F.lit(1).alias("_side"), F.col(value).alias("_v"))
    both = last_before(l.unionByName(r), key, ["_t", "_side"], F.to_date("_t"), "_v", out)
    return both.where("_side = 0").drop("_t", "_side", "_v")
