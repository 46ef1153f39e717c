"""Jobs over whole datasets: backfill, derivation, the daily increment, adjustment, bootstrap and validation of a catalog.

Each job is one plan over tables; what it would publish and what became of each dataset are DataFrames, written by the
caller, data first."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.functions.keys import deterministic_uuid, iso_utc
from barloom.operators import actions as act
from barloom.operators import catalog, merge, quality, resample
from barloom.operators.sessions import in_session
from barloom.sources.files import DayStore
from barloom.sources.shared import written

RESOLUTIONS = ("1h", "4h", "1d")


def _all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---- derivation and backfill ------------------------------------------------------------------------------------
def derive(bars: DataFrame, manifests: DataFrame, asked: DataFrame, sessions: DataFrame, resolutions: tuple[str, ...] = RESOLUTIONS) -> tuple[DataFrame, DataFrame]:
    """(derived bars, outcomes) from the latest available manifests of native bars.

    bars: manifest_id and a bar. manifests: manifest_id, price_type, year, revision_number, status. asked: price_type, year.
    Outcomes have a row for each asked pair and resolution: AVAILABLE with its rows, or QUARANTINED with
    SOURCE_MANIFEST_MISSING, or with NO_BARS if nothing was derived."""
    native = catalog.latest_available(manifests, ["price_type", "year"]).select("manifest_id", "price_type", "year").join(asked, ["price_type", "year"])
    rows = bars.join(native, "manifest_id")
    derived = resample.derive_all(rows, sessions, resolutions, ["price_type"]).withColumn("year", F.year("session_date_et"))
    n = derived.groupBy("price_type", "year", "resolution").agg(F.count("*").alias("rows"))
    plan = asked.withColumn("resolution", F.explode(F.array(*[F.lit(r) for r in resolutions])))
    j = plan.join(native.select("price_type", "year", "manifest_id"), ["price_type", "year"], "left").join(n, ["price_type", "year", "resolution"], "left")
    code = F.when(F.col("manifest_id").isNull(), "SOURCE_MANIFEST_MISSING").when(F.col("rows").isNull(), "NO_BARS")
    return derived, j.select("price_type", "year", "resolution", F.when(code.isNull(), "AVAILABLE").otherwise("QUARANTINED").alias("status"), code.alias("code"), F.coalesce("rows", F.lit(0).cast("long")).alias("rows"))


def backfill(staged: DataFrame, sessions: DataFrame, resolutions: tuple[str, ...] = RESOLUTIONS, zero_prices: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(native bars, derived bars, outcomes by price type and year) of staged chunks (price_type, chunk and a bar).

    Of a bar that several chunks have the last chunk's counts. A year with an ERROR finding is FAILED and publishes nothing;
    a price of zero is such a finding, but for zero_prices."""
    keys = ["price_type", "instrument_id", "bar_start_at"]
    native = in_session(merge.keep_last(staged, keys, "chunk"), sessions).drop("opens_at", "closes_at", "chunk").withColumn("year", F.year("session_date_et"))
    group = F.concat_ws("|", "price_type", "year")
    bad = quality.invalid_values(native.withColumn("instrument_id", F.concat_ws("|", group, "instrument_id")), zero_prices).where("severity = 'ERROR'")
    failed = bad.select(F.split("instrument_id", "[|]")[0].alias("price_type"), F.split("instrument_id", "[|]")[1].cast("int").alias("year")).distinct()
    good = native.join(failed, ["price_type", "year"], "left_anti")
    derived = resample.derive_all(good, sessions, resolutions, ["price_type"]).withColumn("year", F.year("session_date_et"))
    counts = native.groupBy("price_type", "year").agg(F.count("*").alias("native_rows"))
    made = derived.groupBy("price_type", "year").agg(F.count("*").alias("derived_rows"))
    marked = counts.join(failed.withColumn("_failed", F.lit(True)), ["price_type", "year"], "left").join(made, ["price_type", "year"], "left")
    status = F.when(F.col("_failed").isNotNull(), "FAILED").otherwise("SUCCEEDED")
    return good, derived, marked.select("price_type", "year", status.alias("status"), "native_rows", F.coalesce("derived_rows", F.lit(0).cast("long")).alias("derived_rows"))


# ---- the daily increment ----------------------------------------------------------------------------------------
NATIVE = "30m"


def incremental(store: DayStore, fetched: DataFrame, days: DataFrame, sessions: DataFrame, now: str, resolutions: tuple[str, ...] = RESOLUTIONS, history: Callable[[list[int]], DataFrame] | None = None) -> DataFrame:
    """Brings the days (session_date) of a store up to date and gives (price_type, resolution, session_date, status).

    fetched: price_type and bars, of the days and, for the adjusted type, of some before. A day that is no completed session
    at `now` is NOT_A_SESSION and changes nothing. Of the others the native bars and those of every resolution are derived
    from what was fetched alone and replace the day's folders: PUBLISHED; a day for which nothing came loses them: NO_BARS.

    If an adjusted bar of an earlier day differs from the stored one, prices were adjusted anew: all years that the store
    has are taken from history(years) first, native and derived: CORRECTED for each of their days. Without a history, or if
    it gives nothing, nothing at all is changed and every day is ADJUSTMENT_REVISION_BACKFILL_FAILED."""
    spark = fetched.sparkSession
    done = sessions.where(F.col("closes_at") <= F.lit(now).cast("timestamp")).select("session_date")
    # Days that are asked for: a list as long as the question.
    asked = [r[0] for r in days.select("session_date").distinct().orderBy("session_date").collect()]
    good = [r[0] for r in done.where(F.col("session_date").isin(asked)).orderBy("session_date").collect()] if asked else []
    kinds = ("raw", "adjusted")
    outcome = {(k, r, d): "NOT_A_SESSION" for k in kinds for r in (NATIVE, *resolutions) for d in asked}

    def whole(rows: DataFrame) -> DataFrame:
        """Native bars of sessions and what is derived from them, by resolution."""
        native = in_session(rows, sessions).drop("opens_at", "closes_at").withColumn("resolution", F.lit(NATIVE))
        derived = resample.derive_all(rows, sessions, resolutions, ["price_type"])
        names = [f.name for f in store.schema.fields]
        full = lambda d: d.select(*[F.col(n) if n in d.columns else F.lit(None).cast(store.schema[n].dataType).alias(n) for n in names])
        return full(native).unionByName(full(derived))

    def written_days(kind: str, of: list) -> set:
        found = store.read(kind, None, of).select("resolution", "session_date_et").distinct().collect()
        return {(r["resolution"], r["session_date_et"]) for r in found}

    if good:
        early = fetched.where((F.col("price_type") == "adjusted") & (F.col("session_date_et") < F.lit(good[0])))
        early_days = [r[0] for r in early.select("session_date_et").distinct().collect()]
        stored = store.read("adjusted", NATIVE, early_days)
        if early_days and not merge.revised(stored, early).where("revised").isEmpty():
            years = sorted({r[0].year for r in store.read("adjusted", NATIVE).select("session_date_et").distinct().collect()})
            again = history(years) if history is not None else None
            if again is None or again.isEmpty():
                return _outcomes(spark, {k: "ADJUSTMENT_REVISION_BACKFILL_FAILED" for k in outcome})
            store.replace(whole(again.where(F.year("session_date_et").isin(years)).withColumn("price_type", F.lit("adjusted"))))
            outcome |= {("adjusted", r, d): "CORRECTED" for r, d in written_days("adjusted", [r[0] for r in again.select("session_date_et").distinct().collect()])}
        taken = fetched.where(F.col("session_date_et").isin(good))
        store.replace(whole(taken))
        have = {(k, r, d) for k, r, d in in_session(taken, sessions).select("price_type", F.explode(F.array(*[F.lit(r) for r in (NATIVE, *resolutions)])), "session_date_et").distinct().collect()}
        for k in kinds:
            for r in (NATIVE, *resolutions):
                for d in good:
                    if (k, r, d) not in have:
                        store.drop(k, r, d)
                    outcome[k, r, d] = "PUBLISHED" if (k, r, d) in have else "NO_BARS"
    return _outcomes(spark, outcome)


def _outcomes(spark: SparkSession, outcome: dict) -> DataFrame:
    return spark.createDataFrame([(*k, v) for k, v in outcome.items()], "price_type string, resolution string, session_date date, status string")


# ---- adjustment -------------------------------------------------------------------------------------------------
def approved_actions(actions: DataFrame, states: DataFrame) -> DataFrame:
    """Actions whose candidate is APPROVED; they meet bars by instrument, and within it by the time they take effect."""
    return actions.join(states.where("state = 'APPROVED'").select("candidate_id"), "candidate_id", "left_semi")


def regenerate_adjusted(raw: DataFrame, actions: DataFrame, previous: DataFrame, granularity: str = "YEAR", shards: int = 1) -> tuple[DataFrame, DataFrame]:
    """(adjusted bars, outcome of each partition): a revision more where the content differs from the previous one's.

    previous: partition_start, content_hash, revision_number. The same content is NO_CHANGE and keeps its revision."""
    adjusted = act.adjust_bars(raw, actions)
    objects = catalog.object_stats(adjusted, granularity, shards, 24 * 60).select("partition_start", "row_count", F.col("content_hash").alias("_new"))
    j = objects.join(previous, "partition_start", "left")
    same = F.col("content_hash").eqNullSafe(F.col("_new"))
    revision = F.when(same, F.col("revision_number")).otherwise(F.coalesce("revision_number", F.lit(0)) + 1)
    return adjusted, j.select("partition_start", "row_count", F.when(same, "NO_CHANGE").otherwise("PUBLISHED").alias("status"), revision.alias("revision_number"), F.col("_new").alias("content_hash"))


# ---- catalog ----------------------------------------------------------------------------------------------------
def bootstrap(legacy: DataFrame, target: DataFrame, columns: dict[str, Column], keys: list[str], expected: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows to append, one row of counts) for a legacy table brought under the target's columns.

    Only rows that the target lacks are appended, and none if any row is in conflict with it or the number of legacy rows
    is not the expected one: all or nothing."""
    mapped = legacy.select(*[c.alias(n) for n, c in columns.items()])
    diff = merge.snapshot_diff(mapped, target.select(*columns), keys, allow_extra=True)
    facts = diff.groupBy().agg(F.count_if(F.col("action") == "append").alias("append"), F.count_if(F.col("action") == "conflict").alias("conflicts"))
    n = mapped.groupBy().agg(F.count("*").alias("legacy_rows"))
    ok = (F.col("conflicts") == 0) & (F.lit(expected is None) | (F.col("legacy_rows") == F.lit(expected if expected is not None else 0)))
    report = facts.crossJoin(n).withColumn("accepted", ok)  # one row each
    new = mapped.join(diff.where("action = 'append'").select(*keys), keys, "left_semi")
    return new.join(F.broadcast(report.where("accepted").select("accepted")), F.lit(True), "left_semi"), report


# The codes of findings about a catalog.
CATALOG_CODES = ("UNKNOWN_DATASET_CONTRACT", "MISSING_STORAGE_OBJECT", "CONTENT_HASH_MISMATCH", "PARQUET_FOOTER_INVALID", "ROW_COUNT_MISMATCH", "OVERLAPPING_ACTIVE_OBJECTS", "DATASET_HASH_MISMATCH", "AVAILABLE_MANIFEST_HAS_ERRORS")


def validate_catalog(manifests: DataFrame, objects: DataFrame, storage: DataFrame, found: DataFrame) -> DataFrame:
    """Findings (manifest_id, id, code), of CATALOG_CODES, over all manifests and their objects.

    manifests: manifest_id, status, dataset_hash, price_type, data_layer, resolution. objects: the eleven hashed keys, id,
    manifest_id, object_id. storage: object_id, object_key, expected_hash. found: object_key, actual_hash, actual_rows, as
    read from the files, see catalog.parquet_files(); a file that is not there has a wrong hash, one without rows no footer.
    An object has the first code that holds. A manifest of no known contract is not looked into. Hashes and overlaps of a
    manifest are of the objects that are what they should be, but for their number of rows."""
    unknown, missing, wrong_hash, footer, rows, overlap, dataset, errors_in = CATALOG_CODES
    known = catalog.contracts(manifests.sparkSession).withColumnRenamed("layer", "data_layer")
    strange = manifests.join(F.broadcast(known), ["price_type", "data_layer", "resolution"], "left_anti")  # nine contracts
    manifests = manifests.join(F.broadcast(known), ["price_type", "data_layer", "resolution"], "left_semi")
    objects = objects.join(manifests.select("manifest_id"), "manifest_id", "left_semi")
    j = objects.join(storage, "object_id", "left").join(found, "object_key", "left")
    code = (
        F.when(F.col("object_key").isNull(), missing)
        .when(~F.col("actual_hash").eqNullSafe(F.col("expected_hash")), wrong_hash)
        .when(F.col("actual_rows").isNull(), footer)
        .when(F.col("actual_rows") != F.col("row_count"), rows)
    )
    j = written(j.withColumn("code", code), "objects")
    good = j.where(F.col("code").isNull() | (F.col("code") == rows))
    none = F.lit(None).cast("string").alias("id")
    hashes = catalog.dataset_hash(good.select(*objects.columns), ["manifest_id"]).withColumnRenamed("dataset_hash", "_hash")
    wrong = manifests.join(hashes, "manifest_id", "left").where(~F.col("_hash").eqNullSafe(F.col("dataset_hash")))
    errors = _all([
        j.where("code IS NOT NULL").select("manifest_id", "id", "code"),
        catalog.overlapping_objects(good.select(*objects.columns)).select("manifest_id", "id", F.lit(overlap).alias("code")),
        wrong.select("manifest_id", none, F.lit(dataset).alias("code")),
    ])
    bad = manifests.where("status = 'AVAILABLE'").join(errors.select("manifest_id").distinct(), "manifest_id", "left_semi")
    return _all([errors, bad.select("manifest_id", none, F.lit(errors_in).alias("code")), strange.select("manifest_id", none, F.lit(unknown).alias("code"))])


def checksum_incidents(findings: DataFrame, objects: DataFrame) -> DataFrame:
    """An ERROR incident of OBJECT breadth for each CONTENT_HASH_MISMATCH, with the failing object as its evidence."""
    f = findings.where("code = 'CONTENT_HASH_MISMATCH'").select("manifest_id", "id").join(objects, ["manifest_id", "id"])
    none = F.lit(None).cast("string")
    ident = deterministic_uuid(
        F.lit("quality-incident"), "manifest_id", F.lit("CONTENT_HASH_MISMATCH"), F.lit("OBJECT"), none, "shard_key", F.col("partition_start").cast("string"), F.col("partition_end").cast("string"), iso_utc("period_start"), iso_utc("period_end"), "object_id"
    )
    return f.select(ident.alias("id"), F.col("manifest_id").alias("dataset_manifest_id"), F.lit("ERROR").alias("severity"), F.lit("CONTENT_HASH_MISMATCH").alias("incident_code"), F.lit("OBJECT").alias("breadth"), "shard_key", "period_start", "period_end", F.col("object_id").alias("evidence_object_id"))


def record_incidents(recorded: DataFrame, new: DataFrame) -> DataFrame:
    """Recorded incidents with the new ones: an id that is there already is replaced in place, so a second run changes
    nothing. An incident without a period raises an error."""
    scoped = F.col("period_start").isNotNull() & F.col("period_end").isNotNull()
    checked = new.withColumn("id", F.when(scoped, F.col("id")).otherwise(F.raise_error(F.lit("an incident has no scope")).cast("string")))
    return merge.upsert_keep_last(recorded, checked, ["id"])


def feature_input(bars: DataFrame, manifests: DataFrame, objects: DataFrame, authoritative: DataFrame, start: Column, end: Column) -> tuple[DataFrame, DataFrame]:
    """(bars of current revisions, each once; problems by instrument) that may feed a feature.

    bars: manifest_id and a bar. manifests: manifest_id, dataset_id, revision_number, status. objects: manifest_id,
    instrument_id, period_start, period_end. authoritative: the instruments that must be there, and no others.
    Problems: NOT_AUTHORITATIVE, MISSING, COVERAGE_GAP in [start, end), CONFLICTING_BARS where manifests that overlap differ."""
    current = catalog.latest_available(manifests, ["dataset_id"]).select("manifest_id")
    rows = bars.join(current, "manifest_id", "left_semi").drop("manifest_id")
    have = rows.select("instrument_id").distinct()
    gaps = merge.first_gap(objects.join(current, "manifest_id", "left_semi"), "instrument_id", start, end).where("first_gap IS NOT NULL")
    body = F.struct("open", "high", "low", "close", "volume")
    conflicts = rows.groupBy("instrument_id", "bar_start_at").agg(F.countDistinct(body).alias("n")).where("n > 1").select("instrument_id").distinct()
    problem = lambda df, code: df.select("instrument_id", F.lit(code).alias("problem"))
    found = [
        problem(have.join(authoritative, "instrument_id", "left_anti"), "NOT_AUTHORITATIVE"),
        problem(authoritative.join(have, "instrument_id", "left_anti"), "MISSING"),
        problem(gaps, "COVERAGE_GAP"),
        problem(conflicts, "CONFLICTING_BARS"),
    ]
    problems = _all(found)
    good = rows.join(problems.select("instrument_id").distinct(), "instrument_id", "left_anti")
    return good.dropDuplicates(["instrument_id", "bar_start_at"]), problems
