"""Revisions of published datasets: objects, manifests, lineage, publication and compaction, as tables."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.functions.keys import deterministic_uuid, interval_overlap, iso_utc, partition_end, partition_start, shard_key, stable_shard
from barloom.functions.values import canonical_json, set_hash, sha256
from barloom.operators.merge import keep_last, last_before
from barloom.sources.shared import written

# The datasets that are published, as price type, layer and resolution.
CONTRACTS = [("raw", "RAW", "30m"), ("adjusted", "ADJUSTED", "30m"), ("raw", "RAW", "1m")] + [(p, "DERIVED", r) for p in ("raw", "adjusted") for r in ("1h", "4h", "1d")]
HASH_KEYS = ["content_hash", "object_kind", "partition_granularity", "partition_start", "partition_end", "period_start", "period_end", "shard_key", "part_number", "row_count", "schema_version"]


def contracts(spark: SparkSession, price_type: str = "all", resolution: str = "all", layer: str = "all") -> DataFrame:
    """The dataset contracts that match, a small dimension in order."""
    df = spark.createDataFrame(CONTRACTS, "price_type string, layer string, resolution string")
    for c, v in (("price_type", price_type), ("resolution", resolution), ("layer", layer)):
        df = df if v == "all" else df.where(F.col(c) == v)
    return df.orderBy("price_type", "layer", "resolution")


def object_stats(bars: DataFrame, granularity: str, shards: int, span_minutes: Column | int) -> DataFrame:
    """One object for each partition and shard: rows, least and greatest instrument, and the period that its bars cover.

    content_hash is SHA-256 of the number of rows and the sum of their hashes (the first 60 bits of SHA-256 of the row's
    text, prices in units of 1e-6): it is the same for the same rows in any order, and is summed per task before the
    shuffle."""
    span = F.lit(span_minutes) if isinstance(span_minutes, int) else span_minutes
    price = lambda c: F.round(F.col(c) * 1000000).cast("bigint").cast("string")
    text = F.concat_ws("|", "instrument_id", F.unix_timestamp("bar_start_at").cast("string"), *[F.coalesce(price(c), F.lit("")) for c in ("open", "high", "low", "close")], F.col("volume").cast("string"), F.coalesce(F.col("trade_count").cast("string"), F.lit("")))
    row = F.conv(F.substring(sha256(text), 1, 15), 16, 10).cast("decimal(20,0)")
    day = F.col("session_date_et")
    end = F.timestamp_seconds(F.unix_timestamp("bar_start_at") + span * 60)
    return bars.groupBy(partition_start(day, granularity).alias("partition_start"), partition_end(day, granularity).alias("partition_end"), shard_key("instrument_id", shards).alias("shard_key")).agg(
        F.count("*").alias("row_count"),
        F.min("instrument_id").alias("min_instrument_id"),
        F.max("instrument_id").alias("max_instrument_id"),
        F.min("bar_start_at").alias("period_start"),
        F.max(end).alias("period_end"),
        sha256(F.concat_ws(":", F.count("*"), F.sum(row))).alias("content_hash"),
    ).withColumn("partition_granularity", F.lit(granularity))


def object_key(provider: str, revision: Column, part: Column, **named: Column) -> Column:
    """The Hive-style key of an object; revisions and parts count from 1, others raise an error.

    named: feed, dataset, layer, resolution, granularity, partition_start, partition_end and shard."""
    at = lambda *names: [F.concat(F.lit(f"{k}="), named[k].cast("string")) for k in names]
    tail = F.concat(F.lit("part-"), F.lpad(part.cast("string"), 5, "0"), F.lit(".parquet"))
    middle = at("layer", "resolution", "granularity", "partition_start", "partition_end", "shard")
    key = F.concat_ws("/", F.lit("market-data"), F.lit(f"provider={provider}"), *at("feed", "dataset"), F.concat(F.lit("revision="), revision.cast("string")), *middle, tail)
    return F.when((revision > 0) & (part > 0), key).otherwise(F.raise_error(F.lit("revisions and parts count from 1")))


def dataset_hash(objects: DataFrame, by: list[str]) -> DataFrame:
    """For each group, SHA-256 of the canonical JSON of its objects' eleven keys, in the order of that JSON."""
    kinds = dict(objects.dtypes)
    shown = lambda k: iso_utc(k) if kinds[k] == "timestamp" else F.col(k).cast("string") if kinds[k] == "date" else F.col(k)
    have = {k: (shown(k) if k in kinds else F.lit(None).cast("string")) for k in HASH_KEYS}
    return objects.groupBy(*by).agg(set_hash(canonical_json(**have)).alias("dataset_hash"))


def latest_available(manifests: DataFrame, identity: list[str]) -> DataFrame:
    """The available manifest with the largest revision of each identity."""
    return keep_last(manifests.where("status = 'AVAILABLE'"), identity, "revision_number")


def _years(start: str, end: str) -> Column:
    """The years that a period touches; its end is open."""
    last = F.year(F.timestamp_micros(F.unix_micros(F.col(end)) - 1))
    return F.sequence(F.year(start), F.greatest(F.year(start), last))


def lineage(derived: DataFrame, source: DataFrame) -> DataFrame:
    """(derived_id, source_id) of objects of one shard whose periods overlap, which meet by shard and year."""
    d = derived.select(F.col("id").alias("derived_id"), "shard_key", F.col("period_start").alias("a"), F.col("period_end").alias("b"), F.explode(_years("period_start", "period_end")).alias("year"))
    s = source.select(F.col("id").alias("source_id"), "shard_key", F.col("period_start").alias("c"), F.col("period_end").alias("d"), F.explode(_years("period_start", "period_end")).alias("year"))
    return d.join(s, ["shard_key", "year"]).where(interval_overlap(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).select("derived_id", "source_id").distinct()


def reused_sources(derived: DataFrame, edges: DataFrame, objects: DataFrame, manifests: DataFrame) -> DataFrame:
    """(object_id, manifest_id): for each object the accepted manifests that it belongs to by itself or through a manifest
    that is composed from its own one.

    derived: object_id. edges: target_manifest_id, source_manifest_id, kind. objects: object_id, manifest_id. manifests:
    manifest_id, status."""
    own = derived.join(objects.select("object_id", "manifest_id"), "object_id")
    composed = edges.where("kind = 'COMPOSED_FROM'").select(F.col("source_manifest_id").alias("manifest_id"), F.col("target_manifest_id").alias("_via"))
    through = own.join(composed, "manifest_id").select("object_id", F.col("_via").alias("manifest_id"))
    good = manifests.where("status = 'AVAILABLE'").select("manifest_id")
    return own.select("object_id", "manifest_id").unionByName(through).distinct().join(good, "manifest_id", "left_semi")


def publish_revision(previous: DataFrame, new: DataFrame, replaced: DataFrame, errors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(objects of the next revision, its status): previous objects that overlap no replaced period, and the new ones.

    replaced: period_start, period_end; they meet objects by year, with the overlap as a filter of the join. The status is
    AVAILABLE if there are objects and no finding is an ERROR, else QUARANTINED; one row."""
    r = replaced.select(F.col("period_start").alias("_c"), F.col("period_end").alias("_d"), F.explode(_years("period_start", "period_end")).alias("_year"))
    at = previous.select("id", "period_start", "period_end", F.explode(_years("period_start", "period_end")).alias("_year"))
    hit = at.join(r, "_year").where(interval_overlap(F.col("period_start"), F.col("period_end"), F.col("_c"), F.col("_d"))).select("id").distinct()
    objects = previous.join(hit, "id", "left_anti").unionByName(new)
    bad = errors.groupBy().agg(F.coalesce(F.bool_or(F.col("severity") == "ERROR"), F.lit(False)).alias("bad"))
    status = F.when((F.col("n") > 0) & ~F.col("bad"), "AVAILABLE").otherwise("QUARANTINED")
    return objects, objects.groupBy().agg(F.count("*").alias("n")).crossJoin(bad).select(F.col("n").alias("objects"), status.alias("status"))


def write_revision(objects: DataFrame, manifest: DataFrame, path: str) -> None:
    """Objects first, the manifest last: readers begin at manifests, so a revision is seen whole or not at all."""
    objects.write.parquet(f"{path}/objects")
    manifest.write.parquet(f"{path}/manifest")


def overlapping_objects(objects: DataFrame) -> DataFrame:
    """Objects that begin before the one before them, of their manifest and shard, has ended."""
    w = Window.partitionBy("manifest_id", "shard_key").orderBy("period_start", "period_end")
    return objects.withColumn("previous_end", F.lag("period_end").over(w)).where(F.col("period_start") < F.col("previous_end"))


def compaction_plan(inputs: DataFrame, sessions: DataFrame, granularity: str, shards: list[str] | None = None) -> DataFrame:
    """For each target partition and shard: input objects, rows, days that sessions have and inputs lack, and a status.

    inputs: shard_key, partition_start (a day), row_count. A week that crosses a month is SKIPPED; lacking days make it
    COMPACTION_INPUT_INCOMPLETE; a day that stands twice DUPLICATE_INPUT; else READY."""
    day = F.col("partition_start")
    target = lambda d: partition_start(d, granularity)
    due = sessions.where("opens_at IS NOT NULL").select(F.col("session_date").alias("partition_start"))
    # A row for each shard and day, read twice, so it is written.
    have = written(inputs.groupBy("shard_key", "partition_start").agg(F.count("*").alias("n"), F.sum("row_count").alias("row_count")), "inputs")
    need = due.crossJoin(F.broadcast(have.select("shard_key").distinct()))  # sessions times shards
    j = need.join(have, ["shard_key", "partition_start"], "left")
    out = j.groupBy("shard_key", target(day).alias("target_start"), partition_end(day, granularity).alias("target_end")).agg(
        F.sum(F.coalesce("n", F.lit(0))).alias("inputs"), F.sum(F.coalesce("row_count", F.lit(0))).alias("row_count"), F.count_if(F.col("n").isNull()).alias("missing_days"), F.count_if(F.col("n") > 1).alias("double_days")
    )
    crosses = F.month("target_start") != F.month(F.date_sub("target_end", 1))
    status = F.when(F.lit(granularity == "WEEK") & crosses, "SKIPPED").when(F.col("missing_days") > 0, "COMPACTION_INPUT_INCOMPLETE").when(F.col("double_days") > 0, "DUPLICATE_INPUT").otherwise("READY")
    return out.withColumn("status", status).drop("double_days")


def compact(bars: DataFrame, plan: DataFrame, granularity: str, shards: int) -> DataFrame:
    """Rows of READY targets with the target's partition, to be written sorted in one go."""
    b = bars.withColumn("shard_key", shard_key("instrument_id", shards)).withColumn("target_start", partition_start(F.col("session_date_et"), granularity))
    return b.join(plan.where("status = 'READY'").select("shard_key", "target_start"), ["shard_key", "target_start"], "left_semi")


def instruments_in_all(rows: DataFrame, key: str = "manifest_id") -> DataFrame:
    """Instruments that every manifest has."""
    total = rows.select(key).distinct().groupBy().agg(F.count("*").alias("_n"))
    have = rows.groupBy("instrument_id").agg(F.countDistinct(key).alias("n"))
    return have.join(F.broadcast(total), F.col("n") == F.col("_n")).select("instrument_id")


def reconcile(expected: DataFrame, actual: DataFrame) -> DataFrame:
    """Findings for objects (object_key, version_id, content_hash): missing, of another version, of another hash."""
    a = actual.select("object_key", F.col("version_id").alias("_v"), F.col("content_hash").alias("_h"), F.lit(True).alias("_is"))
    j = expected.join(a, "object_key", "left")
    codes = F.array_compact(
        F.array(
            F.when(F.col("_is").isNull(), F.lit("S3_OBJECT_MISSING")),
            F.when(F.col("_v") != F.col("version_id"), F.lit("VERSION_MISMATCH")),
            F.when(F.col("_h") != F.col("content_hash"), F.lit("SHA256_MISMATCH")),
        )
    )
    return j.select("object_key", F.explode(codes).alias("code"))


def resume_check(recorded: DataFrame, found: DataFrame, least_bytes: int = 1) -> DataFrame:
    """One row: files recorded, the problems by code, and whether all may be resumed; an empty record may not.

    recorded, found: path, sha256, byte_size."""
    f = found.select("path", F.col("sha256").alias("_h"), F.col("byte_size").alias("_n"))
    problem = (
        F.when(F.col("_n").isNull(), "MISSING")
        .when(F.col("_n") == 0, "EMPTY")
        .when(F.col("_n") < least_bytes, "TOO_SMALL")
        .when(F.col("_n") != F.col("byte_size"), "SIZE_MISMATCH")
        .when(F.col("_h") != F.col("sha256"), "HASH_MISMATCH")
    )
    j = recorded.join(f, "path", "left").withColumn("problem", problem)
    counts = [F.count_if(F.col("problem") == c).alias(c.lower()) for c in ("MISSING", "EMPTY", "TOO_SMALL", "SIZE_MISMATCH", "HASH_MISMATCH")]
    return j.groupBy().agg(F.count("*").alias("files"), *counts, F.count_if(F.col("problem").isNotNull()).alias("problems")).select("*", ((F.col("files") > 0) & (F.col("problems") == 0)).alias("resumable"))


def scanned_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, byte_size) of files, read as they are."""
    return spark.read.format("binaryFile").load(path).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"))


def _footer_rows(footer: bytes | None) -> int | None:
    try:
        return pq.read_metadata(pa.BufferReader(b"PAR1" + footer)).num_rows
    except (pa.ArrowException, OSError, TypeError):
        return None


def _read_file(path: str, length: int) -> tuple[str, bytes | None]:
    """(SHA-256, footer) of a file that a task reads in portions."""
    digest, footer = hashlib.sha256(), None
    with open(path, "rb") as f:
        while part := f.read(1 << 20):
            digest.update(part)
        if length >= 12:
            f.seek(length - 8)
            size = int.from_bytes(f.read(4), "little")
            if size + 12 <= length:
                f.seek(length - 8 - size)
                footer = f.read()
    return digest.hexdigest(), footer


def parquet_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256, byte_size, rows) of the files under a folder; rows as their footers say, null where there is no valid one.

    Files of a folder that all machines share are read by tasks in portions, whatever their size. Of other storage, which
    only Spark's reader can open, hashes and footers are cut out of the bytes in the JVM: a file is held whole there, and
    can have 2 GB at most. Spark lists no empty files."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kind = "path string, sha256 string, byte_size long, rows long"
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    if root.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file":

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                paths, sizes = b.column("path").to_pylist(), b.column("length").to_pylist()
                found = [_read_file("/" + p.removeprefix("file:").lstrip("/"), n) for p, n in zip(paths, sizes)]
                yield pa.RecordBatch.from_arrays([b.column("path"), pa.array([h for h, _ in found], pa.string()), b.column("length"), pa.array([_footer_rows(x) for _, x in found], pa.int64())], ["path", "sha256", "byte_size", "rows"])

        return files.select("path", "length").mapInArrow(read, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_footer_rows(x) for x in b.column("footer").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(c) for c in ("path", "sha256", "byte_size")] + [pa.array(rows, pa.int64())], ["path", "sha256", "byte_size", "rows"])

    # The last eight bytes: how long the footer is, lowest byte first, and the mark of the format.
    at = lambda k: F.hex(F.expr(f"substring(content, CAST(length - {8 - k} + 1 AS INT), 1)"))
    size = F.conv(F.concat(at(3), at(2), at(1), at(0)), 16, 10).cast("long")
    cut = F.expr("substring(content, CAST(greatest(length - 8 - size, 0) + 1 AS INT), CAST(least(size + 8, length) AS INT))")
    footer = F.when((F.col("length") >= 12) & (F.col("size") + 12 <= F.col("length")), cut)
    small = files.withColumn("size", F.when(F.col("length") >= 12, size)).select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("byte_size"), footer.alias("footer"))
    return small.mapInArrow(run, kind)


#: Rows and instants that are ordered at once where parts are cut.
PART_RANGE = 100_000


def time_boundary_parts(bars: DataFrame, shards: int, most: int) -> DataFrame:
    """bars with shard and part_number: parts of at most `most` rows, in order of time, none of which splits an instant.

    Where a part begins depends on all parts before it. For each instant the place is found at which a part that began there
    would end, by sums of rows; from the first instant on, jumps of twice the length give all parts in as many rounds as
    their number has bits. Days, ranges of rows and ranges of instants are ordered by themselves, so that a shard with very
    many instants is many tasks."""
    b = bars.withColumn("shard", stable_shard("instrument_id", shards))
    counts = b.groupBy("shard", "bar_start_at").agg(F.count("*").alias("n")).withColumn("_day", F.to_date("bar_start_at"))
    day, days = Window.partitionBy("shard", "_day").orderBy("bar_start_at"), Window.partitionBy("shard").orderBy("_day")
    own = counts.withColumn("_upto", F.sum("n").over(day)).withColumn("_at", F.row_number().over(day))
    sums = own.groupBy("shard", "_day").agg(F.max("_upto").alias("_n"), F.max("_at").alias("_k"))
    sums = sums.select("shard", "_day", (F.sum("_n").over(days) - F.col("_n")).alias("_rows"), (F.sum("_k").over(days) - F.col("_k")).alias("_before"))
    at = own.join(sums, ["shard", "_day"]).select("shard", "bar_start_at", (F.col("_before") + F.col("_at") - 1).alias("idx"), (F.col("_rows") + F.col("_upto")).alias("upto"), "n")
    at = written(at, "instants")
    # An instant ends a part that begins at i if it is the first whose rows, from i on, are too many. In falling order of
    # sums that is the last one met before the limit of i, and equal sums still fit.
    limit = at.select("shard", F.col("idx").alias("asks"), (-(F.col("upto") - F.col("n") + most)).alias("neg"), F.lit(0).alias("side"), F.lit(None).cast("long").alias("idx"))
    sum_ = at.select("shard", F.lit(None).cast("long").alias("asks"), (-F.col("upto")).alias("neg"), F.lit(1).alias("side"), F.col("idx").cast("long").alias("idx"))
    ends = last_before(limit.unionByName(sum_), "shard", ["neg", "side"], F.floor(F.col("neg") / PART_RANGE), "idx", "ends").where("side = 0 AND ends IS NOT NULL")
    jump = written(ends.select("shard", F.col("asks").alias("idx"), F.greatest("ends", F.col("asks") + 1).alias("to")).join(at.select("shard", F.col("idx").alias("to")), ["shard", "to"], "left_semi").select("shard", "idx", "to"), "jumps")
    jumps = [jump]
    while True:
        last = jumps[-1]
        twice = written(last.join(last.select("shard", F.col("idx").alias("to"), F.col("to").alias("_far")), ["shard", "to"]).select("shard", "idx", F.col("_far").alias("to")), "jumps")
        # Jumps from the first instant are the ones that count.
        if twice.where("idx = 0").isEmpty():
            break
        jumps.append(twice)
    starts = at.where("idx = 0").select("shard", "idx", F.lit(0).alias("part_number"))
    for m in range(len(jumps) - 1, -1, -1):
        further = starts.join(jumps[m], ["shard", "idx"]).select("shard", F.col("to").alias("idx"), (F.col("part_number") + (1 << m)).alias("part_number"))
        starts = written(starts.unionByName(further), "starts")
    begun = at.join(starts, ["shard", "idx"], "left")
    parts = last_before(begun, "shard", ["idx"], F.floor(F.col("idx") / PART_RANGE), "part_number", "_part")
    parts = parts.select("shard", "bar_start_at", F.coalesce("part_number", "_part").alias("part_number"))
    return b.join(parts, ["shard", "bar_start_at"])


def input_fingerprint(objects: DataFrame, by: list[str]) -> DataFrame:
    """(by, objects, fingerprint): SHA-256 over the canonical JSON of each group's source objects, in the order of that JSON,
    under the version of the bundle; a repeated object raises an error, and a group without objects has no row.

    objects: id, manifest_id, content_hash, partition_start, partition_end, row_count."""
    entry = {k: F.col(k).cast("string") for k in ("content_hash", "partition_end", "partition_start")}
    row = canonical_json(dataset_manifest_id=F.col("manifest_id"), dataset_object_id=F.col("id"), row_count=F.col("row_count"), **entry)
    payload = F.concat(F.lit('{"bundle_schema_version":1,"objects":['), F.array_join(F.array_sort(F.collect_list(row)), ","), F.lit("]}"))
    g = objects.groupBy(*by).agg(sha256(payload).alias("fingerprint"), F.count("*").alias("objects"), F.countDistinct("id").alias("_d"))
    twice = F.raise_error(F.lit("a source object stands twice"))
    return g.select(*by, "objects", F.when(F.col("_d") == F.col("objects"), F.col("fingerprint")).otherwise(twice).alias("fingerprint"))


def shard_join(instruments: DataFrame, objects: DataFrame) -> DataFrame:
    """(instrument_id, id) where the object's key, sNN-of-n, is the instrument's shard for that n."""
    o = objects.withColumn("_n", F.regexp_extract("shard_key", "-of-([0-9]+)$", 1).cast("int")).withColumn("_k", F.regexp_extract("shard_key", "^s([0-9]+)-of-", 1).cast("int"))
    counts = o.select("_n").distinct()
    i = instruments.select("instrument_id").crossJoin(F.broadcast(counts)).withColumn("_k", stable_shard("instrument_id", F.col("_n")))  # instruments times the few shard counts in use
    return i.join(o, ["_n", "_k"]).select("instrument_id", "id")


def backfill_plan(wanted: DataFrame, objects: DataFrame, done: DataFrame, chunk: int = 512) -> DataFrame:
    """For each wanted (definition_id, instrument_id): the chunk numbers of its source objects, or a warning.

    done holds pairs that are satisfied and left out. Without objects the warning is NO_SOURCE_OBJECTS, with more than one
    chunk PERIOD_SPLIT."""
    todo = wanted.join(done, ["definition_id", "instrument_id"], "left_anti")
    pairs = shard_join(todo.select("instrument_id").distinct(), objects).join(objects.select("id", "period_start"), "id")
    w = Window.partitionBy("instrument_id").orderBy("period_start", "id")
    per = pairs.withColumn("chunk", F.floor((F.row_number().over(w) - 1) / chunk)).groupBy("instrument_id").agg(F.count("*").alias("objects"), (F.max("chunk") + 1).alias("chunks"))
    out = todo.join(per, "instrument_id", "left")
    warning = F.when(F.col("objects").isNull(), "NO_SOURCE_OBJECTS").when(F.col("chunks") > 1, "PERIOD_SPLIT")
    return out.select("definition_id", "instrument_id", F.coalesce("objects", F.lit(0)).alias("objects"), F.coalesce("chunks", F.lit(0)).alias("chunks"), warning.alias("warning"))


def manifest_identity(*values: Column | str) -> Column:
    return deterministic_uuid(F.lit("manifest"), *values)


def readiness(feeds: DataFrame, objects: DataFrame, manifests: DataFrame, watermarks: DataFrame, batches: DataFrame, budget_minutes: int = 60) -> DataFrame:
    """(feed_id, session_date, state, reason): READY, or BLOCKED by the first of data, freshness and features that fails.

    feeds: feed_id, session_date, closes_at, now, required_shards (array). objects: feed_id, session_date, shard_key.
    manifests: feed_id, session_date, status. watermarks: feed_id, last_source_event_at. batches: feed_id, session_date,
    sealed."""
    keys = ["feed_id", "session_date"]
    o = objects.groupBy(*keys).agg(F.collect_set("shard_key").alias("shards"))
    m = manifests.groupBy(*keys).agg(F.bool_or(F.col("status") == "AVAILABLE").alias("available"))
    b = batches.groupBy(*keys).agg(F.bool_and("sealed").alias("sealed"))
    j = feeds.join(o, keys, "left").join(m, keys, "left").join(watermarks.groupBy("feed_id").agg(F.max("last_source_event_at").alias("head")), "feed_id", "left").join(b, keys, "left")
    lacking = F.array_except("required_shards", F.coalesce("shards", F.array().cast("array<string>")))
    late = F.unix_timestamp("now") - F.unix_timestamp("head") > budget_minutes * 60
    reason = (
        F.when(F.size(lacking) > 0, "DAILY_OBJECT_MISSING")
        .when(~F.coalesce("available", F.lit(False)), "MANIFEST_NOT_AVAILABLE")
        .when(F.col("head").isNull(), "WATERMARK_MISSING")
        .when(late, "WATERMARK_STALE")
        .when(F.to_date("head") < F.col("session_date"), "WATERMARK_BEHIND_SESSION")
        .when(F.col("sealed").isNull(), "FEATURE_BATCH_MISSING")
        .when(~F.col("sealed"), "FEATURE_BATCH_INCOMPLETE")
    )
    return j.select(*keys, F.when(reason.isNull(), "READY").otherwise("BLOCKED").alias("state"), reason.alias("reason"), F.element_at(F.concat(F.array_sort(lacking), F.array(F.lit(None).cast("string"))), 1).alias("first_missing_shard"))


def validate_documents(documents: DataFrame, fields: list[str], uuids: list[str], hashes: list[str], instants: list[str], counts: list[str], column: str = "document") -> DataFrame:
    """JSON documents as ACCEPTED or REJECTED with the first violation, in the order: readable, complete, ids, hashes, instants, counts."""
    d = documents.withColumn("_d", F.from_json(column, "map<string,string>"))
    at = lambda k: F.col("_d")[k]
    violation = F.coalesce(
        F.when(F.col("_d").isNull(), F.lit("unreadable")),
        *[F.when(at(k).isNull(), F.lit(f"missing:{k}")) for k in fields],
        *[F.when(~at(k).rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"), F.lit(f"uuid:{k}")) for k in uuids],
        *[F.when(~at(k).rlike("^[0-9a-f]{64}$"), F.lit(f"hash:{k}")) for k in hashes],
        *[F.when(~at(k).rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]{1,6})?Z$"), F.lit(f"instant:{k}")) for k in instants],
        *[F.when(~F.coalesce(at(k).try_cast("bigint") > 0, F.lit(False)), F.lit(f"count:{k}")) for k in counts],
    )
    return d.withColumn("violation", violation).withColumn("result", F.when(F.col("violation").isNull(), "ACCEPTED").otherwise("REJECTED")).drop("_d")


def manifest_objects(manifests: DataFrame, objects: DataFrame, storage: DataFrame) -> DataFrame:
    """Objects of manifests with their stored files: manifest id, object id, key, hash, rows."""
    m = manifests.select(F.col("id").alias("manifest_id"))
    return m.join(objects, "manifest_id").join(storage, "object_id")


def feed_mismatches(raw: DataFrame, adjusted: DataFrame, fields: list[str]) -> DataFrame:
    """(name, fields in which the raw and the adjusted feed of a name differ, comma-joined; null if none)."""
    a = raw.select("name", *[F.col(f).alias(f"{f}_a") for f in fields])
    b = adjusted.select("name", *[F.col(f).alias(f"{f}_b") for f in fields])
    differ = F.array_compact(F.array(*[F.when(~F.col(f"{f}_a").eqNullSafe(F.col(f"{f}_b")), F.lit(f)) for f in fields]))
    return a.join(b, "name").select("name", F.when(F.size(differ) > 0, F.array_join(differ, ",")).alias("mismatch"))


def planned_members(definitions: DataFrame, inputs: DataFrame, materialized: DataFrame) -> DataFrame:
    """Planned (definition_id, instrument_id) that are absent or did not succeed, with what is the matter."""
    plan = definitions.select("definition_id").crossJoin(inputs.select("instrument_id"))  # the plan is all of them
    j = plan.join(materialized.select("definition_id", "instrument_id", "status"), ["definition_id", "instrument_id"], "left")
    matter = F.when(F.col("status").isNull(), "ABSENT").when(F.col("status") != "SUCCEEDED", "NOT_SUCCEEDED")
    return j.select("definition_id", "instrument_id", matter.alias("matter")).where("matter IS NOT NULL")


def watermark_projection(feeds: DataFrame, manifests: DataFrame) -> DataFrame:
    """(feed_id, last_source_event_at): the largest period end of the available manifests of each active feed."""
    active = feeds.where("feed_active AND provider_active").select("feed_id")
    return manifests.where("status = 'AVAILABLE'").join(active, "feed_id", "left_semi").groupBy("feed_id").agg(F.max("period_end").alias("last_source_event_at"))


def readiness_incidents(gate: DataFrame) -> DataFrame:
    """An ERROR incident for each blocked row of readiness(): of the first missing shard for missing objects, else of the manifest."""
    shard = F.col("reason") == "DAILY_OBJECT_MISSING"
    blocked = gate.where("state = 'BLOCKED'").withColumn("breadth", F.when(shard, "PARTITION").otherwise("MANIFEST"))
    scope = F.when(shard, F.col("first_missing_shard"))
    ident = deterministic_uuid(F.lit("readiness"), "feed_id", F.col("session_date").cast("string"), "reason", scope)
    return blocked.select(ident.alias("id"), "feed_id", "session_date", F.lit("ERROR").alias("severity"), F.col("reason").alias("incident_code"), "breadth", scope.alias("shard_key"))


def fixture_mismatches(declared: DataFrame, actual: DataFrame) -> DataFrame:
    """(id, code) where an object's file is not what its document declares.

    declared: id, layer, object_key, content_hash, row_count, first_bar, last_bar, instruments (array). actual: id and the
    same facts as read. Codes, in this order: LAYER_NOT_IN_KEY, FILE_MISSING, HASH, ROW_COUNT, INSTRUMENTS, FIRST_BAR, LAST_BAR."""
    facts = ["content_hash", "row_count", "first_bar", "last_bar"]
    a = actual.select("id", F.lit(True).alias("_is"), *[F.col(c).alias(f"_{c}") for c in facts], F.array_sort("instruments").alias("_instruments"))
    j = declared.join(a, "id", "left")
    differs = lambda c: F.col("_is") & ~F.col(c).eqNullSafe(F.col(f"_{c}"))
    rules = {
        "LAYER_NOT_IN_KEY": ~F.contains("object_key", F.concat(F.lit("/layer="), F.col("layer"), F.lit("/"))),
        "FILE_MISSING": F.col("_is").isNull(),
        "HASH": differs("content_hash"),
        "ROW_COUNT": differs("row_count"),
        "INSTRUMENTS": F.col("_is") & (F.array_sort("instruments") != F.col("_instruments")),
        "FIRST_BAR": differs("first_bar"),
        "LAST_BAR": differs("last_bar"),
    }
    return j.select("id", F.explode(F.array_compact(F.array(*[F.when(v, F.lit(k)) for k, v in rules.items()]))).alias("code"))


def validate_requests(documents: DataFrame, column: str = "document") -> DataFrame:
    """Backtest requests as ACCEPTED or REJECTED with the first violation: complete, ids and fingerprint well formed, a period
    that begins before it ends, at least one instrument."""
    fields = ["request_id", "strategy_id", "input_bundle_fingerprint", "period_start", "period_end", "instrument_count"]
    d = validate_documents(documents, fields, ["request_id", "strategy_id"], ["input_bundle_fingerprint"], ["period_start", "period_end"], ["instrument_count"], column)
    return _also(d, column, {"period:not_rising": lambda at: at("period_end") <= at("period_start")})


# The contract of result documents, and what each status needs; the first field is its instant.
RESULT_CONTRACT = "com06.backtest-result"
RESULT_FIELDS = {
    "QUEUED": ("queued_at",),
    "RUNNING": ("started_at", "attempt"),
    "COMPLETE": ("completed_at", "result_manifest_id"),
    "FAILED": ("failed_at", "failure_code", "retryable"),
    "UNAVAILABLE": ("decided_at", "reason_code", "missing_requirements"),
}
_UUID = "^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def validate_results(documents: DataFrame, column: str = "document") -> DataFrame:
    """Result documents of backtests as ACCEPTED or REJECTED with the first violation: contract and version, the envelope, a
    known status with its event type, and what that status needs. A document that is no JSON object is `unreadable`."""
    at = lambda k: F.col("_d")[k]
    lacks = lambda k: at(k).isNull() | (at(k) == "")
    not_uuid = lambda k: lacks(k) | ~at(k).rlike(_UUID)
    no_time = lambda k: F.try_to_timestamp(at(k)).isNull() | ~at(k).rlike("(Z|[+-][0-9]{2}:[0-9]{2})$")
    status = at("status")
    rules = {"unreadable": F.col("_d").isNull(), "contract_id": ~at("contract_id").eqNullSafe(F.lit(RESULT_CONTRACT)), "schema_version": ~at("schema_version").eqNullSafe(F.lit("1"))}
    rules |= {f"missing:{k}": at(k).isNull() for k in ("message_id", "occurred_at", "correlation_id", "idempotency_key")}
    rules |= {f"uuid:{k}": not_uuid(k) for k in ("message_id", "correlation_id")} | {"time:occurred_at": no_time("occurred_at"), "empty:idempotency_key": lacks("idempotency_key")}
    rules |= {f"missing:{k}": at(k).isNull() for k in ("event_type", "backtest_run_id", "status")} | {"uuid:backtest_run_id": not_uuid("backtest_run_id")}
    rules |= {"status": ~status.isin(*RESULT_FIELDS), "event_type": at("event_type") != F.concat(F.lit("BACKTEST_"), status)}
    for s, fields in RESULT_FIELDS.items():
        rules |= {f"missing:{k}": (status == s) & at(k).isNull() for k in fields} | {f"time:{fields[0]}": (status == s) & no_time(fields[0])}
    parsed = F.from_json(at("missing_requirements"), "array<string>")
    rules |= {
        "count:attempt": (status == "RUNNING") & ~F.coalesce(at("attempt").rlike("^[1-9][0-9]*$"), F.lit(False)),
        "uuid:result_manifest_id": (status == "COMPLETE") & not_uuid("result_manifest_id"),
        "empty:failure_code": (status == "FAILED") & lacks("failure_code"),
        "boolean:retryable": (status == "FAILED") & ~at("retryable").isin("true", "false"),
        "empty:reason_code": (status == "UNAVAILABLE") & lacks("reason_code"),
        "strings:missing_requirements": (status == "UNAVAILABLE") & (parsed.isNull() | (F.size(parsed) == 0) | F.exists(parsed, lambda x: x.isNull() | (x == ""))),
    }
    d = documents.withColumn("_d", F.from_json(column, "map<string,string>"))
    violation = F.coalesce(*[F.when(rule, F.lit(name)) for name, rule in rules.items()])
    return d.withColumn("violation", violation).withColumn("result", F.when(F.col("violation").isNull(), "ACCEPTED").otherwise("REJECTED")).drop("_d")


def validate_snapshots(documents: DataFrame, column: str = "document") -> DataFrame:
    """Snapshot documents as ACCEPTED or REJECTED: complete, hashes, a SUCCEEDED status, a rising period, counts, and a
    version that is made of its hashes."""
    fields = ["feature_set_hash", "input_market_set_hash", "batch_hash", "status", "period_start", "period_end", "member_count", "row_count", "version"]
    hashes = fields[:3]
    d = validate_documents(documents, fields, [], hashes, ["period_start", "period_end"], ["member_count", "row_count"], column)
    version = lambda at: F.concat_ws(":", F.lit("fmv1:b"), *[F.substring(at(h), 1, 16) for h in hashes])
    return _also(d, column, {"status": lambda at: at("status") != "SUCCEEDED", "period:not_rising": lambda at: at("period_end") <= at("period_start"), "version": lambda at: at("version") != version(at)})


def _also(validated: DataFrame, column: str, rules: dict) -> DataFrame:
    """validated with further rules, which are asked where it found no violation."""
    d = validated.withColumn("_d", F.from_json(column, "map<string,string>"))
    at = lambda k: F.col("_d")[k]
    violation = F.coalesce("violation", *[F.when(rule(at), F.lit(name)) for name, rule in rules.items()])
    return d.withColumn("violation", violation).withColumn("result", F.when(F.col("violation").isNull(), "ACCEPTED").otherwise("REJECTED")).drop("_d")
