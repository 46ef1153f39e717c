"""Bars of a stream, merged into partitions and published a revision a batch, with a ledger of the batches that are done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.keys import partition_start, shard_key
from barloom.operators import catalog, quality
from barloom.operators.merge import keep_last
from barloom.streaming.events import run_batches

_LEDGER = "batch long, revision int, status string, row_count long, partitions long, objects long, watermark timestamp"
_WHERE = ["partition_start", "shard_key"]


class Store:
    """Published bars under `path`: data/published=R by partition and shard, objects and manifests of each revision, ledger.

    A batch writes rows, then objects, then the manifest, then its line in the ledger. What it writes is named after the
    batch and it reads only revisions before its own, so a batch that was cut off anywhere writes the same again."""

    def __init__(self, spark: SparkSession, path: str, bars: T.StructType, granularity: str = "DAY", shards: int = 4, span_minutes: int = 60):
        self.spark, self.path, self.granularity, self.shards, self.span = spark, path, granularity, shards, span_minutes
        self.schema = T.StructType([*bars.fields, T.StructField("partition_start", T.DateType()), T.StructField("shard_key", T.StringType())])

    def _table(self, name: str, schema: str | T.StructType, number: str = "published int") -> DataFrame:
        """What revisions or batches have written so far; nothing at first."""
        parts = T._parse_datatype_string(number)
        whole = T.StructType([*(T._parse_datatype_string(schema) if isinstance(schema, str) else schema).fields, *parts.fields])
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return self.spark.createDataFrame([], whole)
        return self.spark.read.schema(whole).parquet(f"{self.path}/{name}")

    def ledger(self) -> DataFrame:
        return self._table("ledger", ", ".join(c for c in _LEDGER.split(", ") if c != "batch long"), "batch long").select(*[c.split()[0] for c in _LEDGER.split(", ")])

    def manifests(self) -> DataFrame:
        return self._table("manifests", "status string, dataset_hash string")

    def objects(self, before: int | None = None) -> DataFrame:
        """Objects of the last available revision (before the given one): where each partition's rows are, and what they hold."""
        good = self.manifests().where("status = 'AVAILABLE'")
        last = (good if before is None else good.where(F.col("published") < before)).agg(F.max("published").alias("published"))
        return self._table("objects", self._object_schema()).join(F.broadcast(last), "published").drop("published")  # one row

    def _object_schema(self) -> str:
        return "id string, data_revision int, partition_start date, partition_end date, shard_key string, partition_granularity string, row_count long, min_instrument_id string, max_instrument_id string, period_start timestamp, period_end timestamp, content_hash string"

    def rows(self, objects: DataFrame | None = None) -> DataFrame:
        """The bars of objects, by default of the last available revision. Partitions that are not among them are not read."""
        objects = self.objects() if objects is None else objects
        plain = T.StructType([f for f in self.schema.fields if f.name not in _WHERE])
        data = self._table("data", plain, "published int, partition_start date, shard_key string")
        wanted = objects.select(F.col("data_revision").alias("published"), *_WHERE)
        return data.join(wanted, ["published", *_WHERE], "left_semi").select(*[f.name for f in self.schema.fields])

    def publish(self, batch: DataFrame, number: int, before_ledger: Callable[[int], None] | None = None) -> None:
        """Merges a batch of bars (instrument_id, bar_start_at, revision and values) into the partitions that it touches.

        Of one bar the highest revision counts, stored or new. Partitions that are not touched keep their objects. A revision
        with an ERROR finding is QUARANTINED: it is kept, and later batches go on from the last available one."""
        done = self.ledger().where(F.col("batch") == number)
        if not done.isEmpty():
            return
        if batch.isEmpty():
            self._note(number, None, "NO_CHANGE")
            return
        revision = number + 1
        new = batch.withColumn("partition_start", partition_start(F.col("session_date_et"), self.granularity)).withColumn("shard_key", shard_key("instrument_id", self.shards))
        touched = new.select(*_WHERE).distinct()
        previous = self.objects(revision)
        stored = self.rows(previous.join(touched, _WHERE, "left_semi"))
        merged = keep_last(stored.unionByName(new.select(*stored.columns)), ["instrument_id", "bar_start_at"], "revision")
        merged.repartition(*_WHERE).sortWithinPartitions(*_WHERE, "instrument_id", "bar_start_at").write.mode("overwrite").partitionBy(*_WHERE).parquet(f"{self.path}/data/published={revision}")
        plain = T.StructType([f for f in self.schema.fields if f.name not in _WHERE])
        rows = self._table("data", plain, "published int, partition_start date, shard_key string").where(F.col("published") == revision).drop("published")
        stats = catalog.object_stats(rows, self.granularity, self.shards, self.span)
        made = stats.withColumn("id", F.concat_ws("/", F.lit(f"r{revision}"), "partition_start", "shard_key")).withColumn("data_revision", F.lit(revision))
        # Objects of the same partition and shard give way; the others of the revision before stay as they are.
        kept = previous.join(touched, _WHERE, "left_anti")
        objects = kept.select(*made.columns).unionByName(made)
        objects.write.mode("overwrite").parquet(f"{self.path}/objects/published={revision}")
        written = self._table("objects", self._object_schema()).where(F.col("published") == revision).drop("published")
        errors = quality.invalid_values(rows).where("severity = 'ERROR'")
        status = "AVAILABLE" if errors.isEmpty() and not written.isEmpty() else "QUARANTINED"
        digest = catalog.dataset_hash(written.withColumn("part_number", F.lit(1)), ["partition_granularity"]).select(F.lit(status).alias("status"), "dataset_hash")
        digest.write.mode("overwrite").parquet(f"{self.path}/manifests/published={revision}")
        if before_ledger:
            before_ledger(number)
        self._note(number, revision, status, batch)

    def _note(self, number: int, revision: int | None, status: str, batch: DataFrame | None = None) -> None:
        if batch is None:
            line = self.spark.createDataFrame([(None, status, 0, 0, 0, None)], "revision int, status string, row_count long, partitions long, objects long, watermark timestamp")
        else:
            new = batch.withColumn("partition_start", partition_start(F.col("session_date_et"), self.granularity))
            counts = new.agg(F.countDistinct("instrument_id", "bar_start_at").alias("row_count"), F.countDistinct("partition_start").alias("partitions"), F.max("bar_start_at").alias("watermark"))
            objects = self._table("objects", self._object_schema()).where(F.col("published") == revision).agg(F.count("*").alias("objects"))
            line = counts.crossJoin(objects).select(F.lit(revision).alias("revision"), F.lit(status).alias("status"), "row_count", "partitions", "objects", "watermark")  # one row each
        line.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ledger/batch={number}")


def flush_stream(bars: DataFrame, path: str, granularity: str = "DAY", shards: int = 4, span_minutes: int = 60, before_ledger: Callable[[int], None] | None = None) -> Store:
    """Runs a stream of accepted bars over what its source has now and publishes a revision for each batch; gives the store.

    bars: instrument_id, bar_start_at, session_date_et, open, high, low, close, volume, trade_count, revision. With the same
    path a stream goes on where it stopped."""
    store = Store(bars.sparkSession, path, bars.schema, granularity, shards, span_minutes)
    run_batches(bars, lambda batch, number: store.publish(batch, number, before_ledger), f"{path}/state")
    return store
