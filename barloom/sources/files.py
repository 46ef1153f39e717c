"""Readers and writers of bars, pages, catalogs and feature series. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.functions.keys import session_date_et, shard_key
from barloom.functions.values import sha256
from barloom.operators.merge import keep_last, latest_n

_REQUIRED = [("instrument_id", "string"), ("provider_symbol", "string"), ("bar_start_at", "timestamp"), ("session_date_et", "date"), ("open", "double"), ("high", "double"), ("low", "double"), ("close", "double"), ("volume", "bigint")]
_OPTIONAL = [("trade_count", "bigint"), ("vwap", "double")]
_TYPES = {"string": T.StringType(), "timestamp": T.TimestampType(), "date": T.DateType(), "double": T.DoubleType(), "bigint": T.LongType()}
BAR_SCHEMA = T.StructType([T.StructField(n, _TYPES[t]) for n, t in _REQUIRED + _OPTIONAL])
DERIVED_SCHEMA = T.StructType(BAR_SCHEMA.fields + [T.StructField("source_minutes", T.ShortType())])
#: Fixed value: days of history that a timeframe's projection looks back.
LOOKBACK_DAYS = {"30m": 120, "1h": 240, "4h": 600, "1d": 900}


def bar_scan(spark: SparkSession, *paths: str, derived: bool = False) -> DataFrame:
    """Bars of the fixed schema; a null where none may be raises an error, as files cannot promise it."""
    df = spark.read.schema(DERIVED_SCHEMA if derived else BAR_SCHEMA).parquet(*paths)
    need = [n for n, _ in _REQUIRED] + ["source_minutes"] * derived
    return df.select(*[F.coalesce(F.col(c), F.raise_error(F.lit(f"null in {c}")).cast(df.schema[c].dataType)).alias(c) if c in need else F.col(c) for c in df.columns])


def projected_scan(spark: SparkSession, paths: list[str], columns: list[str], predicate: Column | None = None) -> DataFrame:
    """Some columns of some rows; both reach the scan."""
    df = spark.read.schema(BAR_SCHEMA).parquet(*paths)
    return (df.where(predicate) if predicate is not None else df).select(*columns)


def schema_mismatch(df: DataFrame, derived: bool = False) -> list[str]:
    """Names of columns that are missing, of another type, or not in the schema; empty if names and types agree."""
    want = {f.name: f.dataType for f in (DERIVED_SCHEMA if derived else BAR_SCHEMA).fields}
    have = {f.name: f.dataType for f in df.schema.fields}
    return sorted(k for k in want.keys() | have.keys() if want.get(k) != have.get(k))


def legacy_scan(spark: SparkSession, path: str, columns: str) -> DataFrame:
    """A CSV or Parquet file keyed by symbol and timestamp; columns: DDL of what it holds."""
    schema = T.StructType.fromDDL(columns)
    lacking = {"symbol", "timestamp"} - set(schema.names)
    if lacking:
        raise ValueError(f"key columns are missing: {sorted(lacking)}")
    text = path.rstrip("/").endswith((".csv", ".csv.gz"))
    return spark.read.schema(schema).option("header", True).csv(path) if text else spark.read.schema(schema).parquet(path)


def parse_mixed_timestamp(df: DataFrame, column: str, out: str = "bar_start_at") -> DataFrame:
    """Text that is ISO 8601 or a number since 1970, one kind for the whole column, as an instant.

    A number's unit follows from the median of their sizes: below 1e11 seconds, 1e14 milliseconds, 1e17 microseconds, else
    nanoseconds. The median is not looked for: counts, least and largest sizes of the four classes tell where it lies, and
    one aggregate over the column gives them. Text that is neither becomes null."""
    n = F.col(column).try_cast("decimal(38,9)")
    size = F.abs(n.cast("double"))
    limits = [0.0, 1e11, 1e14, 1e17, float("inf")]
    inside = [(size >= a) & (size < b) for a, b in zip(limits, limits[1:])]
    parts = [x for k, c in enumerate(inside) for x in (F.count_if(c).alias(f"n{k}"), F.min(F.when(c, size)).alias(f"lo{k}"), F.max(F.when(c, size)).alias(f"hi{k}"))]
    facts = df.agg(F.count_if(n.isNull() & F.col(column).isNotNull()).alias("texts"), *parts).head()
    total = sum(facts[f"n{k}"] for k in range(4))
    if facts["texts"] or not total:
        return df.withColumn(out, F.expr(f"try_to_timestamp(`{column}`)"))
    upto = lambda rank: next(k for k in range(4) if sum(facts[f"n{j}"] for j in range(k + 1)) > rank)
    low, high = upto((total - 1) // 2), upto(total // 2)  # classes of the middle value, or of the two
    middle = low if low == high else next(k for k in range(4) if (facts[f"hi{low}"] + facts[f"lo{high}"]) / 2 < limits[k + 1])
    per_micro = {0: 1_000_000, 1: 1_000, 2: 1}.get(middle)
    micros = n * F.lit(per_micro) if per_micro else n / F.lit(1000)
    return df.withColumn(out, F.timestamp_micros(F.floor(micros).cast("bigint")))


def normalize(raw: DataFrame, instruments: DataFrame, arrival: str | Column) -> DataFrame:
    """Provider rows (symbol, timestamp, OHLCV, perhaps trade_count and vwap) as bars; the last arrival of a key counts.

    Required values that are no numbers raise an error, optional ones become null. Unmapped symbols are left out."""
    optional = [(F.col(n).try_cast(t) if n in raw.columns else F.lit(None).cast(t)).alias(n) for n, t in _OPTIONAL]
    j = raw.join(instruments.select(F.col("provider_symbol").alias("symbol"), "instrument_id"), "symbol")
    cols = [F.col(n).cast(t).alias(n) for n, t in _REQUIRED[4:]]
    rows = j.select("instrument_id", F.col("symbol").alias("provider_symbol"), F.col("timestamp").cast("timestamp").alias("bar_start_at"), *cols, *optional, (F.col(arrival) if isinstance(arrival, str) else arrival).alias("_arrival"))
    out = keep_last(rows, ["instrument_id", "bar_start_at"], "_arrival").withColumn("session_date_et", session_date_et("bar_start_at"))
    return out.select(*BAR_SCHEMA.names)


def explode_bar_pages(pages: DataFrame, column: str = "page") -> tuple[DataFrame, DataFrame]:
    """(bars, rejects) of provider pages {"bars": {symbol: [{t,o,h,l,c,v,n,vw}]}}; n and vw that are absent stay null."""
    bar = "struct<t:timestamp,o:double,h:double,l:double,c:double,v:bigint,n:bigint,vw:double>"
    doc = pages.select(F.from_json(column, f"bars map<string,array<{bar}>>").alias("d"))
    rows = doc.select(F.explode("d.bars").alias("symbol", "list")).select("symbol", F.explode("list").alias("b"))
    rows = rows.select("symbol", F.col("b.t").alias("timestamp"), F.col("b.o").alias("open"), F.col("b.h").alias("high"), F.col("b.l").alias("low"), F.col("b.c").alias("close"), F.col("b.v").alias("volume"), F.col("b.n").alias("trade_count"), F.col("b.vw").alias("vwap"))
    ok = F.lit(True)
    for c in ("timestamp", "open", "high", "low", "close", "volume"):
        ok = ok & F.col(c).isNotNull()
    return rows.where(ok), rows.where(~ok)


def write_bars(bars: DataFrame, path: str, shards: int = 16, most: int | None = None) -> None:
    """Bars under year and shard, each file in the order of instrument and time, uncompressed and without dictionary.

    One shuffle by year and shard; with `most`, rows go to files of at most so many by parts of the time, so that a large
    shard is many tasks. A partition that is written again replaces itself."""
    b = bars.withColumn("year", F.year("session_date_et")).withColumn("shard", shard_key("instrument_id", shards))
    keys = ["year", "shard"]
    if most:
        before = F.sum("_rows").over(Window.partitionBy("year", "shard").orderBy("bar_start_at"))
        instants = b.groupBy("year", "shard", "bar_start_at").agg(F.count("*").alias("_rows")).withColumn("_part", F.floor((before - 1) / most)).drop("_rows")
        b = b.join(instants, ["year", "shard", "bar_start_at"])
        keys.append("_part")
    b = b.repartition(*keys).sortWithinPartitions("year", "shard", "instrument_id", "bar_start_at").drop("_part")
    options = {"compression": "none", "parquet.enable.dictionary": "false", "partitionOverwriteMode": "dynamic"}
    b.write.mode("overwrite").options(**options).partitionBy("year", "shard").parquet(path)


def staging_write(bars: DataFrame, path: str, price_type: str, chunk: str, shards: int = 16) -> None:
    """Rows of one fetched chunk under price type, year and shard; a chunk that comes again replaces itself."""
    b = bars.withColumn("price_type", F.lit(price_type)).withColumn("year", F.year("session_date_et")).withColumn("shard", shard_key("instrument_id", shards)).withColumn("chunk", F.lit(chunk))
    b.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("price_type", "year", "shard", "chunk").parquet(path)


def migrate_legacy(files: DataFrame, instruments: DataFrame, path_column: str = "path") -> tuple[DataFrame, DataFrame]:
    """(rows with their instrument, unmapped symbols) for rows that carry the file they come from.

    The symbol is the file's name; it is looked up with - as ., then as it is. The map is joined as a table."""
    name = F.regexp_extract(path_column, "([^/]+?)(_[^/_]*)?[.](parquet|csv)$", 1)
    i = instruments.select(F.col("provider_symbol").alias("_s"), "instrument_id")
    tries = F.array(F.translate(name, "-", "."), name)
    f = files.select(path_column).distinct().select(path_column, name.alias("symbol"), F.posexplode(tries).alias("_k", "_s"))
    found = f.join(i, "_s").groupBy(path_column, "symbol").agg(F.min_by("instrument_id", "_k").alias("instrument_id"))
    lost = f.select(path_column, "symbol").distinct().join(found.select(path_column), path_column, "left_anti").withColumn("code", F.lit("UNMAPPED_INSTRUMENT"))
    return files.join(found, path_column), lost


def write_series(values: DataFrame, path: str, shards: int = 64) -> None:
    """Feature values by definition and shard, each file in order of instrument and time: the number of files does not grow
    with the instruments, and one instrument is a few row groups of one file."""
    v = values.withColumn("shard", shard_key("instrument_id", shards)).repartition("definition_id", "shard")
    v = v.sortWithinPartitions("definition_id", "shard", "instrument_id", "bar_start_at")
    v.write.option("compression", "zstd").partitionBy("definition_id", "shard").parquet(path)


def series_facts(values: DataFrame) -> DataFrame:
    """(definition_id, instrument_id, increasing) of a series as it was written: whether its instants only rise."""
    w = Window.partitionBy("definition_id", "instrument_id").orderBy("bar_start_at")
    v = values.withColumn("_up", F.col("bar_start_at") > F.lag("bar_start_at").over(w))
    return v.groupBy("definition_id", "instrument_id").agg(F.coalesce(F.bool_and("_up"), F.lit(True)).alias("increasing"))


def history_documents(bars: DataFrame, timeframe: str, n: int, now: str) -> DataFrame:
    """For each instrument a JSON list of its last n bars inside the timeframe's look-back, oldest first."""
    since = F.lit(now).cast("timestamp") - F.expr(f"INTERVAL {LOOKBACK_DAYS[timeframe]} DAYS")
    rows = latest_n(bars.where((F.col("bar_start_at") >= since) & (F.col("bar_start_at") <= F.lit(now).cast("timestamp"))), "instrument_id", n)
    entry = F.struct(F.unix_timestamp("bar_start_at").alias("t"), "open", "high", "low", "close", "volume")
    return rows.groupBy("instrument_id").agg(F.count("*").alias("bars"), F.to_json(F.array_sort(F.collect_list(entry))).alias("document"))


def catalog_scan(spark: SparkSession, path: str, schema: str, **where: object) -> DataFrame:
    """Records of a catalog table, one JSON object a line, with equality filters."""
    df = spark.read.schema(schema).json(path)
    for k, v in where.items():
        df = df.where(F.col(k).eqNullSafe(F.lit(v)))
    return df


def instrument_export(rows: DataFrame, symbols: DataFrame, cutoff: str) -> DataFrame:
    """(symbol, instrument_id) of instruments that every manifest has, with the symbol in force at the cutoff."""
    from barloom.operators.catalog import instruments_in_all
    from barloom.operators.reference import symbol_at

    both = instruments_in_all(rows).withColumn("_at", F.lit(cutoff).cast("date"))
    return symbol_at(both, symbols, "_at").where("symbol IS NOT NULL").select("symbol", "instrument_id")


def requirement_coverage(observations: DataFrame, required: DataFrame) -> DataFrame:
    """(requirement, instrument_id, observed, required, covered) for each required pair.

    observations: requirement, instrument_id, one row each; required: the pair and `required`."""
    n = observations.groupBy("requirement", "instrument_id").agg(F.count("*").alias("observed"))
    j = required.join(n, ["requirement", "instrument_id"], "left").withColumn("observed", F.coalesce("observed", F.lit(0).cast("long")))
    return j.withColumn("covered", F.col("observed") >= F.col("required"))


def warmup_series(events: DataFrame, requirements: DataFrame) -> DataFrame:
    """For each requirement and instrument its last `required` observations as one list, and a hash of it.

    events: instrument_id, bar_start_at, close. requirements: requirement, required."""
    n = Window.partitionBy("instrument_id").orderBy(F.desc("bar_start_at"))
    most = requirements.agg(F.max("required").alias("_most"))
    last = events.withColumn("_n", F.row_number().over(n)).join(F.broadcast(most), F.col("_n") <= F.col("_most")).drop("_most")  # one row
    rows = last.join(F.broadcast(requirements), F.col("_n") <= F.col("required"))  # requirements are a short list
    series = F.to_json(F.array_sort(F.collect_list(F.struct(F.unix_timestamp("bar_start_at").alias("t"), F.col("close").alias("c")))))
    out = rows.groupBy("requirement", "instrument_id").agg(F.count("*").alias("observed"), series.alias("series"))
    return out.withColumn("series_hash", sha256(F.col("series")))


def storage_profile(objects: DataFrame) -> DataFrame:
    """By granularity: objects, parts, rows, and least, mean and largest size. objects: partition_granularity, part_number, row_count, byte_size."""
    return objects.groupBy("partition_granularity").agg(
        F.count("*").alias("objects"), F.countDistinct("part_number").alias("parts"), F.sum("row_count").alias("row_count"), F.min("byte_size").alias("min_bytes"), F.avg("byte_size").alias("mean_bytes"), F.max("byte_size").alias("max_bytes")
    )


def latest_published(bars: DataFrame) -> DataFrame:
    """(instrument_id, year, latest): for each instrument and year its last bar start in the year, or else in the year
    before; no row for a year where neither has bars. Bars without a session date are in no year."""
    of = bars.where("session_date_et IS NOT NULL").groupBy("instrument_id", F.year("session_date_et").cast("long").alias("of")).agg(F.max("bar_start_at").alias("last"))
    seen = of.withColumn("year", F.explode(F.array("of", F.col("of") + 1)))
    return seen.groupBy("instrument_id", "year").agg(F.max_by("last", "of").alias("latest"))


class DayStore:
    """Bars in folders by price type, resolution and session date, which are replaced a folder at a time."""

    PARTS = ["price_type", "resolution", "session_date_et"]

    def __init__(self, spark: SparkSession, path: str, bars: T.StructType):
        """bars: the fields of a bar; those that name folders are added."""
        self.spark, self.path = spark, path
        parts = [T.StructField("price_type", T.StringType()), T.StructField("resolution", T.StringType()), T.StructField("session_date_et", T.DateType())]
        self.schema = T.StructType([*[f for f in bars.fields if f.name not in self.PARTS], *parts])

    def _folder(self, *names: str):
        path = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def read(self, price_type: str, resolution: str | None = None, days: list | None = None) -> DataFrame:
        """Bars of a price type; with a resolution or days only their folders are listed for the scan."""
        path, fs = self._folder()
        if not fs.exists(path):
            return self.spark.createDataFrame([], self.schema)
        out = self.spark.read.schema(self.schema).parquet(self.path).where(F.col("price_type") == price_type)
        out = out if resolution is None else out.where(F.col("resolution") == resolution)
        return out if days is None else out.where(F.col("session_date_et").isin(days))

    def replace(self, rows: DataFrame) -> None:
        """Writes rows in place of the folders that they fall into; all others stay."""
        rows = rows.select(*[f.name for f in self.schema.fields]).repartition(*self.PARTS).sortWithinPartitions(*self.PARTS, "instrument_id", "bar_start_at")
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*self.PARTS).parquet(self.path)

    def drop(self, price_type: str, resolution: str, day) -> None:
        path, fs = self._folder(f"price_type={price_type}", f"resolution={resolution}", f"session_date_et={day}")
        fs.delete(path, True)
