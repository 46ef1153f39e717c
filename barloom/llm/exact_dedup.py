"""Exact dedup by an extendible-hash index whose files lie in the shared folder."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import n_partitions, text_or_empty, written

#: Distinct hashes that a bucket holds before it splits.
CAPACITY = 2048
#: Rows of a hash with this share of all rows meet their entry by a broadcast: there are at most 1 / HOT_SHARE of them.
HOT_SHARE = 1 / 512


def _cell(depth: int) -> Column:
    return F.expr(f"shiftrightunsigned(hash, {64 - depth})")


def directory(hashes: DataFrame, capacity: int = CAPACITY) -> tuple[int, DataFrame]:
    """The directory that repeated doubling ends in: its depth, and (cell, bucket, local_depth, n_entries).

    hashes has a row for each distinct 64-bit hash. A bucket is a prefix of the hash. Doubling gives every prefix one bit
    more, and each bucket that is over its capacity splits by that bit; cells that share a bucket point to the same one.
    A split at depth d only asks how many entries each prefix of d bits has, so all doublings are one aggregate over the
    cells: a prefix is a bucket when it fits and the prefix before it did not. The depth grows until every cell fits.
    """
    total = hashes.count()
    depth = min(63, max(1, math.ceil(math.log2(max(1, total) / capacity + 1)) + 2))
    while True:
        cells = hashes.groupBy(_cell(depth).alias("cell")).agg(F.count("*").alias("n"))
        if depth == 63 or (cells.agg(F.max("n")).head()[0] or 0) <= capacity:
            break
        depth = min(63, depth + 2)
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("depth"))
    prefix = F.expr(f"shiftright(cell, {depth} - depth)")
    prefixes = levels.groupBy("depth", prefix.alias("prefix")).agg(F.sum("n").alias("n"))
    parent = prefixes.select((F.col("depth") + 1).alias("depth"), F.col("prefix").alias("up"), F.col("n").alias("n_up"))
    leaves = (
        prefixes.withColumn("up", F.expr("shiftright(prefix, 1)"))
        .join(parent, ["depth", "up"], "left")
        .where(((F.col("n") <= capacity) | (F.col("depth") == depth)) & (F.col("n_up").isNull() | (F.col("n_up") > capacity)))
        .select("depth", "prefix", "n")
    )
    pointers = levels.select("cell", "depth", prefix.alias("prefix")).join(leaves, ["depth", "prefix"])
    return depth, pointers.select(
        "cell",
        F.concat_ws("-", "depth", "prefix").alias("bucket"),
        F.col("depth").alias("local_depth"),
        F.col("n").alias("n_entries"),
    )


def hash_of(text: Column) -> Column:
    return F.xxhash64(text)


class Index:
    """The index of a table of texts: `rows` (id, hash, text_sha256), the `directory` with its `depth`, and `buckets`.

    buckets, in files by owner and sorted by bucket and hash, has a row for each distinct text: bucket, hash, chain (its
    place among the texts of one hash), chain_length, keep_id, group_size, and the text itself where the chain has more
    than one, as only there a look-up must compare bytes."""

    def __init__(self, docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, hash_of=hash_of):
        spark = docs.sparkSession
        text = text_or_empty(text_column)
        self.docs, self.text, self.hash_of = docs.select(F.col(id_column).alias("id"), text.alias("text")), text, hash_of
        self.rows = written(self.docs.select("id", hash_of(F.col("text")).alias("hash"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")), "rows")
        hashes = written(self.rows.groupBy("hash").agg(F.count("*").alias("n")), "hashes")
        total = hashes.agg(F.sum("n")).head()[0] or 0
        #: At most 1 / HOT_SHARE rows.
        self.hot = written(hashes.where(F.col("n") >= max(2, math.ceil(total * HOT_SHARE))).select("hash"), "hot")
        self.depth, cells = directory(hashes, capacity)
        self.directory = written(cells, "directory")
        self.buckets = self._insert(n_partitions(spark))

    def placed(self, rows: DataFrame) -> DataFrame:
        """rows, which have a hash, with the bucket that the directory points to."""
        return rows.withColumn("cell", _cell(self.depth)).join(self.directory.select("cell", "bucket"), "cell").drop("cell")

    def _insert(self, owners: int) -> DataFrame:
        rows = self.docs.withColumn("hash", self.hash_of(F.col("text")))
        # Copies are merged where they are read and then by hash, whatever their number: the least and the greatest text
        # of a hash are one text exactly when all its bytes agree.
        by_hash = rows.groupBy("hash").agg(F.min("text").alias("low"), F.max("text").alias("high"), F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        merged = written(by_hash.select("hash", (F.col("low") == F.col("high")).alias("one_text"), "keep_id", "group_size"), "merged")
        single = merged.where("one_text").select("hash", F.lit(1).alias("chain"), F.lit(1).cast("long").alias("chain_length"), F.lit(None).cast("string").alias("text"), "keep_id", "group_size")
        # Hashes with several texts: the chain has each of them, told apart by their bytes.
        chained = rows.join(merged.where("not one_text").select("hash"), "hash", "left_semi").groupBy("hash", "text").agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size"))
        chain = Window.partitionBy("hash")
        chained = chained.withColumn("chain_length", F.count("*").over(chain)).withColumn("chain", F.row_number().over(chain.orderBy("text")))
        entries = single.unionByName(chained)
        owned = self.placed(entries).repartition(owners, "bucket").sortWithinPartitions("bucket", "hash")
        return written(owned.select("bucket", "hash", "chain", "chain_length", "text", "keep_id", "group_size"), "buckets")

    def look_up(self) -> DataFrame:
        """(id, hash, text_sha256, keep_id, group_size) of every row that was put in.

        A hash with one text needs no comparison, as the row is in the index; where a chain is longer the row's bytes
        are compared with its texts. Rows of hot hashes meet their entries by a broadcast of bounded size."""
        found = ["id", "hash", "text_sha256", "keep_id", "group_size"]
        single = self.buckets.where("chain_length = 1").drop("text", "chain")
        hot = F.broadcast(self.hot)
        busy = self.rows.join(F.broadcast(single.join(hot, "hash", "left_semi").drop("bucket")), "hash").select(*found)
        rest = self.placed(self.rows.join(hot, "hash", "left_anti")).join(single, ["bucket", "hash"]).select(*found)
        out = busy.unionByName(rest)
        chained = self.buckets.where("chain_length > 1")
        if chained.isEmpty():
            return out
        rows = self.placed(self.docs.withColumn("hash", self.hash_of(F.col("text"))).join(chained.select("hash").distinct(), "hash", "left_semi"))
        rows = rows.withColumn("text_sha256", F.sha2(F.col("text").cast("binary"), 256))
        return out.unionByName(rows.join(chained, ["bucket", "hash", "text"]).select(*found))


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, hash_of=hash_of) -> DataFrame:
    """One row for each row of docs: id, keep_id, group_size, kept, text_sha256.

    Equal texts (byte by byte; null is the empty text) form a group, and its row with the largest id stays. Rows that
    repeat an id with the same text count each in group_size and are all kept or all dropped; an id of null is smaller
    than any other, and a group with no id has keep_id null and keeps its rows. No rows give no rows. Other columns of
    docs are not read, so their names cannot clash; texts of any length are whole in one row.
    """
    found = Index(docs, id_column, text_column, capacity, hash_of).look_up()
    return found.select(F.col("id").alias(id_column), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """docs without the rows that exact_duplicates() drops; of rows that repeat the kept id and text, all stay.

    All columns of docs stay as they are, whatever their names; nulls, empty texts and empty tables as above."""
    out = exact_duplicates(docs, id_column, text_column)
    names = [f"gone_{k}_{'_'.join(docs.columns)}" for k in (1, 2)]  # longer than any name of docs
    dropped = out.where(~F.col("kept")).select(F.col(id_column).alias(names[0]), F.col("text_sha256").alias(names[1])).distinct()
    sha = F.sha2(text_or_empty(text_column).cast("binary"), 256)
    return docs.join(dropped, docs[id_column].eqNullSafe(dropped[names[0]]) & (sha == dropped[names[1]]), "left_anti")
