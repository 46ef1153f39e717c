"""Mixing sources to target weights by pivotal dependent rounding over a reduction tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import WORD, written

WEIGHTS = (5.0, 2.0, 1.0)
#: Of all sizes, the share that the mix takes; and how often a source may be repeated.
SHARE, MAX_REPEAT = 1.5, 2.0
#: Documents that one group of the first round rounds among themselves, and groups that meet in one node of the tree.
GROUP, FAN_IN = 4096, 16


def sizes(docs: DataFrame, text_column: str = "text"):
    return F.coalesce(F.regexp_count(F.col(text_column), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(by_source: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_REPEAT) -> DataFrame:
    """(source, source_size, target) from (source, source_size).

    Weights are dealt to the sources by code point, null last. A target is weight times a common level, or `most` times
    the source's size where that is less; the level is the one at which targets add up to `share` of all sizes. It is
    found from running sums over the sources in the order in which they reach their limit. The table has a row for each
    source and no more.
    """
    n = len(weights)
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % n + 1).cast("int"))
    s = by_source.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    s = (
        s.withColumn("want", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("caps_before", F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("weights_from", F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (F.col("want") - F.col("caps_before")) / F.col("weights_from"))
    )
    # The level holds where the source that is next to reach its limit does not reach it.
    s = s.withColumn("the_level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("caps_before", "level"))).over(everything)["level"])
    target = F.when(F.col("the_level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("the_level") * F.col("weight")))
    return s.select("source", "source_size", target.alias("target"))


def _uniform(ids: np.ndarray, salt: np.ndarray, seed: int) -> np.ndarray:
    x = ids.astype(np.int64).view(np.uint64) + np.uint64(seed) * np.uint64(0x9E3779B97F4A7C15) + salt.astype(np.int64).view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    for c in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(c)
    return (x ^ (x >> np.uint64(31))) / 2.0**64


def pivot(p: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Rounds the probabilities p one against the next until at most one is not 0 or 1; their sum stays.

    Of two fractions a and b: if a + b < 1, one takes all and the other becomes 0; else one becomes 1 and the other
    keeps a + b - 1. Which one is drawn so that each keeps its expectation.
    """
    p, eps = p.copy(), 1e-12
    open_ = -1
    for i in range(len(p)):
        if p[i] <= eps or p[i] >= 1 - eps:
            p[i] = round(p[i])
            continue
        if open_ < 0:
            open_ = i
            continue
        a, b = p[open_], p[i]
        s = a + b
        if s < 1:
            first = u[i] < a / s
            p[open_], p[i] = (s, 0.0) if first else (0.0, s)
        else:
            first = u[i] < (1 - b) / (2 - s)
            p[open_], p[i] = (1.0, s - 1) if first else (s - 1, 1.0)
        if p[open_] <= eps or p[open_] >= 1 - eps:
            p[open_] = round(p[open_])
            open_ = i if eps < p[i] < 1 - eps else -1
        if open_ != i:
            p[i] = round(p[i]) if p[i] <= eps or p[i] >= 1 - eps else p[i]
    return p


_NODE = T.StructType([T.StructField("rank", T.LongType()), T.StructField("node", T.LongType()), T.StructField("key", T.LongType()), T.StructField("size", T.LongType()), T.StructField("p", T.DoubleType())])


def _round_groups(seed: int):
    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table["key"].to_numpy(), table["size"].to_numpy()))
        table = table.take(pa.array(order))
        key = table["key"].to_numpy()
        p = pivot(table["p"].to_numpy(), _uniform(key, table["node"].to_numpy() + np.int64(1), seed))
        return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))

    return run


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MAX_REPEAT,
    seed: int = 1,
) -> DataFrame:
    """One row for each row of docs: id, size, source_size, target, copies, taken (= copies * size).

    Every document of a source gets target / source_size copies on average: the whole part for certain, the fraction by
    pivotal rounding, so the number of copies that a source takes is fixed up to one and documents of a source whose
    sizes are alike are set off against each other. Fractions are rounded in groups of about GROUP documents of a
    source (split by hash, so a source with a third of all rows is many groups); each group leaves one fraction at
    most, and these meet FAN_IN at a time up a tree until each source has one, which is drawn. Draws depend on id, text,
    source and seed alone, so reruns agree. Sizes count words; a null or empty text has size 0 and takes 0; a null source
    is a source, null ids are drawn by their text. Rows that repeat id, text and source are one draw, and each takes the
    same. Whole texts are counted; no rows give no rows; columns other than the three are not read. The table of sources
    goes through windows without a key, in one task: it has a row for each source, not for each document.
    """
    out = _drawn(docs, id_column, text_column, source_column, weights, share, most, seed)
    return out.select(F.col("id").alias(id_column), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def _key(docs: DataFrame, id_column: str, text_column: str, source_column: str):
    """Tells rows apart that have one id but other texts or sources."""
    return F.xxhash64(docs[id_column], docs[text_column], docs[source_column])


def _drawn(docs: DataFrame, id_column: str, text_column: str, source_column: str, weights: tuple[float, ...], share: float, most: float, seed: int) -> DataFrame:
    """(id, key, size, source_size, target, copies) of each row of docs."""
    rows = written(
        docs.select(F.col(id_column).alias("id"), F.col(source_column).cast("string").alias("source"), sizes(docs, text_column).alias("size"), _key(docs, id_column, text_column, source_column).alias("key")),
        "sizes",
    )
    by_source = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    wanted = targets(by_source.drop("n"), weights, share, most)
    n = by_source.select(F.col("source").alias("_source"), "n")
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())).cast("long")
    per = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    table = written(
        wanted.join(n, F.col("source").eqNullSafe(F.col("_source"))).drop("_source").withColumn("rank", rank).withColumn("per", per).withColumn("groups", F.ceil(F.col("n") / F.lit(GROUP)).cast("long")),
        "targets",
    )
    placed = rows.join(table.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    fraction = F.col("per") - F.floor("per")
    leaves = placed.where((F.col("size") > 0) & (fraction > 0)).select("rank", F.pmod("key", F.col("groups")).alias("node"), "key", "size", fraction.alias("p")).distinct()
    rounded = written(leaves.groupBy("rank", "node").applyInArrow(_round_groups(seed), _NODE), "rounded")
    is_open = (F.col("p") > 0) & (F.col("p") < 1)
    done, left = [rounded.where(~is_open)], rounded.where(is_open)
    width = table.agg(F.max("groups")).head()[0] or 1
    while width > 1:
        left = left.withColumn("node", F.expr(f"node div {FAN_IN}"))
        step = written(left.groupBy("rank", "node").applyInArrow(_round_groups(seed), _NODE), "node")
        done.append(step.where(~is_open))
        left, width = step.where(is_open), -(-width // FAN_IN)
    last = F.col("p") > (F.pmod(F.xxhash64("key", F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30)))
    done.append(left.withColumn("p", F.when(last, 1.0).otherwise(0.0)))
    drawn = done[0]
    for more in done[1:]:
        drawn = drawn.unionByName(more)
    extra = drawn.where("p = 1").select(F.col("rank"), F.col("key"), F.lit(1).cast("long").alias("extra"))
    out = placed.join(extra, ["rank", "key"], "left")
    copies = F.when(F.col("size") > 0, F.floor("per").cast("long") + F.coalesce("extra", F.lit(0).cast("long"))).otherwise(F.lit(0).cast("long"))
    return out.select("id", "key", "size", "source_size", "target", copies.alias("copies"))


def mixed_documents(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MAX_REPEAT, seed: int = 1) -> DataFrame:
    """docs as the mix has them: each row as often as mix() takes it, all its columns as they are, whatever their names.

    Rows of one id with other texts or sources are each taken as often as they are drawn; nulls, empty texts and empty
    tables as in mix()."""
    took = _drawn(docs, id_column, text_column, source_column, weights, share, most, seed).where("copies > 0")
    own, key, n = (f"{x}_{'_'.join(docs.columns)}" for x in ("own", "key", "copies"))  # longer than any name of docs
    took = took.select(F.col("id").alias(own), F.col("key").alias(key), F.col("copies").cast("int").alias(n)).distinct()
    joined = docs.join(took, docs[id_column].eqNullSafe(took[own]) & (_key(docs, id_column, text_column, source_column) == took[key]))
    return joined.withColumn(own, F.explode(F.sequence(F.lit(1), F.col(n)))).select(*docs.columns)
