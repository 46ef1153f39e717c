"""An exact histogram of encoded lengths, and by its suffix sums the totals for every context limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm import bpe
from barloom.llm.common import written

#: Lengths that one task sums up; blocks of lengths are joined by the sums of the blocks after them.
BLOCK = 4096


def histogram(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", by: str | None = "source", path: str | None = None) -> DataFrame:
    """(by, length, n_docs): how many texts have each encoded length. Null and empty texts have length 0."""
    group = F.col(by).cast("string") if by else F.lit(None).cast("string")
    lengths = bpe.lengths(docs.select(group.alias("by"), F.col(text_column).alias("text")), "by", "text", path)
    return lengths.groupBy("by", F.col("n_tokens").alias("length")).agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame) -> DataFrame:
    """hist with, for each group and length: docs and tokens at or above it, tokens of texts cut to it, and its rank share.

    docs_at_least, tokens_at_least: of texts of this length or more. truncated_tokens: of all texts, each cut to this
    length, which is the answer for a context limit of this many tokens. share_up_to: of the texts, those of this length
    or less, so the quantile q is the least length whose share is q or more. Sums are over blocks of lengths first, then
    within each block, so no task holds more than BLOCK lengths of a group.
    """
    h = hist.withColumn("block", F.expr(f"length div {BLOCK}"))
    blocks = h.groupBy("by", "block").agg(F.sum("n_docs").alias("d"), F.sum(F.col("n_docs") * F.col("length")).alias("t"))
    up = Window.partitionBy("by").orderBy(F.desc("block"))
    later = up.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("by")
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        F.col("by").alias("_by"),
        F.col("block").alias("_block"),
        F.coalesce(F.sum("d").over(later), zero).alias("d_after"),
        F.coalesce(F.sum("t").over(later), zero).alias("t_after"),
        F.sum("d").over(whole).alias("d_all"),
        F.sum("t").over(whole).alias("t_all"),
    )
    h = h.join(blocks, F.col("by").eqNullSafe(F.col("_by")) & (F.col("block") == F.col("_block")))
    within = Window.partitionBy("by", "block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    docs = F.col("d_after") + F.sum("n_docs").over(within)
    tokens = F.col("t_after") + F.sum(F.col("n_docs") * F.col("length")).over(within)
    h = h.withColumn("docs_at_least", docs).withColumn("tokens_at_least", tokens)
    return h.select(
        "by",
        "length",
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        (F.col("t_all") - F.col("tokens_at_least") + F.col("docs_at_least") * F.col("length")).alias("truncated_tokens"),
        ((F.col("d_all") - F.col("docs_at_least") + F.col("n_docs")) / F.col("d_all")).alias("share_up_to"),
    )


def token_counts(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", by: str | None = "source", path: str | None = None) -> DataFrame:
    """suffix_sums() of histogram(), `by` under its own name. Rows of docs count each, repeated ones too; a null group is a group.

    Texts are encoded once: the histogram, a row for each group and length, is written. Null and empty texts have length
    0, texts of any length are encoded whole, no rows give no rows, and columns of docs other than the two are not read."""
    out = suffix_sums(written(histogram(docs, id_column, text_column, by, path), "histogram"))
    return out.withColumnRenamed("by", by) if by else out.drop("by")


def at_limits(sums: DataFrame, limits: DataFrame, by: str | None = "source") -> DataFrame:
    """For each row (limit) of limits and each group: tokens of all texts cut to the limit, and texts that are cut.

    The first length at or above the limit has what is needed: texts there and beyond give `limit` tokens each."""
    keys = [by] if by else []
    top = sums.groupBy(*keys).agg(F.max("tokens_at_least").alias("_all"), F.max("docs_at_least").alias("_docs"))
    pairs = top.crossJoin(F.broadcast(limits.select("limit").distinct()))  # groups times limits: both are small by meaning
    s = sums.withColumnsRenamed({k: f"_{k}" for k in keys})
    cond = F.col("length") > F.col("limit")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_{k}"))
    over = pairs.join(s, cond, "left").groupBy(*keys, "limit", "_all").agg(F.coalesce(F.max("docs_at_least"), F.lit(0).cast("long")).alias("cut_docs"), F.coalesce(F.max("tokens_at_least"), F.lit(0).cast("long")).alias("_over"))
    return over.select(*keys, "limit", (F.col("_all") - F.col("_over") + F.col("cut_docs") * F.col("limit")).alias("tokens"), "cut_docs")
