"""A corpus pipeline: documents in, token ids of a mix of deduplicated documents out. Each stage reads what the one before wrote.

Every stage takes null ids, texts, languages and sources, empty and very long texts, repeated rows, columns of any other
names and empty tables, as its docstring says; all but the last give the columns they got."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm import bpe, exact_dedup, jaccard, langid, mixing
from barloom.llm.common import written

#: A text stays if its best language has this mean share of its words.
LEAST_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without a letter, null and empty ones among them, and those of which no language has LEAST_SCORE.

    The model is fitted on labelled rows of docs that are not held out; without any, every document is rejected. Repeated
    rows stay or go together."""
    model = langid.fit(langid.sample(docs.where(~langid.held_out("doc_id")), "text", "lang"))
    return langid.keep_identified(docs, model, LEAST_SCORE)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id stays, a null text being empty and a null id the smallest; rows that repeat
    the kept id and text stay all."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their shingles the one with the smallest id stays; texts without words, null ones too, all stay.

    Rows that repeat an id are told apart by their texts."""
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, up to twice; texts without words are not taken. A null source is one."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, with digests of them and of the bytes that they decode to; a null text has none."""
    out = bpe.encode(docs, decoded=True)
    return out.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", drop_exact_copies),
    ("jaccard_join", drop_near_copies),
    ("mixing", mix_sources),
    ("byte_bpe", encode),
]

#: SQL cannot express the first, fourth and fifth stage; tests/llm compares the pipeline with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
