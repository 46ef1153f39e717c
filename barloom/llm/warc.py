"""A content-addressed WARC archive: payload bytes once by digest, record headers beside them, records rebuilt by joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import new_path, release, written

#: Payloads from this size on are stored as a response once and revisited by the others.
MIN_REVISIT_BYTES = 1000
#: Records of one digest that one copy of its payload serves when records are rebuilt.
RECORDS_A_COPY = 1000
#: pages has no time of capture; records of one archive share this one unless the caller has another.
DATE = "1970-01-01T00:00:00Z"

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = "\r\n\r\n"


def write_archive(pages: DataFrame, path: str, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", min_revisit: int = MIN_REVISIT_BYTES, date: str = DATE) -> None:
    """Writes path/payloads (sha256, payload: each distinct payload once) and path/headers (a row for each page).

    The payload is the html in UTF-8 (null: empty). Of records with equal payloads of at least min_revisit bytes the one
    with the largest id is a response and the others revisit it; smaller ones are all responses, and still share the
    stored bytes. The header text is kept exactly as it stands in the record. Ids identify pages: a repeated id with the
    same payload gives the same record again. A null id is smaller than any other, a null url has no WARC-Target-URI.
    Columns other than the three are not read.

    Only digests and ids are shuffled to find copies. Payloads go once through the scan that stores them; which rows
    store is an anti join with the repeats, which Spark broadcasts if it measures them as small.
    """
    html = F.coalesce(F.col(html_column).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"), html.alias("payload"))
    light = written(
        rows.select("id", "url", F.sha2("payload", 256).alias("sha256"), F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("payload_bytes")),
        "digests",
    )
    copies = light.groupBy("sha256").agg(F.max("id").alias("keep"), F.count("*").alias("n")).where("n > 1")
    kept = light.join(copies, "sha256", "left").withColumn("keep", F.coalesce("keep", "id"))
    repeats = kept.where(~F.col("id").eqNullSafe(F.col("keep"))).select("id", "sha256").distinct()
    stored = rows.withColumn("sha256", F.sha2("payload", 256))
    stored = stored.join(repeats, stored["id"].eqNullSafe(repeats["id"]) & (stored["sha256"] == repeats["sha256"]), "left_anti")
    stored.select("sha256", "payload").write.parquet(f"{path}/payloads")

    revisit = (F.col("payload_bytes") >= min_revisit) & ~F.col("id").eqNullSafe(F.col("keep"))
    kind = F.when(revisit, "revisit").otherwise("response")
    uri = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), kind),
        F.concat(F.lit("WARC-Record-ID: "), uri("id")),
        F.lit(f"WARC-Date: {date}"),
        F.concat(F.lit("WARC-Target-URI: "), F.regexp_replace(F.col("url"), "[\\r\\n]+", " ")),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1")),
        F.when(revisit, F.concat(F.lit("WARC-Refers-To: "), uri("keep"))),
        F.when(revisit, F.lit(f"WARC-Profile: {_PROFILE}")),
        F.lit("Content-Type: text/html; charset=utf-8"),
        F.concat(F.lit("Content-Length: "), F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
    ]
    kept.select(
        "id",
        "sha256",
        F.coalesce("n", F.lit(1).cast("long")).alias("sharers"),
        kind.alias("record_type"),
        F.when(revisit, F.col("keep")).alias("refers_to"),
        F.concat(F.concat_ws("\r\n", *lines), F.lit(_END)).alias("header"),
    ).write.parquet(f"{path}/headers")
    release(pages.sparkSession)


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, payload, payload_sha1, payload_bytes, verified): the stored bytes, digested anew as they are read.

    Rows of pages that repeat id and payload store the same bytes again; callers may read either."""
    return spark.read.parquet(f"{path}/payloads").select(
        "sha256",
        "payload",
        F.sha1("payload").alias("payload_sha1"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        (F.sha2("payload", 256) == F.col("sha256")).alias("verified"),
    )


def _copies(sharers: Column) -> Column:
    return F.ceil(sharers / F.lit(RECORDS_A_COPY)).cast("int")


def records(spark: SparkSession, path: str) -> DataFrame:
    """(id, sha256, record_type, refers_to, record, payload_sha1, payload_bytes, verified) of each record.

    record is the bytes of the WARC record as a file of records holds them: the stored header, the payload (empty for a
    revisit) and the end of a record, joined by digest; the last three columns tell of the payload in the store, which a
    revisit shares. Responses fetch their payload. A payload that more than RECORDS_A_COPY responses share is spread
    over as many copies. Revisits fetch digests alone.
    """
    headers = spark.read.parquet(f"{path}/headers")
    store = payloads(spark, path)
    about = store.select("sha256", "payload_sha1", "payload_bytes", "verified").dropDuplicates(["sha256"])
    revisits = headers.where("record_type = 'revisit'").withColumn("payload", F.lit(None).cast("binary")).join(about, "sha256")
    answers = headers.where("record_type = 'response'")
    # At most one digest in RECORDS_A_COPY; as a table, so that Spark knows its size when it picks the join.
    wide = written(answers.where(_copies(F.col("sharers")) > 1).groupBy("sha256").agg(F.max(_copies(F.col("sharers"))).alias("copies")), "wide")
    part = F.when(_copies(F.col("sharers")) > 1, F.pmod(F.xxhash64("id"), _copies(F.col("sharers")))).otherwise(F.lit(0)).cast("int")
    spread = store.join(wide, "sha256", "left").withColumn("part", F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1))).drop("copies")
    spread = spread.dropDuplicates(["sha256", "part"])
    responses = answers.withColumn("part", part).join(spread, ["sha256", "part"])
    out = responses.drop("part").unionByName(revisits)
    record = F.concat(F.col("header").cast("binary"), F.coalesce("payload", F.lit(b"")), F.lit(_END.encode()))
    return out.select("id", "sha256", "record_type", "refers_to", record.alias("record"), "payload_sha1", "payload_bytes", "verified")


def parsed(record: str = "record") -> dict[str, Column]:
    """Columns read from the bytes of a record: header, warc_type, digest, refers_to, length, block, and whether it is whole:
    a first line and an end as they must be, and as many bytes between them as Content-Length says."""
    raw = F.col(record)
    header = F.substring_index(raw.cast("string"), _END, 1)
    field = lambda name, what: F.regexp_extract(header, f"\r\n{name}: {what}", 1)
    length = field("Content-Length", "([0-9]+)").cast("long")
    begin = (F.octet_length(header) + len(_END)).cast("int")
    block = raw.substr(begin + 1, length.cast("int"))
    whole = header.startswith("WARC/1.1\r\n") & (F.octet_length(raw) == begin + length + len(_END)) & (F.right(raw.cast("string"), F.lit(len(_END))) == _END)
    return {
        "header": header,
        "warc_type": field("WARC-Type", "([a-z]+)"),
        "digest": field("WARC-Payload-Digest", "sha1:([0-9a-f]{40})"),
        "refers_to": F.nullif(field("WARC-Refers-To", "<urn:page:([^>]*)>"), F.lit("")),
        "length": length,
        "block": block,
        "whole": whole,
    }


def archive_pages(pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html", path: str | None = None) -> DataFrame:
    """Writes pages to an archive and reads its records back: (id, payload_bytes, payload_digest, record_type, refers_to).

    What is returned is parsed from the bytes of each rebuilt record. A record that is not whole, whose block does not
    have the digest in its header, or whose stored payload does not verify against its strong digest raises an error. No
    pages give no rows; nulls, repeated rows and other columns as in write_archive().
    """
    spark = pages.sparkSession
    path = path or new_path(spark, "archive")
    write_archive(pages, path, id_column, url_column, html_column)
    out = records(spark, path).withColumns({f"read_{k}": v for k, v in parsed().items()})
    own = F.when(F.col("read_warc_type") == "revisit", F.col("payload_sha1")).otherwise(F.sha1("read_block"))
    good = F.col("verified") & F.col("read_whole") & (F.col("read_digest") == own) & (F.col("read_warc_type") == F.col("record_type"))
    digest = F.when(good, F.col("read_digest")).otherwise(F.raise_error(F.lit("a record or a stored payload does not match its digest")))
    size = F.when(F.col("read_warc_type") == "revisit", F.col("payload_bytes")).otherwise(F.col("read_length"))
    return out.select(
        F.col("id").alias(id_column),
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        F.col("read_warc_type").alias("record_type"),
        F.col("read_refers_to").cast(pages.schema[id_column].dataType).alias("refers_to"),
    )
