r"""A content-addressed WARC archive.

`write_archive` turns page rows into WARC/1.1 records and stores them in two tables:
* `payloads`: every distinct payload of a response once, keyed by its SHA-256, in whole bytes;
* `headers`: one row per record with the exact bytes of its header block and the digest.

Of the pages with equal payloads of at least `shortest` bytes the one with the smallest page_id becomes a
`response`, the others are `revisit` records that refer to it; shorter payloads are stored with
every digest once as well, but all their records are responses. `read_archive` parses the
header blocks, checks each payload against its digest, joins both and checks that the header block is whole and states the
length that the record has; `record_bytes` gives back the original records, header block, payload and trailer.

Who is a response is decided on narrow rows. Payloads are grouped by digest with partial aggregation, so one
that a third of the pages share leaves each task once, and none moves in reading unless it is asked for.

Defined results: a null html is an empty payload. A null page_id comes last among equal payloads; rows that
agree in page_id and payload are ordered by url, and of identical rows one is the response. Line
breaks and blanks in a url are percent-encoded; a null url gives no WARC-Target-URI.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import table
from mentiongrid.session import new_folder

SHORTEST = 100

# The format of a record.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "<urn:x-page:"
LINE_END = "\r\n"
TRAILER = b"\r\n\r\n"
#: The version, lines of fields, and the empty line that ends them.
WHOLE_HEADER = r"\AWARC/1\.1\r\n(?:[A-Za-z-]+: [^\r\n]*\r\n)+\r\n\z"


def pages_to_records(pages: DataFrame) -> DataFrame:
    """(page_id, url, html) to (page_id, url, payload, digest, bytes)."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", "url", payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.octet_length("payload").cast("long").alias("bytes")
    )


def _place(page_id: str = "page_id", url: str = "url") -> Column:
    """Orders the records of one payload: ids first, nulls last."""
    return F.struct(F.col(page_id).isNull().alias("no_id"), F.col(page_id).alias("page_id"), F.col(url).isNull().alias("no_url"), F.col(url).alias("url"))


def decide(records: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(page_id, url, digest, bytes, type, refers_to), one row per record, without payloads.

    Equal rows are counted first. The first of a digest is joined only to the digests that occur more than once.
    """
    counted = records.groupBy("page_id", "url", "digest", "bytes").agg(F.count("*").alias("copies"))
    firsts = counted.groupBy("digest").agg(F.min(_place()).alias("first"), F.sum("copies").alias("all"))
    firsts = firsts.where("all > 1").select("digest", "first")
    joined = counted.join(firsts, "digest", "left")
    each = joined.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
    is_first = F.col("first").isNull() | ((_place() == F.col("first")) & (F.col("copy") == 1))
    revisit = (F.col("bytes") >= shortest) & ~is_first
    return each.select(
        "page_id", "url", "digest", "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("type"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"),
    )


def _id_text(page_id: Column) -> Column:
    return F.concat(F.lit(RECORD_ID), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def header_block(date: str) -> Column:
    """The header lines of a row of `decide`, with the empty line that ends them."""

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(LINE_END))

    uri = F.col("url")
    for raw, coded in (("\r", "%0D"), ("\n", "%0A"), (" ", "%20")):
        uri = F.replace(uri, F.lit(raw), F.lit(coded))
    revisit = F.col("type") == "revisit"
    return F.encode(
        F.concat(
            F.lit(VERSION + LINE_END),
            line("WARC-Type", F.col("type")),
            line("WARC-Record-ID", _id_text(F.col("page_id"))),
            line("WARC-Date", F.lit(date)),
            F.coalesce(line("WARC-Target-URI", uri), F.lit("")),
            line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
            F.when(revisit, F.concat(line("WARC-Refers-To", _id_text(F.col("refers_to"))), line("WARC-Profile", F.lit(REVISIT_PROFILE)))).otherwise(""),
            line("Content-Type", F.lit("text/html; charset=utf-8")),
            line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("bytes")).cast("string")),
            F.lit(LINE_END),
        ),
        "UTF-8",
    )


def write_archive(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", shortest: int = SHORTEST) -> None:
    """Write the tables `headers` and `payloads` below `path`."""
    records = pages_to_records(pages)
    decide(records.drop("payload"), shortest).select("digest", header_block(date).alias("header")).write.parquet(f"{path}/headers")
    # Copies fall together in the task that reads them, before anything moves.
    records.groupBy("digest").agg(F.first("payload").alias("payload")).write.parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: header fields, the payload, and what was found when checking it."""
    blocks = spark.read.parquet(f"{path}/headers").select("header", F.decode("header", "UTF-8").alias("lines"))

    def field(name: str) -> Column:
        return F.nullif(F.regexp_extract("lines", rf"\n{name}: ([^\r\n]*)\r\n", 1), F.lit(""))

    def page(name: str) -> Column:
        return F.nullif(F.regexp_extract(field(name), r"^<urn:x-page:([^>]*)>$", 1), F.lit("")).cast("long")

    records = blocks.select(
        "header",
        page("WARC-Record-ID").alias("page_id"),
        field("WARC-Target-URI").alias("url"),
        field("WARC-Type").alias("record_type"),
        page("WARC-Refers-To").alias("refers_to"),
        F.regexp_extract(field("WARC-Payload-Digest"), r"^sha256:([0-9a-f]{64})$", 1).alias("digest"),
        field("Content-Length").try_cast("long").alias("content_length"),
        F.col("lines").rlike(WHOLE_HEADER).alias("whole_header"),
    )
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("digest"),
        "payload",
        F.sha2("payload", 256).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"),
    )
    # A record is as long as its header says: a response holds its payload, a revisit nothing.
    length = F.when(F.col("record_type") == "revisit", F.lit(0)).when(F.col("record_type") == "response", F.col("payload_bytes"))
    right = F.col("whole_header") & (F.col("digest") == F.col("payload_digest")) & (F.col("content_length") == length)
    checked = records.join(payloads, "digest", "left").withColumn("verified", F.coalesce(right, F.lit(False)))
    return checked.withColumn("record_bytes", F.octet_length("header") + F.col("content_length") + len(TRAILER)).drop("whole_header")


def record_bytes(records: DataFrame) -> DataFrame:
    """Adds `record`: the original bytes of each record of `read_archive`."""
    body = F.when(F.col("record_type") == "revisit", F.lit(b"")).otherwise(F.col("payload"))
    return records.withColumn("record", F.concat("header", body, F.lit(TRAILER)))


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    write_archive(table(spark, sf_dir, "pages"), path)
    records = read_archive(spark, path)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "verified")


OP3_SQL = """
WITH payloads AS (
  SELECT page_id, url, sha256(coalesce(html, '')) AS payload_digest,
         CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes
  FROM pages),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST) AS n,
         first_value(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, url NULLS LAST) AS first_id
  FROM payloads)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND n > 1 THEN first_id END AS refers_to, true AS verified
FROM ranked"""

QUERIES = {"op3_warc_archive": op3_warc_archive}
SQL = {"op3_warc_archive": OP3_SQL}
