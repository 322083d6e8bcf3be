"""Archives derived from the stored tables, as inputs of the ingestion queries."""

from __future__ import annotations

import io
import zipfile
import zlib

import pyarrow as pa
import pyarrow.fs  # noqa: F401 - used as pa.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.registry.base import stored, table
from mentiongrid.session import spread_small_scan
from mentiongrid.sources.archives import list_zip_files

# Every 97th article is damaged on purpose.
_XML = """'<text><title>' || source || ' ' || lang || '</title><p>' ||
  replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), chr(10), '</p><p>') ||
  CASE WHEN doc_id % 97 = 0 THEN '</p>' ELSE '</p></text>' END"""

# The members that the article archives must contain, in SQL that both engines read alike.
ARTICLE_XML_SQL = f"""members AS (
  SELECT doc_id, upper(source) || '/' || upper(source) || '_' || CAST(doc_id AS VARCHAR) || '_0001_articletext.xml' AS member,
         {_XML} AS content
  FROM documents)"""


def _pack(batches):
    """One zip blob per Arrow batch, with an unrelated member in each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buffer = io.BytesIO()
        with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
            archive.writestr("readme.txt", "not an article")
            # Row by row: the batch must not stand in memory as Python values too.
            for member, content in zip(batch["member"], batch["content"], strict=True):
                archive.writestr(member.as_py(), content.as_py())
        first = batch.column("member")[0].as_py()
        path = f"archive_{zlib.crc32(first.encode())}.zip"
        yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([buffer.getbuffer()], pa.binary())], ["path", "content"])


def article_archives(spark: SparkSession, sf: str) -> DataFrame:
    """(path, content) zip blobs of article XML."""
    docs = spread_small_scan(table(spark, sf, "documents"), "doc_id")
    member = F.expr("concat(upper(source), '/', upper(source), '_', cast(doc_id as string), '_0001_articletext.xml')")
    return docs.select(member.alias("member"), F.expr(_XML).alias("content")).mapInArrow(_pack, "path string, content binary")


def stored_archives(spark: SparkSession, sf: str) -> list[str]:
    """Paths of zip files on the shared folder, each with article and issue members."""

    def write_all(folder: str) -> None:
        def write(batches):
            for packed in _pack(batches):
                path = f"{folder}/{packed.column('path')[0].as_py()}"
                filesystem, location = pa.fs.FileSystem.from_uri(path)
                filesystem.create_dir(location.rpartition("/")[0], recursive=True)
                with filesystem.open_output_stream(location) as out:
                    out.write(packed.column("content")[0].as_py())
                yield pa.RecordBatch.from_arrays([pa.array([path])], ["path"])

        docs = spread_small_scan(table(spark, sf, "documents"), "doc_id")
        member = F.expr("concat(upper(source), '/', upper(source), '_', cast(doc_id as string), '_0001_articletext.xml')")
        articles = docs.select(member.alias("member"), F.expr(_XML).alias("content"))
        members = articles.unionByName(issue_descriptions(spark, sf)).repartition(8, F.xxhash64("member"))
        members.mapInArrow(write, "path string").write.parquet(f"{folder}/written")

    folder = stored(spark, sf, "archives", lambda path: write_all(path if ":" in path else f"file://{path}"))
    return [r.path for r in list_zip_files(spark, folder).collect()]


_NAMESPACES = (
    'xmlns:didl="urn:mpeg:mpeg21:2002:02-DIDL-NS" xmlns:dc="http://purl.org/dc/elements/1.1/" '
    'xmlns:dcterms="http://purl.org/dc/terms/" xmlns:ddd="http://www.kb.nl/namespaces/ddd"'
)


# The same description as one SQL expression.
ISSUE_XML_SQL = f"""'<didl:DIDL {_NAMESPACES} ><didl:Item dc:identifier="' || source || '"><didl:Component dc:identifier="' || source ||
  ':meta"><dc:title>Daily ' || source || '</dc:title><dcterms:spatial>Region ' || lang ||
  '</dcterms:spatial><dcterms:spatial xsi:type="dcx:creation">' || upper(lang) || '</dcterms:spatial><dc:date>' ||
  CASE WHEN doc_id % 50 = 0 THEN 'undated' ELSE strftime(DATE '1830-01-01' + CAST((doc_id % 3650 * 37) % 3650 AS INTEGER), '%Y-%m-%d') END ||
  '</dc:date><dc:language xsi:type="dcterms:ISO639-1">' || lang || '</dc:language></didl:Component><didl:Item dc:identifier="' ||
  source || ':a' || doc_id || '"><dc:subject>artikel</dc:subject></didl:Item><didl:Item dc:identifier="' || source ||
  ':p001"/></didl:Item></didl:DIDL>'"""


def issue_descriptions(spark: SparkSession, sf: str) -> DataFrame:
    """(member, content): one issue description per document and its source, without the xsi namespace.

    Each lists the document as an article and one page scan.
    """
    docs = spread_small_scan(table(spark, sf, "documents"), "doc_id")
    parts = [
        f"<didl:DIDL {_NAMESPACES} ><didl:Item dc:identifier=\"",
        F.col("source"),
        '"><didl:Component dc:identifier="', F.col("source"), ':meta"><dc:title>Daily ', F.col("source"),
        "</dc:title><dcterms:spatial>Region ", F.col("lang"),
        '</dcterms:spatial><dcterms:spatial xsi:type="dcx:creation">', F.upper("lang"), "</dcterms:spatial><dc:date>",
        F.expr("CASE WHEN doc_id % 50 = 0 THEN 'undated' ELSE date_format(date_add(date'1830-01-01', cast((doc_id % 3650 * 37) % 3650 as int)), 'yyyy-MM-dd') END"),
        '</dc:date><dc:language xsi:type="dcterms:ISO639-1">', F.col("lang"),
        "</dc:language></didl:Component><didl:Item dc:identifier=\"", F.col("source"), ":a", F.col("doc_id").cast("string"),
        '"><dc:subject>artikel</dc:subject></didl:Item><didl:Item dc:identifier="', F.col("source"),
        ':p001"/></didl:Item></didl:DIDL>',
    ]
    content = F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))
    return docs.select(F.expr("concat(source, '/', source, '_', cast(doc_id as string), '_didl.xml')").alias("member"), content.alias("content"))


def issue_archives(spark: SparkSession, sf: str) -> DataFrame:
    return issue_descriptions(spark, sf).mapInArrow(_pack, "path string, content binary")
