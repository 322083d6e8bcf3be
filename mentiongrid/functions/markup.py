"""Titles, paragraphs and issue metadata from XML and web markup.

XML is parsed in Arrow-batched Python helpers, a few documents at a time: one malformed document must become one row
with `parse_error`, while Spark's own XPath functions would fail the job, and `from_xml` gives an element with
nested markup as its source, in which escaped characters can no longer be told from tags.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentiongrid.fixed_values import NAMESPACES
from mentiongrid.functions.ids import article_id_from_file, is_page_item, repair_namespace
from mentiongrid.session import bounded_batches

# Issue metadata field -> element, and whether it is looked up inside the
# issue's metadata component or in the whole document.
ISSUE_FIELDS = [
    ("newspaper_name", ".//dc:title", "component"),
    ("newspaper_location", ".//dcterms:spatial[@xsi:type='dcx:creation']", "component"),
    ("newspaper_date", ".//dc:date", "document"),
    ("newspaper_years_digitalised", ".//ddd:yearsDigitized", "document"),
    ("newspaper_years_issued", ".//dcterms:issued", "document"),
    ("newspaper_language", ".//dc:language[@xsi:type='dcterms:ISO639-1']", "document"),
    ("newspaper_temporal", ".//dcterms:temporal", "document"),
    ("newspaper_publisher", ".//dc:publisher", "document"),
    ("newspaper_spatial", ".//dcterms:spatial", "document"),
]

# The entities of web markup that texts use; the ampersand comes last.
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


_ARTICLE_TYPE = T.StructType(_strings("title", "text", "parse_error"))
_ISSUE_TYPE = T.StructType([
    *_strings("newspaper_id", *(name for name, _, _ in ISSUE_FIELDS)),
    T.StructField("items", T.ArrayType(T.StructType(_strings("article_id", "article_subject")))),
    *_strings("parse_error"),
])
#: Documents parsed before their rows are handed on.
_ROWS = 200


def _parsed(rows: DataFrame, parse: Callable[[str | None], tuple], kind: T.StructType) -> DataFrame:
    """The rows with what `parse` finds in their last column, the content, in place of it."""
    kept_names = rows.columns[:-1]
    schema = pa.schema([(f.name, _arrow_type(f.dataType)) for f in kind])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                part = batch.slice(start, _ROWS)
                *kept, contents = part.columns
                found = zip(*(parse(c.as_py()) for c in contents), strict=True)
                arrays = [pa.array(values, f.type) for values, f in zip(found, schema, strict=True)]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], [*kept_names, *schema.names])

    bounded_batches(rows.sparkSession)
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields[:-1], *kind.fields]))


def _arrow_type(kind: T.DataType) -> pa.DataType:
    if isinstance(kind, T.ArrayType):
        return pa.list_(_arrow_type(kind.elementType))
    return pa.struct([(f.name, _arrow_type(f.dataType)) for f in kind]) if isinstance(kind, T.StructType) else pa.string()


def _article(content):
    """First title and blank-joined paragraphs of article XML, at any depth, each with all its nested text."""
    try:
        root = ET.fromstring(content)
        title = root.find(".//title")
        if title is None:
            raise ValueError("no title element")
        paragraphs = ("".join(p.itertext()) for p in root.iter("p"))
        return "".join(title.itertext()), " ".join(paragraphs), None
    except (ET.ParseError, ValueError, TypeError) as exc:
        return None, None, f"{type(exc).__name__}: {exc}"


def _identifier(node):
    return node.get(f"{{{NAMESPACES['dc']}}}identifier") or ""


def _text(node, path):
    found = None if node is None else node.find(path, NAMESPACES)
    return None if found is None else found.text


def _issue(content):
    """Metadata fields and listed items of an issue description."""
    try:
        root = ET.fromstring(content)
        issue_tag = f"{{{NAMESPACES['didl']}}}DIDL"
        document = root if root.tag == issue_tag else next(root.iter(issue_tag))
        issue = document.find("didl:Item", NAMESPACES)
        components = issue.findall("didl:Component", NAMESPACES)
    except (ET.ParseError, StopIteration, AttributeError, TypeError) as exc:
        return (None,) * (len(ISSUE_FIELDS) + 2) + (f"{type(exc).__name__}: {exc}",)
    described = [c for c in components if "meta" in _identifier(c)]
    if document is not root:
        # A description wrapped in a delivery record has its metadata in the first component.
        described = components[:1]
    scopes = {"component": described[-1] if described else None, "document": root if described else None}
    fields = [_text(scopes[scope], path) for _, path, scope in ISSUE_FIELDS]
    items = [
        {"article_id": _identifier(item), "article_subject": _text(item, ".//dc:subject")}
        for item in issue.findall("didl:Item", NAMESPACES)
    ]
    return (_identifier(issue) or None, *fields, items, None)


def article_texts(members: DataFrame, *keep: str) -> DataFrame:
    """(article_id, article_title, article_text, parse_error, *keep) from (member, content) rows."""
    article_id = article_id_from_file(F.col("member")).alias("article_id")
    rows = members.select(article_id, *keep, F.col("content").alias("_content"))
    parsed = _parsed(rows, _article, _ARTICLE_TYPE)
    return parsed.select(
        "article_id", F.col("title").alias("article_title"), F.col("text").alias("article_text"), "parse_error", *keep
    )


def parsed_issues(members: DataFrame, *keep: str) -> DataFrame:
    """Parsed issue descriptions; both tables below read this one result."""
    rows = members.select(*keep, repair_namespace(F.col("content")).alias("_content"))
    return _parsed(rows, _issue, _ISSUE_TYPE).select(*_ISSUE_TYPE.names, *keep)


def newspaper_meta(issues: DataFrame, *keep: str) -> DataFrame:
    names = [name for name, _, _ in ISSUE_FIELDS]
    return issues.select("newspaper_id", *names, "parse_error", *keep).withColumn(
        "newspaper_date", F.try_to_date("newspaper_date", "yyyy-MM-dd")
    )


def article_meta(issues: DataFrame, *keep: str) -> DataFrame:
    """One row per listed article; page scans are left out."""
    items = issues.select("newspaper_id", F.inline("items"), *keep)
    return items.filter(~is_page_item(F.col("article_id")))


def web_title(html: Column) -> Column:
    return F.regexp_extract(html, r"(?s)<title>(.*?)</title>", 1)


def web_paragraphs(html: Column) -> Column:
    """Paragraphs of raw web markup joined by blanks, without their tags.

    A paragraph ends at its end tag, at the next paragraph or at the end of the page. The
    usual entities are decoded.
    """
    paragraphs = F.regexp_extract_all(html, F.lit(r"(?s)<p(?:\s[^>]*)?>(.*?)(?=<p[\s>]|</p>|\z)"), F.lit(1))
    text = F.regexp_replace(F.array_join(paragraphs, " "), r"<[^>]*>", "")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text
