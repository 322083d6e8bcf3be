"""C: ingestion and harmonisation."""

from pyspark.sql import functions as F

from mentiongrid.fixed_values import ARTICLE_SUFFIX, ISSUE_SUFFIX
from mentiongrid.functions import ids
from mentiongrid.functions.markup import (
    article_meta, article_texts, newspaper_meta, parsed_issues, web_paragraphs, web_title,
)
from mentiongrid.operators.combine import harmonise, one_per_key
from mentiongrid.operators.worklist import month_grid, result_pages
from mentiongrid.registry.archives import ARTICLE_XML_SQL, article_archives, issue_archives, issue_descriptions
from mentiongrid.registry.base import ARTICLES, articles, query, table
from mentiongrid.sources.archives import zip_members

_FILE = "concat('x/', upper(source), '_', lpad(cast(doc_id as string), 9, '0'), '_', lang, '_articletext.xml')"


@query(
    "c01_article_id_from_file_name",
    "SELECT doc_id, source || ':' || lpad(CAST(doc_id AS VARCHAR), 9, '0') || ':mpeg21:a' || lang AS article_id FROM documents",
)
def _c01(spark, sf):
    return table(spark, sf, "documents").select("doc_id", ids.article_id_from_file(F.expr(_FILE)).alias("article_id"))


@query(
    "c02_title_and_paragraphs_of_web_markup",
    """SELECT page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) AS title,
  replace(replace(replace(replace(replace(replace(regexp_replace(array_to_string(list_transform(
    string_split(regexp_replace(html, '<p(\\s[^>]*)?>', chr(1), 'g'), chr(1))[2:], lambda x: string_split(x, '</p>')[1]), ' '),
    '<[^>]*>', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&') AS text FROM pages""",
)
def _c02_web(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", web_title(F.col("html")).alias("title"), web_paragraphs(F.col("html")).alias("text"))


_XML_TEXTS = f"""WITH {ARTICLE_XML_SQL}
SELECT d.source || ':' || d.doc_id || ':mpeg21:a0001' AS article_id,
  CASE WHEN d.doc_id % 97 <> 0 THEN d.source || ' ' || d.lang END AS article_title,
  CASE WHEN d.doc_id % 97 <> 0 THEN replace(d.text, chr(10), ' ') END AS article_text
FROM documents d"""


@query("c02_title_and_paragraphs_of_xml", _XML_TEXTS)
def _c02_xml(spark, sf):
    return article_texts(zip_members(article_archives(spark, sf), ARTICLE_SUFFIX)).drop("parse_error")


@query(
    "c03_parse_errors_as_rows",
    "SELECT source || ':' || doc_id || ':mpeg21:a0001' AS article_id, doc_id % 97 = 0 AS failed FROM documents",
)
def _c03(spark, sf):
    texts = article_texts(zip_members(article_archives(spark, sf), ARTICLE_SUFFIX))
    return texts.select("article_id", F.col("parse_error").isNotNull().alias("failed"))


@query(
    "c04_namespace_repair",
    """SELECT page_id, CASE WHEN contains(x, 'http://www.w3.org/2001/XMLSchema-instance') THEN x ELSE
  replace(x, '<didl:DIDL ', '<didl:DIDL xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" ') END AS content
FROM (SELECT page_id, '<didl:DIDL ' || CASE WHEN page_id % 2 = 0 THEN 'xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" ' ELSE '' END
  || 'id="' || url || '"/>' AS x FROM pages)""",
)
def _c04(spark, sf):
    declared = "CASE WHEN page_id % 2 = 0 THEN 'xmlns:xsi=\"http://www.w3.org/2001/XMLSchema-instance\" ' ELSE '' END"
    pages = table(spark, sf, "pages")
    content = F.concat(F.lit("<didl:DIDL "), F.expr(declared), F.lit('id="'), "url", F.lit('"/>'))
    return pages.select("page_id", ids.repair_namespace(content).alias("content"))


@query(
    "c05_newspaper_metadata",
    f"""WITH {ARTICLES} SELECT newspaper_id, 'Daily ' || newspaper_id AS newspaper_name, upper(lang) AS newspaper_location,
  CASE WHEN CAST(article_id AS BIGINT) % 50 <> 0 THEN newspaper_date END AS newspaper_date,
  CAST(NULL AS VARCHAR) AS newspaper_years_digitalised, CAST(NULL AS VARCHAR) AS newspaper_years_issued,
  lang AS newspaper_language, CAST(NULL AS VARCHAR) AS newspaper_temporal, CAST(NULL AS VARCHAR) AS newspaper_publisher,
  'Region ' || lang AS newspaper_spatial, CAST(NULL AS VARCHAR) AS parse_error FROM articles""",
)
def _c05(spark, sf):
    return newspaper_meta(parsed_issues(zip_members(issue_archives(spark, sf), ISSUE_SUFFIX)))


@query(
    "c06_metadata_component_only",
    "SELECT source AS newspaper_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE doc_id % 3 = 0) AS n_named FROM documents GROUP BY source",
)
def _c06(spark, sf):
    issues = issue_descriptions(spark, sf)
    other = F.replace(F.col("content"), F.lit(":meta\""), F.lit(":scan\""))
    is_third = F.regexp_extract("content", r":a(\d+)\"", 1).cast("bigint") % 3 == 0
    parsed = newspaper_meta(parsed_issues(issues.withColumn("content", F.when(is_third, F.col("content")).otherwise(other))))
    return parsed.groupBy("newspaper_id").agg(F.count(F.lit(1)).alias("n"), F.count("newspaper_name").alias("n_named"))


@query(
    "c07_article_items_of_issues",
    "SELECT source AS newspaper_id, source || ':a' || doc_id AS article_id, 'artikel' AS article_subject FROM documents",
)
def _c07(spark, sf):
    return article_meta(parsed_issues(zip_members(issue_archives(spark, sf), ISSUE_SUFFIX)))


@query(
    "c08_date_parsing",
    """SELECT o_orderkey, try_strptime(CASE WHEN o_orderkey % 7 = 0 THEN 'no date' ELSE strftime(o_orderdate, '%Y-%m-%d') END, '%Y-%m-%d')::DATE
  AS newspaper_date FROM orders""",
)
def _c08(spark, sf):
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("no date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").select("o_orderkey", F.try_to_date(text, "yyyy-MM-dd").alias("newspaper_date"))


@query(
    "c09_list_values_joined",
    "SELECT p_partkey, p_brand, array_to_string(string_split(p_name, ' '), ', ') AS words FROM part",
)
def _c09(spark, sf):
    return ids.standardize_values(table(spark, sf, "part").select("p_partkey", "p_brand", F.split("p_name", " ").alias("words")))


@query("c10_select_and_rename", "SELECT source AS newspaper_id, doc_id AS article_id, lang AS article_subject FROM documents")
def _c10(spark, sf):
    renames = {"source": "newspaper_id", "doc_id": "article_id", "lang": "article_subject"}
    return table(spark, sf, "documents").select(*renames).withColumnsRenamed(renames)


@query("c11_id_cleaning", "SELECT page_id, 'ddd:' || url AS article_id, lower(url) AS newspaper_id FROM pages")
def _c11(spark, sf):
    harvested = F.concat(F.lit("http://resolver.kb.nl/resolve?urn=ddd:"), "url", F.lit(":ocr"))
    pages = table(spark, sf, "pages")
    return pages.select("page_id", ids.clean_article_id(harvested).alias("article_id"), F.lower("url").alias("newspaper_id"))


_PREFIX = "CASE CAST(doc_id % 3 AS INTEGER) WHEN 0 THEN 'ddd' WHEN 1 THEN 'abcddd' ELSE source END"
_ID = f"'KRANTEN:' || {_PREFIX} || ':' || CAST(doc_id AS VARCHAR) || ':mpeg21'"
_ID_SPARK = _ID.replace("VARCHAR", "STRING")


@query(
    "c12_id_parts",
    f"SELECT doc_id, {_PREFIX} AS prefix, CAST(doc_id AS VARCHAR) || ':mpeg21' AS number FROM documents",
)
def _c12(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_ID_SPARK).alias("id"))
    return docs.select("doc_id", ids.newspaper_prefix(F.col("id")).alias("prefix"), ids.newspaper_number(F.col("id")).alias("number"))


@query(
    "c13_record_identifier",
    """SELECT doc_id, CASE CAST(doc_id % 3 AS INTEGER) WHEN 0 THEN 'DDD:ddd:' || doc_id || ':mpeg21'
  WHEN 1 THEN 'KRANTEN:DDD:ddd:' || doc_id || ':mpeg21'
  ELSE 'KRANTEN:' || upper(source) || ':' || upper(source) || ':' || doc_id || ':mpeg21' END AS identifier FROM documents""",
)
def _c13(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", F.expr(_ID_SPARK).alias("id"))
    identifier = ids.record_identifier(ids.newspaper_prefix(F.col("id")), ids.newspaper_number(F.col("id")))
    return docs.select("doc_id", identifier.alias("identifier"))


@query("c14_newspapers_of_a_month", f"WITH {ARTICLES} SELECT DISTINCT year, month, newspaper_id FROM articles")
def _c14(spark, sf):
    return articles(spark, sf).select("year", "month", "newspaper_id").distinct()


@query(
    "c15_month_queries_and_pages",
    f"""WITH {ARTICLES}, totals AS (SELECT year, month, COUNT(*) AS total FROM articles GROUP BY year, month),
pages AS (SELECT *, unnest(generate_series(0, CAST(ceil(total / 3.0) AS BIGINT) - 1)) AS page FROM totals)
SELECT year, month, make_date(year, month, 1) AS first_day, last_day(make_date(year, month, 1)) AS last_day,
  '* AND date within "' || strftime(make_date(year, month, 1), '%Y-%m-%d') || ' '
    || strftime(last_day(make_date(year, month, 1)), '%Y-%m-%d') || '"' AS query,
  page * 3 + 1 AS start_record FROM pages""",
)
def _c15(spark, sf):
    totals = articles(spark, sf).groupBy("year", "month").agg(F.count(F.lit(1)).alias("total"))
    months = month_grid(spark, 1830, 1840).join(totals, ["year", "month"])
    return result_pages(months, "total", size=3).select(
        "year", "month", "first_day", "last_day",
        ids.month_query(F.lit("*"), F.col("year"), F.col("month")).alias("query"), "start_record",
    )


@query(
    "c16_harmonise_sources",
    """WITH eras AS (
  SELECT 'd' || doc_id AS article_id, lang AS newspaper_language, n_chars AS n FROM documents
  UNION ALL SELECT 'd' || doc_id, lang, n_chars FROM documents WHERE doc_id % 2 = 0
  UNION ALL SELECT 'c' || conv_id || '.' || turn, NULL, length(text) FROM conversations)
SELECT DISTINCT ON (article_id) article_id, newspaper_language, n FROM eras ORDER BY article_id, newspaper_language NULLS FIRST, n""",
)
def _c16(spark, sf):
    docs = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), "doc_id").alias("article_id"), F.col("lang").alias("newspaper_language"), F.col("n_chars").alias("n")
    )
    talks = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), "conv_id", F.lit("."), "turn").alias("article_id"), F.length("text").cast("bigint").alias("n")
    )
    again = docs.filter(F.substring("article_id", 2, 20).cast("bigint") % 2 == 0)
    return one_per_key(harmonise(docs, again, talks), "article_id")
