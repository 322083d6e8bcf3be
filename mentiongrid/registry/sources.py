"""A: sources and scans."""

from pyspark.sql import functions as F

from mentiongrid.fixed_values import ARTICLE_SUFFIX, ISSUE_SUFFIX, KEY_DATES, ZIP_PERIODS
from mentiongrid.operators.counting import place_counts
from mentiongrid.registry.archives import ARTICLE_XML_SQL, ISSUE_XML_SQL, stored_archives
from mentiongrid.registry.base import (
    ARTICLES, HITS_SQL, articles, place_terms, query, stored_articles, table, topic_terms,
)
from mentiongrid.session import local_table, new_folder
from mentiongrid.sources.archives import read_zip_members, with_zip_period
from mentiongrid.sources.nested_json import keyed_values, region_names
from mentiongrid.sources.sinks import write_csv
from mentiongrid.sources.tables import read_csv, read_folder, read_month_counts, read_partitioned, read_years
from mentiongrid.schemas import GEO


@query("a01_scan_filling_missing_columns", "SELECT doc_id, source, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang FROM documents")
def _a01(spark, sf):
    docs, folder = table(spark, sf, "documents").select("doc_id", "source", "lang"), new_folder(spark, "drift")
    docs.filter("doc_id % 2 = 0").write.parquet(f"{folder}/late")
    docs.filter("doc_id % 2 = 1").drop("lang").write.parquet(f"{folder}/early")
    return read_folder(spark, folder)


@query("a02_scan_of_a_decade", f"WITH {ARTICLES} SELECT article_id, year, newspaper_date FROM articles WHERE year BETWEEN 1830 AND 1839")
def _a02(spark, sf):
    return read_years(spark, stored_articles(spark, sf), 1830, 1840).select("article_id", "year", "newspaper_date")


@query("a03_scan_of_listed_years", f"WITH {ARTICLES} SELECT article_id, year, newspaper_id FROM articles WHERE year IN (1831, 1832)")
def _a03(spark, sf):
    return read_years(spark, stored_articles(spark, sf), 1831, 1833).select("article_id", "year", "newspaper_id")


@query("a04_scan_of_all_chunks", f"WITH {ARTICLES} SELECT year, COUNT(*) AS n, MIN(newspaper_date) AS first_date FROM articles GROUP BY year")
def _a04(spark, sf):
    chunks = read_partitioned(spark, stored_articles(spark, sf))
    return chunks.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.min("newspaper_date").alias("first_date"))


_DICTIONARY = (
    r"SELECT s_name || ', \"' || s_nationkey || '\"' AS name, '\b(' || lower(s_name) || ',|\w*)\s?\b' AS Regex, "
    "CAST(s_suppkey AS INTEGER) AS cbscode, s_nationkey AS amsterdamcode FROM supplier"
).replace('\\"', '"')


def _supplier_dictionary(spark, sf):
    return table(spark, sf, "supplier").select(
        F.concat("s_name", F.lit(', "'), "s_nationkey", F.lit('"')).alias("name"),
        F.concat(F.lit(r"\b("), F.lower("s_name"), F.lit(r",|\w*)\s?\b")).alias("Regex"),
        F.col("s_suppkey").cast("int").alias("cbscode"), F.col("s_nationkey").alias("amsterdamcode"),
    )


_DICTIONARY_SCHEMA = "name string, Regex string, cbscode int, amsterdamcode int"


@query("a05_csv_dictionary", _DICTIONARY)
def _a05(spark, sf):
    path = new_folder(spark, "dictionary")
    write_csv(_supplier_dictionary(spark, sf), path)
    return read_csv(spark, path, _DICTIONARY_SCHEMA)


@query("a06_csv_dictionary_with_semicolons", _DICTIONARY)
def _a06(spark, sf):
    path = new_folder(spark, "dictionary")
    rows = _supplier_dictionary(spark, sf)
    rows.write.option("header", True).option("sep", ";").option("escape", '"').csv(path)
    return read_csv(spark, path, _DICTIONARY_SCHEMA, sep=";", required=["Regex"])


MONTHLY_ORDERS_SQL = (
    "SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS count "
    "FROM orders GROUP BY 1, 2"
)


def monthly_orders(spark, sf):
    orders = table(spark, sf, "orders")
    by_month = orders.groupBy(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return by_month.agg(F.count(F.lit(1)).alias("count"))


@query("a07_csv_month_counts", MONTHLY_ORDERS_SQL)
def _a07(spark, sf):
    path = new_folder(spark, "counts")
    write_csv(monthly_orders(spark, sf), path)
    return read_month_counts(spark, path)


@query(
    "a08_region_names_from_nested_json",
    "SELECT c_name AS location, CAST(c_custkey AS INTEGER) AS cbscode FROM customer "
    "UNION ALL SELECT c_mktsegment, c_nationkey FROM customer",
)
def _a08(spark, sf):
    region = lambda name, code: F.struct(F.struct(F.col(name).alias("name"), F.col(code).cast("int").alias("cbscode")).alias("properties"))
    geometries = F.array(region("c_name", "c_custkey"), region("c_mktsegment", "c_nationkey"))
    documents = table(spark, sf, "customer").select(F.struct(F.struct(geometries.alias("geometries")).alias("nld")).alias("objects"))
    path = new_folder(spark, "geo")
    documents.write.json(path)
    schema = "objects " + GEO.removeprefix("struct<objects:").removesuffix(">")
    return region_names(spark.read.schema(schema).json(path))


@query("a09_keyed_json_to_rows", "SELECT CAST(c_custkey AS INTEGER) AS amsterdamcode, c_acctbal AS pop FROM customer")
def _a09(spark, sf):
    entry = F.create_map(F.col("c_custkey").cast("string"), F.struct(F.col("c_acctbal").alias("value")))
    return keyed_values(table(spark, sf, "customer").select(F.to_json(entry).alias("json")), "json", "amsterdamcode", "pop")


@query(
    "a10_article_members_of_archives",
    f"WITH {ARTICLE_XML_SQL} SELECT member, content FROM members WHERE member LIKE '%articletext.xml'",
)
def _a10(spark, sf):
    return read_zip_members(spark, stored_archives(spark, sf), ARTICLE_SUFFIX, part_bytes=1 << 18).select("member", "content")


@query(
    "a11_issue_members_of_archives",
    f"SELECT source || '/' || source || '_' || doc_id || '_didl.xml' AS member, {ISSUE_XML_SQL} AS content FROM documents",
)
def _a11(spark, sf):
    return read_zip_members(spark, stored_archives(spark, sf), ISSUE_SUFFIX, part_bytes=1 << 18).select("member", "content")


@query(
    "a11_members_of_both_kinds",
    f"""WITH {ARTICLE_XML_SQL} SELECT member, 'article' AS kind, content FROM members WHERE member LIKE '%articletext.xml'
UNION ALL SELECT source || '/' || source || '_' || doc_id || '_didl.xml', 'issue', {ISSUE_XML_SQL} FROM documents""",
)
def _a11_both(spark, sf):
    found = read_zip_members(spark, stored_archives(spark, sf), ARTICLE_SUFFIX, ISSUE_SUFFIX)
    kind = F.when(F.col("member").endswith(ISSUE_SUFFIX), "issue").otherwise("article")
    return found.select("member", kind.alias("kind"), "content")


_PERIOD_NAMES = [*(name for name, _ in ZIP_PERIODS), "unknown.zip"]


@query(
    "a12_zip_period_lookup",
    "SELECT doc_id, CASE CAST(doc_id % 10 AS INTEGER) "
    + " ".join(f"WHEN {i} THEN '{label}'" for i, (_, label) in enumerate(ZIP_PERIODS))
    + " END AS period FROM documents",
)
def _a12(spark, sf):
    name = F.element_at(F.array(*(F.lit(n) for n in _PERIOD_NAMES)), (F.col("doc_id") % 10 + 1).cast("int"))
    paths = table(spark, sf, "documents").select("doc_id", F.concat(F.lit("file:/delivery/"), name).alias("path"))
    return with_zip_period(paths).select("doc_id", "period")


@query(
    "a13_key_dates",
    f"WITH {ARTICLES}, key_dates(date, label, yloc) AS (VALUES "
    + ", ".join(f"(DATE '{d}', '{label}', CAST({y} AS DOUBLE))" for d, label, y in KEY_DATES)
    + ") SELECT date, label, yloc, COUNT(article_id) AS n_articles FROM key_dates "
    "LEFT JOIN articles ON year = year(date) GROUP BY date, label, yloc",
)
def _a13(spark, sf):
    dates = local_table(spark, KEY_DATES, {"date": "string", "label": "string", "yloc": "double"}).withColumn("date", F.to_date("date"))
    per_year = articles(spark, sf).groupBy("year").agg(F.count(F.lit(1)).alias("n"))
    joined = dates.withColumn("year", F.year("date")).join(per_year, "year", "left")
    return joined.select("date", "label", "yloc", F.coalesce("n", F.lit(0)).alias("n_articles"))


@query(
    "a14_saved_year_tables",
    f"WITH {HITS_SQL} SELECT cbscode, year, COUNT(*) AS n_location, "
    r"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)\b(die|der)\b')) AS n_both "
    "FROM hits GROUP BY cbscode, year",
)
def _a14(spark, sf):
    counts = place_counts(articles(spark, sf), place_terms(), topic_terms()[2], by=("year",), unicode_case=False)
    codes = local_table(spark, [(t.id, t.attributes[1]) for t in place_terms()], {"place_id": "int", "cbscode": "int"})
    path = new_folder(spark, "years")
    counts.join(codes, "place_id").write.partitionBy("year").parquet(path)
    saved = read_years(spark, path, 1830, 1840)
    return saved.filter("n_location > 0").select("cbscode", "year", "n_location", "n_both")
