"""B: sinks and incremental runs. Each query writes, reads back and returns what it wrote."""

from pyspark.sql import functions as F

from mentiongrid import schemas
from mentiongrid.operators.panel import complete_panel, mention_rates
from mentiongrid.operators.worklist import month_grid, pending, ready
from mentiongrid.registry.base import (
    ARTICLES, FLAT_SQL, HITS_SQL, PANEL_SQL, articles, place_terms, query, stored_articles, stored_flat, table, topic_terms,
)
from mentiongrid.operators.counting import place_shares
from mentiongrid.session import local_table, new_folder
from mentiongrid.sources.sinks import append_csv, write_csv, write_parquet, write_pending, write_sorted
from mentiongrid.sources.tables import read_csv, read_month_counts
from mentiongrid.streaming.incremental import ingest_new_files

_FLAT = "SELECT year, month, n_location, n_both, location, cbscode, amsterdamcode, disease FROM flat"


@query(
    "b01_partitioned_write_by_year",
    f"WITH {ARTICLES} SELECT year, COUNT(*) AS n, CAST(SUM(length(article_text)) AS BIGINT) AS n_chars FROM articles GROUP BY year",
)
def _b01(spark, sf):
    stored = spark.read.parquet(stored_articles(spark, sf))
    return stored.groupBy("year").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("article_text")).alias("n_chars"))


@query("b02_parquet_sink", f"WITH {ARTICLES} SELECT article_id, newspaper_id, newspaper_date, article_text FROM articles")
def _b02(spark, sf):
    path = new_folder(spark, "combined")
    write_parquet(articles(spark, sf).select("article_id", "newspaper_id", "newspaper_date", "article_text"), path)
    return spark.read.parquet(path)


@query("b03_flat_table_sink", f"WITH {FLAT_SQL} {_FLAT}")
def _b03(spark, sf):
    return stored_flat(spark, sf)


@query("b04_sorted_release_sink", f"WITH {PANEL_SQL} SELECT * FROM panel")
def _b04(spark, sf):
    path = new_folder(spark, "database")
    write_sorted(mention_rates(complete_panel(stored_flat(spark, sf))), path, ["disease", "year", "month", "cbscode"], files=2)
    return spark.read.schema(schemas.DATABASE).parquet(path)


@query("b05_csv_per_month", f"WITH {FLAT_SQL} {_FLAT}")
def _b05(spark, sf):
    path = new_folder(spark, "csv")
    write_csv(stored_flat(spark, sf), path, partition_by=["year", "month"])
    columns = "n_location bigint, n_both bigint, location string, cbscode int, amsterdamcode int, disease string, year int, month int"
    return spark.read.schema(columns).option("header", True).csv(path)


@query(
    "b06_append_counts_to_csv",
    f"WITH {ARTICLES} SELECT year, month, COUNT(*) AS count FROM articles GROUP BY year, month",
)
def _b06(spark, sf):
    path = new_folder(spark, "appended")
    counts = articles(spark, sf).groupBy("year", "month").agg(F.count(F.lit(1)).alias("count"))
    append_csv(counts.filter("year < 1835"), path)
    append_csv(counts.filter("year >= 1835"), path)
    return read_month_counts(spark, path)


@query(
    "b07_chunks_still_to_do",
    f"WITH {ARTICLES}, {'requested(year, month) AS (SELECT y, m FROM range(1828, 1842) a(y), range(1, 13) b(m))'} "
    "SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month FROM requested "
    "WHERE NOT EXISTS (SELECT 1 FROM articles x WHERE x.year = requested.year AND x.month = requested.month)",
)
def _b07(spark, sf):
    requested = month_grid(spark, 1828, 1842).select("year", "month")
    return pending(requested, articles(spark, sf), "year", "month")


@query("b07_incremental_append", f"WITH {ARTICLES} SELECT article_id, lang, year FROM articles")
def _b07_append(spark, sf):
    path, rows = new_folder(spark, "chunks"), articles(spark, sf).select("article_id", "lang", "year")
    write_pending(rows.filter("year < 1836"), path, None, "year")
    write_pending(rows, path, spark.read.parquet(path), "year")
    return spark.read.parquet(path)


@query("b07_incremental_stream", "SELECT doc_id, source, lang, n_chars FROM documents")
def _b07_stream(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "source", "lang", "n_chars")
    landing, target, checkpoint = (new_folder(spark, n) for n in ("landing", "ingested", "progress"))
    schema = "doc_id bigint, source string, lang string, n_chars bigint"
    for part in (0, 1):  # the second run takes up only what arrived after the first
        docs.filter(F.col("doc_id") % 2 == part).write.mode("append").parquet(landing)
        ingest_new_files(spark, landing, target, checkpoint, schema)
    return spark.read.schema(schema).parquet(target)


@query(
    "b08_chunks_with_all_inputs",
    f"""WITH {ARTICLES}, requested(year) AS (SELECT y FROM range(1825, 1845) a(y))
SELECT CAST(year AS INTEGER) AS year FROM requested
WHERE year IN (SELECT year FROM articles WHERE lang = 'en') AND year IN (SELECT year FROM articles WHERE lang = 'fr')
  AND year IN (SELECT year FROM articles WHERE newspaper_id = 'src1')""",
)
def _b08(spark, sf):
    chunks = articles(spark, sf)
    inputs = [chunks.filter("lang = 'en'"), chunks.filter("lang = 'fr'"), chunks.filter("newspaper_id = 'src1'")]
    requested = month_grid(spark, 1825, 1845).select("year").distinct()
    return ready(requested, inputs, "year")


@query(
    "b05_csv_of_place_shares",
    f"""WITH {HITS_SQL},
counted AS (SELECT place_id, year, month, COUNT(*) AS n_total,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)\\b(die|der)\\b')) AS n_both FROM hits GROUP BY ALL),
periods AS (SELECT DISTINCT year, month FROM articles)
SELECT p.regex AS Location_Regex, p.location AS name, p.cbscode, p.amsterdamcode, q.year, q.month,
  COALESCE(n_both, 0) AS n_both, COALESCE(n_total, 0) AS n_total,
  CASE WHEN COALESCE(n_total, 0) = 0 THEN 0.0 ELSE CAST(n_both AS DOUBLE) / n_total END AS Normalized_Mentions
FROM places p CROSS JOIN periods q LEFT JOIN counted USING (place_id, year, month)""",
)
def _b05_shares(spark, sf):
    terms = place_terms()
    shares = place_shares(articles(spark, sf), terms, topic_terms()[2], unicode_case=False)
    columns = {"place_id": "int", "Location_Regex": "string", "name": "string", "cbscode": "int", "amsterdamcode": "int"}
    attributes = local_table(spark, [(t.id, t.regex, *t.attributes) for t in terms], columns)
    rows = shares.withColumnRenamed("normalized_mentions", "Normalized_Mentions").join(attributes, "place_id")
    path = new_folder(spark, "municipality_month")
    order = ["Location_Regex", "name", "cbscode", "amsterdamcode", "n_both", "n_total", "Normalized_Mentions"]
    write_csv(rows.select(*order, "year", "month"), path, partition_by=["year", "month"])
    kinds = "Location_Regex string, name string, cbscode int, amsterdamcode int, n_both bigint, n_total bigint, Normalized_Mentions double"
    return read_csv(spark, path, f"{kinds}, year int, month int")
