"""G: joins and set operations."""

from pyspark.sql import functions as F

from mentiongrid.operators.combine import combine, combine_stored, one_per_key, partitioned
from mentiongrid.operators.counting import pair_counts, place_counts
from mentiongrid.operators.panel import complete_panel, mention_rates, panel_grid
from mentiongrid.operators.reports import join_attributes, with_names
from mentiongrid.plans.harvest import combine_harvest
from mentiongrid.session import local_table, new_folder
from mentiongrid.registry.base import (
    ARTICLES, FLAT_SQL, NAMES_SQL, PAIR_PLACE, PAIR_TOPIC, PANEL_SQL, PLACES_SQL, TOPICS,
    articles, names, place_terms, query, stored, stored_flat, table, topic_terms,
)
from mentiongrid.sources.bucketed import declare_bucketed, store_bucketed

# Ids, texts and issues as three tables. Each article is listed a second time under an id
# without text and an issue without description, so that no side of the joins is complete.
_SPLIT_SQL = f"""{ARTICLES},
meta AS (SELECT newspaper_id || '-' || year AS newspaper_id, article_id, lang AS article_subject FROM articles
  UNION ALL SELECT 'lost-' || newspaper_id, 'x' || article_id, lang FROM articles),
texts AS (SELECT article_id, lang AS article_title, article_text FROM articles),
papers AS (SELECT newspaper_id || '-' || year AS newspaper_id, MIN(newspaper_date) AS newspaper_date FROM articles
  GROUP BY 1)"""


def _split(spark, sf):
    rows = articles(spark, sf)
    issue = F.concat("newspaper_id", F.lit("-"), "year").alias("newspaper_id")
    listed = rows.select(issue, "article_id", F.col("lang").alias("article_subject"))
    lost = rows.select(F.concat(F.lit("lost-"), "newspaper_id").alias("newspaper_id"), F.concat(F.lit("x"), "article_id").alias("article_id"), F.col("lang").alias("article_subject"))
    meta = listed.unionAll(lost)
    texts = rows.select("article_id", F.col("lang").alias("article_title"), "article_text")
    papers = rows.groupBy(issue).agg(F.min("newspaper_date").alias("newspaper_date"))
    return meta, texts, papers


@query("g01_article_ids_with_texts", f"WITH {_SPLIT_SQL} SELECT newspaper_id, article_id, article_title, article_text FROM meta LEFT JOIN texts USING (article_id)")
def _g01(spark, sf):
    meta, texts, _ = _split(spark, sf)
    return meta.join(texts, "article_id", "left").select("newspaper_id", "article_id", "article_title", "article_text")


_G02_SQL = f"""WITH {_SPLIT_SQL},
m AS (SELECT DISTINCT ON (article_id) * FROM meta WHERE newspaper_id IN
  (SELECT newspaper_id FROM papers WHERE year(newspaper_date) >= 1831 AND year(newspaper_date) < 1837) ORDER BY article_id, newspaper_id, article_subject),
t AS (SELECT DISTINCT ON (article_id) * FROM texts ORDER BY article_id, article_title, article_text)
SELECT article_id, newspaper_id, article_subject, newspaper_date, article_title, article_text,
  CAST(year(newspaper_date) AS INTEGER) AS year
FROM m JOIN papers USING (newspaper_id) LEFT JOIN t USING (article_id)"""


@query("g02_articles_with_issues", _G02_SQL)
def _g02(spark, sf):
    return partitioned(combine(*_split(spark, sf), 1831, 1837))


def stored_texts(spark, sf):
    """The texts in buckets of article_id."""
    schema = "article_id string, article_title string, article_text string"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = stored(spark, sf, f"texts-{buckets}", lambda path: store_bucketed(one_per_key(_split(spark, sf)[1], "article_id"), path, "article_id", buckets))
    return declare_bucketed(spark, path, schema, "article_id", buckets)


@query("g02_articles_with_stored_texts", _G02_SQL)
def _g02_stored(spark, sf):
    meta, _, papers = _split(spark, sf)
    return partitioned(combine_stored(meta, stored_texts(spark, sf), papers, 1831, 1837))


@query(
    "g02_harvested_years",
    f"""WITH {_SPLIT_SQL}
SELECT article_id, newspaper_id, article_subject, newspaper_date, article_title, article_text, CAST(year(newspaper_date) AS INTEGER) AS year, CAST(NULL AS VARCHAR) AS newspaper_language
FROM meta JOIN papers USING (newspaper_id) LEFT JOIN texts USING (article_id)
WHERE year(newspaper_date) BETWEEN 1831 AND 1837 AND year(newspaper_date) NOT IN (1833, 1835)""",
)
def _g02_harvest(spark, sf):
    rows = articles(spark, sf)
    texts, meta, papers, out = (new_folder(spark, n) for n in ("texts", "meta", "papers", "harvest"))
    issue = F.concat("newspaper_id", F.lit("-"), "year").alias("newspaper_id")
    dated = rows.groupBy(issue, "year").agg(F.min("newspaper_date").alias("newspaper_date"))
    rows.select("article_id", F.col("lang").alias("article_title"), "article_text", "year").write.partitionBy("year").parquet(texts)
    rows.select(issue, "article_id", F.col("lang").alias("article_subject"), "year").write.partitionBy("year").parquet(meta)
    # Two years lack an input; a second run has nothing left to do.
    dated.filter("year NOT IN (1833, 1835)").write.partitionBy("year").parquet(papers)
    first_era = local_table(spark, [], {"article_id": "string", "newspaper_language": "string"})
    for _ in range(2):
        combine_harvest(spark, texts, meta, papers, out, 1831, 1838, first_era)
    return spark.read.parquet(out)


@query(
    "g03_skeleton_with_facts",
    """WITH facts AS (SELECT o_orderstatus, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
  CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS n FROM orders GROUP BY 1, 2, 3, 4)
SELECT o_orderstatus, o_orderpriority, year, month, COALESCE(n, 0) AS n
FROM (SELECT * FROM (SELECT DISTINCT o_orderstatus FROM facts), (SELECT DISTINCT o_orderpriority FROM facts),
  (SELECT DISTINCT year FROM facts), (SELECT DISTINCT month FROM facts)) LEFT JOIN facts USING (o_orderstatus, o_orderpriority, year, month)""",
)
def _g03(spark, sf):
    keys = ["o_orderstatus", "o_orderpriority", "month", "year"]
    orders = table(spark, sf, "orders")
    dated = orders.withColumns({"year": F.year("o_orderdate"), "month": F.month("o_orderdate")})
    return complete_panel(dated.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys, ["n"])


@query("g04_panel_with_names", f"WITH {PANEL_SQL}, {NAMES_SQL} SELECT p.*, location FROM panel p LEFT JOIN (SELECT location, cbscode FROM names) USING (cbscode)")
def _g04(spark, sf):
    panel = mention_rates(complete_panel(stored_flat(spark, sf)))
    return with_names(panel, names(spark).drop("amsterdamcode"))


@query(
    "g05_attributes_by_text_key",
    f"""WITH {FLAT_SQL}, {NAMES_SQL} SELECT CAST(n.cbscode AS VARCHAR) AS cbscode, n.location, n.amsterdamcode, disease, year, month, n_both
FROM names n LEFT JOIN (SELECT cbscode, disease, year, month, n_both FROM flat) f ON n.cbscode = f.cbscode""",
)
def _g05(spark, sf):
    facts = stored_flat(spark, sf).select("cbscode", "disease", "year", "month", "n_both")
    return join_attributes(names(spark), facts, "cbscode")


@query(
    "g06_name_conflict_repair",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, COALESCE(CASE WHEN c_custkey % 2 = 0 THEN c_name END, s_name) AS name, s_acctbal
FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey""",
)
def _g06(spark, sf):
    base = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("name")
    )
    other = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal")
    return join_attributes(base, other, "key")


@query(
    "g07_product_of_distinct_values",
    f"WITH {PANEL_SQL} SELECT disease, year, month, cbscode FROM skeleton",
)
def _g07(spark, sf):
    return panel_grid(stored_flat(spark, sf))


@query(
    "g09_tables_stacked",
    f"""WITH {ARTICLES} SELECT 'a' AS part, year AS yr, COUNT(*) AS n_total FROM articles WHERE year < 1835 GROUP BY year
UNION ALL SELECT 'b', year, COUNT(*) FROM articles WHERE year >= 1833 GROUP BY year""",
)
def _g09(spark, sf):
    early = pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1800, 1835, by=["yr"])
    late = pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1833, 1900, by=["yr"])
    tagged = [df.select(F.lit(tag).alias("part"), "yr", "n_total") for tag, df in (("a", early), ("b", late))]
    return tagged[0].unionByName(tagged[1])


@query(
    "g10_dictionary_beside_counts",
    f"""WITH {ARTICLES}, {PLACES_SQL} SELECT location, regex AS Regex, cbscode, amsterdamcode, n_disease, n_location, n_both FROM (
  SELECT place_id, COUNT(*) FILTER (WHERE d) AS n_disease, COUNT(*) FILTER (WHERE l) AS n_location, COUNT(*) FILTER (WHERE d AND l) AS n_both FROM (
    SELECT place_id, regexp_matches(article_text, '(?i){TOPICS[0][1]}') AS d, regexp_matches(article_text, '(?i)' || regex) AS l
    FROM articles, places WHERE year = 1834) GROUP BY place_id) JOIN places USING (place_id)""",
)
def _g10(spark, sf):
    terms = place_terms()
    year = articles(spark, sf).filter("newspaper_date >= '1834-01-01' and newspaper_date < '1835-01-01'")
    counts = place_counts(year, terms, topic_terms()[0], by=("year",), unicode_case=False)
    columns = {"place_id": "int", "Regex": "string", "location": "string", "cbscode": "int", "amsterdamcode": "int"}
    dictionary = local_table(spark, [(t.id, t.regex, *t.attributes) for t in terms], columns)
    joined = dictionary.join(counts, "place_id")
    return joined.select("location", "Regex", "cbscode", "amsterdamcode", "n_disease", "n_location", "n_both")


@query(
    "g01_unique_texts",
    f"WITH {ARTICLES} SELECT DISTINCT ON (article_id) article_id, lang, article_text FROM articles ORDER BY article_id, lang, article_text",
)
def _g01_unique(spark, sf):
    return one_per_key(articles(spark, sf).select("article_id", "lang", "article_text"), "article_id")
