"""F: filters and predicates."""

from pyspark.sql import functions as F

from mentiongrid.operators.counting import in_years, with_pair_flags
from mentiongrid.operators.panel import mention_rates, complete_panel
from mentiongrid.operators.reports import blank_ambiguous
from mentiongrid.functions.ids import choose_query
from mentiongrid.registry.base import (
    ARTICLES, FLAT_SQL, NAMES_SQL, PAIR_PLACE, PAIR_TOPIC, PANEL_SQL, articles, query, stored_articles, stored_flat, table,
)
from mentiongrid.sources.tables import read_partitioned


@query("f01_year_range", "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE year(o_orderdate) >= 1996 AND year(o_orderdate) < 1998")
def _f01(spark, sf):
    orders = table(spark, sf, "orders").filter(in_years("o_orderdate", 1996, 1998))
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias("d"))


@query("f02_year_and_month", f"WITH {ARTICLES} SELECT article_id, newspaper_date FROM articles WHERE year = 1833 AND month = 6")
def _f02(spark, sf):
    stored = read_partitioned(spark, stored_articles(spark, sf)).filter("year = 1833")
    return stored.filter("newspaper_date >= '1833-06-01' and newspaper_date < '1833-07-01'").select("article_id", "newspaper_date")


@query(
    "f03_value_lists",
    f"WITH {FLAT_SQL} SELECT * EXCLUDE (amsterdamcode) FROM flat WHERE location IN ('Oned', 'Ver', 'Thble') AND disease IN ('alpha', 'gamma')",
)
def _f03(spark, sf):
    flat = stored_flat(spark, sf).drop("amsterdamcode")
    return flat.filter(F.col("location").isin("Oned", "Ver", "Thble") & F.col("disease").isin("alpha", "gamma"))


@query("f04_panel_range", f"WITH {PANEL_SQL} SELECT * FROM panel WHERE year <= 1837 AND year >= 1833 AND disease = 'alpha'")
def _f04(spark, sf):
    panel = mention_rates(complete_panel(stored_flat(spark, sf)))
    return panel.filter((F.col("year") <= 1837) & (F.col("year") >= 1833) & (F.col("disease") == "alpha"))


@query("f05_upper_bound", f"WITH {FLAT_SQL} SELECT cbscode, n_both, n_location FROM flat WHERE n_location < 3")
def _f05(spark, sf):
    return stored_flat(spark, sf).filter("n_location < 3").select("cbscode", "n_both", "n_location")


@query("f06_flag_filter", f"WITH {ARTICLES} SELECT article_id, lang FROM articles WHERE regexp_matches(article_text, '(?i){PAIR_PLACE}')")
def _f06(spark, sf):
    flags = with_pair_flags(articles(spark, sf).select("article_id", "lang", "article_text"), PAIR_TOPIC, PAIR_PLACE)
    return flags.filter("location").select("article_id", "lang")


@query(
    "f07_three_valued_and",
    """SELECT o_orderpriority, COUNT(*) FILTER (WHERE a AND b) AS n_both, COUNT(*) FILTER (WHERE a) AS n_a FROM (
  SELECT o_orderpriority, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice > 200000 END AS a,
         CASE WHEN o_custkey % 3 <> 0 THEN o_custkey % 2 = 0 END AS b FROM orders) GROUP BY o_orderpriority""",
)
def _f07(spark, sf):
    flags = table(spark, sf, "orders").select(
        "o_orderpriority",
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") > 200000).alias("a"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 2 == 0).alias("b"),
    )
    return flags.groupBy("o_orderpriority").agg(
        F.count_if(F.col("a") & F.col("b")).alias("n_both"), F.count_if("a").alias("n_a")
    )


@query("f08_label_filter", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'ring')")
def _f08(spark, sf):
    return table(spark, sf, "part").filter(F.col("p_name").contains("ring")).select("p_partkey", "p_name")


@query(
    "f09_manual_or_automatic",
    """SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN c_mktsegment ELSE substr(lower(c_name), 1, length(c_name) - 2) || '*' END AS query
FROM customer""",
)
def _f09(spark, sf):
    manual = F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", choose_query(manual, F.col("c_name")).alias("query"))


@query(
    "f10_blank_listed_names",
    f"""WITH {FLAT_SQL}, {NAMES_SQL} SELECT location, year, month, disease,
  CASE WHEN NOT regexp_matches(location, 'Oned|Ver') THEN n_both END AS n_both FROM flat""",
)
def _f10(spark, sf):
    blanked = blank_ambiguous(stored_flat(spark, sf), "location", "n_both", "Oned|Ver")
    return blanked.select("location", "year", "month", "disease", "n_both")
