"""H: aggregation, windows, sorting, scalar functions, reports."""

from pyspark.sql import functions as F

from mentiongrid.functions.interval import binomial_interval, clamp_interval, normalized
from mentiongrid.operators.panel import complete_panel, mean_rate, mention_rates
from mentiongrid.operators.reports import MAP_COLUMNS, map_report, month_date, population, series_report, uncertainty_map, with_names
from mentiongrid.operators.series import impute_group_mean, rolling_mean
from mentiongrid.registry.base import (
    ARTICLES, FLAT_SQL, NAMES_SQL, PANEL_SQL, articles, names, query, stored_flat, table,
)
from mentiongrid.registry.interval_sql import with_interval
from mentiongrid.registry.sources import MONTHLY_ORDERS_SQL, monthly_orders


def _panel(spark, sf):
    return mention_rates(complete_panel(stored_flat(spark, sf)))


@query("h01_group_by_year_and_month", MONTHLY_ORDERS_SQL)
def _h01(spark, sf):
    return monthly_orders(spark, sf)


@query(
    "h02_rows_and_true_flags",
    "SELECT o_orderstatus, COUNT(*) AS n_location, COUNT(*) FILTER (WHERE o_totalprice > 250000) AS n_both FROM orders GROUP BY o_orderstatus",
)
def _h02(spark, sf):
    orders = table(spark, sf, "orders").groupBy("o_orderstatus")
    return orders.agg(F.count(F.lit(1)).alias("n_location"), F.count_if(F.col("o_totalprice") > 250000).alias("n_both"))


@query(
    "h03_group_sums",
    f"WITH {FLAT_SQL} SELECT disease, year, cbscode, CAST(SUM(n_location) AS BIGINT) AS n_location, CAST(SUM(n_both) AS BIGINT) AS n_both FROM flat GROUP BY 1, 2, 3",
)
def _h03(spark, sf):
    return stored_flat(spark, sf).groupBy("disease", "year", "cbscode").agg(
        F.sum("n_location").alias("n_location"), F.sum("n_both").alias("n_both")
    )


@query(
    "h04_mean_of_rates",
    f"WITH {PANEL_SQL} SELECT cbscode, year, round(AVG(mention_rate), 9) AS mention_rate FROM panel GROUP BY cbscode, year",
)
def _h04(spark, sf):
    return mean_rate(_panel(spark, sf)).withColumn("mention_rate", F.round("mention_rate", 9))


@query(
    "h05_distinct_values_of_columns",
    f"""WITH {ARTICLES} SELECT 'lang' AS key, lang AS value FROM articles GROUP BY lang
UNION ALL SELECT 'newspaper_id', newspaper_id FROM articles GROUP BY newspaper_id
UNION ALL SELECT 'year', CAST(year AS VARCHAR) FROM articles GROUP BY year""",
)
def _h05(spark, sf):
    columns = ["lang", "newspaper_id", "year"]
    pairs = F.inline(F.array(*(F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value")) for c in columns)))
    return articles(spark, sf).select(*columns).select(pairs).distinct()


@query(
    "h06_rolling_mean_of_six_months",
    f"""SELECT year, month, count, CASE WHEN COUNT(count) OVER w = 6 THEN AVG(count) OVER w END AS count_6m
FROM ({MONTHLY_ORDERS_SQL}) WINDOW w AS (ORDER BY year, month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def _h06(spark, sf):
    one_series = monthly_orders(spark, sf).withColumn("series", F.lit(1))
    return rolling_mean(one_series, ["series"], ["year", "month"], "count").drop("series")


@query(
    "h06_rolling_mean_per_series",
    """WITH m AS (SELECT o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
  COUNT(*) AS count FROM orders GROUP BY 1, 2, 3)
SELECT *, CASE WHEN COUNT(count) OVER w = 6 THEN AVG(count) OVER w END AS count_6m
FROM m WINDOW w AS (PARTITION BY o_orderpriority ORDER BY year, month ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)""",
)
def _h06_series(spark, sf):
    orders = table(spark, sf, "orders")
    keys = ["o_orderpriority", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")]
    monthly = orders.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return rolling_mean(monthly, ["o_orderpriority"], ["year", "month"], "count")


@query(
    "h07_group_mean_imputation",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_returnflag <> 'R' THEN CAST(year(l_shipdate) AS INTEGER) END AS year,
  CASE WHEN l_quantity > 10 THEN l_quantity END AS n_both, CASE WHEN l_linenumber <> 2 THEN CAST(l_linenumber AS DOUBLE) END AS n_location FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, year, round(COALESCE(n_both, AVG(n_both) OVER (PARTITION BY year)), 6) AS n_both,
  round(COALESCE(n_location, AVG(n_location) OVER (PARTITION BY year)), 6) AS n_location FROM x""",
)
def _h07(spark, sf):
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_returnflag") != "R", F.year("l_shipdate")).alias("year"),
        F.when(F.col("l_quantity") > 10, F.col("l_quantity")).alias("n_both"),
        F.when(F.col("l_linenumber") != 2, F.col("l_linenumber").cast("double")).alias("n_location"),
    )
    filled = impute_group_mean(rows, ["year"], ["n_both", "n_location"])
    return filled.withColumns({c: F.round(c, 6) for c in ("n_both", "n_location")})


@query("h08_sorted_panel", f"WITH {PANEL_SQL} SELECT * FROM panel ORDER BY disease, year, month, cbscode")
def _h08(spark, sf):
    return _panel(spark, sf).orderBy("disease", "year", "month", "cbscode")


_POPULATION = """WITH m AS (SELECT c_custkey AS amsterdamcode, c_acctbal AS pop_m FROM customer),
f AS (SELECT s_suppkey AS amsterdamcode, s_acctbal AS pop_f FROM supplier)
SELECT amsterdamcode, pop_m, pop_f, pop_m + pop_f AS pop FROM m LEFT JOIN f USING (amsterdamcode)"""


@query("h10_population_in_descending_order", _POPULATION)
def _h10(spark, sf):
    men = table(spark, sf, "customer").select(F.col("c_custkey").alias("amsterdamcode"), F.col("c_acctbal").alias("pop_m"))
    women = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("amsterdamcode"), F.col("s_acctbal").alias("pop_f"))
    return population(men, women)


@query("h11_first_rows", f"WITH {PANEL_SQL} SELECT * FROM panel ORDER BY mention_rate DESC, disease, year, month, cbscode LIMIT 10")
def _h11(spark, sf):
    return _panel(spark, sf).orderBy(F.desc("mention_rate"), "disease", "year", "month", "cbscode").limit(10)


@query("h12_date_parts", "SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month FROM orders")
def _h12(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query(
    "h13_dates_from_parts_and_texts",
    "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start, CAST(o_orderdate AS DATE) AS parsed FROM orders",
)
def _h13(spark, sf):
    orders = table(spark, sf, "orders")
    start = month_date(F.year("o_orderdate"), F.month("o_orderdate"))
    return orders.select("o_orderkey", start.alias("month_start"), F.to_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("parsed"))


@query("h14_last_day_of_month", "SELECT o_orderkey, last_day(o_orderdate) AS last_day, strftime(last_day(o_orderdate), '%Y-%m-%d') AS iso FROM orders")
def _h14(spark, sf):
    last = F.last_day("o_orderdate")
    return table(spark, sf, "orders").select("o_orderkey", last.alias("last_day"), F.date_format(last, "yyyy-MM-dd").alias("iso"))


_SUPPLIER_YEAR = """s AS (SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, COUNT(*) AS n_location,
  COUNT(*) FILTER (WHERE l_returnflag = 'A' AND l_discount > 0.02) AS n_both FROM lineitem GROUP BY 1, 2)"""


def _supplier_years(spark, sf):
    rows = table(spark, sf, "lineitem").groupBy("l_suppkey", F.year("l_shipdate").alias("year"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_location"),
        F.count_if((F.col("l_returnflag") == "A") & (F.col("l_discount") > 0.02)).alias("n_both"),
    )


@query(
    "h15_case_chains",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity = 1 THEN 0.0 WHEN l_quantity > 40 THEN 1.0 ELSE l_discount END AS level FROM lineitem""",
)
def _h15(spark, sf):
    level = F.when(F.col("l_quantity") == 1, 0.0).when(F.col("l_quantity") > 40, 1.0).otherwise(F.col("l_discount"))
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", level.alias("level"))


@query(
    "h16_guarded_division",
    f"""WITH {_SUPPLIER_YEAR} SELECT l_suppkey, year, CASE WHEN n_both = 0 THEN CAST('NaN' AS DOUBLE)
  ELSE CAST(n_location AS DOUBLE) / n_both END AS ratio, CAST(n_both AS DOUBLE) / n_location AS mention_rate FROM s""",
)
def _h16(spark, sf):
    rows = _supplier_years(spark, sf)
    return rows.select(
        "l_suppkey", "year", normalized(F.col("n_location"), F.col("n_both")).alias("ratio"),
        normalized(F.col("n_both"), F.col("n_location")).alias("mention_rate"),
    )


_SUPPLIER_COUNTS = f"WITH {_SUPPLIER_YEAR} SELECT l_suppkey, year, n_location, n_both FROM s"


def rounded(bounds):
    """Bounds to six digits, as two ways of computing them agree on."""
    return bounds.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("h17_binomial_interval", with_interval(_SUPPLIER_COUNTS, "l_suppkey, year, n_location, n_both", "textbook"))
def _h17(spark, sf):
    return rounded(binomial_interval(_supplier_years(spark, sf), "n_both", "n_location"))


@query("h17_binomial_interval_as_published", with_interval(_SUPPLIER_COUNTS, "l_suppkey, year, n_location, n_both", "reference"))
def _h17_published(spark, sf):
    return rounded(binomial_interval(_supplier_years(spark, sf), "n_both", "n_location", variant="reference"))


@query(
    "h18_interval_clamping",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_linenumber - 1 AS BIGINT) AS n_both,
  CASE WHEN l_quantity = 1 THEN 1.0 WHEN l_quantity = 2 THEN CAST('NaN' AS DOUBLE) ELSE l_tax END AS rate,
  l_discount AS lower, l_discount + 0.02 AS upper FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, n_both, rate,
  CASE WHEN n_both = 0 THEN 0.0 WHEN lower > rate THEN rate ELSE lower END AS lower,
  CASE WHEN rate = 1 THEN 1.0 WHEN upper < rate THEN rate ELSE upper END AS upper FROM x""",
)
def _h18(spark, sf):
    rate = F.when(F.col("l_quantity") == 1, 1.0).when(F.col("l_quantity") == 2, float("nan")).otherwise(F.col("l_tax"))
    rows = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (F.col("l_linenumber") - 1).cast("bigint").alias("n_both"), rate.alias("rate"),
        F.col("l_discount").alias("lower"), (F.col("l_discount") + 0.02).alias("upper"),
    )
    return clamp_interval(rows, "n_both", "rate")


@query("h19_width_and_sums", f"WITH p AS ({_POPULATION}) SELECT amsterdamcode, pop_m + pop_f AS pop, pop_m - pop_f AS width FROM p")
def _h19(spark, sf):
    rows = _h10(spark, sf)
    return rows.select("amsterdamcode", "pop", (F.col("pop_m") - F.col("pop_f")).alias("width"))


@query("h20_zeros_for_missing_counts", "SELECT c_custkey, COUNT(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY c_custkey")
def _h20(spark, sf):
    counts = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    customers = table(spark, sf, "customer").select("c_custkey")
    return customers.join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").fillna(0, subset=["n"]).select("c_custkey", "n")


@query(
    "h21_text_functions",
    """SELECT page_id, lower(url) AS lowered, string_split(url, '/')[3] AS host, url || '#' || page_id AS joined,
  regexp_replace(url, '^https?://', '') AS stripped, contains(url, 'example.com') AS is_com,
  regexp_extract(url, '/([a-z]{2})/', 1) AS lang, substr(url, 1, length(url) - 2) AS shortened FROM pages""",
)
def _h21(spark, sf):
    url = F.col("url")
    return table(spark, sf, "pages").select(
        "page_id", F.lower(url).alias("lowered"), F.element_at(F.split(url, "/"), 3).alias("host"),
        F.concat(url, F.lit("#"), F.col("page_id").cast("string")).alias("joined"),
        F.regexp_replace(url, "^https?://", "").alias("stripped"), url.contains("example.com").alias("is_com"),
        F.regexp_extract(url, "/([a-z]{2})/", 1).alias("lang"), F.left(url, F.length(url) - 2).alias("shortened"),
    )


@query("h22_casts", "SELECT CAST(l_orderkey AS VARCHAR) AS code, CAST(l_linenumber AS VARCHAR) AS line, CAST(l_partkey AS INTEGER) AS part, CAST(l_quantity AS INTEGER) AS n FROM lineitem")
def _h22(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("code"), F.col("l_linenumber").cast("string").alias("line"),
        F.col("l_partkey").cast("int").alias("part"), F.col("l_quantity").cast("int").alias("n"),
    )


@query("h23_columns_in_order", f"WITH {FLAT_SQL} SELECT disease, year, month, cbscode, n_location, n_both FROM flat")
def _h23(spark, sf):
    return stored_flat(spark, sf).select("disease", "year", "month", "cbscode", "n_location", "n_both")


@query(
    "h24_constant_per_branch",
    f"""WITH {FLAT_SQL}, {NAMES_SQL}, g AS (SELECT cbscode, year, month, n_both FROM flat WHERE disease = 'gamma')
SELECT n.cbscode, n.location, g.month, g.n_both, CAST(1834 AS INTEGER) AS year FROM names n LEFT JOIN g ON g.cbscode = n.cbscode AND g.year = 1834
UNION ALL SELECT n.cbscode, n.location, g.month, g.n_both, CAST(1835 AS INTEGER) FROM names n LEFT JOIN g ON g.cbscode = n.cbscode AND g.year = 1835""",
)
def _h24(spark, sf):
    gamma, places = stored_flat(spark, sf).filter("disease = 'gamma'"), names(spark).select("cbscode", "location")
    branches = [
        with_names(places, gamma.filter(F.col("year") == y).select("cbscode", "month", "n_both")).withColumn("year", F.lit(y))
        for y in (1834, 1835)
    ]
    return branches[0].unionByName(branches[1])


@query(
    "h25_map_report",
    f"""WITH {PANEL_SQL}, {NAMES_SQL}, r AS (SELECT cbscode, year, round(AVG(mention_rate), 9) AS mention_rate FROM panel
  WHERE year <= 1836 AND year >= 1832 AND disease = 'gamma' GROUP BY cbscode, year) SELECT r.*, location, amsterdamcode FROM r LEFT JOIN names USING (cbscode)""",
)
def _h25(spark, sf):
    report = map_report(_panel(spark, sf), names(spark), "gamma", 1832, 1836)
    return report.withColumn("mention_rate", F.round("mention_rate", 9))


_MAP_YEARS = (1832, 1833, 1834, 1835, 1836)
_MAP_SQL = with_interval(
    f"""WITH {FLAT_SQL}, {NAMES_SQL}, counts AS (
  SELECT year, cbscode, SUM(n_both) AS n_both, SUM(n_location) AS n_location FROM flat WHERE disease = 'gamma' GROUP BY ALL HAVING SUM(n_location) < 40)
SELECT y AS year, cbscode, location, amsterdamcode, n_both, n_location
FROM names CROSS JOIN (SELECT unnest({list(_MAP_YEARS)}) AS y) LEFT JOIN (SELECT year AS y, cbscode, n_both, n_location FROM counts) USING (y, cbscode)""",
    "base.*", "textbook", digits=13,
)


def _filled(c: str) -> str:
    return f"round(coalesce({c}, AVG({c}) OVER (PARTITION BY year)), 6)"


@query(
    "h25_uncertainty_map",
    f"""SELECT CAST(year AS INTEGER) AS year, cbscode, location, amsterdamcode, {", ".join(f"{_filled(c)} AS {c}" for c in ("n_both", "n_location", "lower", "upper", "width"))},
  round(coalesce(n_both, AVG(n_both) OVER (PARTITION BY year)) / coalesce(n_location, AVG(n_location) OVER (PARTITION BY year)), 6) AS mention_rate
FROM (SELECT * REPLACE (CAST(n_both AS DOUBLE) AS n_both, CAST(n_location AS DOUBLE) AS n_location), upper - lower AS width FROM ({_MAP_SQL}))""",
)
def _h25_uncertainty(spark, sf):
    counts = stored_flat(spark, sf).filter("disease = 'gamma'").groupBy("year", "cbscode").agg(F.sum("n_both").alias("n_both"), F.sum("n_location").alias("n_location"))
    rows = uncertainty_map(counts, names(spark), _MAP_YEARS, most_mentions=40)
    return rows.withColumns({c: F.round(c, 6) for c in (*MAP_COLUMNS, "mention_rate")})


def _series(spark, sf):
    return series_report(_panel(spark, sf), names(spark), ["Oned", "Ver", "Thble"], ["alpha", "gamma"])


_SERIES_SQL = f"""WITH {PANEL_SQL}, {NAMES_SQL} SELECT panel.*, location, amsterdamcode, make_date(year, month, 1) AS date,
  CASE WHEN n_location = 0 THEN CAST('NaN' AS DOUBLE) ELSE CAST(n_both AS DOUBLE) / n_location END AS normalized_mentions
FROM panel JOIN names USING (cbscode) WHERE location IN ('Oned', 'Ver', 'Thble') AND disease IN ('alpha', 'gamma')"""


@query(
    "h26_series_report",
    with_interval(
        _SERIES_SQL, "base.*", "reference",
        "CASE WHEN n_both = 0 THEN CAST(0 AS DOUBLE) ELSE least(lower, normalized_mentions) END",
        "CASE WHEN normalized_mentions = 1 THEN CAST(1 AS DOUBLE) ELSE greatest(upper, normalized_mentions) END",
    ),
)
def _h26(spark, sf):
    return rounded(_series(spark, sf))


@query("h26_series_report_rates", _SERIES_SQL)
def _h26_rates(spark, sf):
    return _series(spark, sf).drop("lower", "upper")
