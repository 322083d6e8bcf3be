"""D: term dictionaries."""

from pyspark.sql import functions as F

from mentiongrid.fixed_values import TOPIC_TERMS
from mentiongrid.functions.ids import choose_query, last_word
from mentiongrid.functions.patterns import java_pattern, near_pattern
from mentiongrid.operators.counting import pair_set_counts
from mentiongrid.operators.dictionary import compile_term, select_pattern, validate_dictionary
from mentiongrid.operators.matching import mention, with_folded
from mentiongrid.registry.base import (
    ARTICLES, PAIR_PLACE, PAIR_TOPIC, PLACES, TOPICS, articles, query, table,
)

_ALL_TERMS = [*TOPIC_TERMS, *TOPICS, *((name, regex) for name, regex, _, _ in PLACES)]


@query(
    "d01_dictionary_patterns",
    f"WITH {ARTICLES} SELECT year, "
    + ", ".join(f"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){regex}')) AS {label}" for label, regex in _ALL_TERMS)
    + " FROM articles GROUP BY year",
)
def _d01(spark, sf):
    folded = with_folded(articles(spark, sf).select("year", "article_text"), "article_text")
    terms = [compile_term(regex, label) for label, regex in _ALL_TERMS]
    flags = folded.select("year", *(mention("article_text", t, F.col("_folded")).alias(t.label) for t in terms))
    return flags.groupBy("year").agg(*(F.count_if(F.col(t.label)).alias(t.label) for t in terms))


@query(
    "d02_dictionary_validation",
    "SELECT p_partkey, CAST(p_partkey % 5 AS INTEGER) NOT IN (0, 3) AS usable FROM part",
)
def _d02(spark, sf):
    patterns = F.array(
        F.concat(F.lit(r"\b("), "p_name"), F.concat(F.lit(r"\b"), "p_name", F.lit(r"\b")),
        F.concat(F.lit("(?:[^a-zA-Z]|\\b)"), "p_brand"), F.concat(F.lit("*"), "p_name"), F.col("p_name"),
    )
    dictionary = table(spark, sf, "part").select("p_partkey", patterns[(F.col("p_partkey") % 5).cast("int")].alias("Regex"))
    checked = validate_dictionary(dictionary)
    return checked.select("p_partkey", F.col("pattern_error").isNull().alias("usable"))


def _near_sql(a: str, b: str, n: int) -> str:
    return f"(?i)(?:{a}).{{0,{n}}}(?:{b})|(?:{b}).{{0,{n}}}(?:{a})"


@query(
    "d03_proximity_pattern",
    f"WITH {ARTICLES} SELECT article_id, regexp_matches(article_text, '{_near_sql(PAIR_TOPIC, PAIR_PLACE, 20)}') AS near_20, "
    f"regexp_matches(article_text, '{_near_sql(PAIR_TOPIC, PAIR_PLACE, 40)}') AS near_40 FROM articles",
)
def _d03(spark, sf):
    folded = with_folded(articles(spark, sf).select("article_id", "article_text"), "article_text", unicode_case=True)
    both = [mention("article_text", compile_term(r, unicode_case=True), F.col("_folded")) for r in (PAIR_TOPIC, PAIR_PLACE)]
    # Each of the two is sought first; the distance is measured only where both are mentioned.
    flags = folded.select("article_id", "article_text", (both[0] & both[1]).alias("both"))
    near = {n: F.col("both") & F.col("article_text").rlike(near_pattern(PAIR_TOPIC, PAIR_PLACE, n, unicode_case=True)) for n in (20, 40)}
    return flags.select("article_id", near[20].alias("near_20"), near[40].alias("near_40"))


@query(
    "d04_automatic_queries",
    """SELECT p_partkey, COALESCE(CASE WHEN p_size < 10 THEN p_type END,
  substr(lower(p_name), 1, greatest(length(p_name) - 2, 0)) || '*') AS query FROM part""",
)
def _d04(spark, sf):
    manual = F.when(F.col("p_size") < 10, F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", choose_query(manual, F.col("p_name")).alias("query"))


@query(
    "d05_last_word_of_name",
    "SELECT c_custkey, NULLIF(regexp_extract(c_name, '(?i) ?(\\w+)$', 1), '') AS word FROM customer "
    "UNION ALL SELECT p_partkey, NULLIF(regexp_extract(p_name || CASE WHEN p_size > 25 THEN '.' ELSE '' END, '(?i) ?(\\w+)$', 1), '') FROM part",
)
def _d05(spark, sf):
    parts = table(spark, sf, "part")
    name = F.concat("p_name", F.when(F.col("p_size") > 25, F.lit(".")).otherwise(F.lit("")))
    customers = table(spark, sf, "customer").select("c_custkey", last_word(F.col("c_name")).alias("word"))
    return customers.union(parts.select("p_partkey", last_word(name).alias("word")))


@query(
    "d06_one_pattern_by_name",
    f"WITH {ARTICLES} SELECT lang, COUNT(*) AS n FROM articles WHERE regexp_matches(article_text, '(?i){TOPICS[1][1]}') GROUP BY lang",
)
def _d06(spark, sf):
    dictionary = spark.createDataFrame([(f"{label} group", regex) for label, regex in TOPICS], "Disease string, Regex string")
    pattern = java_pattern(select_pattern(dictionary, "Beta"))
    return articles(spark, sf).filter(F.col("article_text").rlike(pattern)).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("d07_labels_lower_cased", "SELECT p_partkey, lower(p_type) AS disease FROM part")
def _d07(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.lower("p_type").alias("disease"))


_CITIES = [("Oned", r"oned\."), ("Thing", "thing.*")]


@query(
    "d08_results_tagged_with_literals",
    f"WITH {ARTICLES} "
    + " UNION ALL ".join(
        f"SELECT '{city}' AS City, year AS yr, month AS mo, COUNT(*) AS n_total, "
        f"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){regex}')) AS n_location FROM articles GROUP BY year, month"
        for city, regex in _CITIES
    ),
)
def _d08(spark, sf):
    counts = pair_set_counts(articles(spark, sf), [(city, PAIR_TOPIC, regex) for city, regex in _CITIES])
    return counts.select(F.col("label").alias("City"), "yr", "mo", "n_total", "n_location")
