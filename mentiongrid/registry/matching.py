"""E: matching, counting, panel."""

from pyspark.sql import functions as F

from mentiongrid.fixed_values import PAIR_QUERIES
from mentiongrid.functions.interval import binomial_interval
from mentiongrid.operators.counting import (
    mention_counts, pair_counts, pair_set_counts, place_counts, place_shares, with_pair_flags,
)
from mentiongrid.operators.dictionary import compile_terms, load_terms, terms_table
from mentiongrid.operators.matching import match_terms, mention, with_folded, with_mentioned_ids
from mentiongrid.operators.panel import complete_panel, duplicate_keys, mention_rates, yearly
from mentiongrid.plans import ad_hoc
from mentiongrid.plans.build_database import Dictionaries, build, flat_counts, monthly_panel
from mentiongrid.registry.interval_sql import with_interval
from mentiongrid.registry.base import (
    ARTICLES, EVERYWHERE_SQL, EVERYWHERE_TOPICS, FLAT_SQL, FULL_PLACES_SQL, FULL_TOPICS, FULL_TOPICS_SQL, HITS_SQL, OPEN_PLACES_SQL, PAIR_PLACE, PAIR_TOPIC, PANEL_SQL, PLACES, PLACES_SQL, TOPICS,
    articles, dictionaries, full_places, open_places, place_terms, query, stored_flat, table, topic_terms,
)
from mentiongrid.session import local_table, new_folder
from mentiongrid.sources.sinks import write_csv
from mentiongrid.sources.tables import read_csv

_GAMMA = TOPICS[2][1]


@query("e01_articles_of_a_place", f"WITH {ARTICLES} SELECT article_id, newspaper_date, lang FROM articles WHERE regexp_matches(article_text, '(?i){PLACES[4][1]}')")
def _e01(spark, sf):
    place = place_terms()[4]
    folded = with_folded(articles(spark, sf), "article_text")
    return folded.filter(mention("article_text", place, F.col("_folded"))).select("article_id", "newspaper_date", "lang")


@query(
    "e02_mention_flags",
    f"WITH {ARTICLES} SELECT article_id, regexp_matches(article_text, '(?i){PAIR_TOPIC}') AS disease, "
    f"regexp_matches(article_text, '(?i){PAIR_PLACE}') AS location FROM articles",
)
def _e02(spark, sf):
    return with_pair_flags(articles(spark, sf).select("article_id", "article_text"), PAIR_TOPIC, PAIR_PLACE).drop("both")


_FLAT = "SELECT year, month, n_location, n_both, location, cbscode, amsterdamcode, disease FROM flat"


@query("e03_all_pairs_by_month", f"WITH {FLAT_SQL} {_FLAT}")
def _e03(spark, sf):
    return flat_counts(articles(spark, sf), dictionaries())


# A dictionary of realistic size: every word of at least five letters found in 2 % of the
# articles. Its number of rows is bounded by words per article / 2 %, so it may be collected.
_VOCABULARY_SQL = f"""{ARTICLES},
numbered AS (SELECT row_number() OVER () AS id, * FROM articles),
words AS (SELECT DISTINCT id, unnest(regexp_split_to_array(lower(article_text), '[^a-z0-9_]+')) AS word FROM numbered),
vocabulary AS (
  SELECT word FROM words WHERE regexp_full_match(word, '[a-z]{{5,}}') GROUP BY word
  HAVING COUNT(*) * 50 >= (SELECT COUNT(*) FROM articles))"""


def vocabulary_terms(spark, sf):
    word = F.explode(F.array_distinct(F.split(F.lower("article_text"), "[^a-z0-9_]+"))).alias("word")
    counted = articles(spark, sf).select(word).filter(F.col("word").rlike("^[a-z]{5,}$")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    total = table(spark, sf, "documents").count()
    words = counted.filter(F.col("n") * 50 >= total).select("word").orderBy("word").collect()
    return compile_terms([(w.word, rf"\b{w.word}\b", w.word) for w in words])


@query(
    "e03_large_dictionary_by_month",
    f"""WITH {_VOCABULARY_SQL}
SELECT year, month, word AS location, COUNT(*) AS n_location,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){_GAMMA}')) AS n_both
FROM numbered JOIN words USING (id) SEMI JOIN vocabulary USING (word) GROUP BY year, month, word""",
)
def _e03_large(spark, sf):
    terms = vocabulary_terms(spark, sf)
    counts = mention_counts(articles(spark, sf), terms, [topic_terms()[2]])
    return counts.join(terms_table(spark, terms, "place_id", {"location": "string"}), "place_id").select("year", "month", "location", "n_location", "n_both")


def full_dictionaries(spark) -> Dictionaries:
    """The large dictionaries, written as the delivered CSV files and read back."""
    columns = {"name": "string", "Regex": "string", "cbscode": "int", "amsterdamcode": "int"}
    places, topics = new_folder(spark, "places"), new_folder(spark, "topics")
    write_csv(local_table(spark, full_places(), columns), places)
    write_csv(local_table(spark, FULL_TOPICS, {"Label": "string", "Regex": "string"}), topics)
    place_rows = read_csv(spark, places, ", ".join(f"{c} {t}" for c, t in columns.items()))
    topic_rows = read_csv(spark, topics, "Label string, Regex string")
    return Dictionaries(
        load_terms(place_rows, "name", "Regex", ("name", "cbscode", "amsterdamcode")), load_terms(topic_rows, "Label", "Regex", ("Label",))
    )


@query(
    "e03_full_dictionary_by_month",
    f"""WITH {ARTICLES},
{FULL_PLACES_SQL},
{FULL_TOPICS_SQL},
flags AS (SELECT label, list(article_id) AS ids FROM articles, topics WHERE regexp_matches(article_text, '(?i)' || topic_regex) GROUP BY label),
hits AS (SELECT article_id, year, month, location, cbscode, amsterdamcode FROM articles JOIN places ON regexp_matches(article_text, '(?i)' || regex)),
counted AS (SELECT year, month, location, cbscode, amsterdamcode, COUNT(*) AS n_location FROM hits GROUP BY ALL),
both_ AS (SELECT year, month, location, label, COUNT(*) AS n_both FROM hits JOIN (SELECT label, unnest(ids) AS article_id FROM flags) USING (article_id) GROUP BY ALL)
SELECT year, month, n_location, COALESCE(n_both, 0) AS n_both, location, cbscode, amsterdamcode, lower(label) AS disease
FROM (SELECT * FROM counted, topics) LEFT JOIN both_ USING (year, month, location, label)""",
)
def _e03_full(spark, sf):
    return flat_counts(articles(spark, sf), full_dictionaries(spark))


@query("e04_completed_panel", f"WITH {PANEL_SQL} SELECT disease, year, month, cbscode, n_location, n_both FROM panel")
def _e04(spark, sf):
    return complete_panel(stored_flat(spark, sf))


@query("e05_monthly_rates", f"WITH {PANEL_SQL} SELECT * FROM panel")
def _e05(spark, sf):
    return monthly_panel(articles(spark, sf), dictionaries())


YEARLY_SQL = """SELECT disease, year, cbscode,
  CASE WHEN SUM(n_location) = 0 THEN 0.0 ELSE CAST(SUM(n_both) AS DOUBLE) / CAST(SUM(n_location) AS DOUBLE) END AS mention_rate,
  CAST(SUM(n_location) AS BIGINT) AS n_location, CAST(SUM(n_both) AS BIGINT) AS n_both
FROM panel GROUP BY disease, year, cbscode"""


@query("e05_yearly_rates", f"WITH {PANEL_SQL} {YEARLY_SQL}")
def _e05_yearly(spark, sf):
    return yearly(mention_rates(complete_panel(stored_flat(spark, sf))))


@query(
    "e06_repeated_panel_keys",
    f"""WITH {FLAT_SQL}, coded AS (SELECT * REPLACE (CASE WHEN cbscode = 101 THEN 103 ELSE cbscode END AS cbscode) FROM flat)
SELECT disease, year, month, cbscode, COUNT(*) AS n_rows FROM coded GROUP BY disease, year, month, cbscode HAVING COUNT(*) > 1""",
)
def _e06(spark, sf):
    # Two places that share a code.
    code = F.when(F.col("cbscode") == 101, 103).otherwise(F.col("cbscode"))
    return duplicate_keys(stored_flat(spark, sf).withColumn("cbscode", code))


def _near(a: str, b: str, n: int) -> str:
    """SQL expression for the proximity pattern of two pattern expressions."""
    return f"'(?i)(?:' || {a} || ').{{0,{n}}}(?:' || {b} || ')|(?:' || {b} || ').{{0,{n}}}(?:' || {a} || ')'"


_NEAR_40 = _near("topic_regex", "regex", 40)


@query(
    "e07_proximity_counts_by_month",
    f"""WITH {HITS_SQL}, topics2 AS (SELECT * FROM topics)
SELECT place_id, year, month, topic_id, COUNT(*) AS n_location,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, {_NEAR_40})) AS n_both
FROM hits, topics2 GROUP BY place_id, year, month, topic_id""",
)
def _e07(spark, sf):
    return mention_counts(articles(spark, sf), place_terms(), topic_terms(), max_chars=40)


_PAIR_FLAGS = f"""{ARTICLES}, flags AS (
  SELECT year AS yr, month AS mo, regexp_matches(article_text, '(?i){PAIR_TOPIC}') AS disease,
         regexp_matches(article_text, '(?i){PAIR_PLACE}') AS location,
         regexp_matches(article_text, {_near(f"'{PAIR_TOPIC}'", f"'{PAIR_PLACE}'", 40)}) AS near
  FROM articles)"""


@query(
    "e07_full_proximity_everywhere",
    f"""WITH {ARTICLES},
{OPEN_PLACES_SQL},
{EVERYWHERE_SQL},
hits AS (SELECT article_id, article_text, year, month, place_id, regex FROM articles JOIN places ON regexp_matches(article_text, '(?i)' || regex)),
topical AS (SELECT article_id, topic_id, topic_regex FROM articles JOIN topics ON regexp_matches(article_text, '(?i)' || topic_regex)),
close AS (SELECT place_id, year, month, topic_id, COUNT(*) AS n_both FROM hits JOIN topical USING (article_id) WHERE regexp_matches(article_text, {_NEAR_40}) GROUP BY ALL),
counted AS (SELECT place_id, year, month, COUNT(*) AS n_location FROM hits GROUP BY ALL)
SELECT place_id, year, month, topic_id, n_location, COALESCE(n_both, 0) AS n_both
FROM (SELECT * FROM counted, topics) LEFT JOIN close USING (place_id, year, month, topic_id)""",
)
def _e07_everywhere(spark, sf):
    places = compile_terms([(name, regex, name) for name, regex, _, _ in open_places()], unicode_case=True)
    topics = compile_terms([(label, regex, label) for label, regex in EVERYWHERE_TOPICS], unicode_case=True)
    return mention_counts(articles(spark, sf), places, topics, max_chars=40, unicode_case=True)


@query(
    "e08_pair_counts_by_month",
    f"""WITH {_PAIR_FLAGS} SELECT yr, mo, COUNT(*) AS n_total, COUNT(*) FILTER (WHERE disease) AS n_disease,
  COUNT(*) FILTER (WHERE location) AS n_location, COUNT(*) FILTER (WHERE disease AND location) AS n_both
FROM flags WHERE yr >= 1831 AND yr < 1839 GROUP BY yr, mo""",
)
def _e08(spark, sf):
    return pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1831, 1839)


_SAVED = [*PAIR_QUERIES, ("erth thing", PAIR_TOPIC, PAIR_PLACE), ("cholera thing", r"cholera", PAIR_PLACE)]


@query(
    "e08_saved_pair_queries",
    f"WITH {ARTICLES} "
    + " UNION ALL ".join(
        f"SELECT '{label}' AS label, year AS yr, month AS mo, COUNT(*) AS n_total, "
        f"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){d}')) AS n_disease, "
        f"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){p}')) AS n_location, "
        f"COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){d}') AND regexp_matches(article_text, '(?i){p}')) AS n_both "
        "FROM articles GROUP BY year, month"
        for label, d, p in _SAVED
    ),
)
def _e08_saved(spark, sf):
    return pair_set_counts(articles(spark, sf), _SAVED)


@query(
    "e09_pair_counts_of_a_year",
    f"""WITH {_PAIR_FLAGS} SELECT yr, mo, COUNT(*) AS n_location, COUNT(*) FILTER (WHERE disease) AS n_both
FROM flags WHERE location AND yr = 1833 GROUP BY yr, mo""",
)
def _e09(spark, sf):
    return pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1833, 1834, denominator="location")


_SPACE_SQL = f"""WITH {HITS_SQL} SELECT year AS yr, month AS mo, location AS municipality, cbscode, amsterdamcode,
  COUNT(*) AS n_location, COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){_GAMMA}')) AS n_both
FROM hits WHERE year = 1833 GROUP BY ALL"""


def _query_space(spark, sf):
    terms = place_terms()
    year = articles(spark, sf).filter("newspaper_date >= '1833-01-01' and newspaper_date < '1834-01-01'")
    counts = mention_counts(year, terms, [topic_terms()[2]])
    codes = terms_table(spark, terms, "place_id", {"municipality": "string", "cbscode": "int", "amsterdamcode": "int"})
    return counts.join(codes, "place_id").select(
        F.col("year").alias("yr"), F.col("month").alias("mo"), "municipality", "cbscode", "amsterdamcode", "n_location", "n_both"
    )


@query("e10_counts_over_space", _SPACE_SQL)
def _e10(spark, sf):
    return _query_space(spark, sf)


@query("e10_counts_over_space_with_interval", with_interval(_SPACE_SQL, "base.*", "reference"))
def _e10_interval(spark, sf):
    found = binomial_interval(_query_space(spark, sf), "n_both", "n_location", variant="reference")
    return found.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


_TIME_SQL = f"""WITH {_PAIR_FLAGS} SELECT yr, mo, COUNT(*) AS n_location, COUNT(*) FILTER (WHERE disease) AS n_both
FROM flags WHERE location AND yr >= 1830 AND yr < 1840 GROUP BY yr, mo"""


@query("e11_counts_over_time", _TIME_SQL)
def _e11(spark, sf):
    return pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1830, 1840, denominator="location")


@query("e11_counts_over_time_with_interval", with_interval(_TIME_SQL, "base.*", "reference"))
def _e11_interval(spark, sf):
    counts = pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1830, 1840, denominator="location")
    found = binomial_interval(counts, "n_both", "n_location", variant="reference")
    return found.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query(
    "e12_year_counts_per_place",
    f"""WITH {ARTICLES}, {PLACES_SQL} SELECT year, place_id,
  COUNT(*) AS n_total, COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){_GAMMA}')) AS n_disease,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)' || regex)) AS n_location,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)' || regex) AND regexp_matches(article_text, '(?i){_GAMMA}')) AS n_both
FROM articles, places GROUP BY year, place_id""",
)
def _e12(spark, sf):
    return place_counts(articles(spark, sf), place_terms(), topic_terms()[2], by=("year",), unicode_case=False)


@query(
    "e13_near_share_by_month",
    f"WITH {_PAIR_FLAGS} SELECT yr, mo, COUNT(*) AS n_total, COUNT(*) FILTER (WHERE near) AS n_near_matches FROM flags GROUP BY yr, mo",
)
def _e13(spark, sf):
    counts = pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, max_chars=40)
    return counts.select("yr", "mo", "n_total", F.col("n_both").alias("n_near_matches"))


def _shares_sql(n: int, denominator: str, by: str) -> str:
    near = _near(f"'{_GAMMA}'", "regex", n)
    return f"""WITH {ARTICLES}, {PLACES_SQL}, counted AS (SELECT {by}, place_id,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)' || regex) AND regexp_matches(article_text, {near})) AS n_both,
  COUNT(*) FILTER (WHERE {denominator}) AS n_total FROM articles, places GROUP BY {by}, place_id)
SELECT *, CASE WHEN n_total = 0 THEN 0.0 ELSE CAST(n_both AS DOUBLE) / n_total END AS normalized_mentions FROM counted"""


@query("e14_near_share_of_all_articles", _shares_sql(20, "true", "year"))
def _e14(spark, sf):
    return place_shares(
        articles(spark, sf), place_terms(), topic_terms()[2], by=("year",), max_chars=20, denominator="total", unicode_case=False
    )


_HERE = "regexp_matches(article_text, '(?i)' || regex)"


@query("e15_near_share_of_a_month", _shares_sql(40, _HERE, "year, month") + " WHERE year = 1833 AND month = 6")
def _e15(spark, sf):
    month = articles(spark, sf).filter("newspaper_date >= '1833-06-01' and newspaper_date < '1833-07-01'")
    return place_shares(month, place_terms(), topic_terms()[2], max_chars=40, unicode_case=False)


@query("e16_near_share_of_all_months", _shares_sql(40, _HERE, "year, month"))
def _e16(spark, sf):
    return place_shares(articles(spark, sf), place_terms(), topic_terms()[2], max_chars=40, unicode_case=False)


@query(
    "e16_near_share_of_full_dictionary",
    f"""WITH {ARTICLES},
{FULL_PLACES_SQL},
hits AS (SELECT article_id, article_text, year, month, cbscode, regex FROM articles JOIN places ON regexp_matches(article_text, '(?i)' || regex)),
counted AS (SELECT year, month, cbscode, COUNT(*) AS n_total FROM hits GROUP BY ALL),
close AS (SELECT year, month, cbscode, COUNT(*) AS n_both FROM hits WHERE regexp_matches(article_text, '(?i){_GAMMA}')
  AND regexp_matches(article_text, {_near(f"'{_GAMMA}'", "regex", 40)}) GROUP BY ALL)
SELECT year, month, cbscode, COALESCE(n_both, 0) AS n_both, COALESCE(n_total, 0) AS n_total,
  CASE WHEN COALESCE(n_total, 0) = 0 THEN 0.0 ELSE CAST(COALESCE(n_both, 0) AS DOUBLE) / n_total END AS normalized_mentions
FROM (SELECT DISTINCT year, month FROM articles) CROSS JOIN (SELECT cbscode FROM places)
  LEFT JOIN counted USING (year, month, cbscode) LEFT JOIN close USING (year, month, cbscode)""",
)
def _e16_full(spark, sf):
    places = full_dictionaries(spark).places
    shares = place_shares(articles(spark, sf), places, topic_terms()[2], max_chars=40, unicode_case=False)
    codes = terms_table(spark, places, "place_id", {"location": "string", "cbscode": "int", "amsterdamcode": "int"})
    return shares.join(codes, "place_id").select("year", "month", "cbscode", "n_both", "n_total", "normalized_mentions")


@query(
    "e17_counts_over_everything",
    f"WITH {_PAIR_FLAGS} SELECT COUNT(*) AS n_total, COUNT(*) FILTER (WHERE disease) AS n_disease, "
    "COUNT(*) FILTER (WHERE location) AS n_location, COUNT(*) FILTER (WHERE near) AS n_both FROM flags",
)
def _e17(spark, sf):
    return pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE, by=(), max_chars=40)


@query("e18_hits_of_a_query_by_month", f"WITH {_PAIR_FLAGS} SELECT yr AS year, mo AS month, COUNT(*) FILTER (WHERE disease AND location) AS count FROM flags GROUP BY yr, mo")
def _e18(spark, sf):
    counts = pair_counts(articles(spark, sf), PAIR_TOPIC, PAIR_PLACE)
    return counts.select(F.col("yr").alias("year"), F.col("mo").alias("month"), F.col("n_both").alias("count"))


@query("g08_articles_joined_to_terms", f"WITH {HITS_SQL} SELECT article_id, place_id AS term_id FROM hits")
def _g08(spark, sf):
    rows = articles(spark, sf).select("article_id", "article_text")
    return match_terms(rows, place_terms(), "article_text").select("article_id", "term_id")


@query(
    "g08_terms_of_each_article",
    f"""WITH {HITS_SQL} SELECT article_id, newspaper_id, COUNT(place_id) AS n_terms
FROM (SELECT a.article_id, a.newspaper_id, a.newspaper_date, a.article_text, p.place_id FROM articles a
  LEFT JOIN places p ON regexp_matches(a.article_text, '(?i)' || p.regex)) GROUP BY article_id, newspaper_id, newspaper_date, article_text""",
)
def _g08_array(spark, sf):
    rows = articles(spark, sf).select("article_id", "newspaper_id", "article_text")
    ids = with_mentioned_ids(rows, "article_text", place_terms(), "terms")
    return ids.select("article_id", "newspaper_id", F.size("terms").cast("bigint").alias("n_terms"))


# --- plans --------------------------------------------------------------------

_OPEN = [(name, regex.replace("\\b", "").replace("\\w*", ""), cbs, ams) for name, regex, cbs, ams in PLACES]
_OPEN_SQL = "places(location, regex, cbscode, amsterdamcode) AS (VALUES " + ", ".join(f"('{n}', '{r}', {c}, {a})" for n, r, c, a in _OPEN) + ")"


def _open_terms():
    return compile_terms([(name, regex, name, cbs, ams) for name, regex, cbs, ams in _OPEN], unicode_case=True)


def _plain(spark, sf):
    return articles(spark, sf).select("article_text", "newspaper_date")


@query(
    "e10_plan_over_space",
    with_interval(
        f"""WITH {ARTICLES}, {_OPEN_SQL} SELECT year, month, location, cbscode, amsterdamcode, COUNT(*) AS n_location,
  COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){PAIR_TOPIC}')) AS n_both
FROM articles JOIN places ON regexp_matches(article_text, '(?i)' || regex) WHERE year = 1834 GROUP BY ALL""",
        "base.*", "reference",
    ),
)
def _plan_space(spark, sf):
    rows = ad_hoc.over_space(_plain(spark, sf), _open_terms(), PAIR_TOPIC, 1834)
    return rows.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query("e11_plan_over_time", with_interval(_TIME_SQL, "base.*", "reference"))
def _plan_time(spark, sf):
    rows = ad_hoc.over_time(_plain(spark, sf), PAIR_TOPIC, PAIR_PLACE, 1830, 1840)
    return rows.withColumns({c: F.round(c, 6) for c in ("lower", "upper")})


@query(
    "e12_plan_year_map",
    f"""WITH {ARTICLES}, {_OPEN_SQL}, y AS (SELECT * FROM articles WHERE year = 1834),
counted AS (SELECT location, COUNT(*) AS n_location, COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i){PAIR_TOPIC}')) AS n_both
  FROM y JOIN places ON regexp_matches(article_text, '(?i)' || regex) GROUP BY location)
SELECT location, cbscode, amsterdamcode, CAST(1834 AS INTEGER) AS year, COALESCE(n_location, 0) AS n_location, COALESCE(n_both, 0) AS n_both,
  (SELECT COUNT(*) FROM y WHERE regexp_matches(article_text, '(?i){PAIR_TOPIC}')) AS n_disease
FROM places LEFT JOIN counted USING (location)""",
)
def _plan_map(spark, sf):
    return ad_hoc.year_map(_plain(spark, sf), _open_terms(), PAIR_TOPIC, 1834)


@query(
    "e05_plan_database_build",
    f"WITH {PANEL_SQL} {YEARLY_SQL}",
)
def _plan_build(spark, sf):
    out = new_folder(spark, "database")
    build(spark, _plain(spark, sf), dictionaries(), out)
    return spark.read.parquet(f"{out}/database_yearly")
