"""Registered queries: one per operator, each with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.fixed_values import CHOLERA_EVERYWHERE, SMALLPOX_EVERYWHERE
from mentiongrid.operators.dictionary import Term, compile_terms
from mentiongrid.plans.build_database import Dictionaries, flat_counts
from mentiongrid.session import local_table, new_folder, spread_small_scan
from mentiongrid.sources.sinks import write_by_year


@dataclass(frozen=True)
class Entry:
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build):
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Entry(build, sql)
        return build

    return register


# --- inputs ------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


_DATE = "date_add(date'1830-01-01', cast((doc_id % 3650 * 37) % 3650 as int))"

# The stored documents stand in for dated articles.
ARTICLES = """articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS article_id, source AS newspaper_id, lang,
         DATE '1830-01-01' + CAST((doc_id % 3650 * 37) % 3650 AS INTEGER) AS newspaper_date,
         CAST(year(DATE '1830-01-01' + CAST((doc_id % 3650 * 37) % 3650 AS INTEGER)) AS INTEGER) AS year,
         CAST(month(DATE '1830-01-01' + CAST((doc_id % 3650 * 37) % 3650 AS INTEGER)) AS INTEGER) AS month,
         text AS article_text
  FROM documents)"""


def articles(spark: SparkSession, sf: str) -> DataFrame:
    scan = spread_small_scan(table(spark, sf, "documents"), "doc_id")
    dated = scan.select(
        F.col("doc_id").cast("string").alias("article_id"), F.col("source").alias("newspaper_id"), "lang",
        F.expr(_DATE).alias("newspaper_date"), F.col("text").alias("article_text"),
    )
    return dated.withColumns({"year": F.year("newspaper_date"), "month": F.month("newspaper_date")})


PLACES = [
    ("Thble", r"\bthble\b", 101, 9001),
    ("Thti", r"\bthti\w*\b", 102, 9002),
    ("Oned", r"\b(oned|oner)\b", 103, 9003),
    ("Queau", r"\bqu?eau\b", 104, 9004),
    ("Ver", r"\bver\b", 105, 9005),
    ("Zzzz", r"\bzzzz\b", 106, 9006),
]
TOPICS = [
    ("Alpha", r"\b(er(th|ti)\w*|onin)\b"),
    ("Beta", r"\b(anea|thon\s?re)\b"),
    ("Gamma", r"\b(die|der)\b"),
]

# Patterns of single-pair queries; Unicode mode, hence without word boundaries.
PAIR_TOPIC, PAIR_PLACE = r"erth.*|th.?on", r"th(ing|ent)|oned\."


def place_terms(unicode_case: bool = False) -> list[Term]:
    return compile_terms([(name, regex, name, cbs, ams) for name, regex, cbs, ams in PLACES], unicode_case)


def topic_terms(unicode_case: bool = False) -> list[Term]:
    return compile_terms([(name, regex, name) for name, regex in TOPICS], unicode_case)


def dictionaries() -> Dictionaries:
    return Dictionaries(place_terms(), topic_terms())


def _values(name: str, columns: str, rows) -> str:
    def literal(v):
        return str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"

    body = ",\n    ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"{name}({columns}) AS (VALUES\n    {body})"


PLACES_SQL = _values("places", "place_id, location, regex, cbscode, amsterdamcode", [(i, *p) for i, p in enumerate(PLACES)])
TOPICS_SQL = _values("topics", "topic_id, label, topic_regex", [(i, *t) for i, t in enumerate(TOPICS)])

# A dictionary of about the size and the mixture of forms of a hand-written one: all pairs of these syllables, written as
# whole words, words with endings, alternatives, split words, open forms and substrings.
SYLLABLES = "th he in er an re on at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve co me de".split()
PLACE_FORMS = [
    r"\b{a}{b}\b", r"\b{a}{b}\w*\b", r"\b({a}{b}|{b}{a})\b", r"\b{a}{b}s?\b", r"\b{a}\s?{b}\b", r"\b{a}{b}(en|er)?\b", r"{a}{b}st|\b{a}{b}\.", r"\b{a}[aeo]{b}\b",
]
FULL_TOPICS = [
    *TOPICS, ("Delta", r"\b(the\s?re|whha\w*)\b"), ("Epsilon", r"\b(on(er|ed)|inan)\b"), ("Zeta", r"\b(re(re|th)\w*)\b"), ("Eta", r"\b(ou(an|re)|andou)\b"),
    ("Theta", r"\b(eau|eaux)\b"), ("Iota", r"\b(c|k)oup\b|schen"), ("Kappa", r"\b(tion\w*|ing\s?of)\b"),
]


def full_places() -> list[tuple]:
    """(name, Regex, cbscode, amsterdamcode) of the large dictionary."""
    pairs = [(a, b) for a in SYLLABLES for b in SYLLABLES]
    return [(a + "-" + b, PLACE_FORMS[k % len(PLACE_FORMS)].format(a=a, b=b), 1000 + k, 5000 + k) for k, (a, b) in enumerate(pairs)]


# The same size in the open form of the Unicode mode, where boundaries would differ between engines.
OPEN_FORMS = [r"{a}{b}s", r"{a}.?{b}t", r"({a}{b}|{b}{a})n", r"{a}[aeo]{b}", r"{a}\s?{b}(en|er)"]


def open_places() -> list[tuple]:
    """(name, Regex, cbscode, amsterdamcode) of the large dictionary without word boundaries."""
    return [(name, OPEN_FORMS[k % len(OPEN_FORMS)].format(a=name.split("-")[0], b=name.split("-")[1]), c, d) for k, (name, _, c, d) in enumerate(full_places())]


OPEN_PLACES_SQL = _values("places", "place_id, regex", [(k, p[1]) for k, p in enumerate(open_places())])
EVERYWHERE_TOPICS = [("Cholera", CHOLERA_EVERYWHERE), ("Smallpox", SMALLPOX_EVERYWHERE), ("Erth", r"erth|th.?on")]
EVERYWHERE_SQL = _values("topics", "topic_id, topic_regex", [(k, r) for k, (_, r) in enumerate(EVERYWHERE_TOPICS)])
FULL_PLACES_SQL = _values("places", "location, regex, cbscode, amsterdamcode", full_places())
FULL_TOPICS_SQL = _values("topics", "label, topic_regex", FULL_TOPICS)

# Articles by place, and the flat table, in SQL.
HITS_SQL = f"""{ARTICLES},
{PLACES_SQL},
{TOPICS_SQL},
hits AS (SELECT a.*, p.* FROM articles a JOIN places p ON regexp_matches(a.article_text, '(?i)' || p.regex))"""
FLAT_SQL = f"""{HITS_SQL},
flat AS (
  SELECT year, month, COUNT(*) AS n_location,
         COUNT(*) FILTER (WHERE regexp_matches(article_text, '(?i)' || topic_regex)) AS n_both,
         location, cbscode, amsterdamcode, lower(label) AS disease
  FROM hits, topics
  GROUP BY year, month, location, cbscode, amsterdamcode, label)"""
PANEL_SQL = f"""{FLAT_SQL},
skeleton AS (
  SELECT disease, year, month, cbscode
  FROM (SELECT DISTINCT disease FROM flat), (SELECT DISTINCT year FROM flat),
       (SELECT DISTINCT month FROM flat), (SELECT DISTINCT cbscode FROM flat)),
filled AS (
  SELECT disease, year, month, cbscode, COALESCE(n_location, 0) AS n_location, COALESCE(n_both, 0) AS n_both
  FROM skeleton LEFT JOIN flat USING (disease, year, month, cbscode)),
panel AS (
  SELECT disease, year, month, cbscode,
         CASE WHEN n_location = 0 THEN 0.0 ELSE CAST(n_both AS DOUBLE) / n_location END AS mention_rate,
         n_location, n_both
  FROM filled)"""
NAMES_SQL = "names AS (SELECT location, cbscode, amsterdamcode FROM places)"


def names(spark: SparkSession) -> DataFrame:
    rows = [(name, cbs, ams) for name, _, cbs, ams in PLACES]
    return local_table(spark, rows, {"location": "string", "cbscode": "int", "amsterdamcode": "int"})


# Results that several queries read are stored once per session and input.
_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf: str, name: str, write: Callable[[str], None]) -> str:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _STORED:
        path = new_folder(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def stored_articles(spark: SparkSession, sf: str) -> str:
    """Path of the articles partitioned by year."""
    return stored(spark, sf, "articles", lambda path: write_by_year(articles(spark, sf).drop("month"), path))


def stored_flat(spark: SparkSession, sf: str) -> DataFrame:
    def write(path):
        flat_counts(articles(spark, sf), dictionaries()).write.parquet(path)

    return spark.read.parquet(stored(spark, sf, "flat", write))
