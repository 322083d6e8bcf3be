"""The questions analysts ask of the articles, each as one Spark job.

`articles` needs `article_text` and `newspaper_date`; `places` are compiled terms with the
attributes (location, cbscode, amsterdamcode).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentiongrid.functions.interval import binomial_interval
from mentiongrid.operators.counting import (
    mention_counts, of_years, pair_counts, place_counts, place_shares, with_year_month,
)
from mentiongrid.operators.dictionary import Term, compile_term, terms_table

_ATTRIBUTES = {"location": "string", "cbscode": "int", "amsterdamcode": "int"}


def _of_years(articles: DataFrame, start: int, end: int) -> DataFrame:
    return with_year_month(of_years(articles, start, end))


def over_space(articles: DataFrame, places: list[Term], disease: str, year: int, variant: str = "reference") -> DataFrame:
    """Monthly counts of one topic in every place of a year, with interval, sorted by place and month."""
    counts = mention_counts(_of_years(articles, year, year + 1), places, [compile_term(disease, unicode_case=True)], unicode_case=True)
    named = counts.drop("topic_id").join(terms_table(articles.sparkSession, places, "place_id", _ATTRIBUTES), "place_id")
    rows = binomial_interval(named.drop("place_id"), "n_both", "n_location", variant=variant)
    return rows.orderBy("location", "year", "month")


def over_time(articles: DataFrame, disease: str, location: str, start: int = 1830, end: int = 1940, variant: str = "reference") -> DataFrame:
    """Monthly counts of one topic in one place over the years [start, end), with interval."""
    counts = pair_counts(articles, disease, location, start, end, denominator="location")
    return binomial_interval(counts, "n_both", "n_location", variant=variant)


def year_map(articles: DataFrame, places: list[Term], disease: str, year: int) -> DataFrame:
    """Counts of a whole year beside the place dictionary, places without mentions included."""
    topic = compile_term(disease, unicode_case=True)
    counts = place_counts(_of_years(articles, year, year + 1), places, topic, by=("year",))
    attributes = terms_table(articles.sparkSession, places, "place_id", _ATTRIBUTES)
    return attributes.join(counts, "place_id").drop("place_id", "n_total")


def near_shares(
    articles: DataFrame, places: list[Term], disease: str, start: int, end: int,
    max_chars: int = 40, denominator: str = "location", by: tuple[str, ...] = ("year", "month"),
) -> DataFrame:
    """Share of articles with topic and place close together, for every place and period of [start, end)."""
    topic = compile_term(disease, unicode_case=True)
    shares = place_shares(_of_years(articles, start, end), places, topic, by, max_chars, denominator)
    attributes = terms_table(articles.sparkSession, places, "place_id", _ATTRIBUTES)
    return attributes.join(shares, "place_id").drop("place_id")


def share_of_total(counts: DataFrame, out: str = "y") -> DataFrame:
    """Share of all articles of the period, with the period's first day, as plotted over time."""
    y = F.when(F.col("n_total") == 0, F.lit(float("nan"))).otherwise(F.col("n_both") / F.col("n_total"))
    return counts.withColumns({"date": F.make_date("yr", "mo", F.lit(1)), out: y})
