"""The database build: combined articles -> flat counts -> monthly and yearly panel."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from mentiongrid.operators.counting import database_rows, mention_counts, with_year_month
from mentiongrid.operators.dictionary import Term, terms_table
from mentiongrid.operators.panel import PANEL_KEYS, complete_panel, duplicate_keys, mention_rates, watched_panel, yearly
from mentiongrid.session import materialise
from mentiongrid.sources.sinks import publish, write_parquet, write_sorted


@dataclass(frozen=True)
class Dictionaries:
    """Places carry (location, cbscode, amsterdamcode) as attributes, topics their (disease,)."""

    places: list[Term]
    topics: list[Term]


def flat_counts(articles: DataFrame, terms: Dictionaries, max_chars: int = 0) -> DataFrame:
    """The flat table: one row per (place, month, topic) in which the place is mentioned.

    `articles` needs `article_text` and `newspaper_date`.
    """
    spark = articles.sparkSession
    counts = mention_counts(with_year_month(articles), terms.places, terms.topics, max_chars=max_chars)
    places = terms_table(spark, terms.places, "place_id", {"location": "string", "cbscode": "int", "amsterdamcode": "int"})
    return database_rows(counts, places, terms_table(spark, terms.topics, "topic_id", {"disease": "string"}))


def panel_tables(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Monthly and yearly panel of a stored flat table."""
    monthly = mention_rates(complete_panel(flat))
    return monthly, yearly(monthly)


def monthly_panel(articles: DataFrame, terms: Dictionaries, max_chars: int = 0) -> DataFrame:
    """The monthly panel, with the flat table stored once in between."""
    return panel_tables(materialise(flat_counts(articles, terms, max_chars), "flat"))[0]


def build(spark: SparkSession, articles: DataFrame, terms: Dictionaries, out: str, max_chars: int = 0, files: int = 8) -> None:
    """Write `database_flat`, `database` and `database_yearly` below `out`.

    The monthly panel is published only if its keys identify its rows; that shows while it is written.
    """
    write_parquet(flat_counts(articles, terms, max_chars), f"{out}/database_flat")
    flat = spark.read.parquet(f"{out}/database_flat")
    panel, seen = watched_panel(flat)
    pending = f"{out}/_database_pending"
    write_sorted(mention_rates(panel), pending, list(PANEL_KEYS), files)
    if (seen.get["most"] or 0) > 1:
        shared = [tuple(r) for r in duplicate_keys(flat).limit(5).collect()]
        raise ValueError(f"{', '.join(PANEL_KEYS)} do not identify the rows, as in {shared}")
    publish(spark, pending, f"{out}/database")
    by_year = yearly(spark.read.parquet(f"{out}/database"))
    write_sorted(by_year, f"{out}/database_yearly", ["disease", "year", "cbscode"], files)
