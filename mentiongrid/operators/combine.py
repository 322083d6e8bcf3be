"""Joining ids, texts and publication metadata into one row per article."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mentiongrid.operators.counting import in_years
from mentiongrid.session import materialise
from mentiongrid.sources.bucketed import join_stored


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """One row per key: the smallest row by value, so that reruns agree.

    A partially aggregated minimum: copies of one key collapse before the shuffle, however
    many there are.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    return df.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row")).select(key, *(F.col(f"_row.{c}").alias(c) for c in rest))


def harmonise(*eras: DataFrame) -> DataFrame:
    """All sources under one schema; a column that a source lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), eras)


def combine(article_meta: DataFrame, article_texts: DataFrame, newspapers: DataFrame, start: int, end: int) -> DataFrame:
    """One row per article of the years [start, end): ids, text and issue metadata.

    The date range cuts the issues first, the inner join with them cuts the article ids, and
    only then do the texts, by far the largest input, join on the article id. An article
    without text stays with NULLs.

    The issues of the range are stored first. So Spark knows their real size and broadcasts
    them if they are small; and if they are not, both sides of the join are plain shuffles, the
    only form in which adaptive execution splits an issue or source that holds a large share of
    all articles.
    """
    wanted = wanted_articles(article_meta, newspapers, start, end)
    return wanted.join(one_per_key(article_texts, "article_id"), "article_id", "left")


def wanted_articles(article_meta: DataFrame, newspapers: DataFrame, start: int, end: int) -> DataFrame:
    """One row per article of the years [start, end): its ids and the metadata of its issue."""
    in_range = newspapers.filter(in_years("newspaper_date", start, end))
    issues = materialise(one_per_key(in_range, "newspaper_id"), "issues")
    return one_per_key(article_meta.join(issues, "newspaper_id"), "article_id")


def combine_stored(article_meta: DataFrame, stored_texts: DataFrame, newspapers: DataFrame, start: int, end: int) -> DataFrame:
    """`combine` with texts that are stored in buckets of `article_id`, one row each: no text is shuffled or sorted."""
    return join_stored(wanted_articles(article_meta, newspapers, start, end), stored_texts, "article_id")


def partitioned(combined: DataFrame) -> DataFrame:
    """Add the partition column `year`."""
    return combined.withColumn("year", F.year("newspaper_date"))
