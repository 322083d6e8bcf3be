"""Work lists: months to fetch, result pages, and which chunks are still to do."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def month_grid(spark: SparkSession, start: int, end: int) -> DataFrame:
    """One row per month of the years [start, end) with its first and last day."""
    months = spark.range(start * 12, end * 12).select(
        F.floor(F.col("id") / 12).cast("int").alias("year"), (F.col("id") % 12 + 1).cast("int").alias("month")
    )
    first = F.make_date("year", "month", F.lit(1))
    return months.select("year", "month", first.alias("first_day"), F.last_day(first).alias("last_day"))


def result_pages(totals: DataFrame, total: str, size: int = 1000) -> DataFrame:
    """One row per result page with the number of its first record; no page for no records."""
    first = F.explode(F.sequence(F.lit(0), F.ceil(F.col(total) / size) - 1))
    return totals.filter(F.col(total) > 0).select("*", first.alias("page")).withColumn(
        "start_record", F.col("page") * size + 1
    )


def pending(requested: DataFrame, existing: DataFrame, *keys: str) -> DataFrame:
    """Requested chunks whose output does not exist yet."""
    return requested.join(existing.select(*keys).distinct(), list(keys), "left_anti")


def ready(requested: DataFrame, inputs: list[DataFrame], *keys: str) -> DataFrame:
    """Requested chunks for which every input has data."""
    return reduce(
        lambda left, table: left.join(table.select(*keys).distinct(), list(keys), "left_semi"), inputs, requested
    )
