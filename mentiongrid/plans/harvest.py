"""The second era: yearly harvests of texts, article ids and issues, joined into the combined articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.operators.combine import combine, harmonise, partitioned
from mentiongrid.operators.manifest import record, unprocessed
from mentiongrid.operators.worklist import ready
from mentiongrid.session import local_table
from mentiongrid.sources.sinks import write_by_year
from mentiongrid.sources.tables import read_years, stored_keys

_YEAR = {"year": "int"}


def combine_harvest(spark: SparkSession, texts: str, meta: str, papers: str, out: str, start: int, end: int, like: DataFrame | None = None) -> list[int]:
    """Write the combined articles of the harvested years [start, end) that are not done, by year; gives those years.

    A year that lacks any of its three inputs waits for a later run. `like` is a table whose columns the result shall have too,
    such as the articles of the first era; what the harvest lacks is NULL there.
    """
    inputs = [stored_keys(spark, path, _YEAR) for path in (texts, meta, papers)]
    requested = spark.range(start, end).select(F.col("id").cast("int").alias("year"))
    years = [r.year for r in unprocessed(ready(requested, inputs, "year"), out, _YEAR).orderBy("year").collect()]
    if years:
        tables = [read_years(spark, path, start, end).filter(F.col("year").isin(years)).drop("year") for path in (meta, texts, papers)]
        combined = partitioned(combine(*tables, start, end))
        write_by_year(combined if like is None else harmonise(like.limit(0), combined), out)
        record(local_table(spark, [(y,) for y in years], _YEAR), out, _YEAR)
    return years
