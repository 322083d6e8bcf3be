"""Parquet and CSV scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.operators.dictionary import require_columns
from mentiongrid.session import local_table


def read_folder(spark: SparkSession, path: str | Sequence[str], schema: str | None = None) -> DataFrame:
    """All Parquet files below a folder; a column that some files lack is NULL for them.

    With an explicit schema no file footer has to be read for the union of the columns.
    """
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*([path] if isinstance(path, str) else path))


def read_partitioned(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A folder partitioned by `year`; filters on `year` skip whole partitions."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def stored_keys(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Distinct keys of a stored table; none where nothing is stored yet."""
    try:
        return spark.read.parquet(path).select(*(F.col(c).cast(t).alias(c) for c, t in columns.items())).distinct()
    except AnalysisException as exc:
        if exc.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return local_table(spark, [], columns)


def read_years(spark: SparkSession, path: str, start: int, end: int, schema: str | None = None) -> DataFrame:
    """The partitions of the years [start, end)."""
    return read_partitioned(spark, path, schema).filter((F.col("year") >= start) & (F.col("year") < end))


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",", required: Sequence[str] = ()) -> DataFrame:
    """A CSV table by column name; quoted separators, backslashes and a byte order mark are kept apart."""
    reader = spark.read.option("header", True).option("sep", sep).option("escape", '"').option("enforceSchema", False)
    if required:
        require_columns(reader.csv(path), *required)
    return reader.schema(schema).csv(path)


def read_month_counts(spark: SparkSession, path: str) -> DataFrame:
    """Monthly counts stored as text, counts as BIGINT."""
    table = read_csv(spark, path, "year string, month string, count string")
    return table.select(*(F.col(c).cast(t).alias(c) for c, t in (("year", "int"), ("month", "int"), ("count", "bigint"))))
