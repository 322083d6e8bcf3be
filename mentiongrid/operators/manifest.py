"""Manifests: what a step has processed, kept beside its output and written after it.

A run that is killed before its manifest rows are appended repeats its partitions and overwrites them, so nothing is
lost or doubled. A manifest names inputs, not outputs: a later delivery is new however much of
its year or period is stored already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mentiongrid.operators.worklist import pending
from mentiongrid.sources.tables import stored_keys


def manifest_path(output: str) -> str:
    return f"{output.rstrip('/')}_manifest"


def processed(spark: SparkSession, output: str, columns: dict[str, str]) -> DataFrame:
    """Rows of the manifest of `output`; none where nothing was processed yet."""
    return stored_keys(spark, manifest_path(output), columns)


def unprocessed(requested: DataFrame, output: str, columns: dict[str, str]) -> DataFrame:
    """The requested inputs that the manifest of `output` does not name."""
    return pending(requested, processed(requested.sparkSession, output, columns), *columns)


def record(done: DataFrame, output: str, columns: dict[str, str]) -> None:
    """Append processed inputs; call it after the output is written."""
    done.select(*columns).distinct().coalesce(1).write.mode("append").parquet(manifest_path(output))
