"""Writing results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def write_by_year(df: DataFrame, path: str, max_records_per_file: int = 0, mode: str = "overwrite") -> None:
    """Parquet partitioned by `year`, rows of a file ordered by date.

    The rebalance hint lets adaptive execution split a year that is much larger than
    others over several tasks and merge small years; file size follows
    `spark.sql.adaptive.advisoryPartitionSizeInBytes`. Years not in `df` are left alone.
    """
    ordered = df.hint("rebalance", "year").sortWithinPartitions("year", "newspaper_date")
    writer = ordered.write.mode(mode).partitionBy("year").option("partitionOverwriteMode", "dynamic")
    writer.option("maxRecordsPerFile", max_records_per_file).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_sorted(df: DataFrame, path: str, keys: Sequence[str], files: int, mode: str = "overwrite") -> None:
    """A released table: range-sorted Parquet in a chosen number of files.

    Disjoint key ranges make the minimum and maximum kept per file selective. Ask for one
    file only for a table whose size does not grow with the number of articles.
    """
    df.repartitionByRange(files, *keys).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def publish(spark: SparkSession, pending: str, path: str) -> None:
    """Put a folder that was written and checked in the place of an earlier one."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (pending, path))
    store = source.getFileSystem(spark._jsc.hadoopConfiguration())
    store.delete(target, True)
    if not store.rename(source, target):
        raise OSError(f"{pending} could not be moved to {path}")


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """CSV with a header; with `partition_by` one folder per value, each written by few tasks."""
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.mode(mode).option("header", True).option("escape", '"')
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    write_csv(df, path, mode="append")


def write_pending(df: DataFrame, path: str, existing: DataFrame | None, *keys: str) -> None:
    """Append only the chunks (by `keys`, which partition the output) that do not exist yet."""
    todo = df if existing is None else df.join(existing.select(*keys).distinct(), list(keys), "left_anti")
    todo.hint("rebalance", *keys).write.mode("append").partitionBy(*keys).parquet(path)

