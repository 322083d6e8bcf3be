"""Tables stored by buckets of a key, so that later joins on the key move the other side only.

The files of a bucketed table name their bucket; a session only has to declare the table over its folder
(`declare_bucketed`) to join it without shuffling it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def store_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> DataFrame:
    """Write `df`, which has one row per key, below `path` in buckets of `key` and give the table.

    This is the only time that the rows are shuffled. A bucket is one file, however many tasks read `df`; choose at least as
    many buckets as `spark.sql.shuffle.partitions`, or Spark may deal both sides of a join anew.
    """
    name = f"stored_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.option("path", path).bucketBy(buckets, key).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def declare_bucketed(spark: SparkSession, path: str, schema: str, key: str, buckets: int) -> DataFrame:
    """A stored bucketed table in a session that did not write it."""
    name = f"stored_{uuid.uuid4().hex}"
    spark.sql(f"CREATE TABLE {name} ({schema}) USING parquet CLUSTERED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(name)


def join_stored(wanted: DataFrame, stored: DataFrame, key: str) -> DataFrame:
    """`wanted` (one row per key) with the columns of its stored row, NULL where there is none.

    Only `wanted` is shuffled, to the buckets, and it is the side that is held in a hash table, bucket by bucket. So the stored
    rows are streamed: they are neither moved nor sorted. Keys without a row are found from the key column alone.
    """
    rest = [c for c in stored.columns if c != key]
    columns = [*wanted.columns, *rest]
    found = stored.join(wanted.hint("shuffle_hash"), key)
    missing = wanted.join(stored.select(key), key, "left_anti")
    missing = missing.select("*", *(F.lit(None).cast(stored.schema[c].dataType).alias(c) for c in rest))
    return found.select(*columns).unionByName(missing.select(*columns))
