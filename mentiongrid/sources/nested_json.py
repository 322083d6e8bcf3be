"""Tables inside JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.schemas import GEO


def region_names(topology: DataFrame) -> DataFrame:
    """(location, cbscode) from rows holding a parsed map topology as `objects`."""
    properties = topology.select(F.explode("objects.nld.geometries").alias("g")).select("g.properties.*")
    return properties.select(F.col("name").alias("location"), "cbscode")


def read_region_names(spark: SparkSession, path: str) -> DataFrame:
    schema = GEO.removeprefix("struct<").removesuffix(">")
    return region_names(spark.read.schema(schema.replace("objects:", "objects ", 1)).option("multiLine", True).json(path))


def keyed_values(df: DataFrame, json: str | Column, key: str, value: str) -> DataFrame:
    """Rows (key, value) from JSON objects of the form `{"<code>": {"value": <number>}}`."""
    parsed = F.from_json(F.col(json) if isinstance(json, str) else json, "map<string,struct<value:double>>")
    rows = df.select(F.explode(parsed).alias("code", "entry"))
    return rows.select(F.col("code").try_cast("int").alias(key), F.col("entry.value").alias(value))
