"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Settings every job needs whatever the cluster size. Shuffle partition counts
# are an upper bound: adaptive execution coalesces small ones and splits skewed ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def get_session(app_name: str = "mentiongrid", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the base settings; keyword settings use `__` for `.`."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the package to the Python workers, wherever they start."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="mentiongrid-"), "mentiongrid.zip")
    with zipfile.ZipFile(path, "w") as archive:
        for folder, _, files in os.walk(here):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(here)))
    spark.sparkContext.addPyFile(path)
    _SHIPPED.add(app)


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own;
    on a cluster a machine-local folder would be lost with the machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="mentiongrid-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# The scratch folders that are open, innermost last.
_SCRATCH: list[str] = []


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the innermost scratch folder, or else below the shared folder."""
    return f"{_SCRATCH[-1] if _SCRATCH else shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, name: str) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """What is materialised inside goes into one folder that is removed at the end.

    Gives a function that stores a result outside of it, so that nothing lazy is left that
    would read the removed folder.
    """
    path = new_folder(spark, name)
    outside = len(_SCRATCH)
    _SCRATCH.append(path)

    def keep(result: DataFrame) -> DataFrame:
        held = _SCRATCH[outside:]
        del _SCRATCH[outside:]
        try:
            return materialise(result, f"{name}-result")
        finally:
            _SCRATCH.extend(held)

    try:
        yield keep
    finally:
        del _SCRATCH[outside:]
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and read it back.

    Used where one expensive result feeds several branches: without the cut, column
    pruning makes the branches differ and every branch would read the texts again.
    """
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
_DEFAULT_BATCH_BYTES = "67108864b"


def bounded_batches(spark: SparkSession, size: str = "8m") -> None:
    """Texts and archives reach the Python workers in batches of this size, unless the session sets its own.

    A chain of Python steps has a worker for each step and core, and each holds a batch or two.
    """
    if spark.conf.get(_BATCH_BYTES, _DEFAULT_BATCH_BYTES) == _DEFAULT_BATCH_BYTES:
        spark.conf.set(_BATCH_BYTES, size)


def spread_small_scan(scan: DataFrame, key: str) -> DataFrame:
    """Repartition a scan that has fewer splits than the cluster has cores.

    A large corpus has far more splits than cores and passes through untouched, so
    its texts are never shuffled. `scan` must be a plain scan (no exchange below).
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() >= cores:
        return scan
    return scan.repartition(2 * cores, key)


_ARROW_TYPES = {
    "int": pa.int32(), "bigint": pa.int64(), "string": pa.string(), "double": pa.float64(), "array<string>": pa.list_(pa.string()),
    "array<int>": pa.list_(pa.int32()),
}


def local_table(spark: SparkSession, rows: Sequence[tuple], columns: dict[str, str]) -> DataFrame:
    """A small driver-side table as a local relation, so that Spark knows its size.

    From a plain list of rows Spark would build a scan of unknown size and join it by
    shuffling the other side.
    """
    values = list(zip(*rows, strict=True)) if rows else [()] * len(columns)
    arrays = [pa.array(v, _ARROW_TYPES[kind]) for v, kind in zip(values, columns.values(), strict=True)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(columns)))
