"""Delivered archives: zip files of XML members."""

from __future__ import annotations

import json
import zipfile
import zlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.fixed_values import ZIP_PERIODS
from mentiongrid.functions.ids import file_name
from mentiongrid.session import bounded_batches
from mentiongrid.sources.zip_source import PART_BYTES, ZipMembers

_BATCH_BYTES = 8 * 2**20
_MEMBERS = "path string, member string, content string, read_error string"


def list_zip_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the zip files of a folder; their content is not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True)
    return files.load(folder).select("path", "length")


def read_zip_members(spark: SparkSession, paths: Sequence[str], *suffixes: str, part_bytes: int = PART_BYTES) -> DataFrame:
    """(path, member, content, read_error) of the members with these suffixes, of archives on any store.

    A delivery is a few archives of many gigabytes each; see `zip_source` for how they are divided.
    """
    spark.dataSource.register(ZipMembers)
    reader = spark.read.format(ZipMembers.name()).option("paths", json.dumps(list(paths))).option("suffixes", ",".join(suffixes))
    return reader.option("partBytes", part_bytes).load()


def read_zip_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, content) of zip files that are small enough to be values (below 2 GB each)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").option("recursiveFileLookup", True)
    return files.load(folder).select("path", "content")


def read_member_files(spark: SparkSession, folder: str, suffix: str) -> DataFrame:
    """(path, member, content) of already unpacked members, one task per group of files."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{suffix}").option("recursiveFileLookup", True)
    content = F.try_validate_utf8(F.col("content").cast("string"))
    return files.load(folder).select("path", F.col("path").alias("member"), content.alias("content"))


def zip_members(archives: DataFrame, suffix: str) -> DataFrame:
    """(path, member, content, read_error) of the members of zip values whose name ends in `suffix`."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    yield from _members(path.as_py(), archive, suffix)

    bounded_batches(archives.sparkSession)
    return archives.select("path", "content").mapInArrow(members, _MEMBERS)


def _members(path: str, archive: zipfile.ZipFile, suffix: str) -> Iterator[pa.RecordBatch]:
    """Wanted members of an archive, in batches of bounded size.

    Members that are damaged, encrypted, or not text have NULL content and a `read_error`.
    """
    rows, size = [], 0
    for info in archive.infolist():
        if not info.filename.endswith(suffix):
            continue
        text, error = _read_text(archive, info)
        rows.append((path, info.filename, text, error))
        size += len(text or "")
        if size > _BATCH_BYTES:
            yield _batch(rows)
            rows, size = [], 0
    if rows:
        yield _batch(rows)


def _read_text(archive: zipfile.ZipFile, info: zipfile.ZipInfo) -> tuple[str | None, str | None]:
    try:
        return archive.read(info).decode("utf8"), None
    except (UnicodeDecodeError, zipfile.BadZipFile, zlib.error, NotImplementedError, RuntimeError, EOFError) as exc:
        return None, f"{type(exc).__name__}: {exc}"


def _batch(rows) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "member", "content", "read_error"])


def zip_period(path: Column) -> Column:
    """Period label of a delivered zip file, NULL for an unknown name."""
    labels = F.create_map(*(F.lit(x) for pair in ZIP_PERIODS for x in pair))
    return F.try_element_at(labels, file_name(path))


def with_zip_period(archives: DataFrame, path: str = "path") -> DataFrame:
    return archives.withColumn("period", zip_period(F.col(path)))
