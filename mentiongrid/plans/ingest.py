"""From delivered archives to combined articles; every step takes up only what is new."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.fixed_values import ARTICLE_SUFFIX, ISSUE_SUFFIX
from mentiongrid.functions.ids import file_name
from mentiongrid.functions.markup import article_meta, article_texts, newspaper_meta, parsed_issues
from mentiongrid.operators.combine import combine, partitioned
from mentiongrid.operators.counting import in_years
from mentiongrid.operators.manifest import processed, record, unprocessed
from mentiongrid.session import local_table, materialise
from mentiongrid.sources.archives import list_zip_files, read_zip_members, with_zip_period
from mentiongrid.sources.sinks import write_by_year

# An archive is the same as long as its name and length are.
_ARCHIVE = {"name": "string", "length": "bigint", "period": "string"}
_ARCHIVE_YEAR = {"name": "string", "length": "bigint", "year": "int"}


def _new_archives(spark: SparkSession, folder: str, target: str) -> tuple[DataFrame, list[str]]:
    """Archives that `target` does not have, and the paths of all archives of their periods; deliveries are few files."""
    archives = with_zip_period(list_zip_files(spark, folder)).withColumn("name", file_name(F.col("path")))
    unknown = [r.path for r in archives.filter(F.col("period").isNull()).select("path").limit(20).collect()]
    if unknown:
        raise ValueError(f"archives of unknown periods: {unknown}")
    new = local_copy(unprocessed(archives, target, _ARCHIVE), _ARCHIVE)
    whole = archives.join(new.select("period").distinct(), "period", "left_semi")
    return new, [r.path for r in whole.select("path").orderBy("path").collect()]


def _write_periods(df: DataFrame, path: str) -> None:
    df.hint("rebalance", "period").write.mode("overwrite").partitionBy("period").option(
        "partitionOverwriteMode", "dynamic"
    ).parquet(path)


def extract_archives(spark: SparkSession, folder: str, texts: str, meta: str, papers: str) -> None:
    """Article texts, article ids and issue metadata of all archives that are new or have changed.

    Each table is partitioned by the archive's period. A period with a new archive is written anew from all its
    archives; then the manifest of the table names them.
    """
    new, paths = _new_archives(spark, folder, texts)
    if paths:
        _write_periods(_with_period(read_zip_members(spark, paths, ARTICLE_SUFFIX), article_texts), texts)
        record(new, texts, _ARCHIVE)
    new, paths = _new_archives(spark, folder, papers)
    if paths:
        # Parsed once, read for two tables.
        issues = materialise(_with_period(read_zip_members(spark, paths, ISSUE_SUFFIX), parsed_issues), "issues")
        _write_periods(_with_period(issues, article_meta), meta)
        _write_periods(_with_period(issues, newspaper_meta), papers)
        record(new, papers, _ARCHIVE)


def _with_period(df: DataFrame, step) -> DataFrame:
    """Apply a step that keeps further columns in place, with the archive's period."""
    return step(df if "period" in df.columns else with_zip_period(df), "period")


def combine_years(
    spark: SparkSession, texts: str, meta: str, papers: str, out: str, start: int, end: int
) -> None:
    """Write the combined articles of the years [start, end) anew that an archive touches for the first time, by year.

    Texts are read from the periods of these years only.
    """
    issues = spark.read.parquet(papers).filter(in_years("newspaper_date", start, end)).withColumn("year", F.year("newspaper_date"))
    archives = processed(spark, texts, _ARCHIVE).unionByName(processed(spark, papers, _ARCHIVE)).distinct()
    by_period = issues.select("period", "year").distinct()
    todo = local_copy(unprocessed(by_period.join(archives, "period"), out, _ARCHIVE_YEAR), {**_ARCHIVE_YEAR, "period": "string"})
    touched = todo.select("year").distinct()
    # Years and periods are a few hundred values at most.
    years = [r.year for r in touched.collect()]
    if not years:
        return
    periods = [r.period for r in by_period.join(touched, "year", "left_semi").select("period").distinct().collect()]
    missing = issues.filter(F.col("year").isin(years)).drop("year", "period", "parse_error")
    ids = spark.read.parquet(meta).filter(F.col("period").isin(periods)).drop("period")
    articles = spark.read.parquet(texts).filter(F.col("period").isin(periods)).drop("period", "parse_error")
    write_by_year(partitioned(combine(ids, articles, missing, start, end)), out)
    record(todo, out, _ARCHIVE_YEAR)


def local_copy(rows: DataFrame, columns: dict[str, str]) -> DataFrame:
    """A few rows as they are now, whatever is written afterwards."""
    return local_table(rows.sparkSession, [tuple(r) for r in rows.select(*columns).distinct().collect()], columns)
