import datetime
import os

import pytest

from pyspark.sql import functions as F

from mentiongrid import schemas
from mentiongrid.fixed_values import TOPIC_TERMS
from mentiongrid.operators.combine import one_per_key
from mentiongrid.operators.dictionary import load_terms
from mentiongrid.session import local_table, materialise, new_folder, scratch, shared_folder
from mentiongrid.sources.nested_json import keyed_values, read_region_names
from mentiongrid.sources.bucketed import declare_bucketed, join_stored, store_bucketed
from mentiongrid.sources.sinks import append_csv, write_by_year, write_pending, write_sorted
from mentiongrid.sources.tables import read_csv, read_folder, read_month_counts, read_years
from mentiongrid.streaming.incremental import ingest_new_files


def test_dictionary_csv_with_mark_quotes_and_backslashes(spark, tmp_path):
    lines = ["Label,Disease,Type ,Regex"] + [f'{label},"{label}, and others",x,{regex}' for label, regex in TOPIC_TERMS]
    path = tmp_path / "terms.csv"
    path.write_text("﻿" + "\n".join(lines) + "\n", encoding="utf-8")
    table = read_csv(spark, str(path), schemas.DISEASE_TERMS, required=["Regex"])
    assert {(r.Label, r.Disease, r.Regex) for r in table.collect()} == {(n, f"{n}, and others", r) for n, r in TOPIC_TERMS}
    terms = load_terms(table, "Label")
    assert [t.label for t in terms] == sorted(n for n, _ in TOPIC_TERMS) and [t.id for t in terms] == list(range(10))


def test_municipality_csv(spark, tmp_path):
    path = tmp_path / "places.csv"
    path.write_text("﻿Regex;name;cbscode;amsterdamcode;pop\n(?:[^a-zA-Z]|\\b)aalst(?:[^a-zA-Z]|\\b);Aalst;1001;11423;\n", encoding="utf-8")
    rows = read_csv(spark, str(path), schemas.MUNICIPALITIES, sep=";", required=["Regex"]).collect()
    assert [tuple(r) for r in rows] == [(r"(?:[^a-zA-Z]|\b)aalst(?:[^a-zA-Z]|\b)", "Aalst", 1001, 11423, None)]


def test_map_topology_file(spark, tmp_path):
    path = tmp_path / "map.json"
    path.write_text('{"type": "Topology",\n "objects": {"nld": {"geometries": [\n {"properties": {"name": "Aalst", "cbscode": 1, "x": 2}},\n {"properties": {"name": "Ee", "cbscode": 2}}]}}}')
    assert sorted(tuple(r) for r in read_region_names(spark, str(path)).collect()) == [("Aalst", 1), ("Ee", 2)]
    df = spark.createDataFrame([('{"10531": {"value": 330}, "x": {"value": 1}}',)], "j string")
    assert sorted(tuple(r) for r in keyed_values(df, "j", "code", "n").collect() if r[0]) == [(10531, 330.0)]


def test_years_are_partitions_and_reruns_replace_them(spark, tmp_path):
    path = str(tmp_path / "by_year")
    rows = [(i, datetime.date(1830 + i % 3, 1 + i % 12, 1), 1830 + i % 3) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, newspaper_date date, year int")
    write_by_year(df, path)
    write_by_year(df.filter("year = 1831 and id > 50"), path)
    assert {r.year: r["count"] for r in spark.read.parquet(path).groupBy("year").count().collect()} == {1830: 30, 1831: 13, 1832: 30}
    plan = read_years(spark, path, 1831, 1832)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert read_years(spark, path, 1831, 1832).count() == 13


def test_schema_drift(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "id int, x string").write.parquet(str(tmp_path / "d" / "one"))
    spark.createDataFrame([(2,)], "id int").write.parquet(str(tmp_path / "d" / "two"))
    for schema in (None, "id int, x string"):
        assert sorted((r.id, r.x) for r in read_folder(spark, str(tmp_path / "d"), schema).collect()) == [(1, "a"), (2, None)]


def test_appended_counts_and_sorted_release(spark, tmp_path):
    counts = spark.createDataFrame([(1860, 1, 5)], schemas.MONTH_COUNTS)
    for _ in range(2):
        append_csv(counts, str(tmp_path / "c"))
    assert [tuple(r) for r in read_month_counts(spark, str(tmp_path / "c")).collect()] == [(1860, 1, 5)] * 2
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("k"))
    write_sorted(df, str(tmp_path / "s"), ["k"], files=4)
    stored = spark.read.parquet(str(tmp_path / "s"))
    bounds = sorted(tuple(r) for r in stored.groupBy(F.input_file_name()).agg(F.min("k"), F.max("k")).drop("input_file_name()").collect())
    assert len(bounds) == 4 and all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))


def test_pending_chunks_are_added_once(spark, tmp_path):
    path = str(tmp_path / "p")
    df = spark.createDataFrame([(1, 1830), (2, 1831), (3, 1832)], "id int, year int")
    write_pending(df.filter("year < 1832"), path, None, "year")
    write_pending(df, path, spark.read.parquet(path), "year")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_stream_takes_up_new_files_only(spark, tmp_path):
    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "chk"))
    only_even = lambda df: df.filter("id % 2 = 0").withColumn("part", F.col("id") % 3)
    for start in (0, 10):
        spark.range(start, start + 10).write.mode("append").parquet(source)
        for _ in range(2):
            ingest_new_files(spark, source, target, checkpoint, "id bigint", only_even, partition_by="part", files_per_batch=2)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == list(range(0, 20, 2))


def test_cut_lineage_is_a_stored_table(spark):
    df = spark.range(10).withColumn("x", F.rand(1))
    cut = materialise(df, "cut")
    assert cut.collect() == cut.collect() and cut.dtypes == df.dtypes
    assert cut.inputFiles()[0].startswith("file:") and "cut-" in cut.inputFiles()[0] and shared_folder(spark)
    assert local_table(spark, [], {"a": "int"}).count() == 0


def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path):
    hot = spark.range(200_000, numPartitions=8).select(
        F.sha2(F.col("id").cast("string"), 256).alias("article_text"),
        F.date_add(F.lit("1866-01-01"), F.when(F.col("id") % 3 == 0, 0).otherwise((F.col("id") % 4000).cast("int"))).alias("newspaper_date"),
    ).withColumn("year", F.year("newspaper_date"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_by_year(hot, str(tmp_path / "y"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(str(tmp_path / "y"))
    per_file = stored.groupBy("year", F.input_file_name()).count().collect()
    of_hot_year = [r["count"] for r in per_file if r.year == 1866]
    assert sum(r["count"] for r in per_file) == 200_000 and len(of_hot_year) > 1 and max(of_hot_year) < 50_000


def test_copies_of_one_id_collapse_before_the_shuffle(spark):
    copies = spark.range(30_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("article_id"), F.lit("text").alias("article_text")
    )
    unique = one_per_key(copies, "article_id")
    assert unique.count() == 20_001
    plan = unique._jdf.queryExecution().executedPlan().toString()
    assert plan.index("SortAggregate") < plan.index("Exchange") < plan.rindex("SortAggregate")


def test_scratch_folders_are_removed_and_results_kept(spark):
    with scratch(spark, "outer") as keep:
        inner = materialise(spark.range(5), "inner")
        with scratch(spark, "nested"):
            path = new_folder(spark, "x")
            spark.range(3).write.parquet(path)
        result = keep(inner.selectExpr("id + 1 as id"))
        assert "/outer-" in path and not os.path.exists(path.removeprefix("file:"))
        assert inner.count() == 5
    assert sorted(r.id for r in result.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception):
        inner.count()


def _above(plan: str, wanted: str) -> list[str]:
    """The operators above every scan that reads a column."""
    path, found = [], []
    for line in plan.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        path = [(d, text) for d, text in path if d < depth] + [(depth, line.lstrip(" :+-"))]
        if "FileScan" in line and wanted in line:
            found += [text for _, text in path[:-1]]
    return found


def test_stored_texts_are_neither_moved_nor_sorted(spark, tmp_path):
    texts = spark.range(2000).selectExpr("concat('a', id) AS article_id", "'t' AS article_title", "repeat('x', 50) AS article_text")
    path, buckets = f"file://{tmp_path}/texts", 8
    store_bucketed(texts, path, "article_id", buckets)
    stored = declare_bucketed(spark, path, "article_id string, article_title string, article_text string", "article_id", buckets)
    wanted = spark.range(1000, 3000).selectExpr("concat('a', id) AS article_id", "id AS n")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = join_stored(wanted, stored, "article_id")
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(rows) == 2000 and sum(r.article_text is None for r in rows) == 1000
    above = _above(plan, "article_text")
    assert above and not any(line.split(" ", 1)[-1].startswith(("Exchange", "Sort", "SortMergeJoin")) or "Exchange" in line for line in above)
    assert any("ShuffledHashJoin" in line for line in above)
