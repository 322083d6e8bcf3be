"""The corpus pipeline: documents in, a weighted mix of clean, deduplicated documents out.

Every stage takes (spark, documents, folder of tables) and returns the rows it keeps with the columns of
`documents`, except the last, which returns the mix. `run` writes each stage as Parquet below the
shared folder and reads it again, so a lost executor costs at most the stage at hand.

Defined results: every stage keeps all columns it gets, whatever their names, and handles null ids and
texts as its operator says. Empty documents give an empty mix.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from mentiongrid.llm import decontam, langid, mixing, neardup, secrets  # noqa: E402
from mentiongrid.llm.common import row_key, table  # noqa: E402
from mentiongrid.session import materialise, ship_package  # noqa: E402

#: Letters below which an ambiguous prediction is no reason to reject.
ENOUGH_LETTERS = 200


def language_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects texts without letters, and long ones that decode to no language clearly."""
    ship_package(spark)
    model = langid.fit(langid.with_fold(documents.select("doc_id", "text", "lang")).where("not held_out"))
    found = langid.identify(documents, model, documents.columns)
    unclear = F.col("ambiguous") & (F.col("score") < 0.5) & (F.length("row.text") >= ENOUGH_LETTERS)
    return found.where((F.col("lang_pred") != langid.UNKNOWN) & ~unclear).select("row.*")


def near_duplicate_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near duplicates, that of the smallest id, and one of identical rows.

    Documents that link with nothing for want of words stay, and so do those without any id in their group.
    """
    ship_package(spark)
    kept = neardup.near_duplicates(documents).where("kept")
    grouped = (F.col("n_shingles") > 0) & F.col("component_id").isNotNull()
    one = kept.where(grouped).groupBy("component_id").agg(F.min(F.struct("doc_id", "text_hash")).alias("k")).select("k.*")
    keys = one.unionByName(kept.where(~grouped).select("doc_id", "text_hash"))
    keys = keys.select(F.xxhash64("doc_id", "text_hash").alias("key"), "text_hash").distinct()
    # The row travels in a struct, so that no column of it can clash.
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"), *row_key("text"))
    keyed = rows.withColumn("key", F.xxhash64("doc_id", "text_hash"))
    return keyed.join(keys, ["key", "text_hash"], "left_semi").dropDuplicates(["key", "text_hash"]).select("row.*")


def decontamination_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that hold a benchmark item, as it is or re-parameterised."""
    ship_package(spark)
    return decontam.remove_contaminated(documents, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps all documents and replaces the secrets in their texts."""
    ship_package(spark)
    return secrets.redact(documents)


def mixing_stage(spark: SparkSession, documents: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    ship_package(spark)
    return mixing.mix(documents.select("doc_id", "text", "source"))[1]


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("secrets", secret_stage),
    ("mixing", mixing_stage),
]

#: The stages of the odd sketches, the classifiers and the pseudorandom draws have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        documents = materialise(stage(spark, documents, sf_dir), f"stage-{name}")
    return documents
