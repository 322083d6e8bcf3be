"""The pipeline's stages on a small folder of tables, and native plans."""

from __future__ import annotations

import pytest

import corpus_pipeline
from mentiongrid.llm import mixing, quality, urlfilter
from mentiongrid.llm.queries import QUERIES, SQL

from test_operators import lines


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    item = "which of the seven small rivers of the northern valley carries the most water in a dry late summer"
    rows = [(i, lines(4, 300 + i), "en", f"s{i % 2}", 7, "x") for i in range(30)]
    rows += [
        (100, rows[0][1], "en", "s0", 7, "x"), (101, rows[1][1] + " more", "en", "s1", 7, "x"), (102, "1234 !!", "en", "s0", 7, "x"),
        (103, lines(2, 400) + item + lines(1, 401), "en", None, 7, "x"), (104, lines(3, 402) + "password=abcdef123", "en", "s1", 7, "x"),
        (105, None, None, None, None, None), (104, lines(3, 402) + "password=abcdef123", "en", "s1", 7, "x"), (None, lines(4, 403), "en", "s0", 7, "x"),
    ]
    path = tmp_path_factory.mktemp("tables")
    # An extra column that clashes with an operator's own names.
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages_do_their_work(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = corpus_pipeline.materialise(stage(spark, docs, folder), f"test-{name}")
        seen[name] = docs.collect()
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
    ids = {name: [r["doc_id"] for r in rows] for name, rows in seen.items()}
    clean = set(range(30))
    assert clean <= set(ids["language_id"]) and not {102, 105} & set(ids["language_id"])
    assert clean <= set(ids["near_duplicates"]) and not {100, 101} & set(ids["near_duplicates"])
    assert ids["near_duplicates"].count(104) == 1 and None in ids["near_duplicates"]
    assert set(ids["decontamination"]) == set(ids["near_duplicates"]) - {103}
    text = {r["doc_id"]: r for r in seen["secrets"]}
    assert "abcdef123" not in text[104]["text"] and text[104]["n_chars"] == len(text[104]["text"]) and text[3]["n_chars"] == 7
    assert sorted(ids["mixing"], key=str) == sorted(ids["secrets"], key=str)
    assert sum(r["taken"] for r in seen["mixing"]) > 0


def test_pipeline_of_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_native_operators_run_no_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    pages = docs.selectExpr("doc_id as page_id", "concat('http://', source, '.net/') as url")
    frames = [quality.clean(docs), mixing.mix(docs)[1], urlfilter.evaluate(urlfilter.captures_of_pages(pages), urlfilter.intervals(urlfilter.entries_of_pages(pages)))]
    for frame in frames:
        plan = frame._jdf.queryExecution().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES)
