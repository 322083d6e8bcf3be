"""Columns named like helpers, very large ids and very long texts."""

from __future__ import annotations

import time

import corpus_pipeline
from pyspark.sql import functions as F
from mentiongrid.llm import decontam, quality, secrets, urlfilter, warc

from test_operators import lines

NAMES = ["__hash", "__key", "__doc", "_doc", "_hash", "_spans", "row", "all", "key", "text_hash", "spans"]
ITEM = "which of the seven small rivers of the northern valley carries the most water in a dry late summer"


def table(spark):
    rows = [
        (1, lines(4, 1), *NAMES), (2, lines(4, 1), *NAMES), (3, lines(3, 2) + "password=abcdef123", *NAMES), (4, lines(2, 3) + ITEM, *NAMES),
        (1 << 62, lines(4, 4), *NAMES), (None, lines(4, 5), *NAMES), (6, None, *NAMES),
    ]
    columns = ", ".join(f"`{n}` string" for n in NAMES)
    return spark.createDataFrame(rows, f"doc_id long, text string, {columns}"), rows


def test_no_column_is_lost_or_clashes(spark):
    documents, rows = table(spark)
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    for kept, ids in (
        (secrets.redact(documents), {1, 2, 3, 4, 1 << 62, None, 6}),
        (decontam.remove_contaminated(documents, benchmark), {1, 2, 3, 1 << 62, None, 6}),
        (corpus_pipeline.near_duplicate_stage(spark, documents, ""), {1, 3, 4, 1 << 62, None, 6}),
    ):
        assert kept.columns == documents.columns
        got = kept.collect()
        assert {r["doc_id"] for r in got} == ids
        assert all([r[n] for n in NAMES] == NAMES for r in got)


def test_large_page_ids(spark):
    pages = spark.createDataFrame([(1 << 62, "http://a.example/x"), (-(1 << 62), "http://a.example/y"), (5, None)], "page_id long, url string")
    captures = urlfilter.captures_of_pages(pages).collect()
    assert all(r["fetched"].isoformat() >= "2020-01-01" for r in captures)
    assert captures[0]["fetched"].toordinal() - 737425 == (1 << 62) % 1461 * 37 % 1461


def test_key_without_end_in_a_long_text(spark):
    text = "-----BEGIN RSA PRIVATE KEY-----" + "ab- c" * 4_000_000
    documents = spark.createDataFrame([(1, text)], "doc_id long, text string")
    start = time.monotonic()
    found = secrets.scan(documents).collect()[0]
    assert [(s["start"], s["end"]) for s in found["spans"]] == [(0, 31)] and time.monotonic() - start < 120


def test_phrases_count_in_short_lines_only(spark):
    article = " ".join([lines(3, 7).replace("\n", " "), "It ran on JavaScript once.", lines(17, 8).replace("\n", " ")])
    bullets = "\n".join(f"- buy {w} and carry it home today" for w in lines(2, 9).split())
    footer = lines(6, 10) + "Powered by a website builder, all rights reserved."
    menu = lines(6, 11) + "\nHome | About | Contact | Imprint"
    rows = [(i, t) for i, t in enumerate([article, bullets, footer, menu])]
    got = {r["doc_id"]: r for r in quality.clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0]["kept"] and got[0]["n_bad_lines"] == 0
    assert got[1]["n_bad_lines"] == 0
    assert got[2]["kept"] and got[2]["n_bad_lines"] == 1 and "Powered" not in got[2]["clean_text"]
    assert got[3]["n_bad_lines"] == 1 and "Imprint" not in got[3]["clean_text"]


def test_damaged_headers_are_found(spark, tmp_path):
    rows = [(i, f"http://a.example/{i}", "x" * (50 + 60 * (i % 2)) + str(i // 4)) for i in range(8)]
    warc.write_archive(spark.createDataFrame(rows, "page_id long, url string, html string"), str(tmp_path / "a"))
    whole = warc.record_bytes(warc.read_archive(spark, str(tmp_path / "a"))).collect()
    assert all(r["verified"] and len(r["record"]) == r["record_bytes"] for r in whole)
    headers = spark.read.parquet(str(tmp_path / "a" / "headers"))
    text = F.decode("header", "UTF-8")
    damages = [
        F.substring(text, 1, 150), F.substr(text, F.lit(1), F.length(text) - 2), F.regexp_replace(text, "Content-Length: ", "Content-Length: 1"),
        F.regexp_replace(text, r"Content-Length: [^\r]*\r\n", ""), F.regexp_replace(text, "WARC-Type: [a-z]*", "WARC-Type: other"),
    ]
    for k, damage in enumerate(damages):
        path = str(tmp_path / f"b{k}")
        headers.withColumn("header", F.encode(damage, "UTF-8")).write.parquet(f"{path}/headers")
        spark.read.parquet(str(tmp_path / "a" / "payloads")).write.parquet(f"{path}/payloads")
        assert not any(r["verified"] for r in warc.read_archive(spark, path).collect()), k
