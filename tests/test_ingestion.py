import datetime
import zipfile

import pytest

from pyspark.sql import functions as F

from mentiongrid.functions import ids
from mentiongrid.functions.markup import article_meta, article_texts, newspaper_meta, parsed_issues, web_paragraphs, web_title
from mentiongrid.operators.combine import combine, harmonise, one_per_key, partitioned
from mentiongrid.operators.worklist import month_grid, pending, ready, result_pages
from mentiongrid.plans.build_database import Dictionaries, monthly_panel
from mentiongrid.plans.ingest import combine_years, extract_archives
from mentiongrid.operators.dictionary import compile_terms
from mentiongrid.sources.archives import list_zip_files, read_member_files, read_zip_files, read_zip_members, with_zip_period, zip_members

DIDL = """<didl:DIDL xmlns:didl="urn:mpeg:mpeg21:2002:02-DIDL-NS" xmlns:dc="http://purl.org/dc/elements/1.1/"
 xmlns:dcterms="http://purl.org/dc/terms/" xmlns:ddd="http://www.kb.nl/namespaces/ddd">
<didl:Item dc:identifier="DDD:ddd:1:mpeg21">
 <didl:Component dc:identifier="ddd:1:mpeg21:metadata"><didl:Resource>
  <dc:title>Courant</dc:title><dc:date>{date}</dc:date><dcterms:spatial>Landelijk</dcterms:spatial>
  <dcterms:spatial xsi:type="dcx:creation">Leiden</dcterms:spatial>
  <dc:language xsi:type="dcterms:ISO639-1">nl</dc:language><dc:publisher/></didl:Resource></didl:Component>
 <didl:Component dc:identifier="ddd:1:mpeg21:pdf"><dc:title>Other</dc:title></didl:Component>
 <didl:Item dc:identifier="ddd:1:mpeg21:p001"/>
 <didl:Item dc:identifier="ddd:1:mpeg21:a0001"><dc:subject>artikel</dc:subject></didl:Item>
 <didl:Item dc:identifier="ddd:1:mpeg21:a0002"/>
</didl:Item></didl:DIDL>"""
RECORD = """<OAI-PMH xmlns="http://www.openarchives.org/OAI/2.0/"><GetRecord><record><metadata>{didl}</metadata></record></GetRecord></OAI-PMH>"""


def members(spark, *contents):
    return spark.createDataFrame([(f"x/DDD_{i}_0001_articletext.xml", c) for i, c in enumerate(contents)], "member string, content string")


def test_article_xml(spark):
    rows = article_texts(members(
        spark, "<text><title>T <b>x</b></title><p>one <i>two</i> three</p><p/><p>é &amp; f</p></text>", "<text><p>no title</p></text>", "<broken", None,
    )).orderBy("article_id").collect()
    assert [r.article_id for r in rows] == [f"ddd:{i}:mpeg21:a0001" for i in range(4)]
    assert (rows[0].article_title, rows[0].article_text, rows[0].parse_error) == ("T x", "one two three  é & f", None)
    assert all(r.article_text is None and r.article_title is None and r.parse_error for r in rows[1:])


def test_issue_xml(spark):
    good, undated = DIDL.format(date="1866-07-01"), DIDL.format(date="July 1866")
    rows = spark.createDataFrame([(good,), (undated,), (RECORD.format(didl=good),), ("<x",)], "content string")
    issues = parsed_issues(rows)
    papers = newspaper_meta(issues).collect()
    assert papers[0].newspaper_id == "DDD:ddd:1:mpeg21"
    assert (papers[0].newspaper_name, papers[0].newspaper_location, papers[0].newspaper_spatial) == ("Courant", "Leiden", "Landelijk")
    assert papers[0].newspaper_date == datetime.date(1866, 7, 1) and papers[1].newspaper_date is None
    assert papers[0].newspaper_language == "nl" and papers[0].newspaper_publisher is None and papers[0].newspaper_temporal is None
    assert papers[2][:-1] == papers[0][:-1]
    assert papers[3].newspaper_id is None and papers[3].parse_error
    items = [tuple(r) for r in article_meta(issues.limit(1)).collect()]
    assert items == [("DDD:ddd:1:mpeg21", "ddd:1:mpeg21:a0001", "artikel"), ("DDD:ddd:1:mpeg21", "ddd:1:mpeg21:a0002", None)]


def test_archives(spark, tmp_path):
    names = [f"d/DDD_{i}_0001_articletext.xml" for i in range(25)]
    with zipfile.ZipFile(tmp_path / "kranten_pd_183x.zip", "w") as archive:
        for i, name in enumerate(names):
            archive.writestr(name, f"<text><title>{i}</title></text>")
        archive.writestr("d/bad_articletext.xml", b"\xff\xfe")
        archive.writestr("d/readme.txt", "x")
    (tmp_path / "plain_articletext.xml").write_text("<text/>")
    by_value = zip_members(read_zip_files(spark, str(tmp_path)), "articletext.xml")
    paths = [r.path for r in list_zip_files(spark, str(tmp_path)).collect()]
    in_parts = read_zip_members(spark, paths, "articletext.xml", part_bytes=200)
    assert in_parts.rdd.getNumPartitions() > 3
    for found in (by_value, in_parts):
        rows = {r.member: r.content for r in found.collect()}
        assert set(rows) == {*names, "d/bad_articletext.xml"}
        assert rows[names[3]] == "<text><title>3</title></text>" and rows["d/bad_articletext.xml"] is None
        assert found.count() == 26
    assert {r.period for r in with_zip_period(in_parts).collect()} == {"1830_1839"}
    assert [r.content for r in read_member_files(spark, str(tmp_path), "articletext.xml").collect()] == ["<text/>"]


def test_paragraphs_at_any_depth(spark):
    xml = "<r><head><title>A <b>&amp; B</b></title></head><p>x <i>y</i></p><sec><p>z &lt;q&gt;</p><sub><p><![CDATA[<w>]]></p></sub></sec></r>"
    row = article_texts(spark.createDataFrame([("a/DDD_1_0001_articletext.xml", xml)], "member string, content string")).first()
    assert (row.article_title, row.article_text, row.parse_error) == ("A & B", "x y z <q> <w>", None)


def test_zip_source_reads_what_zipfile_writes(spark, tmp_path):
    stored, long_name = "é\n" * 5000, "n" * 3000 + "_didl.xml"
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.comment = b"PK\5\6 in a comment"
        archive.writestr("ü_didl.xml", stored, zipfile.ZIP_STORED)
        archive.writestr(long_name, "", zipfile.ZIP_DEFLATED)
        archive.writestr("b_didl.xml", "x" * 100, zipfile.ZIP_BZIP2)
        with archive.open("wide_articletext.xml", "w", force_zip64=True) as out:
            out.write(b"zip64")
        archive.writestr("c.txt", "not wanted")
    with open(tmp_path / "prefixed.zip", "wb") as out:
        out.write(b"#!/bin/sh\n" + (tmp_path / "a.zip").read_bytes())
    damaged = bytearray((tmp_path / "a.zip").read_bytes())
    damaged[60] ^= 1
    (tmp_path / "damaged.zip").write_bytes(damaged)
    with zipfile.ZipFile(tmp_path / "empty.zip", "w"):
        pass
    for part_bytes in (1, 1 << 20):
        paths = [f"file:{tmp_path}/{n}.zip" for n in ("a", "prefixed", "damaged", "empty")]
        found = read_zip_members(spark, paths, "articletext.xml", "didl.xml", part_bytes=part_bytes).collect()
        rows = {(r.path.rsplit("/")[-1], r.member): (r.content, r.read_error) for r in found}
        for name in ("a.zip", "prefixed.zip"):
            assert rows[name, "ü_didl.xml"] == (stored, None) and rows[name, long_name] == ("", None)
            assert rows[name, "wide_articletext.xml"] == ("zip64", None) and "method 12" in rows[name, "b_didl.xml"][1]
        assert rows["damaged.zip", "ü_didl.xml"][0] is None and rows["damaged.zip", "wide_articletext.xml"][0] == "zip64"
        assert len(found) == 12
    assert read_zip_members(spark, [], "x").collect() == []
    (tmp_path / "none.zip").write_bytes(b"no archive")
    with pytest.raises(Exception, match="none.zip"):
        read_zip_members(spark, [f"file:{tmp_path}/none.zip"], "x").collect()


def test_web_markup(spark):
    html = "<title>A\nB</title><p>x <b>y</b></p><p class='a'>open<p>z &lt;&amp;lt;</p> no <p>last"
    row = spark.createDataFrame([(html,)], "h string").select(web_title(F.col("h")), web_paragraphs(F.col("h"))).first()
    assert tuple(row) == ("A\nB", "x y open z <&lt; last")


def test_ids(spark):
    df = spark.createDataFrame([("a/b/DDD_000010_012_articletext.xml", "KRANTEN:kbdkb:99:mpeg21", "http://resolver.kb.nl/resolve?urn=x:ocr:1:ocr")], "f string, n string, u string")
    prefix, number = ids.newspaper_prefix(F.col("n")), ids.newspaper_number(F.col("n"))
    row = df.select(ids.article_id_from_file(F.col("f")), prefix, number, ids.record_identifier(prefix, number), ids.clean_article_id(F.col("u"))).first()
    assert tuple(row) == ("ddd:000010:mpeg21:a012", "kbdkb", "99:mpeg21", "KRANTEN:KBDKB:KBDKB:99:mpeg21", "x:ocr:1")
    short = df.select(ids.article_id_from_file(F.lit("x.xml")), ids.last_word(F.lit("Den Haag")), ids.last_word(F.lit("x.")), ids.auto_query(F.lit("A")), ids.choose_query(F.lit(None), F.lit("Leiden"))).first()
    assert tuple(short) == (None, "Haag", None, "*", "leid*")
    listed = spark.createDataFrame([(["a", "b"], "c")], "x array<string>, y string")
    assert tuple(ids.standardize_values(listed).first()) == ("a, b", "c")


def test_combine_keeps_one_row_per_article_in_range(spark):
    day = datetime.date
    papers = spark.createDataFrame([("n1", day(1830, 1, 1)), ("n2", day(1831, 12, 31)), ("n3", day(1832, 1, 1)), ("n4", None), ("n1", day(1830, 1, 1))], "newspaper_id string, newspaper_date date")
    meta = spark.createDataFrame([("n1", "a1", "s"), ("n1", "a1", "s"), ("n2", "a2", None), ("n3", "a3", "s"), ("n4", "a4", "s"), ("nx", "a5", "s")], "newspaper_id string, article_id string, article_subject string")
    texts = spark.createDataFrame([("a1", "t", "x"), ("a1", "t", "x"), ("a3", "t", "y")], "article_id string, article_title string, article_text string")
    rows = {r.article_id: r for r in partitioned(combine(meta, texts, papers, 1830, 1832)).collect()}
    assert set(rows) == {"a1", "a2"} and rows["a1"].article_text == "x" and rows["a2"].article_text is None
    assert rows["a2"].year == 1831
    both = harmonise(texts.drop("article_title"), texts.limit(1))
    assert one_per_key(both, "article_id").count() == 2 and both.columns == ["article_id", "article_text", "article_title"]


def test_work_lists(spark):
    months = month_grid(spark, 1880, 1881)
    assert months.count() == 12
    assert tuple(months.filter("month = 2").first()) == (1880, 2, datetime.date(1880, 2, 1), datetime.date(1880, 2, 29))
    totals = spark.createDataFrame([(0,), (1000,), (1001,)], "total bigint")
    starts = sorted((r.total, r.start_record) for r in result_pages(totals, "total").collect())
    assert starts == [(1000, 1), (1001, 1), (1001, 1001)]
    query = months.filter("month = 2").select(ids.month_query(F.lit("cholera"), F.col("year"), F.col("month"))).first()[0]
    assert query == 'cholera AND date within "1880-02-01 1880-02-29"'
    done = months.filter("month < 11").select("year", "month")
    assert sorted(r.month for r in pending(months, done, "year", "month").collect()) == [11, 12]
    assert sorted(r.month for r in ready(months, [done, months.filter("month > 9")], "year", "month").collect()) == [10]


def _delivery(path, issues):
    with zipfile.ZipFile(path, "w") as archive:
        for number, date, texts in issues:
            didl = DIDL.format(date=date).replace("ddd:1:", f"ddd:{number}:")
            archive.writestr(f"DDD_{number}/DDD_{number}_didl.xml", didl)
            for item, text in texts.items():
                archive.writestr(f"DDD_{number}/DDD_{number}_{item}_articletext.xml", f"<text><title>t</title><p>{text}</p></text>")


def test_from_archives_to_panel(spark, tmp_path):
    delivery, out = tmp_path / "in", tmp_path / "out"
    delivery.mkdir()
    folders = {n: str(out / n) for n in ("texts", "meta", "papers", "combined")}
    _delivery(delivery / "kranten_pd_183x.zip", [("1", "1832-07-01", {"0001": "Cholera te Leiden", "0002": "Leiden"})])
    extract_archives(spark, str(delivery), folders["texts"], folders["meta"], folders["papers"])
    combine_years(spark, folders["texts"], folders["meta"], folders["papers"], folders["combined"], 1830, 1840)
    # A later delivery adds its own period and years; what is there already is left alone.
    _delivery(delivery / "kranten_pd_184x.zip", [("2", "1841-01-01", {"0001": "cholera"})])
    for _ in range(2):
        extract_archives(spark, str(delivery), folders["texts"], folders["meta"], folders["papers"])
        combine_years(spark, folders["texts"], folders["meta"], folders["papers"], folders["combined"], 1830, 1850)
    stored = spark.read.parquet(folders["combined"])
    rows = {(r.article_id, r.year): r.article_text for r in stored.collect()}
    assert stored.count() == 4 and rows == {
        ("ddd:1:mpeg21:a0001", 1832): "Cholera te Leiden", ("ddd:1:mpeg21:a0002", 1832): "Leiden",
        ("ddd:2:mpeg21:a0001", 1841): "cholera", ("ddd:2:mpeg21:a0002", 1841): None,
    }
    # A stored year and a stored period get more: an issue in a changed archive and a text that was missing.
    _delivery(delivery / "kranten_pd_184x.zip", [("2", "1841-01-01", {"0001": "cholera", "0002": "late"}), ("3", "1841-05-01", {"0001": "new"})])
    for _ in range(2):
        extract_archives(spark, str(delivery), folders["texts"], folders["meta"], folders["papers"])
        combine_years(spark, folders["texts"], folders["meta"], folders["papers"], folders["combined"], 1830, 1850)
    later = {(r.article_id, r.year): r.article_text for r in spark.read.parquet(folders["combined"]).collect()}
    assert later == {**rows, ("ddd:2:mpeg21:a0002", 1841): "late", ("ddd:3:mpeg21:a0001", 1841): "new", ("ddd:3:mpeg21:a0002", 1841): None}
    # A run that was killed before its manifest was written repeats its years.
    manifest = tmp_path / "out" / "combined_manifest"
    manifest.rename(tmp_path / "lost")
    combine_years(spark, folders["texts"], folders["meta"], folders["papers"], folders["combined"], 1830, 1850)
    assert {(r.article_id, r.year): r.article_text for r in spark.read.parquet(folders["combined"]).collect()} == later
    stored = spark.read.parquet(folders["combined"]).filter("year = 1832")
    terms = Dictionaries(compile_terms([("Leiden", r"\bleiden\b", "Leiden", 1, 2)]), compile_terms([("C", r"\bcholer\w*\b", "Cholera")]))
    assert [tuple(r) for r in monthly_panel(stored, terms).collect()] == [("cholera", 1832, 7, 1, 0.5, 2, 1)]


def test_a_hot_issue_is_split_over_tasks(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "16",
    }
    meta = spark.range(200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("n"), (F.col("id") % 500).cast("string"))).alias("newspaper_id"),
        F.col("id").cast("string").alias("article_id"), F.sha2(F.col("id").cast("string"), 256).alias("article_subject"),
    )
    papers = meta.select("newspaper_id").distinct().withColumn("newspaper_date", F.lit("1850-01-01").cast("date"))
    texts = meta.select("article_id", F.lit("t").alias("article_title"), F.lit("x").alias("article_text"))
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        combined = combine(meta, texts, papers, 1850, 1851)
        rows = combined.collect()
        assert len(rows) == 200_000
        assert "SortMergeJoin(skew=true)" in combined._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)


def test_documents_are_parsed_a_few_at_a_time(spark):
    members = spark.range(1000).selectExpr(
        "concat('x/A_', id, '_0001_articletext.xml') as member", "id % 7 as part",
        "if(id % 97 = 0, '<text><title>t', concat('<text><title>t', id, '</title><p>a</p><p>b', id, '</p></text>')) as content",
    ).coalesce(1)
    texts = article_texts(members, "part")
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" not in plan and "MapInArrow" in plan
    rows = texts.collect()
    assert len(rows) == 1000 and sum(r.parse_error is not None for r in rows) == 11
    assert {(r.article_title, r.article_text) for r in rows if r.parse_error is None and r.part == 3} == {(f"t{i}", f"a b{i}") for i in range(3, 1000, 7) if i % 97}
