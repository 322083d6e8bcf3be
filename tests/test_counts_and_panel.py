import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from mentiongrid.operators.counting import mention_counts, pair_counts, pair_set_counts, place_counts, place_shares, with_year_month
from mentiongrid.operators.dictionary import compile_term, compile_terms, require_columns, select_pattern
from mentiongrid.operators.panel import complete_panel, duplicate_keys, mean_rate, mention_rates, panel_grid, require_unique, yearly
from mentiongrid.operators.term_index import Patterns
from mentiongrid.functions.patterns import python_near_pattern
from mentiongrid.operators.series import impute_group_mean, rolling_mean
from mentiongrid.plans import ad_hoc
from mentiongrid.plans.build_database import Dictionaries, build, monthly_panel
from mentiongrid.sources.sinks import write_by_year

DAY = datetime.date(1866, 7, 1)
GAP = "x" * 38
ARTICLES = [
    (DAY, "Cholera te Leiden"), (DAY, "leiden en amsterdam"), (DAY, None), (DAY, ""),
    (datetime.date(1866, 8, 1), f"cholera {GAP} leiden"),  # 40 characters between
    (datetime.date(1866, 8, 2), f"cholera  {GAP} leiden"),  # 41
    (datetime.date(1866, 8, 3), f"leiden {GAP} cholera"),  # 40, other order
    (datetime.date(1866, 8, 4), "cholera\nleiden"),
    (datetime.date(1867, 1, 1), "éleiden choleré"), (datetime.date(1867, 1, 2), "leidens cholerus amsterdam pokken"),
]
PLACES = [("Leiden", r"\ble(i|y)den\b", "Leiden", 1, 11), ("Amsterdam", r"amster\w*|amst\.", "Amsterdam", 2, 12), ("Nergens", r"\bnergens\b", "Nergens", 3, 13)]
TOPICS = [("Cholera", r"\b(choler\w*|krim\s?koorts)\b", "Cholera"), ("Smallpox", r"\b(pokken|variola)\b", "Smallpox")]


@pytest.fixture(scope="module")
def articles(spark):
    return spark.createDataFrame(ARTICLES, "newspaper_date date, article_text string").repartition(3)


def brute_force(max_chars=0):
    counts = {}
    for day, text in ARTICLES:
        for p, place in enumerate(PLACES):
            if text is None or not re.search(place[1], text, re.I | re.A):
                continue
            for t, topic in enumerate(TOPICS):
                a, b, gap = f"(?:{topic[1]})", f"(?:{place[1]})", f".{{0,{max_chars}}}"
                pattern = f"{a}{gap}{b}|{b}{gap}{a}" if max_chars else a
                both = re.search(pattern, text, re.I | re.A) is not None
                key = (p, day.year, day.month, t)
                n, m = counts.get(key, (0, 0))
                counts[key] = (n + 1, m + both)
    return counts


@pytest.mark.parametrize("max_chars", [0, 40, 41])
def test_all_pairs_equal_brute_force(articles, max_chars):
    rows = mention_counts(with_year_month(articles), compile_terms(PLACES), compile_terms(TOPICS), max_chars=max_chars).collect()
    got = {(r.place_id, r.year, r.month, r.topic_id): (r.n_location, r.n_both) for r in rows}
    assert got == brute_force(max_chars) and len(rows) == len(got)


def test_large_dictionary_of_topics(articles):
    topics = compile_terms([*TOPICS, *((f"w{i}", rf"\bword{i}\b") for i in range(150))])
    rows = mention_counts(with_year_month(articles), compile_terms(PLACES), topics).collect()
    got = {(r.place_id, r.year, r.month, r.topic_id): (r.n_location, r.n_both) for r in rows if r.topic_id < 2}
    assert got == brute_force()
    assert all(r.n_both == 0 for r in rows if r.topic_id >= 2)
    assert len(rows) == len(topics) * len({(r.place_id, r.year, r.month) for r in rows})


def test_pair_counts(articles):
    by_month = {(r.yr, r.mo): tuple(r)[2:] for r in pair_counts(articles, "choler.*", "leiden").collect()}
    assert by_month == {(1866, 7): (4, 1, 2, 1), (1866, 8): (4, 4, 4, 4), (1867, 1): (2, 2, 2, 2)}
    near = pair_counts(articles, "cholera", "leiden", 1866, 1867, by=(), max_chars=40).first()
    assert tuple(near) == (8, 5, 6, 3)
    here = pair_counts(articles, "cholera", "amster", 1866, 1868, denominator="location").collect()
    assert {(r.yr, r.mo): (r.n_location, r.n_both) for r in here} == {(1866, 7): (1, 0), (1867, 1): (1, 0)}
    nothing = pair_counts(articles, "cholera", "leiden", 1900, 1901, by=(), denominator="location").first()
    assert tuple(nothing) == (0, 0)
    with pytest.raises(ValueError):
        pair_counts(articles, "a", "b", denominator="none")


def test_place_counts_keep_places_without_mentions(articles):
    topic = compile_term(TOPICS[0][1])
    rows = place_counts(with_year_month(articles), compile_terms(PLACES), topic, by=("year",), unicode_case=False).collect()
    got = {(r.place_id, r.year): (r.n_total, r.n_disease, r.n_location, r.n_both) for r in rows}
    assert got == {
        (0, 1866): (8, 5, 6, 5), (0, 1867): (2, 2, 1, 1), (1, 1866): (8, 5, 1, 0), (1, 1867): (2, 2, 1, 1),
        (2, 1866): (8, 5, 0, 0), (2, 1867): (2, 2, 0, 0),
    }
    shares = place_shares(with_year_month(articles), compile_terms(PLACES), topic, by=(), max_chars=40, unicode_case=False).collect()
    assert {r.place_id: (r.n_both, r.n_total, r.normalized_mentions) for r in shares} == {0: (4, 7, 4 / 7), 1: (1, 2, 0.5), 2: (0, 0, 0.0)}


def test_panel_invariants(spark, articles):
    panel = monthly_panel(articles, Dictionaries(compile_terms(PLACES), compile_terms(TOPICS)))
    rows = panel.collect()
    assert len(rows) == 2 * 2 * 3 * 2  # topics x years x months x places seen
    assert all(0 <= r.n_both <= r.n_location and 0 <= r.mention_rate <= 1 for r in rows)
    assert {r.disease for r in rows} == {"cholera", "smallpox"} and {r.cbscode for r in rows} == {1, 2}
    by_year = {(r.disease, r.year, r.cbscode): r for r in yearly(panel).collect()}
    for key, row in by_year.items():
        months = [r for r in rows if (r.disease, r.year, r.cbscode) == key]
        assert row.n_both == sum(r.n_both for r in months) and row.n_location == sum(r.n_location for r in months)
    mean = {(r.cbscode, r.year): r.mention_rate for r in mean_rate(panel.filter("disease = 'cholera'")).collect()}
    assert mean[(1, 1866)] == pytest.approx((0 + 0.5 + 1) / 3)
    assert duplicate_keys(panel).count() == 0 and require_unique(panel) is panel


def test_rows_sharing_a_key_stay(spark):
    flat = spark.createDataFrame([("a", 1, 1, 5, 2, 1), ("a", 1, 1, 5, 3, 0), ("b", 2, 1, 6, 1, 1)], "disease string, year int, month int, cbscode int, n_location bigint, n_both bigint")
    panel = complete_panel(flat)
    assert panel.count() == 9
    assert [tuple(r) for r in duplicate_keys(panel).collect()] == [("a", 1, 1, 5, 2)]
    with pytest.raises(ValueError):
        require_unique(panel)
    assert mention_rates(panel).filter("n_location = 0").agg(F.max("mention_rate")).first()[0] == 0.0


def test_build_writes_three_tables(spark, articles, tmp_path):
    build(spark, articles, Dictionaries(compile_terms(PLACES), compile_terms(TOPICS)), str(tmp_path / "db"), files=2)
    counts = {n: spark.read.parquet(str(tmp_path / "db" / n)).count() for n in ("database_flat", "database", "database_yearly")}
    assert counts == {"database_flat": 10, "database": 24, "database_yearly": 8}


def test_build_refuses_shared_codes(spark, articles, tmp_path):
    places = [(name, regex, name, 1, ams) for name, regex, _, _, ams in PLACES]
    with pytest.raises(ValueError, match="do not identify"):
        build(spark, articles, Dictionaries(compile_terms(places), compile_terms(TOPICS)), str(tmp_path / "db"), files=2)
    assert not (tmp_path / "db" / "database").exists() and (tmp_path / "db" / "database_flat").exists()


def test_series(spark):
    rows = [("s", 1, m, float(m)) for m in range(1, 9)] + [("t", 1, m, None if m == 3 else 1.0) for m in range(1, 8)]
    df = spark.createDataFrame(rows, "s string, year int, month int, n double")
    got = {(r.s, r.month): r.n_6m for r in rolling_mean(df, ["s"], ["year", "month"], "n").collect()}
    assert got[("s", 5)] is None and got[("s", 6)] == 3.5 and got[("s", 8)] == 5.5 and got[("t", 7)] is None
    filled = {(r.s, r.month): r.n for r in impute_group_mean(df, ["s"], ["n"]).collect()}
    assert filled[("t", 3)] == 1.0 and filled[("s", 1)] == 1.0


def test_dictionary_helpers(spark):
    df = spark.createDataFrame([("Cholera x", "c"), ("Pokken", "p")], "Disease string, Regex string")
    assert select_pattern(df, "Cholera") == "c"
    for wrong in ("o", "none"):
        with pytest.raises(ValueError):
            select_pattern(df, wrong)
    with pytest.raises(ValueError, match="Missing"):
        require_columns(df, "Missing")


def test_ad_hoc_questions(articles):
    places = [compile_term(r, n, i, True, (n, c, a)) for i, (n, r, _, c, a) in enumerate(PLACES)]
    space = ad_hoc.over_space(articles, places, "choler.*|krim.?koorts", 1866).collect()
    assert [(r.location, r.month, r.n_location, r.n_both) for r in space] == [("Amsterdam", 7, 1, 0), ("Leiden", 7, 2, 1), ("Leiden", 8, 4, 4)]
    assert all(0 <= r.lower <= r.upper <= 1 for r in space)
    time = {(r.yr, r.mo): (r.n_location, r.n_both) for r in ad_hoc.over_time(articles, "cholera", "leiden", 1866, 1867).collect()}
    assert time == {(1866, 7): (2, 1), (1866, 8): (4, 4)}
    year = {r.location: (r.n_disease, r.n_location, r.n_both) for r in ad_hoc.year_map(articles, places, "cholera", 1866).collect()}
    assert year == {"Leiden": (5, 6, 5), "Amsterdam": (5, 1, 0), "Nergens": (5, 0, 0)}
    near = {(r.location, r.month): (r.n_both, r.n_total) for r in ad_hoc.near_shares(articles, places, "cholera", 1866, 1867).collect()}
    assert near[("Leiden", 8)] == (2, 4) and near[("Nergens", 7)] == (0, 0) and len(near) == 6
    of_all = {r.year: r.normalized_mentions for r in ad_hoc.near_shares(articles, places[:1], "cholera", 1866, 1867, 20, "total", ("year",)).collect()}
    assert of_all == {1866: 1 / 8}


def test_pair_set_equals_single_pairs(articles):
    pairs = [("a", "choler.*", "leiden"), ("b", "choler.*", "amster"), ("c", "pokken", "leiden")]
    got = {(r.label, r.yr, r.mo): (r.n_total, r.n_disease, r.n_location, r.n_both) for r in pair_set_counts(articles, pairs, 1866, 1868).collect()}
    expected = {
        (label, r.yr, r.mo): (r.n_total, r.n_disease, r.n_location, r.n_both)
        for label, d, p in pairs for r in pair_counts(articles, d, p, 1866, 1868).collect()
    }
    assert got == expected
    assert share_of_july(articles) == 1 / 4


def share_of_july(articles):
    return {r.mo: r.y for r in ad_hoc.share_of_total(pair_counts(articles, "cholera", "leiden", 1866, 1867)).collect()}[7]


def test_year_ranges_skip_partitions(spark, tmp_path):
    dated = spark.createDataFrame([(t, d, d.year) for d, t in ARTICLES], "article_text string, newspaper_date date, year int")
    write_by_year(dated, str(tmp_path / "a"))
    counts = pair_counts(spark.read.parquet(str(tmp_path / "a")), "cholera", "leiden", 1867, 1868)
    assert [(r.yr, r.n_total) for r in counts.collect()] == [(1867, 2)]
    plan = counts._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "PushedFilters: [IsNotNull(newspaper_date), GreaterThanOrEqual(newspaper_date" in plan


def test_matching_never_shuffles_texts(articles):
    counts = mention_counts(with_year_month(articles), compile_terms(PLACES), compile_terms(TOPICS), max_chars=40)
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan and "RLIKE" not in plan
    below = counts._jdf.queryExecution().optimizedPlan()
    assert "article_text" not in [a.name() for a in _attributes(below.output())]
    for line in plan.splitlines():
        if "Exchange " in line or "SortMergeJoin" in line:
            assert "article_text" not in line


def _attributes(seq):
    return [seq.apply(i) for i in range(seq.size())]


def test_near_pairs_equal_the_pair_pattern():
    rng = random.Random(4)
    regexes = [r"ab", r"b(c|cd)", r"a.?c", r"\bcd\b", r"d\s?a", r"bc\w*", r"c.*d", r"a{2,3}"]
    for unicode_case in (False, True):
        patterns = Patterns(regexes, unicode_case, 3)
        for _ in range(3000):
            text = "".join(rng.choice("aabbccdd  \né") for _ in range(rng.randint(0, 40)))
            a, b = rng.randrange(len(regexes)), rng.randrange(len(regexes))
            if patterns[a].search(text) and patterns[b].search(text):
                whole = python_near_pattern(regexes[a], regexes[b], 3, unicode_case).search(text) is not None
                assert patterns.near(a, b, text, patterns.spans(a, text), patterns.spans(b, text)) == whole, (regexes[a], regexes[b], text)


def test_empty_dictionaries_and_empty_periods(articles):
    dated, places, topics = with_year_month(articles), compile_terms(PLACES), compile_terms(TOPICS)
    expected = ["place_id", "year", "month", "topic_id", "n_location", "n_both"]
    for counts in (mention_counts(dated, [], topics), mention_counts(dated, places, []), mention_counts(dated, [], [])):
        assert counts.columns == expected and counts.collect() == []
    nothing = place_shares(dated.filter("year = 1900"), places, topics[0], by=(), unicode_case=False)
    assert {r.place_id: (r.n_both, r.n_total, r.normalized_mentions) for r in nothing.collect()} == {i: (0, 0, 0.0) for i in range(3)}
    assert place_shares(dated, [], topics[0], unicode_case=False).collect() == []


def test_pattern_modes_must_agree(articles):
    with pytest.raises(ValueError, match="Leiden"):
        mention_counts(with_year_month(articles), compile_terms(PLACES, unicode_case=True), compile_terms(TOPICS))


def test_null_keys_and_groups_are_values(spark):
    rows = [("a", 1, None, 5, 1), ("a", 2, 7, 3, 0), (None, 1, 7, 2, 2)]
    counts = spark.createDataFrame(rows, "disease string, year int, cbscode int, n_location long, n_both long")
    panel = complete_panel(counts, ["disease", "year", "cbscode"]).collect()
    assert len(panel) == 8 and sum(r.n_location for r in panel) == 10
    assert {(r.disease, r.year, r.cbscode): r.n_both for r in panel}[(None, 1, 7)] == 2
    filled = impute_group_mean(spark.createDataFrame([(None, 1.0), (None, None), ("a", 3.0)], "g string, x double"), ["g"], ["x"])
    assert sorted(r.x for r in filled.collect()) == [1.0, 1.0, 3.0]


def test_the_grid_is_expanded_by_many_tasks(spark):
    counts = spark.range(400).selectExpr("id % 4 as disease", "id % 5 as year", "id as cbscode", "id as n_location", "id as n_both")
    grid = panel_grid(counts, ["disease", "year", "cbscode"])
    per_task = grid.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in per_task) == 8000 and len(per_task) > 1 and max(r["count"] for r in per_task) < 6000
