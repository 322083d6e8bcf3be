import re

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from mentiongrid.fixed_values import TOPIC_TERMS
from mentiongrid.functions.patterns import (
    ALWAYS, INSIDE, RUN, RUN_START, WORD, WORD_START, Key, PatternError, index_keys, java_pattern,
)
from mentiongrid.operators.dictionary import compile_terms, validate_dictionary
from mentiongrid.operators.matching import match_terms, with_mentioned_ids

TEXTS = [
    "the ver and", "éver", "veré", "ver2 ver_x", "VER.", "xver verx", "", "ver", "\nver\n", "Kver kver", "ſver", "İver",
    "krimkoorts", "krim koorts", "Krim\nKoorts", "krim  koorts", "ékrim koortsé", "choleriek", "cholera", "achol chol",
    "aarle-rixtel", "aarle\nrixtel", "aarlerixtel", "1aalsmeer2", "_aalsmeer_", "éaalsmeer", "aalsmeers", "aalsmeer",
    "leiden", "leyden", "leʏden", "Krim Koorts", "Krim koorts", "poKken", "poKken", "pokſen", "gri ep", "grıep", "GRİEP", "griep",
    "s hage", "'s-hage", "grave.", "gravenhage", "oned\r\noner", "a.b", "aab", "ab", "ty phus typhus tyfeuzen",
]
REGEXES = [
    r"\bver\b", r"ver", r"\bver", r"ver\b", r"\b(choler\w*|krim\s?koorts)\b", r"\bchol\w*\b", r"\bchol\w+",
    r"(?:[^a-zA-Z]|\b)aarle.?rixtel(?:[^a-zA-Z]|\b)", r"(?:[^a-zA-Z]|\b)aalsmeer(?:[^a-zA-Z]|\b)", r"\baalsmeer\b",
    r"[^a-zA-Z]aalsmeer", r"le[iy]den", r"\bqu?eau\b", r"graven.?hage|haag.*|s.?hage|grave\.", r"a+b", r"\b\w\b", r"^ver$",
    r"\b(oned|oner)\b", r"pok+en", r"griep|influenza", r"\d", r"ver\d", r"_x", r"(a|b){2}", r"\bs\b", r"\Bver",
    *(regex for _, regex in TOPIC_TERMS),
]


def ascii_search(regex, text):
    return re.search(regex.replace("$", r"\Z"), text, re.I | re.A) is not None


def matched(spark, regexes, texts, unicode_case=False):
    terms = compile_terms([(r, r) for r in regexes], unicode_case)
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(4)
    rows = match_terms(df, terms, "text", unicode_case).select("id", "term_id").collect()
    ids = with_mentioned_ids(df, "text", terms, "ids", unicode_case).select("id", "ids").collect()
    assert len(rows) == len(set(rows))
    by_array = {(r.id, i) for r in ids for i in r.ids}
    assert by_array == {(r.id, r.term_id) for r in rows}
    return by_array


def test_ascii_mode_equals_brute_force(spark):
    expected = {(i, j) for i, t in enumerate(TEXTS) for j, r in enumerate(REGEXES) if ascii_search(r, t)}
    got = matched(spark, REGEXES, TEXTS)
    assert {(TEXTS[i], REGEXES[j]) for i, j in got} == {(TEXTS[i], REGEXES[j]) for i, j in expected}


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_repeated_patterns_with_and_without_broadcast(spark, threshold):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        regexes = REGEXES * 2
        expected = {(i, j) for i, t in enumerate(TEXTS) for j, r in enumerate(regexes) if ascii_search(r, t)}
        assert matched(spark, regexes, TEXTS) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unicode_mode_equals_sql_engine(spark):
    regexes = [r for r in REGEXES if "\\" not in r or r"\." in r]
    con = duckdb.connect()
    sql = "SELECT regexp_matches(?, ?)"
    expected = {
        (i, j) for i, t in enumerate(TEXTS) for j, r in enumerate(regexes)
        if con.execute(sql, [t, "(?i)" + r]).fetchall()[0][0]
    }
    got = matched(spark, regexes, TEXTS, unicode_case=True)
    assert {(TEXTS[i], regexes[j]) for i, j in got} == {(TEXTS[i], regexes[j]) for i, j in expected}


def test_unicode_boundaries(spark):
    got = matched(spark, [r"\bver\b"], ["éver", "ver", "ver-x"], unicode_case=True)
    assert got == {(1, 0), (2, 0)}


letters = st.text(alphabet="aKkſsé_1 .\n-b", max_size=12)
pieces = st.sampled_from([r"\b", "a", "b", "ab", "k", "s", r"\w*", r"\s?", ".?", "[^a-zA-Z]", "(a|b)", "(k|sa)", "é", "_", "1", "[ab]", "a?", "(?:[^a-zA-Z]|\\b)", "s+"])
regexes = st.lists(pieces, min_size=1, max_size=6).map("".join)


@settings(max_examples=12, deadline=None)
@given(st.lists(letters, min_size=40, max_size=60), st.lists(regexes, min_size=40, max_size=40))
def test_random_patterns_equal_brute_force(spark, texts, patterns):
    expected = {(i, j) for i, t in enumerate(texts) for j, r in enumerate(patterns) if ascii_search(r, t)}
    got = matched(spark, patterns, texts)
    assert {(texts[i], patterns[j]) for i, j in got} == {(texts[i], patterns[j]) for i, j in expected}


folding = st.text(alphabet="iIıİkKKsSſéÉ -.\n", max_size=10)
plain_pieces = st.sampled_from(["i", "k", "s", "is", "ski", "é", ".?", "[^a-zA-Z]", "[a-z]", "[ik]", "(i|k)", "s*", "k+", "-", "[^i]", ".{0,3}", "i?", r"\."])
plain_regexes = st.lists(plain_pieces, min_size=1, max_size=5).map("".join)


@settings(max_examples=8, deadline=None)
@given(st.lists(folding, min_size=40, max_size=60, unique=True), st.lists(plain_regexes, min_size=30, max_size=30, unique=True))
def test_random_unicode_patterns_equal_sql_engine(spark, texts, patterns):
    con = duckdb.connect()
    con.execute("CREATE TABLE t(x VARCHAR)")
    con.execute("CREATE TABLE p(x VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?)", [[t] for t in texts])
    con.executemany("INSERT INTO p VALUES (?)", [[r] for r in patterns])
    expected = set(con.execute("SELECT t.x, p.x FROM t, p WHERE regexp_matches(t.x, '(?i)' || p.x)").fetchall())
    got = matched(spark, patterns, texts, unicode_case=True)
    assert {(texts[i], patterns[j]) for i, j in got} == expected


@pytest.mark.parametrize("regex, keys", [
    (r"\bver\b", [Key(False, WORD, "ver")]),
    (r"\b(oned|oner)\b", [Key(False, WORD, "oned"), Key(False, WORD, "oner")]),
    (r"(?:[^a-zA-Z]|\b)aalsmeer(?:[^a-zA-Z]|\b)", [Key(False, RUN, "aalsmeer")]),
    (r"(?:[^a-zA-Z]|\b)aarle.?rixtel", [Key(True, RUN_START, "aarle")]),
    (r"\bcholer\w*\b", [Key(True, WORD_START, "chole")]),
    (r"\bchol\w*\b", [Key(False, WORD_START, "chol")]),
    (r"amste.?dam|amst\.", [Key(True, INSIDE, "amst"), Key(True, INSIDE, "amste")]),
    (r"\b\w\b", [Key(True, ALWAYS)]),
])
def test_index_keys(regex, keys):
    assert index_keys(regex) == keys


def test_unicode_mode_has_no_certain_words():
    assert all(k.uncertain for _, r in TOPIC_TERMS for k in index_keys(r, unicode_case=True))


def test_null_text_and_empty_dictionary(spark):
    df = spark.createDataFrame([(1, None), (2, "ver")], "id int, text string")
    terms = compile_terms([("a", r"\bver\b"), ("b", r"\d?")])
    assert {(r.id, r.term_id) for r in match_terms(df, terms, "text").collect()} == {(2, 0), (2, 1)}
    assert match_terms(df, [], "text").collect() == []
    assert [r.ids for r in with_mentioned_ids(df, "text", [], "ids").collect()] == [[], []]


@pytest.mark.parametrize("bad", ["", " ", "(", "*a", "[a", "(?-i:a)b", r"(a)\1"])
def test_bad_patterns(bad):
    with pytest.raises(PatternError):
        java_pattern(bad)


def test_validation_sets_bad_rows_apart(spark):
    rows = [("ok", r"\bver\b"), ("bad", "("), ("none", None)]
    checked = validate_dictionary(spark.createDataFrame(rows, "name string, Regex string")).collect()
    assert {r.name: r.pattern_error is None for r in checked} == {"ok": True, "bad": False, "none": False}
    assert [t.label for t in compile_terms(rows, skip_invalid=True)] == ["ok"]
    with pytest.raises(PatternError, match="cannot be used"):
        compile_terms(rows)
    with pytest.raises(PatternError, match="POSIX"):
        java_pattern(r"[[:alpha:]]ver")


def test_spellings_of_other_dialects(spark):
    regexes = [r"(?<place>leiden)\b", r"(?i:Leiden)$", r"leiden\z", r"[(?<z]eiden", r"[]z]x", r"\\z", r"(?P<a>haag)"]
    texts = ["te Leiden", "leiden te", "(eiden", "]x", "a\\z", "Haag", None]
    hits = matched(spark, regexes, texts)
    assert hits == {(0, 0), (0, 1), (0, 2), (1, 0), (2, 3), (3, 4), (4, 5), (5, 6)}


def test_the_parser_still_has_the_shape_this_package_reads():
    from re import _parser

    kinds = [str(op) for op, _ in _parser.parse(r"a[b-c]\b(d|ef)g{2,3}.")]
    assert kinds == ["LITERAL", "IN", "AT", "SUBPATTERN", "MAX_REPEAT", "ANY"]
