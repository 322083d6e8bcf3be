import random

import pytest

from mentiongrid.functions.patterns import python_near_pattern, python_pattern
from mentiongrid.operators import term_index
from mentiongrid.operators.counting import mention_counts
from mentiongrid.operators.dictionary import compile_terms
from mentiongrid.operators.term_index import Matcher, TermIndex

FIRST = [
    r"\babc\b", r"abcs", r"ab.?cd", r"(abc|cab)d", r"ab[aeo]c", r"ab\s?c(en|er)", r"\babc\w*\b", r"abcst|\babc\.", r"^abc", r"ca{2,3}b",
    r"\bab\s?cd\b", r"abc.*abd", r"x?", r"\Bcab", r"ab[^s]k", r"kas", r"bac\s\w+\sde", r"abc$", r"abc\d", r"(^|[^a-z])bca([^a-z]|$)",
]
SECOND = [r"dab|ca.?d", r"\b(bad|cad\w*)\b", r"dac+b", r"skd"]


def _text(rng):
    words = ["".join(rng.choice("aabbccddesk") for _ in range(rng.randint(1, 7))) for _ in range(rng.randint(0, 30))]
    parts = [rng.choice([w, w, "abc", "cad", "bad", "abcs", "ab", "cd", "kas", "bca", "abcst", "dab"]) for w in words]
    text = "".join(p + rng.choice([" ", " ", "", ". ", "\n", "é", "_", "7", ", "]) for p in parts)
    return "".join(rng.choice([c, c, c, c.upper()]) for c in text) + rng.choice(["", "", "ſ", "Kas", "İ", " kaſ abc"])


@pytest.mark.parametrize("unicode_case", [False, True])
@pytest.mark.parametrize("few", [0, 1000])
def test_words_tell_what_the_patterns_find(monkeypatch, unicode_case, few):
    monkeypatch.setattr(term_index, "_FEW", few)
    monkeypatch.setattr(term_index, "_REMEMBERED", 300)
    first, second = (compile_terms([(r, r) for r in regexes], unicode_case) for regexes in (FIRST, SECOND))
    rng, patterns = random.Random(few), [python_pattern(r, unicode_case) for r in FIRST + SECOND]
    pairs = [[python_near_pattern(a, b, 6, unicode_case) for b in SECOND] for a in FIRST]
    for dictionary in (range(len(FIRST)), [0, 1, 4, 9]):
        index = TermIndex.of([first[i] for i in dictionary], second, unicode_case=unicode_case)
        plain, close = Matcher(index), Matcher(index, 6)
        for _ in range(700):
            text = _text(rng)
            terms = [i for i, n in enumerate([*dictionary, *range(len(FIRST), len(patterns))]) if patterns[n].search(text)]
            assert plain.match(text) == (terms, []), text
            found, near = close.match(text)
            size = len(dictionary)
            expected = [[size + b for b in range(len(SECOND)) if size + b in terms and pairs[dictionary[a]][b].search(text)] for a in terms if a < size]
            assert (found, near) == (terms, expected), text
    assert plain.match(None) == ([], [])


def test_texts_are_read_once_and_no_token_is_moved(spark):
    articles = spark.createDataFrame([(1866, "abc cad"), (1866, "abc"), (1866, "abc"), (1867, None)], "year int, article_text string")
    first, second = (compile_terms([(r, r) for r in regexes]) for regexes in (FIRST[:12], SECOND))
    counts = mention_counts(articles, first, second, by=["year"], max_chars=40)
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "token" not in plan and "Join" not in plan
    rows = {(r.place_id, r.topic_id): (r.n_location, r.n_both) for r in counts.collect()}
    assert rows[0, 0] == (3, 1) and rows[0, 2] == (3, 0)
