r"""Line-first cleaning and quality rules, in DataFrame functions only.

Every line of a text is judged first. A line with a word fails if it is
* punctuation: fewer than half of its characters outside words' separators are letters or
  digits, or it ends without sentence punctuation although it has more than `long_line` words
  and is not the end of the text;
* navigation: one word in three or more is only a separator such as `|` (one that opens the line is a bullet and does not count);
* boilerplate: it has at most `furniture` words and contains one of the fixed phrases. A longer line is running text that
  may well name such things.
Failing lines are removed. A document is rejected if it loses more than `most_lost` percent of the
characters of its words, or if it fails the base rules (fewer than 20 words, or more than
30 % of its words in repeated windows of eight words).

The repeated words of a text are found inside its own row: hashes of all windows of eight words,
sorted together with their positions, show which windows repeat; nothing is shuffled.

Defined results: a null text has no words and fails the base rules, as does an empty one.
Lines without a word are neither judged nor counted. Repeated rows get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import WORD, table

SYMBOLS = "[#*$%&|<>]"
BLANKS = r"\x20\x09-\x0D"
WINDOW = 8

# Phrases of pages rather than of texts, in lower case.
BOILERPLATE = [
    "all rights reserved", "terms of use", "terms of service", "privacy policy", "cookie policy", "accept cookies",
    "javascript", "lorem ipsum", "sign up for our newsletter", "click here", "subscribe to", "powered by",
]
SEPARATORS = r"[|»«›‹•·>/\\-]+"
SENTENCE_ENDS = ".!?…:;\"'”»)]"


def without(text: Column, characters: str) -> Column:
    return F.regexp_replace(text, f"[{characters}]+", "")


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), 0)


def _letters(words: str | Column) -> Column:
    """Code points in an array of words."""
    return F.length(F.array_join(words, "")).cast("long")


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of eight words that the text has at least twice.

    Windows are compared by a 64-bit hash of the 64-bit hashes of their words.
    """
    hashed = F.transform(words, lambda w: F.xxhash64(w))

    def repeats(h: Column) -> Column:
        starts = F.when(F.size(h) >= WINDOW, F.sequence(F.lit(0), F.size(h) - WINDOW)).otherwise(F.array().cast("array<int>"))
        windows = F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)]))
        return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(w)))

    return _let(hashed, repeats)


def _covered(windows: Column) -> Column:
    by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def again(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: (F.get(s, k - 1)["h"] == x["h"]) | (F.get(s, k + 1)["h"] == x["h"]))
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    # Windows overlap: each adds the words up to the next repeated window.
    def total(p: Column) -> Column:
        gaps = F.transform(p, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - i, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda a, g: a + g)

    return _let(by_hash, lambda s: _let(again(s), total))


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once: a lambda over a one-element array binds it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def line_fails(line: Column, last: Column, long_line: int, furniture: int) -> Column:
    """Whether a line that has a word is to be removed. Costly measures stand behind cheap ones."""
    n_words = F.regexp_count(line, F.lit(WORD))
    # Letters and digits are what remains when the rest is taken away.
    plain = F.length(F.regexp_replace(line, r"[^\p{L}\p{N}]+", ""))
    ends = F.instr(F.lit(SENTENCE_ENDS), F.right(F.rtrim(line), F.lit(1))) > 0
    # A line of so many words has as many characters and the blanks between them.
    punctuation = (2 * plain < F.length(without(line, BLANKS))) | ((F.length(line) > 2 * long_line) & ~last & ~ends & (n_words > long_line))
    alone = F.regexp_count(line, F.lit(f"(?<=[^{BLANKS}])[{BLANKS}]+{SEPARATORS}(?![^{BLANKS}])"))
    navigation = (alone > 0) & (3 * alone >= n_words)
    folded = F.lower(line)
    boilerplate = F.lit(False)
    for phrase in BOILERPLATE:
        boilerplate = boilerplate | folded.contains(phrase)
    return punctuation | navigation | (boilerplate & (n_words <= furniture))


def clean(documents: DataFrame, most_lost: int = 50, long_line: int = 200, furniture: int = 25) -> DataFrame:
    """Per row of (doc_id, text): base measures, `clean_text`, what was lost, and the verdict."""
    lines = documents.select(
        "doc_id", "text", words_of(F.coalesce("text", F.lit(""))).alias("words"), F.split(F.coalesce("text", F.lit("")), "\n").alias("lines")
    )
    worded = F.filter("lines", lambda x: x.rlike(WORD))
    measured = lines.select(
        "doc_id",
        F.size("words").cast("long").alias("n_words"),
        _letters("words").alias("word_chars"),
        F.coalesce(F.regexp_count("text", F.lit(SYMBOLS)), F.lit(0)).cast("long").alias("n_symbols"),
        worded.alias("worded"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
    )
    flagged = measured.select(
        "*",
        (F.size("worded") - F.size(F.array_distinct("worded"))).cast("long").alias("n_dup_lines"),
        F.transform("worded", lambda x, i: F.struct(x.alias("line"), line_fails(x, i == F.size("worded") - 1, long_line, furniture).alias("bad"))).alias("flags"),
    )
    judged = flagged.select(
        "*",
        F.transform(F.filter("flags", lambda x: ~x["bad"]), lambda x: x["line"]).alias("good"),
        _letters(words_of(F.array_join(F.transform(F.filter("flags", lambda x: x["bad"]), lambda x: x["line"]), "\n"))).alias("lost_chars"),
    )
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    lost = F.col("lost_chars")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"),
        F.size("worded").cast("long").alias("n_lines"),
        (F.size("worded") - F.size("good")).cast("long").alias("n_bad_lines"),
        "lost_chars",
        (~failed & (100 * lost <= most_lost * F.col("word_chars"))).alias("kept"),
        F.array_join("good", "\n").alias("clean_text"),
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("clean_text")


_PHRASES = "|".join(BOILERPLATE)
OP9_SQL = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS row_id,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
worded AS (
  SELECT row_id, line, pos, max(pos) OVER (PARTITION BY row_id) AS last_pos
  FROM (SELECT row_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM texts)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT *, regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g') AS shown, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS lw
  FROM worded),
flagged AS (
  SELECT row_id, line, shown,
         2 * length(regexp_replace(shown, '[^\p{{L}}\p{{N}}]+', '', 'g')) < length(shown)
         OR (pos < last_pos AND len(lw) > 200 AND NOT regexp_matches(rtrim(line), '[.!?…:;"''”»)\]]$'))
         OR (3 * len(list_filter(lw[2:], lambda w: regexp_full_match(w, '[|»«›‹•·>/\\-]+'))) >= len(lw) AND len(list_filter(lw[2:], lambda w: regexp_full_match(w, '[|»«›‹•·>/\\-]+'))) > 0)
         OR (len(lw) <= 25 AND regexp_matches(lower(line), '{_PHRASES}')) AS bad
  FROM judged),
line_sums AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines,
         count(*) FILTER (WHERE bad) AS n_bad_lines, coalesce(sum(length(shown)) FILTER (WHERE bad), 0) AS lost_chars
  FROM flagged GROUP BY row_id),
windows AS (
  SELECT row_id, unnest(range(1, len(words) - 6)) AS i, words FROM texts WHERE len(words) >= 8),
twice AS (
  SELECT row_id, i, count(*) OVER (PARTITION BY row_id, array_to_string(words[i:i+7], ' ')) AS n FROM windows),
repeats AS (
  SELECT row_id, count(DISTINCT i + k) AS n_repeat_words
  FROM twice, (SELECT unnest(range(0, 8)) AS k) WHERE n > 1 GROUP BY row_id),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_bad_lines, 0) AS BIGINT) AS n_bad_lines,
         CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars
  FROM texts LEFT JOIN line_sums USING (row_id) LEFT JOIN repeats USING (row_id)),
failing AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, n_lines, n_bad_lines, lost_chars,
       NOT base_failed AND 100 * lost_chars <= 50 * word_chars AS kept
FROM failing"""

QUERIES = {"op9_quality_rules": op9_quality_rules}
SQL = {"op9_quality_rules": OP9_SQL}
