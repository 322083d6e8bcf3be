"""Dictionaries against texts through an inverted index of tokens.

The index maps tokens (words, starts of words, runs of letters, pieces of runs) to the terms that they
prove or only nominate. Every task cuts its texts into words and looks each distinct word up once: a word whose letters settle a
pattern settles it for all texts. Only patterns that may reach beyond a word are tried on a text, on the
window around the word that nominates them. So the cost of an article hardly depends on the number of terms. Where distances
count, the same pass compares the places of the mentions. One projection over the texts; no text and no token is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentiongrid.functions.patterns import (
    ALWAYS, INSIDE, RUN, RUN_START, WORD, WORD_START, Key, has_positions, letter_runs, longest_match, python_folded, python_near_pattern,
    python_pattern, within_word,
)
from mentiongrid.operators.dictionary import Term, require_mode

#: Pieces of runs of letters are this long at most; a longer literal is looked up by its first letters.
PIECE = 4
#: A token is a mark of its kind and a literal; the mark alone stands for the text itself.
_MARKS = {WORD: "", WORD_START: "^", RUN: "-", RUN_START: "/", INSIDE: "~", ALWAYS: "*"}
_TEXT = "*"
_LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz0123456789_")
_WORDS, _RUNS = re.compile("[a-z0-9_]+"), re.compile("[a-z]+")
#: So many distinct words are remembered in a task; then it starts anew.
_REMEMBERED = 200_000
#: With so few literals in the index, words are found by these.
_FEW = 40
#: Texts taken from a batch at a time.
_ROWS = 500
#: Patterns with more variants or longer matches are tried without a look at their letters, or on the whole text.
_MAX_RUNS, _MAX_WIDTH = 16, 200


def token(key: Key) -> str:
    literal = key.literal[:PIECE] if key.kind == INSIDE else key.literal
    return _MARKS[key.kind] + literal


@dataclass(frozen=True)
class TermIndex:
    """Several dictionaries under one numbering: term i of all, dictionary after dictionary."""

    dictionaries: tuple[tuple[Term, ...], ...]
    unicode_case: bool

    @staticmethod
    def of(*dictionaries: Sequence[Term], unicode_case: bool = False) -> TermIndex:
        for terms in dictionaries:
            require_mode(terms, unicode_case)
        return TermIndex(tuple(tuple(terms) for terms in dictionaries), unicode_case)

    @property
    def terms(self) -> list[Term]:
        return [t for terms in self.dictionaries for t in terms]

    def keys(self) -> set[Key]:
        return {key for term in self.terms for key in term.keys}

    def entries(self) -> dict[str, tuple[list[int], list[int]]]:
        """By token, the numbers of the terms that it proves, and of those that it nominates."""
        found: dict[str, tuple[set[int], set[int]]] = {}
        for number, term in enumerate(self.terms):
            for key in term.keys:
                found.setdefault(token(key), (set(), set()))[key.uncertain].add(number)
        return {t: (sorted(sure), sorted(asked - sure)) for t, (sure, asked) in sorted(found.items())}

    def ids(self, numbers: Column | str, which: int) -> Column:
        """Ascending ids of the terms of one dictionary among term numbers."""
        before = sum(map(len, self.dictionaries[:which]))
        terms = self.dictionaries[which]
        here = F.filter(numbers, lambda n: (n >= before) & (n < before + len(terms)))
        if all(t.id == i for i, t in enumerate(terms)):
            return F.array_sort(F.transform(here, lambda n: n - before))
        ids = id_list([t.id for t in terms])
        return F.array_sort(F.transform(here, lambda n: F.get(ids, n - before)))


def id_list(ids: Sequence[int]) -> Column:
    """A constant array, short in the plan however long it is."""
    return F.split(F.lit(" ".join(map(str, ids))), " ").cast("array<int>") if ids else F.array().cast("array<int>")


def mentions(texts: DataFrame, index: TermIndex, text: str, by: Sequence[str] = (), max_chars: int = 0) -> DataFrame:
    """(*by, _terms[, _near]): a row for each row, with the ascending numbers of the mentioned terms; a NULL text mentions none.

    With `max_chars`, of two dictionaries, `_near` has an array for every term of the first in `_terms`: the numbers of
    those terms of the second that stand so close to it somewhere.
    """
    kept = texts.select(*(F.col(f"`{c}`") for c in by), F.col(text).alias("_text"))
    arrays = {"_terms": T.ArrayType(T.IntegerType())} | ({"_near": T.ArrayType(T.ArrayType(T.IntegerType()))} if max_chars else {})
    schema = T.StructType([*kept.schema.fields[:-1], *(T.StructField(name, kind) for name, kind in arrays.items())])
    return kept.mapInArrow(_matched(index, max_chars), schema)


def _matched(index: TermIndex, max_chars: int):
    kinds = [pa.list_(pa.int32()), pa.list_(pa.list_(pa.int32()))][: 2 if max_chars else 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(index, max_chars)
        for batch in batches:
            for start in range(0, batch.num_rows, _ROWS):
                rows = batch.slice(start, _ROWS)
                *kept, texts = rows.columns
                found = [matcher.match(t) for t in texts.to_pylist()]
                arrays = [pa.array(c, kind) for c, kind in zip(zip(*found, strict=True), kinds, strict=False)]
                names = [*rows.schema.names[:-1], "_terms", "_near"][: len(kept) + len(kinds)]
                yield pa.RecordBatch.from_arrays([*kept, *arrays], names)

    return run


class Entry:
    """What a token tells: terms it proves, and those it nominates by what else a match of them holds."""

    def __init__(self, literal: str, proved: list[int], nominated: list[int], patterns: Patterns) -> None:
        self.proved, self.named = proved, frozenset((*proved, *nominated))
        #: Nominated terms: with unbounded matches; with matches that hold one of these pairs of letters; any others.
        self.unbounded: list[int] = []
        self.others: dict[str, list[int]] = {}
        self.plain: list[int] = []
        self.reach = 0
        for n in nominated:
            facts = patterns.facts(n)
            if facts.longest is None and not facts.within_word:
                self.unbounded.append(n)
            pairs = facts.other_pairs(literal)
            for pair in pairs or ():
                self.others.setdefault(pair, []).append(n)
            if pairs is None:
                self.plain.append(n)
            if not facts.within_word:
                self.reach = max(self.reach, (facts.longest or 0) - len(literal))


@dataclass(frozen=True, slots=True)
class Told:
    """What a word tells, by numbers of terms."""

    #: Proven by the word; with their place in it.
    sure: tuple[int, ...]
    spans: tuple[tuple[int, int, int], ...]
    #: To be tried on the whole text, and around the word whatever stands beside it.
    unbounded: tuple[int, ...]
    around: tuple[int, ...]
    #: What else its tokens tell; those of them that look beside the word, and how far.
    entries: tuple[Entry, ...]
    open: tuple[Entry, ...]
    reach: int


class Words(dict):
    """What each word of a folded text tells, None for nothing. Remembered for a bounded number of words."""

    def __init__(self, index: TermIndex, patterns: Patterns, with_spans: bool) -> None:
        super().__init__()
        self._patterns, self._with_spans = patterns, with_spans
        by_token, tokens = index.entries(), {}
        for key in index.keys():
            literal = key.literal[:PIECE] if key.kind == INSIDE else key.literal
            tokens.setdefault(key.kind, {})[literal] = Entry(literal, *by_token[token(key)], patterns)
        self._whole, self._runs = tokens.get(WORD, {}), tokens.get(RUN, {})
        lengths = lambda kind: [(n, tokens[kind]) for n in sorted({len(literal) for literal in tokens.get(kind, ())})]
        self._word_starts, self._run_starts, self._pieces = lengths(WORD_START), lengths(RUN_START), lengths(INSIDE)

    def __missing__(self, word: str) -> Told | None:
        if len(self) >= _REMEMBERED:
            self.clear()
        entries = self._entries(word)
        value = self[word] = self._told(word, entries) if entries else None
        return value

    def _entries(self, word: str) -> list[Entry]:
        found = [entries[word[:n]] for n, entries in self._word_starts if word[:n] in entries]
        if word in self._whole:
            found.append(self._whole[word])
        for run in (word,) if word.isalpha() else _RUNS.findall(word):
            if run in self._runs:
                found.append(self._runs[run])
            found += [entries[run[:n]] for n, entries in self._run_starts if run[:n] in entries]
            for n, entries in self._pieces:
                found += [entries[piece] for i in range(len(run) - n + 1) if (piece := run[i : i + n]) in entries]
        return found

    def _told(self, word: str, entries: list[Entry]) -> Told:
        sure, asked, unbounded = set(), set(), set()
        pairs = _pairs(word)
        for entry in entries:
            sure.update(entry.proved)
            asked.update(entry.plain)
            unbounded.update(entry.unbounded)
            if entry.others:
                asked.update(*[entry.others[pair] for pair in pairs.intersection(entry.others)])
        spans, around = [], []
        for n in asked | sure if self._with_spans else asked - sure:
            found = self._inside(n, word)
            if found:
                spans.append((n, *found))
            elif n not in sure and not self._patterns.facts(n).within_word:
                around.append(n)
        sure.update(n for n, _, _ in spans)
        open_entries = tuple(e for e in entries if e.reach and e.others)
        reach = max((e.reach for e in entries), default=0)
        return Told(
            tuple(sure), tuple(spans) if self._with_spans else (), tuple(unbounded - sure), tuple(n for n in around if n not in unbounded),
            tuple(entries), open_entries, reach,
        )

    def _inside(self, n: int, word: str) -> tuple[int, int] | None:
        """Where the term stands in the word, whatever surrounds the word."""
        facts = self._patterns.facts(n)
        if not facts.local or not facts.may_match(word):
            return None
        found = self._patterns[n].search(f" {word} ", 1)
        return (found.start() - 1, found.end() - 1) if found and found.start() < found.end() <= len(word) + 1 else None


def _pairs(letters: str) -> set[str]:
    return {letters[i : i + 2] for i in range(len(letters) - 1)}


def _words_with(literal: str, folded: str) -> Iterator[tuple[int, int]]:
    """Places of the words that hold a literal."""
    at = folded.find(literal)
    while at >= 0:
        end = _WORDS.match(folded, at).end()
        while at > 0 and folded[at - 1] in _LETTERS:
            at -= 1
        yield at, end
        at = folded.find(literal, end)


_Spots = list[tuple[int, int, Told]]


class Matcher:
    """The terms of one text after the other."""

    def __init__(self, index: TermIndex, max_chars: int = 0) -> None:
        self._size, self._max_chars, self._unicode = len(index.dictionaries[0]), max_chars, index.unicode_case
        self._patterns = Patterns([t.regex for t in index.terms], index.unicode_case, max_chars)
        self._words = Words(index, self._patterns, bool(max_chars))
        literals = {k.literal[:PIECE] if k.kind == INSIDE else k.literal for k in index.keys() if k.kind != ALWAYS}
        shortest = sorted(a for a in literals if not any(b != a and b in a for b in literals)) if len(literals) <= _FEW else []
        self._literals = shortest if len(literals) <= _FEW else None
        # Without a key in any word.
        self._always = set(index.entries().get(_TEXT, ([], []))[1])

    def match(self, text: str | None) -> tuple[list[int], list[list[int]]]:
        """Numbers of the mentioned terms; for each of the first dictionary those of the second close to it."""
        if text is None:
            return [], []
        folded = python_folded(text, self._unicode)
        spots = None if self._literals is None else self._spots(folded)
        if spots is None:
            words = [told for told in map(self._words.__getitem__, set(_WORDS.findall(folded))) if told]
        else:
            words = [told for _, _, told in spots]
        odd = len(folded) != len(text) or (self._unicode and ("\u017f" in text or "\u212a" in text))
        found = set()
        if odd:
            if not self._unicode:
                found.update(n for told in words for n in told.sure)
            found |= self._searched(text, {n for told in words for entry in told.entries for n in entry.named} - found)
        elif words:
            found = found.union(*[told.sure for told in words])
            found |= self._searched(text, {n for told in words for n in told.unbounded} - found)
            if any(told.around or told.open for told in words):
                spots = self._spots(folded) if spots is None else spots
                self._look_around(text, folded, spots, found)
        found |= self._searched(text, self._always - found)
        terms = sorted(found)
        return terms, self._close(text, folded, terms, spots, odd) if self._max_chars else []

    def _spots(self, folded: str) -> _Spots:
        """The words that tell something, by their places."""
        if self._literals is not None:
            places = dict(place for literal in self._literals for place in _words_with(literal, folded))
            return [(start, end, told) for start, end in sorted(places.items()) if (told := self._words[folded[start:end]])]
        return [(*m.span(), told) for m in _WORDS.finditer(folded) if (told := self._words[m[0]])]

    def _searched(self, text: str, numbers: set[int]) -> set[int]:
        return {n for n in numbers if self._patterns[n].search(text)}

    def _look_around(self, text: str, folded: str, spots: _Spots, found: set[int]) -> None:
        """Add the terms that a word asks for and that match around it."""
        for start, end, told in spots:
            asked = told.around
            if told.open:
                pairs = _pairs(folded[max(0, start - told.reach) : start]) | _pairs(folded[end : end + told.reach])
                asked = [*asked, *(n for entry in told.open for pair in pairs.intersection(entry.others) for n in entry.others[pair])]
            for n in asked:
                if n in found:
                    continue
                facts = self._patterns.facts(n)
                if facts.within_word or facts.longest is None:
                    continue
                low, high = max(0, start - facts.longest), min(len(text), end + facts.longest)
                if facts.may_match(folded[low:high]) and self._patterns.inside(self._patterns[n], text, low, high):
                    found.add(n)

    def _close(self, text: str, folded: str, terms: list[int], spots: _Spots | None, odd: bool) -> list[list[int]]:
        cut = bisect_left(terms, self._size)
        first, second = terms[:cut], terms[cut:]
        if not first or not second:
            return [[] for _ in first]
        # Terms of which some match need not be near a word that names them are compared span by span.
        plain = set() if odd else {a for a in first if self._patterns.facts(a).longest is not None}.difference(self._always)
        words = (self._spots(folded) if spots is None else spots) if plain else []
        ends = [end for _, end, _ in words]
        near: dict[int, list[int]] = {a: [] for a in first}
        for b in second:
            swept = plain if self._patterns.facts(b).longest is not None else set()
            close = self._swept(text, b, swept, words, ends) if swept else set()
            at_b = self._patterns.spans(b, text) if len(swept) < len(first) else []
            close |= {a for a in first if a not in swept and self._patterns.near(a, b, text, self._patterns.spans(a, text), at_b)}
            for a in close:
                near[a].append(b)
        return [near[a] for a in first]

    def _swept(self, text: str, b: int, wanted: set[int], words: list[tuple[int, int, Told]], ends: list[int]) -> set[int]:
        """Those of the wanted terms that stand close to `b`: only words around a mention of `b` are looked at.

        A term whose place in a word is known, on one line with the mention, is close by its distance; others are
        left to the pair's pattern on the window that such a pair cannot leave.
        """
        close: set[int] = set()
        unsettled: dict[int, set[tuple[int, int]]] = {}
        gap, wide = self._max_chars, self._patterns.facts(b).longest
        reaches = {n: self._patterns.facts(n).longest for n in wanted}
        widest = 2 * max(reaches.values())
        for start, end in self._patterns.spans(b, text):
            first, last = start - gap, end + wide + gap
            for i in range(bisect_right(ends, first - widest), len(words)):
                at, to, told = words[i]
                if at >= last + widest:
                    break
                for n, low, high in told.spans:
                    if n in reaches and n not in close:
                        left, right = at + low, at + high
                        if (first <= right <= start and text.find("\n", right, start) < 0) or (end <= left <= end + gap and text.find("\n", end, left) < 0):
                            close.add(n)
                for entry in told.entries:
                    for n in wanted & entry.named:
                        reach = reaches[n]
                        if n not in close and to > first - 2 * reach and at < last + 2 * reach:
                            unsettled.setdefault(n, set()).add((max(0, first - reach), min(len(text), last + reach)))
        for n, windows in unsettled.items():
            if n not in close and any(self._patterns.inside(self._patterns.pair(n, b), text, low, high) for low, high in windows):
                close.add(n)
        return close


class Facts:
    """What is known of a pattern before any text."""

    def __init__(self, regex: str, unicode_case: bool) -> None:
        self.longest = longest_match(regex)
        if self.longest is not None and self.longest > _MAX_WIDTH:
            self.longest = None
        self.within_word = within_word(regex, unicode_case)
        # A match that lies in a word depends on nothing outside of it; boundaries are ASCII's in ASCII mode only.
        self.local = not (unicode_case and has_positions(regex))
        runs = letter_runs(regex)
        self._runs = runs if len(runs) <= _MAX_RUNS else [()]

    def may_match(self, folded: str) -> bool:
        for runs in self._runs:
            for run in runs:
                if run not in folded:
                    break
            else:
                return True
        return False

    def other_pairs(self, literal: str) -> set[str] | None:
        """Pairs of letters, not of `literal`, of which every match that holds it has one; None without such."""
        pairs = set()
        for runs in self._runs:
            pair = next((run[i : i + 2] for run in runs for i in range(len(run) - 1) if run[i : i + 2] not in literal), None)
            if pair is None:
                return None
            pairs.add(pair)
        return pairs


@cache
def _facts(regex: str, unicode_case: bool) -> Facts:
    return Facts(regex, unicode_case)


class Patterns(dict):
    """Compiled patterns by term number, and the test whether two terms stand close together."""

    def __init__(self, regexes: Sequence[str], unicode_case: bool, max_chars: int = 0) -> None:
        super().__init__()
        self._regexes, self._unicode, self._max_chars = regexes, unicode_case, max_chars
        self._pairs: dict[tuple[int, int], re.Pattern] = {}
        self._facts: dict[int, Facts] = {}

    def __missing__(self, number: int) -> re.Pattern:
        value = self[number] = python_pattern(self._regexes[number], self._unicode)
        return value

    def spans(self, number: int, text: str) -> list[tuple[int, int]]:
        """Mentions in order; every match of the pattern starts inside one of them."""
        return [m.span() for m in self[number].finditer(text)]

    def facts(self, number: int) -> Facts:
        if number not in self._facts:
            self._facts[number] = _facts(self._regexes[number], self._unicode)
        return self._facts[number]

    def near(self, a: int, b: int, text: str, at_a: list[tuple[int, int]], at_b: list[tuple[int, int]]) -> bool:
        """Both patterns on one line with at most `max_chars` characters between, in either order.

        Both lists of mentions are swept once: around each mention of `a` lies a window that a pair with it cannot
        leave, and the pair's pattern is tried where a mention of `b` touches this window.
        """
        wide_a, wide_b = self.facts(a).longest, self.facts(b).longest
        if wide_a is None or wide_b is None:
            return self.pair(a, b).search(text) is not None
        ends_b = [end for _, end in at_b]
        for start, end in at_a:
            low = max(0, start - self._max_chars - wide_b)
            high = min(len(text), end + wide_a + self._max_chars + wide_b)
            k = bisect_left(ends_b, low)
            if k < len(at_b) and at_b[k][0] <= high and self.inside(self.pair(a, b), text, low, high):
                return True
        return False

    def inside(self, pair: re.Pattern, text: str, low: int, high: int) -> bool:
        stop = min(len(text), high + 1)
        found = pair.search(text, low, stop)
        if found is None:
            return False
        # At the window's edge the text seems to end; there the whole text decides.
        return found.end() < stop or stop == len(text) or pair.search(text, low) is not None

    def pair(self, a: int, b: int) -> re.Pattern:
        if (a, b) not in self._pairs:
            self._pairs[a, b] = python_near_pattern(self._regexes[a], self._regexes[b], self._max_chars, self._unicode)
        return self._pairs[a, b]
