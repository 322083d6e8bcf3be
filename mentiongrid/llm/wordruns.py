r"""Periodic runs of words: stretches that repeat a block at least three times over at least 24 words.

1. *Recursive frequency splitting.* A word of a run occurs at least floor(length / period) >= `COPIES` times in it. So a
   word with fewer occurrences in a segment lies in no run and splits the segment; the parts are judged by
   themselves again, until nothing changes. Parts shorter than `SHORTEST` fall away. All texts of a slice are
   split in common passes over one array of word numbers.
2. *Lag scan* of the segments that are left. A run of period q repeats itself q words apart for at least
   max(2q, SHORTEST - q) words, so among the places 0, g, 2g, ... (g = max(q, `PROBE`)) one begins `PROBE` words that are
   the same q words later. Only these places are compared for each lag, m / q of them, and grow to both sides.
   Inside a run whose period divides q, nothing else has the smallest period q, so those places are left out.

Defined results: a null text has no words and no run. A null doc_id changes no word in the query's planted loops.
Every row counts by itself, whatever its doc_id. A long text is cut into words by the megabyte and held as numbers; only
its distinct words are objects.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from mentiongrid.llm.common import annotate, table
from mentiongrid.llm.wordhash import Runs, WordNumbers, mixed, numbered

COPIES, SHORTEST, PROBE = 3, 24, 8
_SLICE = 400_000


def segments(words: np.ndarray, first: np.ndarray) -> list[tuple[int, int]]:
    """Parts (start, end) of the texts that begin at `first` in which every word occurs `COPIES` times."""
    place = np.arange(len(words))
    part = np.searchsorted(first, place, side="right").astype(np.int64)
    while len(place):
        _, inverse, counts = np.unique(part * (words.max() + 1) + words[place], return_inverse=True, return_counts=True)
        often = counts[inverse] >= COPIES
        place, part = place[often], part[often]
        if not len(place):
            break
        new = np.concatenate([[True], (np.diff(place) > 1) | (np.diff(part) > 0)])
        fresh = np.cumsum(new) - 1
        long_enough = (np.bincount(fresh) >= SHORTEST)[fresh]
        if often.all() and long_enough.all():
            return list(zip(place[new].tolist(), (place[np.append(new[1:], True)] + 1).tolist(), strict=True))
        place, part = place[long_enough], fresh[long_enough]
    return []


def _grown(words: np.ndarray, at: int, lag: int) -> tuple[int, int]:
    """The longest stretch around `at` in which words agree with those `lag` later."""
    start, end, step = at, at, 64
    last = len(words) - lag
    while end < last:
        stop = min(last, end + step)
        differ = np.flatnonzero(words[end:stop] != words[end + lag : stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, step = stop, 2 * step
    step = 64
    while start > 0:
        stop = max(0, start - step)
        differ = np.flatnonzero(words[stop:start] != words[stop + lag : start + lag])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, step = stop, 2 * step
    return start, end


def lag_scan(words: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a segment, ordered by start, then period."""
    found: list[tuple[int, int, int]] = []
    probes = Runs(mixed(words.astype(np.uint64) + np.uint64(1))).hashes(np.arange(len(words) - PROBE + 1), PROBE)
    covered: dict[int, list[tuple[int, int]]] = {}  # by lag: runs whose period divides it
    for lag in range(1, len(words) // COPIES + 1):
        step = max(lag, PROBE)
        last = len(probes) - lag
        alike = np.flatnonzero(probes[:last:step] == probes[lag : lag + last : step]) * step
        for start, end in covered.pop(lag, ()):
            alike = alike[(alike < start) | (alike + lag > end)]
        reached = -1
        for at in alike.tolist():
            if at <= reached:
                continue
            start, reached = _grown(words, at, lag)
            length = reached - start + lag
            if length >= max(SHORTEST, COPIES * lag):
                found.append((start, length, lag))
                for multiple in range(2 * lag, min(length, len(words) // COPIES) + 1, lag):
                    covered.setdefault(multiple, []).append((start, start + length))
    return sorted((s, n, q) for s, n, q in found)


def runs_of(texts: Iterable[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The runs of each of several texts of word numbers: (start, length, period) by start, then period."""
    texts = list(texts)
    ends = np.cumsum([len(t) for t in texts])
    found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    words = np.concatenate([*texts, np.zeros(0, np.int64)])
    first = ends - [len(t) for t in texts]
    for start, end in segments(words, first):
        text = int(np.searchsorted(ends, start, side="right"))
        offset = start - int(first[text])
        found[text] += [(offset + s, n, q) for s, n, q in lag_scan(words[start:end])]
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def with_loop(words: np.ndarray, seed: int | None) -> np.ndarray:
    """The words of a text; every tenth text by `seed` ends in a loop of its own words."""
    n = len(words)
    if seed is None or seed % 10 or not n:
        return words
    g = seed // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return words[np.where(i < a, i, a + (i - a) % period)]


def _sha256_of_words(words: list[bytes], chosen: np.ndarray) -> str:
    digest = hashlib.sha256()
    for k in range(0, len(chosen), 1 << 16):
        digest.update(b" " * (k > 0) + b" ".join([words[i] for i in chosen[k : k + (1 << 16)].tolist()]))
    return digest.hexdigest()


def _described(words: np.ndarray, known: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    drop = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        drop[start + period] += 1
        drop[start + length] -= 1
    kept = words[np.cumsum(drop)[:-1] == 0]
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    best: tuple = (None,) * 4
    for start, length, period in runs:  # by start, then period: the first of equals stays
        if best[0] is None or length * best[2] > best[1] * period:
            best = (start, length, period, 1000 * length // period)
    return (len(runs), *best, hashlib.sha256(listed.encode()).hexdigest(), _sha256_of_words(known, kept))


_RESULT = (
    "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
)
_DETAILS = ", runs array<struct<start: long, length: long, period: long>>, collapsed string"


def periodic_runs(documents: DataFrame, loops: bool = False, details: bool = False) -> DataFrame:
    """doc_id, the number of runs, the one of greatest length / period, and digests, per row of (doc_id, text).

    `details` adds all runs and the text without what they repeat; `loops` plants a loop in every tenth text.
    """

    def work(ids: Iterator, texts: Iterator) -> Iterator[tuple]:
        known, held, size = WordNumbers(), [], 0
        for doc_id, text in zip(ids, texts, strict=True):
            words = numbered((text or "").encode("utf-8", "surrogatepass"), known)
            seed = zlib.crc32(str(doc_id).encode()) if loops and doc_id is not None else None
            held.append(with_loop(words, seed))
            size += len(words)
            if size > _SLICE:
                yield from results(held, known.words)
                known, held, size = WordNumbers(), [], 0
        yield from results(held, known.words)

    def results(held: list[np.ndarray], known: list[bytes]) -> Iterator[tuple]:
        for words, runs in zip(held, runs_of(held), strict=True):
            row = _described(words, known, runs)
            if details:
                drop = np.zeros(len(words), bool)
                for s, n, q in runs:
                    drop[s + q : s + n] = True
                text = b" ".join([known[i] for i in words[~drop].tolist()]).decode("utf-8", "surrogatepass")
                row += ([{"start": s, "length": n, "period": q} for s, n, q in runs], text)
            yield row

    found = annotate(documents.select("doc_id", "text"), ["doc_id"], ["doc_id", "text"], work, _RESULT + (_DETAILS if details else ""))
    return found.select("row.*", *found.columns[1:])


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(table(spark, sf_dir, "documents"), loops=True)


QUERIES = {"op12_periodic_runs": op12_periodic_runs}
SQL: dict[str, str] = {}
