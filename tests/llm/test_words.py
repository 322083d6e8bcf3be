"""Operators on words against brute force: repeated sequences, periodic runs, collocations."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from mentiongrid.llm import collocations, substrings, wordruns
from mentiongrid.llm.wordhash import Runs, mixed, packed, unpacked

DOCS = "doc_id long, text string, lang string, source string"


def prose(n: int, seed: int, vocabulary: int = 4000) -> list[str]:
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (4 - len(r))) for r in rows], DOCS)


def test_run_hashes_tell_runs_apart():
    words = mixed(np.array([1, 2, 3, 1, 2, 3, 2, 1], np.uint64))
    h = Runs(words).hashes(np.array([0, 3, 1, 6]), np.array([2, 2, 2, 2]))
    assert h[0] == h[1] and len(set(h.tolist())) == 3
    assert len(set(Runs(words).hashes(np.zeros(9, int), np.arange(9)).tolist())) == 9


@pytest.mark.parametrize("width", [5, 8])
def test_packing_is_reversible(width):
    values = np.sort(np.random.default_rng(1).integers(0, 1 << 39, 1000).astype(np.uint64))
    assert (unpacked(packed(values, width), width) == values).all()
    assert len(unpacked(packed(values[:0], width), width)) == 0


# --- repeated word sequences -------------------------------------------------


def removed_by_brute_force(rows, window=13):
    first: dict[tuple, float] = {}
    for doc_id, text in rows:
        words = (text or "").encode().split()
        for i in range(len(words) - window + 1):
            key = tuple(words[i : i + window])
            first[key] = min(first.get(key, float("inf")), float("inf") if doc_id is None else doc_id)
    out = Counter()
    for doc_id, text in rows:
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            if first[tuple(words[i : i + window])] < (float("inf") if doc_id is None else doc_id):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        out[(doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest())] += 1
    return out


def sequence_rows():
    passage, long_one = prose(40, 1), prose(3000, 2)
    same = ["the"] * 200
    rows = [
        (1, " ".join([*prose(50, 3), *passage, *prose(20, 4)])), (2, "\t".join(passage)), (3, " \n".join([*passage[5:25], *prose(9, 5), *passage[10:23]])),
        (4, " ".join(long_one)), (5, " ".join(long_one)), (5, " ".join(long_one)), (6, " ".join([*long_one[:1500], "é", *long_one[1500:]])),
        (7, None), (8, ""), (9, "a few words"), (10, "a few words"), (None, " ".join(passage)), (None, " ".join([*passage, "x"])),
        (11, " ".join(same)), (12, " ".join(same[:30])), (-5, " ".join([*passage[:14]])), (13, " ".join(passage[:13])), (14, "\x0b".join(passage[1:13])),
        (2, " ".join([*passage[:20], "other", *prose(30, 6)])), (1 << 62, " ".join([*prose(14, 3)])),
    ]
    return rows + [(100 + i, " ".join([*prose(8, 50 + i), *passage[:20], *prose(8, 90 + i)])) for i in range(40)]


@pytest.mark.parametrize("chunk_bytes, group", [(1 << 20, 1 << 18), (2000, 1)])
def test_word_sequences_against_brute_force(spark, chunk_bytes, group):
    rows = sequence_rows()
    got = substrings.remove_repeats(frame(spark, rows), chunk_bytes=chunk_bytes, bucket_bytes=5000, group_suffixes=group)
    assert Counter(map(tuple, got.collect())) == removed_by_brute_force(rows)


def test_word_sequences_odd_tables(spark):
    assert substrings.remove_repeats(frame(spark, [(1, "x")]).where("doc_id > 1")).collect() == []
    clashing = frame(spark, [(1, "a b"), (2, None)]).withColumnsRenamed({"lang": "chunk", "source": "digest"})
    assert sorted(r["n_words"] for r in substrings.remove_repeats(clashing, with_text=True).collect()) == [0, 2]
    text = " ".join(prose(13, 1))
    kept = substrings.remove_repeats(frame(spark, [(1, text), (2, "new " + text + " end")]), with_text=True).collect()
    assert {r["doc_id"]: r["kept"] for r in kept} == {1: text, 2: "new end"}


@pytest.mark.parametrize("cut", [6, 3, 1])
def test_subtrees_keep_the_rightmost_path(cut):
    rows = [(0, 1, 1, 1, 3), (0, 1, 1, 1, 5), (0, 1, 1, 2, 1), (0, 1, 2, 2, 2), (0, 2, 2, 2, 9), (0, 2, 2, 2, 11), (1, 2, 2, 2, 12)]
    trees, found = substrings.Subtrees(), []
    for k in range(0, len(rows), cut):
        columns = [np.array(c) for c in zip(*rows[k : k + cut], strict=True)]
        found += zip(*(x.tolist() for x in trees.add(columns[:4], columns[4])), strict=True)
    assert found == [(0, 3), (13, 3), (5, 1), (1, 2), (0, 9), (13, 9), (0, 12)]


def test_texts_move_once(spark):
    found = substrings.remove_repeats(frame(spark, sequence_rows()))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 2


# --- periodic runs -----------------------------------------------------------


def runs_by_brute_force(words):
    n, out = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                run = words[i : i + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def looping(rng, size):
    words = [rng.randrange(rng.randint(1, 5)) for _ in range(size)]
    for _ in range(rng.randint(0, 3)):
        at, block = rng.randint(0, size), [rng.randrange(4) for _ in range(rng.randint(1, 20))]
        for i in range(at, min(size, at + rng.randint(1, 100))):
            words[i] = block[(i - at) % len(block)]
    return words


def test_runs_against_brute_force():
    rng = random.Random(5)
    for _ in range(200):
        texts = [looping(rng, rng.randint(0, 150)) for _ in range(rng.randint(1, 4))]
        assert wordruns.runs_of([np.array(t, np.int64) for t in texts]) == [runs_by_brute_force(t) for t in texts]


def test_long_loops_take_no_quadratic_time():
    assert wordruns.lag_scan(np.zeros(200_000, np.int64)) == [(0, 200_000, 1)]
    block = np.random.default_rng(0).integers(0, 300, 1000)
    assert wordruns.lag_scan(np.tile(block, 100)) == [(0, 100_000, 1000)]


def described_by_brute_force(doc_id, text):
    words = (text or "").split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = runs_by_brute_force(words)
    drop = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()
    kept = " ".join(w for i, w in enumerate(words) if i not in drop).encode()
    row = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(runs), *row, hashlib.sha256(listed).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_periodic_runs_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(f"w{w}" for w in looping(rng, rng.randint(0, 120)))) for i in range(120)]
    rows += [(500, None), (501, ""), (None, "x " * 40), (502, "é à " * 12), (502, "é à " * 12), (503, "a b\n" * 7 + "c")]
    got = wordruns.periodic_runs(frame(spark, rows), loops=True)
    assert Counter(map(tuple, got.collect())) == Counter(described_by_brute_force(*r) for r in rows)
    empty = frame(spark, [(1, "x")]).where("doc_id > 1")
    assert wordruns.periodic_runs(empty).collect() == []


def test_periodic_runs_give_spans_and_texts(spark):
    row = wordruns.periodic_runs(frame(spark, [(1, "a b " + "x y z " * 9 + "end")]), details=True).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(2, 27, 3)] and row["collapsed"] == "a b x y z end"


# --- collocations ------------------------------------------------------------


def collocation_rows():
    rng = random.Random(3)
    names = ["New York city", "new york City hall", "of the", "the the the", "alpha beta gamma delta", "x"]
    rows = []
    for i in range(300):
        words = [rng.choice([*names, "lone", f"w{rng.randrange(900)}", "the", "of"]) + rng.choice([" ", " ", "\t", ". ", ",", "\n"]) for _ in range(60)]
        rows.append((i, "".join(words), rng.choice(["en", "en", "fr", None, "und"])))
    return [*rows, (300, None, "en"), (301, "", "en"), (302, "only once here", "de"), (303, "é b " * 60, "es"), (303, "é b " * 60, "es")]


@pytest.mark.parametrize("least", [100, 30])
def test_collocations_against_sql(spark, least):
    rows = [(*r, None) for r in collocation_rows()]
    docs = spark.createDataFrame(rows, DOCS)
    con = duckdb.connect()
    documents = pa.table({"doc_id": [r[0] for r in rows], "text": [r[1] for r in rows], "lang": [r[2] for r in rows]})
    con.register("documents", documents)
    want = con.sql(collocations._SQL.replace("count(*) >= 100", f"count(*) >= {least}"))
    columns, want = want.columns, Counter(want.fetchall())
    got = collocations.collocations(docs, least).select(*columns)
    assert Counter(map(tuple, got.collect())) == want and want


def test_collocations_odd_tables(spark):
    docs = spark.createDataFrame([(1, "a b", "en", "s")], DOCS)
    assert collocations.collocations(docs).collect() == []
    assert collocations.collocations(docs.where("doc_id > 1")).collect() == []
    clashing = docs.withColumnsRenamed({"doc_id": "head", "source": "phrase"})
    assert len(collocations.collocations(clashing, least=1).collect()) == 1


def test_stripes_merge_totals():
    stripes = collocations.Stripes()
    stripes.merge([b"a b ", b"a b c ", b"a c "], [2, 3, 5])
    stripes.merge([b"a b d ", b"a b c d "], [1, 4])
    assert stripes.totals() == {b"a b ": 10, b"a b c ": 7, b"a b d ": 1, b"a b c d ": 4, b"a c ": 5}


def test_words_of_decontamination_are_cut_and_coded_as_defined():
    from mentiongrid.llm import decontam

    rng = random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("ab.7\x1d\x85\xa0  \t\n\x0b\x0c\r") for _ in range(rng.randint(0, 12)))
        assert decontam._words(text) == re.findall(r"[^\x20\x09-\x0D]+", text)
    code = decontam._code
    assert code("...") == 0 and code("%") & decontam._IS_UNIT and code("Berlin") & decontam._CAPITAL and not code("berlin,") & decontam._CAPITAL
    assert code("12") & decontam._IS_NUMBER and code("(5%") & decontam._WITH_UNIT and code('end."') & decontam._ENDS and code("km,") & decontam._IS_UNIT
    assert code("Word,") >> decontam._SHIFT == code("word") >> decontam._SHIFT


def test_a_hash_outside_the_benchmark_rarely_passes_both_flags():
    from mentiongrid.llm import decontam

    rng = np.random.default_rng(3)
    known, others = (rng.integers(-(1 << 63), 1 << 63, n, np.int64) for n in (15_000, 1_000_000))
    bits = np.zeros(1 << 22, bool)
    for factor in (decontam._FIRST, decontam._SECOND):
        bits[decontam._bit(known, len(bits), factor)] = True
    passed = [(bits[decontam._bit(keys, len(bits))] & bits[decontam._bit(keys, len(bits), decontam._SECOND)]) for keys in (known, others)]
    assert passed[0].all() and passed[1].sum() < 300
