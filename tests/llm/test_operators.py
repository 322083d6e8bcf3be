"""Operators against brute force, and the edge cases their docstrings define."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from mentiongrid.llm import decontam, langid, mixing, neardup, passages, quality, secrets, toxicity, urlfilter, warc
from mentiongrid.llm.suffixes import least_owner, suffix_array
from mentiongrid.llm.trigrams import required_trigrams

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string"


def lines(n: int, seed: int, words: int = 12) -> str:
    """Invented words, different for each seed."""
    parts = ["ba", "ko", "li", "tu", "mer", "san", "dra", "vo"]
    state, out = seed * 7919 + 13, []
    for i in range(n * words):
        state = (state * 1103515245 + 12345) % (1 << 31)
        word = parts[(state >> 8) % 8] + parts[(state >> 12) % 8] + parts[(state >> 16) % 8]
        out.append(word + (".\n" if i % words == words - 1 else ""))
    return " ".join(out)


def documents(spark, texts, **more):
    rows = [(i, t, more.get("lang"), f"s{i % 3}") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


# --- suffix arrays -----------------------------------------------------------


@pytest.mark.parametrize("text", ["", "a", "aaaa", "abab", "abcabcab", "banana", "mississippi", "zyx", "ababaabab" * 3])
def test_suffix_array_is_the_sorted_order(text):
    symbols = [ord(c) for c in text] + [0]
    assert suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_least_owner_of_windows():
    strings, owners = [b"abcdef", b"xbcdex", b"zzz", b""], [5, 2, 1, 0]
    assert least_owner(strings, owners, 4) == [[5, 2, 5], [2, 2, 2], [], []]


# --- repeated passages -------------------------------------------------------


def removed_by_brute_force(rows, length=50):
    first: dict[bytes, int] = {}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0]))
    rank = lambda d: (d is None, d if d is not None else 0)
    out = Counter()
    for doc_id, text in order:
        data = (text or "").encode()
        marks = bytearray(len(data))
        for i in range(len(data) - length + 1):
            window = data[i : i + length]
            if window in first and rank(first[window]) < rank(doc_id):
                marks[i : i + length] = b"\1" * length
            first.setdefault(window, doc_id)
        spans = len(re.findall(b"\1+", bytes(marks)))
        kept = bytes(c for c, m in zip(data, marks, strict=True) if not m)
        out[(doc_id, len(data), sum(marks), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("hot", [passages.HOT, 2])
def test_passages_against_brute_force(spark, hot):
    shared, long_one = lines(2, 1), lines(8, 2)
    rows = [
        (1, lines(3, 3) + shared + lines(2, 4)),
        (2, shared),
        (3, lines(1, 5) + shared[:60] + lines(1, 6) + shared[30:95]),
        (4, long_one), (5, long_one), (5, long_one), (6, long_one[:200] + "é" + long_one[200:]),
        (7, None), (8, ""), (9, "short"), (10, "short"), (None, shared), (None, shared + "x"),
        (11, "ab" * 200), (12, "ab" * 60 + lines(1, 7)), (13, long_one[:49]), (14, long_one[:50]),
        (2, lines(2, 8)), (15, lines(2, 8)), *((20 + k, lines(1, 30 + k) + shared) for k in range(8)),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = Counter(tuple(r) for r in passages.remove_repeats(df, hot=hot).collect())
    assert got == removed_by_brute_force(rows)
    kept = passages.remove_repeats(df, hot=hot, with_bytes=True).collect()
    assert all(hashlib.sha256(r["kept"]).hexdigest() == r["kept_sha256"] for r in kept)


def test_passages_of_an_empty_table(spark):
    assert passages.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


# --- near duplicates ---------------------------------------------------------


def shingles(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def components_by_brute_force(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 75 * len(sets[i] | sets[j]):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = Counter()
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        least = (min(ids) if ids else None) if sets[i] else doc_id
        out[(doc_id, len(sets[i]), least, least == doc_id)] += 1
    return out


def variants(text, n):
    """Copies that differ from `text` in one to n words."""
    words = text.split()
    for k in range(n):
        changed = list(words)
        for j in range(k % 6 + 1):
            changed[(k * 17 + j * 23) % len(words)] = f"new{k}x{j}"
        yield " ".join(changed)


@pytest.mark.parametrize("chunk", [neardup._CHUNK, 4])
def test_near_duplicates_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(neardup, "_CHUNK", chunk)
    base = lines(10, 50)
    rows = [(100 + i, t) for i, t in enumerate(variants(base, 40))]
    rows += [(50, base), (51, base.upper()), (51, base), (None, base + " end"), (None, lines(4, 51)), (None, lines(4, 51))]
    rows += [(1, None), (2, ""), (3, " \n\t"), (4, "one two"), (5, "ONE  two"), (6, "two one"), (7, lines(4, 52)), (8, lines(4, 53))]
    got = Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"], r["kept"])
        for r in neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    )
    assert got == components_by_brute_force(rows)


def test_near_duplicates_of_an_empty_table(spark):
    assert neardup.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_odd_sketch_estimates_similarity():
    import numpy as np

    a = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 400, dtype=np.uint64))
    b = np.concatenate([a[:350], np.random.default_rng(2).integers(0, 1 << 63, 50, dtype=np.uint64)])
    true = len(set(a.tolist()) & set(b.tolist())) / len(set(a.tolist()) | set(b.tolist()))
    sa, sb = (neardup.odd_sketch(neardup.samples_of(np.unique(x))) for x in (a, b))
    differ = int(np.bitwise_count((sa ^ sb).view(np.uint64)).sum())
    assert neardup.most_bits(true + 0.1) < differ < neardup.most_bits(true - 0.1)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(bytes([i]), bytes([i + 1])) for i in range(40)] + [(bytes([90]), bytes([80]))], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["root"]) for r in neardup.components(links).collect()}
    assert {got[bytes([i])] for i in range(41)} == {bytes([0])} and got[bytes([90])] == bytes([80])


# --- secrets -----------------------------------------------------------------


def test_required_trigrams():
    assert required_trigrams("abc") == [frozenset({"abc"})]
    assert required_trigrams("AKIA[A-Z0-9]+") == [frozenset({"aki", "kia"})]
    assert required_trigrams("[0-9a-f]+") is None and required_trigrams("(abc|.*)") is None
    assert {frozenset({"abc"}), frozenset({"xyz"})} == set(required_trigrams("(?:abc|xyz)d?"))
    assert required_trigrams("a[bB]{2}c+") == [frozenset({"abb", "bbc"})]
    for bad in ("(abc", "a)", "*a", "(?i:a)", "[a", r"\pL"):
        with pytest.raises(ValueError):
            required_trigrams(bad)


SECRETS = [
    None, "", "no secret", 'password = "abcdef1" Token:short TOKEN:longer-than-six', "PassWD=' x api_key=abcdefgh apikey: 'zzzzzzz'",
    "AKIA" + "A1" * 8, "AKIA" + "A1" * 7, "é" * 5 + "deadbeef" * 3 + " AKIAAKIA" + "Z" * 16, "deadbeef" * 2, "ſecret=abcdefg toKen=abcdefg",
    "secret secret=:abc secret: secret=abcdefgh", "password=" + "a1" * 15, "x" * 50_000 + " token=abcdefgh", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----",
]


def base_spans(text):
    """The contract's three patterns, written once more."""
    text, found = text or "", []
    assign = re.compile(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found += [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(found)]


def test_secrets_against_plain_scans(spark):
    rows = [(i, t) for i, t in enumerate(SECRETS)] + [(3, SECRETS[3]), (None, SECRETS[3]), (3, "password: other-one")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    base = F.filter("spans", lambda s: s["kind"] < 3)
    got = Counter((r["doc_id"], r["s"]) for r in secrets.scan(df).select("doc_id", secrets._written(base, secrets.RULES).alias("s")).collect())
    assert got == Counter((d, ",".join(base_spans(t))) for d, t in rows)


def test_redaction_keeps_columns_and_other_rows(spark):
    rows = [(i, t, "x", len(t or "")) for i, t in enumerate(SECRETS)] + [(3, SECRETS[3], "again", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = secrets.redact(df).collect()
    assert len(got) == len(rows) and got[0].__fields__ == ["doc_id", "text", "spans", "n_chars"]
    for r in got:
        assert not base_spans(r["text"])
        if not base_spans(SECRETS[r["doc_id"]]) and r["doc_id"] < 13:
            assert r["text"] == SECRETS[r["doc_id"]]
    assert secrets.redact(df.limit(0)).count() == 0


# --- language ----------------------------------------------------------------


def test_language_id_on_held_out_rows(spark):
    english, german = "the house and that other thing there with", "der hund und die katze auf einem schönen stuhl"
    rows = []
    for i in range(120):
        words = (english if i % 2 else german).split()
        rows.append((i, " ".join(words[(i * 5 + k * 3) % len(words)] for k in range(9)), "en" if i % 2 else "de"))
    rows += [(200, None, "en"), (201, "", "de"), (202, "123 !?", "en"), (203, "house", None), (None, "katze und hund", "de")]
    df = langid.with_fold(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    model = langid.fit(df.where("not held_out"), buckets=1024)
    got = {(r["row"]["doc_id"], r["lang_pred"], r["row"]["lang"]) for r in langid.identify(df, model, ("doc_id", "lang")).collect()}
    assert all(p == lang for d, p, lang in got if d is not None and d < 200)
    assert {(d, p) for d, p, _ in got if d in (200, 201, 202)} == {(d, "und") for d in (200, 201, 202)}
    again = langid.fit(df.where("not held_out"), buckets=1024)
    assert (again.weights == model.weights).all()


def test_language_id_without_teachers(spark):
    df = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    got = langid.identify(df, langid.fit(df)).first()
    assert got["lang_pred"] == "und" and got["score"] == 0
    one = spark.createDataFrame([(1, "some text", "en")], "doc_id long, text string, lang string")
    assert langid.identify(one, langid.fit(one)).first()["lang_pred"] == "en"


def test_features_do_not_depend_on_chunks(monkeypatch):
    text = "Ärger mit dem Straßenverkehr, 12 Mal am Tag! " * 40
    whole = langid.features(text, 512)
    monkeypatch.setattr(langid, "_CHUNK", 37)
    assert abs(langid.features(text, 512) - whole).max() < 1e-12


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 12):
        codes = langid.codewords(n)
        assert codes.shape[0] == n and langid._distance(codes) >= 1


def test_redaction_of_whole_keys(spark):
    body = "\n".join("MIIEpAIBAAKCAQEA" + "Qx7Zk/+9" * 6 for _ in range(5)) + "\nwK2q=="
    begin, end = "-----BEGIN RSA PRIVATE KEY-----", "-----END RSA PRIVATE KEY-----"
    jwt = "eyJ" + "h" * 20 + ".eyJ" + "p" * 20 + "."
    texts = [
        f"a {begin}\n{body}\n{end} z", f"a {begin}\nProc-Type: 4,ENCRYPTED\nDEK-Info: AES,0A\n\n{body}\n{end} z", f"a {begin}\n{body}\n",
        (f"a {begin}\n{body}\n{end} z").replace("\n", "\\n"), f"a {begin}\n{body}\n\n{begin}\n{body}\n{end} z", f"a {jwt}Sig-nature_1234 z", f"{begin} is how a key starts.",
    ]
    got = dict(secrets.redact(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [got[i] for i in (0, 1, 3, 5, 6)] == ["a [secret] z"] * 4 + ["[secret] is how a key starts."]
    assert all(part not in got[i] for i in got for part in ("Qx7Zk", "wK2q", "Sig-", "PRIVATE", "MIIE"))
    assert got[2].startswith("a [secret]") and got[4].startswith("a [secret]") and got[4].endswith(" z")


# --- decontamination ---------------------------------------------------------


def test_decontamination(spark):
    item = "If Anna buys 12 apples for 3 dollars each then how many coins will she have left over from 90 coins in the end"
    other = "Water boils at a lower temperature on high mountains because the pressure of the air up there is much smaller"
    docs = [
        (1, f"Some words before. {item} and words after it."),
        (2, "Well, " + item.replace("Anna", "Berta").replace("12", "17").replace("90", "100") + " indeed"),
        (3, lines(5, 70)), (4, None), (5, ""), (6, other.upper() + "!"), (7, " ".join(item.split()[:9])),
        (8, "x y z the quick fox jumps"), (None, item), (1, f"Some words before. {item} and words after it."),
    ]
    bench = [(0, item), (1, other), (2, item), (3, None), (4, "the quick fox jumps"), (5, "12 34 56")]
    got = decontam.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")
    ).collect()
    found = {(r["doc_id"], r["item_id"], r["exact"]) for r in got}
    assert found == {(1, 0, True), (2, 0, False), (6, 1, True), (8, 4, True), (None, 0, True)} and len(got) == len(found)


def test_decontamination_refuses_inconsistent_slots(spark):
    item = "take 5 red and 5 blue balls and then add 5 more to the 5 others which stand near the old gate"
    same, mixed = item.replace("5", "8"), item.replace("5 red", "8 red").replace("5 blue", "9 blue").replace("add 5", "add 7")
    got = decontam.contaminated(
        spark.createDataFrame([(1, same), (2, mixed)], "doc_id long, text string"), spark.createDataFrame([(0, item)], "item_id long, text string")
    ).collect()
    assert {(r["doc_id"], r["exact"]) for r in got} == {(1, False)}


def test_decontamination_of_empty_tables(spark):
    docs, bench = spark.createDataFrame([(1, "a b c")], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert decontam.contaminated(docs, bench).count() == 0
    assert decontam.remove_contaminated(docs.withColumn("item_id", F.lit(1)), bench).columns == ["doc_id", "text", "item_id"]


def test_decontamination_judges_texts_of_one_id_apart(spark):
    item = "which of the seven small rivers of the northern valley carries the most water in a dry late summer"
    half, rest = " ".join(item.split()[:12]), " ".join(item.split()[7:])
    rows = [(None, "so " + item), (None, lines(2, 80)), (None, None), (1, item), (1, lines(2, 81)), (1, item), (2, half), (2, rest), (3, half), (3, half)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame([(0, item)], "item_id long, text string")
    got = decontam.remove_contaminated(docs, bench).collect()
    assert Counter(map(tuple, got)) == Counter(r for r in rows if item not in (r[1] or ""))


def found_by(spark, items, texts):
    """(text number, item number, exact) of contaminated texts."""
    docs, bench = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"], r["exact"]) for r in decontam.contaminated(docs, bench).collect()}


def test_decontamination_of_items_full_of_numbers(spark):
    sums = "Add 4 5 6 7 8 9 to 1 2 3 4 5 6 and divide 7 8 9 1 2 3 by 5 6 7 8 9 1"
    numbers = " ".join(str(k * k) for k in range(3, 20))
    items = ["Compute 12 + 35 + 48", sums, "12 34 56", numbers, "Ask Anna 12 34 Berta 56 78 Carla 91 23 Dora 45"]
    texts = [
        f"{lines(1, 85)} please compute 12 + 35 + 48 {lines(1, 86)}", "So. Compute 7 + 8 + 9 now", "see " + sums + " now", "see " + sums.replace("9", "77"),
        "it is 12 34 56 here", "it is 12 34 57 here", f"list {numbers} end", f"list {numbers.replace('25', '26')[:30]} end",
        "ask anna 12 34 berta 56 78 carla 91 23 dora 45", "Ask Emma 11 34 Frida 56 78 Gerda 91 23 Hanna 45", lines(3, 87), "add 4 5 6 7 8 9",
    ]
    assert found_by(spark, items, texts) == {
        (0, 0, True), (1, 0, False), (2, 1, True), (3, 1, False), (4, 2, True), (6, 3, True), (8, 4, True), (9, 4, False),
    }


def test_decontamination_in_any_case(spark):
    plain = "Water boils at a lower temperature on high mountains because the pressure of the air up there is much smaller"
    named = "Every morning Anna walks to Berta and brings her fresh bread while Carla and Dora wait at the old gate"
    texts = [
        lines(3, 95) + plain.title() + ". " + lines(3, 96), lines(3, 97) + plain.upper() + ". " + lines(3, 98),
        lines(3, 99).upper() + named + ". " + lines(3, 100).upper(), lines(2, 101) + named.lower(), lines(3, 102) + named.upper() + ". " + lines(3, 103),
        lines(3, 104).upper() + named.replace("Anna", "Emma").replace("Dora", "Hanna") + ". " + lines(3, 105).upper(),
    ]
    found = found_by(spark, [plain, named], texts)
    assert found == {(0, 0, True), (1, 0, True), (2, 1, True), (3, 1, True), (4, 1, True), (5, 1, False)}
    assert found_by(spark, [plain.title(), named.upper()], texts[:5]) == {(0, 0, True), (1, 0, True), (2, 1, True), (3, 1, True), (4, 1, True)}


# --- archive -----------------------------------------------------------------


def test_archive_round_trip(spark, tmp_path):
    big = "ü" * 80
    rows = [
        (3, "http://a/3", big), (1, "http://a/1", big), (1, "http://b/1", big), (1, "http://a/1", big), (2, None, big), (None, "http://n", big),
        (4, "http://a/4", "tiny"), (5, "http://a/5", "tiny"), (6, "http://a/6", None), (7, "http://a\r\nX: y/7", ""), (8, "u", "z" * 100),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archive(pages, str(tmp_path / "archive"))
    stored = spark.read.parquet(str(tmp_path / "archive/payloads"))
    assert stored.count() == stored.select("digest").distinct().count() == 4
    records = warc.record_bytes(warc.read_archive(spark, str(tmp_path / "archive"))).collect()
    assert len(records) == len(rows) and all(r["verified"] for r in records)
    kinds = Counter((r["page_id"], r["record_type"], r["refers_to"]) for r in records)
    assert kinds[(1, "response", None)] == 1 and kinds[(1, "revisit", 1)] == 2 and kinds[(3, "revisit", 1)] == kinds[(None, "revisit", 1)] == 1
    assert all(kinds[(k, "response", None)] == 1 for k in (4, 5, 6, 7, 8))
    assert Counter(r["payload"] for r in records) == Counter((h or "").encode() for _, _, h in rows)
    for r in records:
        head, body = bytes(r["record"]).split(b"\r\n\r\n", 1)
        size = int(re.search(rb"Content-Length: (\d+)", head)[1])
        assert body == (b"" if r["record_type"] == "revisit" else bytes(r["payload"])) + b"\r\n\r\n" and size == len(body) - 4
        assert head.startswith(b"WARC/1.1\r\n") and head.count(b"WARC-Record-ID") == 1


def test_archive_notices_damage(spark, tmp_path):
    warc.write_archive(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"), str(tmp_path / "a"))
    spark.read.parquet(str(tmp_path / "a/payloads")).withColumn("payload", F.lit(b"abd")).write.parquet(str(tmp_path / "b/payloads"))
    spark.read.parquet(str(tmp_path / "a/headers")).write.parquet(str(tmp_path / "b/headers"))
    assert warc.read_archive(spark, str(tmp_path / "b")).first()["verified"] is False


# --- URL lists ---------------------------------------------------------------


def test_url_filter_as_of(spark):
    entries = [
        ("example.org", "adult", "add", "2020-01-10"), ("example.org", "adult", "remove", "2020-06-01"), ("example.org", "adult", "add", "2021-01-01"),
        ("good.example.org", "allow", "add", "2020-02-01"), ("example.org/a/b", "spam", "add", "2020-01-01"),
        ("day.net", "adult", "remove", "2020-03-01"), ("day.net", "adult", "add", "2020-03-01"), (None, "adult", "add", "2020-01-01"), ("x.net", "adult", "add", None),
    ]
    log = spark.createDataFrame(entries, "pattern string, category string, action string, since string").withColumn("since", F.col("since").cast("date"))
    captures = [
        (1, "http://example.org/", "2020-01-09"), (2, "https://WWW.Example.org:80/x", "2020-01-10"), (3, "http://example.org/", "2020-05-31"),
        (4, "http://example.org/", "2020-06-01"), (5, "http://example.org/", "2022-01-01"), (6, "http://good.example.org/", "2020-03-01"),
        (7, "http://example.org/a/b/c?x=/q", "2020-01-05"), (8, "http://example.org/a/bc", "2020-01-05"), (9, "http://day.net", "2020-03-01"),
        (10, None, "2020-03-01"), (11, "http://day.net", None), (12, "not a url", "2020-03-01"), (3, "http://example.org/", "2020-05-31"),
        (None, "http://u@day.net/", "2020-03-02"), (13, "http://notexample.org/", "2020-05-01"),
    ]
    df = spark.createDataFrame(captures, "capture_id long, url string, fetched string").withColumn("fetched", F.col("fetched").cast("date"))
    got = Counter((r["capture_id"], r["blocked"], r["category"]) for r in urlfilter.evaluate(df, urlfilter.intervals(log), period_days=30).collect())
    assert got == Counter({
        (1, False, None): 1, (2, True, "adult"): 1, (3, True, "adult"): 2, (4, False, None): 1, (5, True, "adult"): 1, (6, False, "allow"): 1,
        (7, True, "spam"): 1, (8, False, None): 1, (9, True, "adult"): 1, (10, False, None): 1, (11, False, None): 1, (12, False, None): 1,
        (None, True, "adult"): 1, (13, False, None): 1,
    })
    assert urlfilter.evaluate(df.limit(0), urlfilter.intervals(log)).count() == 0
    assert urlfilter.evaluate(df, urlfilter.intervals(log.limit(0))).where("blocked").count() == 0


# --- mixing ------------------------------------------------------------------


def targets_by_hand(sizes, repeats=3):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, rest, open_ = {}, float(sum(sizes.values())), set(order)
    while True:
        level = rest / sum(weight[s] for s in open_) if open_ else 0
        over = {s for s in open_ if weight[s] * level > repeats * sizes[s]}
        if not over:
            return target | {s: weight[s] * level for s in open_}
        for s in over:
            target[s] = repeats * sizes[s]
            rest -= target[s]
        open_ -= over


def test_mix_meets_targets_and_bounds(spark):
    rows = [(i, "w " * (5 + i % 40), f"s{i % 7}" if i % 9 else None) for i in range(900)]
    rows += [(1000 + i, "w " * 10, "tiny") for i in range(3)] + [(1, None, "s1"), (2, "", "s1"), (3, None, "empty"), (None, "a b c", "s2"), (4, "w " * 20_000, "s3")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    slots, per_document = mixing.mix(df, block_words=16, shard_slots=64)
    got = per_document.collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    wanted = targets_by_hand(dict(sizes))
    taken = Counter()
    for r in got:
        assert r["taken"] <= 3 * r["size"] and r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - wanted[s]) <= 16 + 0.02 * wanted[s] for s in wanted)
    per_shard = Counter(r["shard"] for r in slots.select("shard").collect())
    assert all(n == 64 for shard, n in per_shard.items() if shard < max(per_shard))
    again = mixing.mix(df, block_words=16, shard_slots=64)[1].collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, got))


def test_mix_of_small_sources(spark):
    sizes = {"five": 5, "hundred": 100, "large": 40_000, "one": 1, "sixty-five": 65, "z-large": 20_000}
    rows = [(i, "w " * n, s) for i, (s, n) in enumerate(sizes.items())]
    taken = {r["source"]: r for r in mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"))[1].collect()}
    wanted = targets_by_hand(sizes)
    for s, n in sizes.items():
        assert taken[s]["taken"] <= 3 * n
        if n < 1000:
            assert wanted[s] == 3 * n == taken[s]["taken"]
        assert abs(taken[s]["taken"] - wanted[s]) <= 32 + 0.01 * wanted[s]
    # Below its cap, too, a small source gets what its target says.
    even = {"a": 65, "b": 65, "c": 65}
    got = mixing.mix(spark.createDataFrame([(i, "w " * n, s) for i, (s, n) in enumerate(even.items())], "doc_id long, text string, source string"))[1].collect()
    assert all(abs(r["taken"] - targets_by_hand(even)[r["source"]]) <= 3 for r in got)


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.mix(spark.createDataFrame([], schema))[1].count() == 0
    only_empty = mixing.mix(spark.createDataFrame([(1, None, "a"), (2, "", None)], schema))[1].collect()
    assert [(r["size"], r["target"], r["taken"]) for r in only_empty] == [(0, 0.0, 0), (0, 0.0, 0)]


def test_permutations(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(5)).alias("x"))
        assert sorted(r["x"] for r in df.collect()) == list(range(n))


# --- toxicity ----------------------------------------------------------------


def test_toxicity_learns_from_labels(spark):
    rows, labels = [], []
    for i in range(240):
        toxic = i % 6 == 0
        rows.append((i, lines(2, i) + (" you awfulword " * (1 + i % 4) if toxic else " fine"),))
        if i < 200:
            labels.append((i, int(toxic)))
    rows += [(300, None), (301, ""), (302, "..."), (None, "awfulword"), (0, rows[0][1])]
    labels += [(0, 1), (6, 0), (None, 1), (7, None), (999, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert list(model.thresholds) == sorted(model.thresholds)
    got = {r["row"]["doc_id"]: r for r in toxicity.grade_severity(df, model).collect()}
    assert all(got[i]["toxic"] == (i % 6 == 0) for i in range(240))
    assert got[300]["expected_severity"] == got[301]["expected_severity"] == 0
    assert all(0 <= r["expected_severity"] <= toxicity.GRADES - 1 for r in got.values())


def test_toxicity_without_labels(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    model = toxicity.fit(df, spark.createDataFrame([], "doc_id long, toxic int"))
    assert toxicity.grade_severity(df, model).first()["expected_severity"] == 0


# --- quality -----------------------------------------------------------------


def quality_by_brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    repeated = {i + k for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for k in range(8)}
    worded = [x for x in text.split("\n") if WORD.search(x)]
    base_failed = len(words) < 20 or 100 * len(repeated) > 30 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(worded) - len(set(worded)), len(repeated), base_failed


def test_quality_measures_against_brute_force(spark):
    texts = [
        None, "", " \n ", lines(4, 90), lines(2, 91) * 2, "a b c d e f g h " * 5, "Home | About | Contact\n" + lines(3, 92), "é ü # *\n\n" * 9,
        lines(3, 93) + "All rights reserved by privacy policy and terms of use forever and ever here.\n", "w " * 300 + "\n" + lines(1, 94), "x" * 30_000 + " y" * 25,
        "same line of words\n" * 4, "\x0b\x0ca\rb\tc " * 10, "q w e r t z u i o p q w e r t z u i o p",
    ]
    df = spark.createDataFrame(list(enumerate(texts)) + [(None, texts[3]), (3, texts[3])], "doc_id long, text string")
    got = quality.clean(df).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = texts[3] if r["doc_id"] is None else texts[r["doc_id"]]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) == quality_by_brute_force(text)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[3]["kept"] and by_id[3]["n_bad_lines"] == 0
    assert by_id[6]["n_bad_lines"] == 1 and "Home" not in by_id[6]["clean_text"]
    assert by_id[8]["n_bad_lines"] == 1 and by_id[9]["n_bad_lines"] == 1 and not by_id[9]["kept"]
    assert quality.clean(df.limit(0)).count() == 0
