r"""Phrase collocations by stripes: each prefix keys a counter of its next words.

Texts, A-Z lower-cased, are cut at `[.,;:!?\x0A-\x0D]` into pieces and these at blanks and tabs into words. All counts are per language.

1. *What can be frequent.* Tasks send hashes of words and word pairs with their counts, packed, to buckets of hash ranges.
   Those that reach the least count set a bit each in a map of at most 2^`MOST_BITS` bits, which is broadcast. Then the same for
   runs of three words and more, of which every pair is flagged. A false alarm costs an entry and nothing is lost.
2. *Stripes.* Every place counts for the longest flagged run of up to five words there. A task adds up its runs as stripes, prefix ->
   next word -> count, and sends them packed by head (the first three words); the stripes of one head meet in one task and merge
   elementwise. Prefix totals carry longer runs over to shorter ones; totals of three words and more are complete there, those of
   two words are added up afterwards, so not even a word pair that stands everywhere gathers in one task.
3. *Extensions.* From the same counters: the greatest count of a next word is what a phrase's longer phrases can subsume it with on the
   right; on the left it is the greatest count of a phrase with one word before. Longer ones need no look-up, as counts
   never grow with the length.
4. *Scores.* A candidate's cuts are joined to the counts of both parts; the lowest score counts. All arithmetic is exact (decimals).

Defined results: a null text is empty; a null language counts as `und`, together with texts whose language is `und`. Repeated rows and ids
count as often as they stand there. Ties are ordered by the phrase's bytes, which leaves none. A text of any length is cut by the megabyte.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentiongrid.llm.common import table
from mentiongrid.llm.wordhash import WordNumbers, mixed, packed, stretches, unpacked
from mentiongrid.session import materialise, scratch

LONGEST, LEAST, TOP = 5, 100, 2000
UNKNOWN = "und"
MOST_BITS = 27
BUCKET_BYTES = 8 << 20
_HASH_BITS = 48
_SECTION = 16  # log of the bits of a part of the bitmap
_PIECE = 1 << 20
_FLUSH = 1_500_000
_BREAK = b"\xff"  # in no UTF-8 text
_ENDS = b".,;:!?\n\x0b\x0c\r"
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ" + _ENDS, b"abcdefghijklmnopqrstuvwxyz" + b"\n" * len(_ENDS))


def words_and_breaks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text with a mark between its pieces, some megabyte of text at a time."""
    data = data.translate(_FOLD)
    start = 0
    while start < len(data):
        end = min(len(data), start + _PIECE)
        while end < len(data) and data[end] not in b" \t\n":
            end += 1
        yield data[start:end].replace(b"\n", b" " + _BREAK + b" ").split()
        start = end


class _Words:
    """Words of many texts as numbers in one array; number 0 is a break, and texts are set apart by one."""

    def __init__(self) -> None:
        self.known = WordNumbers()
        self.known[_BREAK]
        self.parts: list[np.ndarray] = [np.zeros(1, np.int64)]
        self.langs: list[str] = []
        self.sizes: list[int] = []
        self.size = 0

    def add(self, data: bytes, lang: str) -> None:
        before = self.size
        for words in words_and_breaks(data):
            self.parts.append(np.fromiter(map(self.known.__getitem__, words), np.int64, len(words)))
            self.size += len(words)
        self.parts.append(np.zeros(1, np.int64))
        self.size += 1
        self.langs.append(lang)
        self.sizes.append(self.size - before)

    def arrays(self) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Word numbers, language numbers, languages."""
        names = sorted(set(self.langs))
        number = {name: i for i, name in enumerate(names)}
        of_text = np.array([number[lang] for lang in self.langs], np.int64)
        return np.concatenate(self.parts), np.concatenate([np.zeros(1, np.int64), np.repeat(of_text, self.sizes)]), names

    def levels(self, words: np.ndarray, langs: np.ndarray, names: list[str], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For runs of 1, 2, .. words: the hash of the run that starts at each place, with its language, and whether there is one."""
        by_word = np.array([xxhash.xxh64_intdigest(w) for w in self.known.words], np.uint64)
        by_lang = np.array([xxhash.xxh64_intdigest(n) for n in names] or [0], np.uint64)
        one = run = mixed(by_word[words] ^ by_lang[langs])
        here = whole = words > 0
        yield run, whole
        for k in range(1, longest):
            run = mixed(run * np.uint64(3) + np.append(one[k:], np.zeros(k, np.uint64)))
            whole = whole & np.append(here[k:], np.zeros(k, bool))
            yield run, whole


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[_Words]:
    held = _Words()
    for batch in batches:
        for data, lang in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
            held.add(data.as_py(), lang.as_py())
            if held.size > _FLUSH:
                yield held
                held = _Words()
    if held.size:
        yield held


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.coalesce("text", F.lit("")).alias("text"), F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"))


@dataclass(frozen=True)
class Flags:
    """Packed bitmaps of the runs that may occur often enough, one of words and pairs and one of longer runs."""

    log_bits: int
    bitmaps: tuple[np.ndarray, ...] = ()

    def __getitem__(self, k: int) -> np.ndarray:
        return self.bitmaps[k > 2]

    def marks(self, k: int, hashes: np.ndarray) -> np.ndarray:
        place = (hashes >> np.uint64(64 - self.log_bits)).astype(np.int64)
        return (self[k][place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1


def _chains(held: _Words, longest: int, flags: Flags) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, hashes, places): places of runs of k words whose shorter runs are all flagged, as far as flags are known."""
    words, langs, names = held.arrays()
    pair = None
    for k, (run, whole) in enumerate(held.levels(words, langs, names, longest), 1):
        if k == 2 and flags.bitmaps:
            pair = whole.copy()
            pair[whole] = flags.marks(2, run[whole])
        if k > 2:
            chain = pair if k == 3 else chain
            chain = chain & np.append(pair[k - 2 :], np.zeros(k - 2, bool))
            whole = chain
        yield k, run, np.flatnonzero(whole)


def _often(documents: DataFrame, sizes: range, flags: Flags, least: int, buckets: int) -> np.ndarray:
    """A packed bitmap of the runs of these sizes that may occur `least` times in a language."""
    log_bits = flags.log_bits
    shift = np.uint64(_HASH_BITS - log_bits)
    fine = np.uint64(_HASH_BITS - (buckets - 1).bit_length())
    shared = documents.sparkSession.sparkContext.broadcast(flags)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _slices(batches):
            runs = [run[at] for k, run, at in _chains(held, sizes[-1], shared.value) if k in sizes]
            value, count = np.unique(np.concatenate(runs) >> np.uint64(64 - _HASH_BITS), return_counts=True)
            bucket, cuts = stretches(value >> fine)
            lists = [packed(value[a:b], _HASH_BITS // 8) for a, b in cuts]
            counts = [count[a:b].astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes() for a, b in cuts]
            yield pa.RecordBatch.from_arrays([pa.array(bucket.astype(np.int64)), pa.array(lists, pa.binary()), pa.array(counts, pa.binary())], ["bucket", "hashes", "counts"])

    def flag(rows: pa.Table) -> pa.Table:
        value = np.concatenate([unpacked(x, _HASH_BITS // 8) for x in rows.column("hashes").to_pylist()])
        count = np.concatenate([np.frombuffer(x, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel() for x in rows.column("counts").to_pylist()])
        order = np.argsort(value)
        value, count = value[order], count[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], value[1:] != value[:-1]]))
        often = value[first][np.add.reduceat(count, first) >= least]
        place = np.unique((often >> shift).astype(np.int64))
        section, cuts = stretches(place >> _SECTION)
        places = [(place[a:b] & ((1 << _SECTION) - 1)).astype(np.uint16).tobytes() for a, b in cuts]
        return pa.table({"section": section, "places": pa.array(places, pa.binary())})

    def join(rows: pa.Table) -> pa.Table:
        bits = np.zeros(1 << _SECTION, np.uint8)
        for places in rows.column("places").to_pylist():
            bits[np.frombuffer(places, np.uint16)] = 1
        return pa.table({"section": rows.column("section")[:1], "bits": pa.array([np.packbits(bits, bitorder="little").tobytes()], pa.binary())})

    sent = _texts(documents).mapInArrow(send, "bucket long, hashes binary, counts binary")
    often = sent.groupBy("bucket").applyInArrow(flag, "section long, places binary")
    found = often.groupBy("section").applyInArrow(join, "section long, bits binary").toArrow()  # at most 2^MOST_BITS bits in all
    bitmap = np.zeros((1 << log_bits) >> _SECTION << (_SECTION - 3), np.uint8)
    for section, bits in zip(found.column(0).to_pylist(), found.column(1).to_pylist(), strict=True):
        bitmap[section << (_SECTION - 3) : (section + 1) << (_SECTION - 3)] = np.frombuffer(bits, np.uint8)
    return bitmap


def _stripes(documents: DataFrame, flags: Flags, longest: int, buckets: int) -> DataFrame:
    """(bucket, lang, runs, counts): the runs of a task by head, each followed by a blank, one to a line; the empty run counts all words."""
    shared = documents.sparkSession.sparkContext.broadcast(flags)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter: Counter[tuple[str, bytes]] = Counter()
        for held in _slices(batches):
            counter.update(_flagged_runs(held, shared.value, longest))
            if len(counter) > _FLUSH:
                yield _packed_runs(counter, buckets)
                counter = Counter()
        if counter:
            yield _packed_runs(counter, buckets)

    return _texts(documents).mapInArrow(send, "bucket long, lang string, runs binary, counts binary")


def _flagged_runs(held: _Words, flags: Flags, longest: int) -> dict[tuple[str, bytes], int]:
    """By language, the longest flagged run at every place with its count; words apart, and the empty run."""
    words, langs, names = held.arrays()
    known = held.known.words
    length = np.zeros(len(words), np.int8)
    found: dict[tuple[str, bytes], int] = {}

    def put(places: np.ndarray, size: int) -> None:
        key = langs[places]
        for k in range(size):  # numbers of distinct runs, word by word
            key = np.unique(key * len(known) + words[places + k], return_inverse=True)[1].reshape(-1)
        _, first, count = np.unique(key, return_index=True, return_counts=True)
        places = places[first]
        parts = [[known[i] for i in words[places + k].tolist()] for k in range(size)]
        runs = [b" ".join(p) + b" " for p in zip(*parts, strict=True)] if size else [b""] * len(places)
        found.update(zip(zip([names[i] for i in langs[places].tolist()], runs, strict=True), count.tolist(), strict=True))

    for k, run, at in _chains(held, longest, flags):
        if k == 1:
            put(at, 0)
        often = at[flags.marks(k, run[at])]
        if k == 1:
            put(often, 1)
        else:
            length[often[length[often] == (k - 1 if k > 2 else 0)]] = k
    for k in range(2, longest + 1):
        put(np.flatnonzero(length == k), k)
    return found


def _packed_runs(counter: dict[tuple[str, bytes], int], buckets: int) -> pa.RecordBatch:
    by_bucket: dict[tuple[int, str], list[tuple[bytes, int]]] = {}
    for (lang, run), n in counter.items():
        head = xxhash.xxh64_intdigest(b" ".join(run.split(b" ", 3)[:3]))
        by_bucket.setdefault((head % buckets, lang), []).append((run, n))
    columns = [
        pa.array([b for b, _ in by_bucket], pa.int64()), pa.array([lang for _, lang in by_bucket], pa.string()),
        pa.array([b"\n".join(r for r, _ in rows) for rows in by_bucket.values()], pa.binary()),
        pa.array([np.array([n for _, n in rows], np.int64).tobytes() for rows in by_bucket.values()], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "lang", "runs", "counts"])


class Stripes:
    """Stripes of one language: prefix -> counter of next words, merged elementwise.

    A run adds to the counter of its last word only; `totals` carries the counts of longer prefixes over to shorter ones.
    """

    def __init__(self) -> None:
        self.stripes: dict[bytes, Counter[bytes]] = {}

    def merge(self, runs: Iterable[bytes], counts: Iterable[int]) -> None:
        for run, n in zip(runs, counts, strict=True):
            cut = run.rfind(b" ", 0, -1) + 1  # before the last word
            stripe = self.stripes.get(run[:cut])
            if stripe is None:
                stripe = self.stripes[run[:cut]] = Counter()
            stripe[run[cut:]] += n

    def totals(self) -> dict[bytes, int]:
        """Counts of all runs of two words and more, those that continue included."""
        deepest = max((prefix.count(b" ") for prefix in self.stripes), default=0)
        for size in range(deepest, 1, -1):
            for prefix in [p for p in self.stripes if p.count(b" ") == size]:
                cut = prefix.rfind(b" ", 0, -1) + 1
                self.stripes.setdefault(prefix[:cut], Counter())[prefix[cut:]] += sum(self.stripes[prefix].values())
        return {prefix + word: n for prefix, stripe in self.stripes.items() for word, n in stripe.items()}


def _merge(least: int):
    def run(rows: pa.Table) -> pa.Table:
        """(lang, phrase, size, n) of one bucket: those of up to two words are parts."""
        columns: list[list] = [[], [], [], []]
        for lang in set(rows.column("lang").to_pylist()):
            stripes, words = Stripes(), Counter()
            for name, runs, counts in zip(*(rows.column(c).to_pylist() for c in ("lang", "runs", "counts")), strict=True):
                if name != lang:
                    continue
                listed, numbers = runs.split(b"\n"), np.frombuffer(counts, np.int64)
                short = [r.count(b" ") < 2 for r in listed]
                for r, n, s in zip(listed, numbers.tolist(), short, strict=True):
                    if s:
                        words[r] += n
                stripes.merge([r for r, s in zip(listed, short, strict=True) if not s], numbers[~np.array(short, bool)].tolist())
            for r, n in [*words.items(), *stripes.totals().items()]:
                size = r.count(b" ")
                if size < 3 or n >= least:
                    for column, value in zip(columns, (lang, r[:-1], size, n), strict=True):
                        column.append(value)
        return pa.table([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.binary(), pa.int32(), pa.int64()), strict=True)], ["lang", "phrase", "size", "n"])

    return run


def phrase_counts(documents: DataFrame, least: int = LEAST, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, size, a): words and phrases of up to `longest` words that occur `least` times, and all words as the empty phrase."""
    size = documents.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]  # one number
    log_bits = min(MOST_BITS, max(16, int(size).bit_length()))
    buckets = 1 + size // BUCKET_BYTES
    flags = Flags(log_bits)
    for sizes in (range(1, 3), range(3, longest + 1)):
        flags = Flags(log_bits, (*flags.bitmaps, _often(documents, sizes, flags, least, buckets)))
    stripes = _stripes(documents, flags, longest, buckets)
    parts = stripes.groupBy("bucket").applyInArrow(_merge(least), "lang string, phrase binary, size int, n long")
    totals = parts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a"))
    return totals.where((F.col("a") >= least) | (F.col("size") == 0))


def collocations(documents: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the best phrases of each language; a stored table."""
    with scratch(documents.sparkSession, "collocations") as keep:
        counts = materialise(phrase_counts(documents.select("text", "lang"), least, longest), "phrase-counts")
        return keep(_ranked(counts, top))


def _ranked(counts: DataFrame, top: int) -> DataFrame:
    phrase = counts.withColumns({"phrase": F.decode("phrase", "UTF-8")})
    words = F.split("phrase", " ")
    candidates = phrase.where("size >= 2").withColumn("words", words)
    # The greatest count of a longer phrase, by what it is without its last or its first word.
    shorter = F.explode(F.array(F.slice("words", 1, F.col("size") - 1), F.slice("words", 2, F.col("size") - 1))).alias("inner")
    longer = candidates.where("size >= 3").select("lang", shorter, "a").groupBy("lang", F.array_join("inner", " ").alias("phrase")).agg(F.max("a").alias("longer"))
    left = candidates.join(longer, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") < F.col("a")))
    cut = left.select("lang", "phrase", "a", "size", "words", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    ends = cut.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("right"),
    )
    of = phrase.where("size > 0").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))
    l, r = (of.withColumnsRenamed({"part": side, "f": name}) for side, name in (("left", "l"), ("right", "r")))
    n = phrase.where("size = 0").select("lang", F.col("a").alias("n"))
    exact = {c: F.col(c).cast("decimal(19,0)") for c in ("a", "n", "l", "r")}
    product = (exact["a"] * F.lit(1000).cast("decimal(4,0)")).cast("decimal(19,0)") * exact["n"]
    scored = ends.join(l, ["lang", "left"]).join(r, ["lang", "right"]).join(n, "lang").withColumn("above", product).withColumn("below", exact["l"] * exact["r"])
    scored = scored.withColumn("score", F.expr("above div below"))
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    flat = lowest.select("lang", "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = flat.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS d, coalesce(lang, 'und') AS lang,
           regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS pieces
    FROM documents
), pieces AS (
    SELECT d, lang, p, list_filter(regexp_split_to_array(pieces[p], '[\x20\x09]+'), lambda w: w <> '') AS words
    FROM texts, unnest(range(1, len(pieces) + 1)) AS u(p)
), grams AS (
    SELECT lang, array_to_string(words[i:i + k - 1], ' ') AS phrase, k
    FROM pieces, unnest(range(1, len(words) + 1)) AS u(i), range(1, 6) AS s(k) WHERE i + k - 1 <= len(words)
), f AS (
    SELECT lang, phrase, k, count(*) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100
), total AS (
    SELECT lang, sum(len(words))::BIGINT AS n FROM pieces GROUP BY lang
), candidates AS (
    SELECT lang, phrase, k, a, string_split(phrase, ' ') AS words FROM f WHERE k >= 2
), longer AS (
    SELECT lang, inner_phrase AS phrase, max(a) AS most FROM (
        SELECT lang, a, array_to_string(words[s:s + m - 1], ' ') AS inner_phrase
        FROM candidates, range(2, 5) AS t(m), range(1, 5) AS v(s) WHERE m < k AND s + m - 1 <= k
    ) GROUP BY ALL
), cuts AS (
    SELECT c.lang, c.phrase, c.a, c.words, c.k, j
    FROM candidates c LEFT JOIN longer l ON c.lang = l.lang AND c.phrase = l.phrase, range(1, 5) AS t(j)
    WHERE j < c.k AND NOT coalesce(100 * l.most >= 100 * c.a, false)
), scored AS (
    SELECT c.lang, c.phrase, c.a, x.a AS l, y.a AS r, n, (1000::HUGEINT * c.a * n) // (x.a::HUGEINT * y.a) AS score, j
    FROM cuts c JOIN total USING (lang)
    JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:j], ' ')
    JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[j + 1:c.k], ' ')
), lowest AS (
    SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM lowest QUALIFY rank <= 2000
"""

QUERIES = {"op13_collocations": op13_collocations}
SQL: dict[str, str] = {"op13_collocations": _SQL}
