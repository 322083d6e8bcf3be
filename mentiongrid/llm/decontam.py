r"""Benchmark decontamination by template windows.

A text becomes a sequence of template tokens: words lose outer punctuation and case, and three kinds become typed
placeholders whose values are kept apart as slots:
* `number`: it starts with a digit, possibly after a sign or currency; letters behind the digits that
  are a unit stay a unit placeholder;
* `unit`: a unit of measure right after a number;
* `name`: a capitalised word that neither starts the text nor follows a sentence end.
Windows with names are also hashed with the names as words, so that neither side has to guess which capitals are names.
Windows of three tracks are hashed:
* template: from every token on, the shortest window of at least `WINDOW` template tokens of which at least `LITERAL`
  are no placeholders, so number-heavy passages get longer windows;
* whole: an item of fewer than `WINDOW` tokens, or without a template window, is one window of its own length, if
  it has a word at all; with names as placeholders only if it is not mostly capitalised. The first token of
  an item starts a sentence, wherever a document has it;
* literal: every `WINDOW` tokens, or all of a shorter item, in lower case and with the values of their placeholders.
Documents are read once: a bit map of the benchmark's
window hashes, of fixed size, drops nearly all windows where they arise, and the rest is joined by hash.

Per document, item and alignment the slots must map consistently: equal values of the item to equal values of
the document; literal windows need no such test. A document is contaminated by an item if windows cover at least
`coverage` of the item's template windows (or its whole one), or of its literal ones. The better share is given. `exact` says that all slots have the item's values; otherwise the question was
re-parameterised.

Items with equal texts are one class, named by the least item_id, so copies do not multiply rows.

Defined results: null texts and texts without a token match nothing. An item without any word, only
numbers, is found as it is and not re-parameterised; a short item is found wherever its few tokens stand. Documents
are rows of equal doc_id and text: repeated ones count once, and texts that share a doc_id are judged apart. The query
gives a doc_id its most covered text. A null doc_id or item_id is a value like any other.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import _arrow_types, row_key, table
from mentiongrid.session import materialise

WINDOW, LITERAL = 8, 5
_CACHE = 200_000
_EDGES = "".join(map(chr, range(0x21, 0x30))) + ":;<=>?@[\\]^_`{|}~«»“”„‘’…–—¡¿"
_QUOTES = "\"'([{«“„‘¿¡"
_NUMBER = re.compile(r"[+\-$€£¥(]*\d[\d.,:/]*")

# Units of measure, in lower case.
UNITS = frozenset(
    "mm cm m km in ft yd mi mile miles meter meters metre metres g kg mg lb lbs oz ton tons gram grams pound pounds s sec second "
    "seconds min minute minutes h hr hour hours day days week weeks month months year years l ml liter liters litre litres "
    "gallon gallons km/h mph % percent dollar dollars euro euros cent cents $ € £ v w kw hz khz mhz ghz kb mb gb tb".split()
)

NUMBER, UNIT, NAME = np.uint64(1), np.uint64(2), np.uint64(3)
LITERALS, TEMPLATES, WHOLES = 0, 1, 2
# An odd base of powers and its inverse modulo 2**64.
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
# The low bits of a word's code.
_CAPITAL, _ENDS, _IS_NUMBER, _IS_UNIT, _WITH_UNIT, _SHIFT = 1, 2, 4, 8, 16, 5


class _Codes(dict):
    """Word to its hash and flags; emptied when full."""

    def __missing__(self, word: str) -> int:
        if len(self) > _CACHE:
            self.clear()
        value = self[word] = _code(word)
        return value


def _code(word: str) -> int:
    bare = word.strip(_EDGES)
    if not bare and word not in UNITS:
        return 0  # punctuation alone
    core = (bare or word).lower()
    flags = _ENDS if not word[-1].isalnum() and word.rstrip("\"')]}»”’")[-1:] in (".", "!", "?", ":") else 0
    # Edges are no digits: what is all letters between them is no number.
    if not bare.isalpha() and (m := _NUMBER.match(word.lstrip(_QUOTES))):
        rest = m.string[m.end() :].strip(_EDGES).lower()
        with_unit = rest in UNITS or "%" in m.string[m.end() :]
        if not rest or with_unit:
            return _hashed(core) | flags | _IS_NUMBER | (_WITH_UNIT if with_unit else 0)
    if core in UNITS:
        flags |= _IS_UNIT
    if core != bare and bare[:1].isupper():
        flags |= _CAPITAL
    return _hashed(core) | flags


def _hashed(core: str) -> int:
    return (xxhash.xxh64_intdigest(core.encode("utf-8", "surrogatepass")) >> (_SHIFT + 1) << _SHIFT) | (1 << 63)


# What `str.split` takes for blanks besides the six ASCII ones.
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def _words(text: str) -> list[str]:
    """Runs of anything but the six ASCII blanks."""
    return re.findall(r"[^\x20\x09-\x0D]+", text) if _OTHER_BLANKS.search(text) else text.split()


class Template:
    """The tokens of a text: words, literal hashes, kinds of placeholders (0 for a word), and hashes of windows."""

    def __init__(self, text: str, codes: dict[str, int]):
        words = _words(text)
        code = np.fromiter(map(codes.__getitem__, words), np.uint64, len(words))
        if not code.all():
            words = [w for w, c in zip(words, code.tolist(), strict=True) if c]
            code = code[code != 0]
        self.words, self.n = words, len(words)

        def has(flag: int) -> np.ndarray:
            return code & np.uint64(flag) != 0

        number, capital = has(_IS_NUMBER), has(_CAPITAL)
        self.capitals = np.concatenate([[0], np.cumsum(capital)])
        kind = np.zeros(self.n, np.uint64)
        kind[number] = NUMBER
        after = np.zeros(self.n, bool)
        after[1:] = (number & ~has(_WITH_UNIT))[:-1]
        kind[has(_IS_UNIT) & after] = UNIT
        start = np.ones(self.n, bool)
        start[1:] = has(_ENDS)[:-1]
        named = kind.copy()
        named[capital & ~start & (kind == 0)] = NAME
        self.names = np.concatenate([[0], np.cumsum(named == NAME)])
        self.kinds = (named, kind)  # with names as placeholders, and as words
        self.literal = code >> np.uint64(_SHIFT)
        self.powers = np.cumprod(np.full(self.n, _BASE))
        self.inverse = np.cumprod(np.full(self.n, _INVERSE))
        self.hashed = [np.where(k == 0, self.literal, k) for k in self.kinds]
        self.sums = [self._sums(h) for h in (*self.hashed, self.literal)]

    def _sums(self, values: np.ndarray) -> np.ndarray:
        return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * self.powers)])

    def _hash(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, track: int) -> np.ndarray:
        """Of the tokens from starts to ends, wherever they stand: sums of powers modulo 2**64."""
        mixed = sums * self.inverse[starts]
        mixed = (mixed ^ (((ends - starts) << 2) | track).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed ^ (mixed >> np.uint64(29))).view(np.int64)

    def literals(self, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the literal windows of `length` tokens."""
        starts = np.arange(max(0, self.n - length + 1))
        ends = starts + length
        return starts, ends, self._hash(self.sums[2][ends] - self.sums[2][starts], starts, ends, LITERALS)

    def templates(self, form: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and hashes of the template windows; in form 1 names are words, and those without names are left out."""
        starts = np.arange(max(0, self.n - WINDOW + 1))
        plain = self.kinds[form] == 0
        ends = np.maximum(self._word_ends(plain)[(np.cumsum(plain) - plain)[starts] + LITERAL - 1], starts + WINDOW)
        good = ends <= self.n
        starts, ends = starts[good], ends[good]
        if form:
            named = self.names[ends] > self.names[starts]
            starts, ends = starts[named], ends[named]
        return starts, ends, self._hash(self.sums[form][ends] - self.sums[form][starts], starts, ends, TEMPLATES)

    def openings(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `templates`, of windows from a name on that is a word where an item starts with it."""
        starts = np.flatnonzero(self.kinds[0][: max(0, self.n - WINDOW + 1)] == NAME)
        plain = self.kinds[0] == 0
        ends = np.maximum(self._word_ends(plain)[np.cumsum(plain)[starts] + LITERAL - 2], starts + WINDOW)
        starts, ends = starts[ends <= self.n], ends[ends <= self.n]
        sums = self.sums[0][ends] - self.sums[0][starts] + (self.literal[starts] - NAME) * self.powers[starts]
        return starts, ends, self._hash(sums, starts, ends, TEMPLATES)

    def _word_ends(self, plain: np.ndarray) -> np.ndarray:
        """Where the words end, and LITERAL places beyond the text."""
        return np.append(np.flatnonzero(plain) + 1, [self.n + 1] * LITERAL)

    def wholes(self, length: int, form: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """As `templates`, of all windows of `length` tokens with a word, the first token taken as the start of a sentence."""
        starts = np.arange(max(0, self.n - length + 1))
        ends = starts + length
        kind, hashed, sums = self.kinds[form], self.hashed[form], self.sums[form]
        words = np.concatenate([[0], np.cumsum(kind == 0)])
        good = (words[ends] > words[starts + 1]) | (kind[starts] != NUMBER)
        if not form:
            good &= 2 * (self.capitals[ends] - self.capitals[starts]) < length
        starts, ends = starts[good], ends[good]
        first = np.where(kind[starts] == NUMBER, NUMBER, self.literal[starts])
        changed = sums[ends] - sums[starts] + (first - hashed[starts]) * self.powers[starts]
        return starts, ends, self._hash(changed, starts, ends, WHOLES)

    def slots(self, start: int, end: int, form: int, opening: bool) -> list[str]:
        kind = self.kinds[form]
        return [
            self.words[i].strip(_EDGES).lower() for i in range(start, end) if kind[i] and not (opening and i == start and kind[i] != NUMBER)
        ]


_ROW = {"id": "long", "text_hash": "long", "track": "int", "length": "int", "start": "int", "hash": "long", "slots": "array<string>"}
# Of items: whether a literal window is as long as the template window from there on, and how many windows there are.
_ITEM_ROW = _ROW | {"same": "boolean", "total": "int", "literals": "int"}


def _item_rows(t: Template) -> Iterator[tuple]:
    found = {}
    templates = [t.templates(form) for form in (0, 1)]
    for form, rows in enumerate(templates):
        # Names as words differ from names as placeholders only where there are names.
        track = TEMPLATES if len(rows[0]) or (form and not t.names[-1] and len(templates[0][0])) else WHOLES
        for s, e, k in zip(*(x.tolist() for x in (rows if track == TEMPLATES else t.wholes(t.n, form))), strict=True):
            found[track, s, k] = e, t.slots(s, e, form, track == WHOLES)
    literal = t.literals(min(WINDOW, t.n))
    totals = len({s for _, s, _ in found}), len(literal[0])
    spans = {(s, e) for (_, s, _), (e, _) in found.items()}
    for (track, s, k), (e, slots) in found.items():
        yield track, e - s, s, k, slots, False, *totals
    for s, e, k in zip(*(x.tolist() for x in literal), strict=True):
        yield LITERALS, e - s, s, k, [], (s, e) in spans, *totals


def _document_rows(t: Template, short: list[int], whole: list[int], bits: np.ndarray) -> Iterator[tuple]:
    """The windows whose hashes may be in the benchmark."""
    forms = (0, 1) if t.n and t.names[-1] else (0,)
    found = [(LITERALS, 0, False, *t.literals(length)) for length in short]
    found += [(TEMPLATES, form, False, *t.templates(form)) for form in forms]
    found += [(WHOLES, form, True, *t.wholes(length, form)) for length in whole for form in (0, 1)]
    if len(forms) > 1:
        found.append((TEMPLATES, 0, True, *t.openings()))
    for track, form, opening, starts, ends, keys in found:
        kept = np.flatnonzero(bits[_bit(keys, len(bits))])
        for i in kept[bits[_bit(keys[kept], len(bits), _SECOND)]].tolist():
            s, e = int(starts[i]), int(ends[i])
            yield track, e - s, s, int(keys[i]), [] if track == LITERALS else t.slots(s, e, form, opening)


def _window_rows(frame: DataFrame, rows: Callable[..., Iterator[tuple]], columns: dict[str, str], *shared) -> DataFrame:
    """The rows that `rows(Template, *shared)` gives for each text of (id, text)."""
    ddl = ", ".join(f"{name} {kind}" for name, kind in columns.items())
    kinds, names = _arrow_types(ddl), list(columns)
    sent = frame.sparkSession.sparkContext.broadcast(shared)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes()
        for batch in batches:
            out: list[tuple] = []
            for i in range(batch.num_rows):
                text = batch.column(2)[i].as_py()
                t = Template(text, codes) if text else None
                if not t or not t.n:
                    continue
                row, key = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                out += [(row, key, *r) for r in rows(t, *sent.value)]
                if len(out) > 20_000:
                    yield _batch(out, kinds, names)
                    out = []
            yield _batch(out, kinds, names)

    return frame.select("id", F.xxhash64("text"), "text").mapInArrow(run, ddl)


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


# Two odd factors, as every hash has two flags.
_FIRST, _SECOND = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9FB21C651E98DF25)


def _bit(keys: np.ndarray, size: int, factor: np.uint64 = _FIRST) -> np.ndarray:
    return ((keys.view(np.uint64) * factor) >> np.uint64(64 - size.bit_length() + 1)).astype(np.int64)


def _bit_map(hashes: DataFrame, log_bits: int) -> np.ndarray:
    """Flags at the places that the leading bits of two mixtures of the hashes name; words of 32 flags come to the driver."""
    size = 1 << log_bits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(0).to_numpy()
            place = np.concatenate([_bit(hashes, size), _bit(hashes, size, _SECOND)])
            yield pa.RecordBatch.from_arrays([pa.array(place >> 5), pa.array(np.int64(1) << (place & 31))], ["word", "flags"])

    words = hashes.select("hash").mapInArrow(run, "word long, flags long").groupBy("word").agg(F.bit_or("flags").alias("flags")).toArrow()
    bits = np.zeros(size >> 5, np.uint32)
    bits[words.column("word").to_numpy()] = words.column("flags").to_numpy().astype(np.uint32)
    return np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool)


def contaminated(documents: DataFrame, benchmark: DataFrame, coverage: float = 0.5, log_bits: int = 22) -> DataFrame:
    """(doc_id, text_hash, item_id, n_windows, item_windows, coverage, exact), one row per contaminated document and item.

    `documents` has doc_id and text, `benchmark` item_id and text.
    """
    items = benchmark.where("text is not null").groupBy("text").agg(F.min("item_id").alias("id"))
    listed = materialise(_window_rows(items, _item_rows, _ITEM_ROW), "benchmark-windows")
    # Few values: lengths below WINDOW, and those of items without template windows.
    lengths = listed.where(F.col("track") != TEMPLATES).select("track", "length").distinct().collect()
    short = sorted({WINDOW} | {r["length"] for r in lengths if r["track"] == LITERALS})
    whole = sorted({r["length"] for r in lengths if r["track"] == WHOLES})
    bits = _bit_map(listed.select("hash"), log_bits)
    found = _window_rows(documents.select(F.col("doc_id").alias("id"), "text"), _document_rows, _ROW, short, whole, bits).distinct()
    d = found.select(F.col("id").alias("doc_id"), "text_hash", F.col("start").alias("d_start"), "hash", F.col("slots").alias("d_slots"))
    i = listed.select(
        F.col("id").alias("item_id"), F.col("start").alias("i_start"), "hash", F.col("slots").alias("i_slots"), "track", "same", "total", "literals"
    )
    aligned = d.join(i, "hash").where(F.size("d_slots") == F.size("i_slots"))
    literal = F.col("track") == LITERALS
    pair = ["doc_id", "text_hash", "item_id", "total", "literals"]
    # A slot pair per placeholder of an alignment; windows overlap, so sets keep each pair once.
    per_alignment = aligned.groupBy(*pair, (F.col("d_start") - F.col("i_start")).alias("shift")).agg(
        F.collect_set(F.when(~literal, F.col("i_start"))).alias("starts"),
        F.bool_or(F.col("track") == WHOLES).alias("whole"),
        F.collect_set(F.when(literal & F.col("same"), F.col("i_start"))).alias("same_starts"),
        F.collect_set(F.when(literal, F.col("i_start"))).alias("literal_starts"),
        F.array_distinct(F.flatten(F.collect_set(F.arrays_zip(F.col("i_slots").alias("i"), F.col("d_slots").alias("d"))))).alias("pairs"),
    )
    consistent = F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"])))
    exact = F.forall("pairs", lambda p: p["i"].eqNullSafe(p["d"]))
    every = {c: F.array_distinct(F.flatten(F.collect_list(c))) for c in ("starts", "same_starts", "literal_starts")}
    covered = (
        per_alignment.withColumn("starts", F.when(consistent, F.col("starts")).otherwise(F.array().cast("array<int>")))
        .where((F.size("starts") > 0) | (F.size("literal_starts") > 0))
        .withColumn("exact", exact)
        .groupBy(*pair)
        .agg(F.bool_or(F.col("whole") & consistent).alias("whole"), *[c.alias(name) for name, c in every.items()], F.bool_and("exact").alias("exact"))
    )
    n_templates = F.when(F.col("whole"), F.col("total")).otherwise(F.size(F.array_union("starts", "same_starts")))
    shares = [
        F.struct((n / F.nullif(F.col(total), F.lit(0))).alias("coverage"), F.col(total).alias("of"), n.alias("n"))
        for n, total in ((n_templates, "total"), (F.size(F.array_union("starts", "literal_starts")), "literals"))
    ]
    better = F.when(F.coalesce(shares[0]["coverage"], F.lit(-1.0)) >= shares[1]["coverage"], shares[0]).otherwise(shares[1])
    return covered.withColumn("best", better).where(F.col("best.coverage") >= coverage).select(
        "doc_id", "text_hash", "item_id", F.col("best.n").alias("n_windows"), F.col("best.of").alias("item_windows"), "best.coverage", "exact"
    )


def remove_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of `documents` that no item contaminates, all columns kept."""
    bad = contaminated(documents, benchmark).select("doc_id", "text_hash").distinct()
    # The row travels in a struct, so that no column of it can clash.
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("all"), *row_key("text"))
    same = (F.col("d.text_hash") == F.col("b.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("b.doc_id"))
    return rows.alias("d").join(bad.alias("b"), same, "left_anti").select("all.*")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    best = F.max(F.struct("coverage", "exact", "n_windows", "item_windows")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "best.n_windows", "best.item_windows", "best.coverage", "best.exact"
    )


QUERIES = {"op2_decontamination": op2_decontamination}
SQL: dict[str, str] = {}
