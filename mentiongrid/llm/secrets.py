"""Secret scanning through a trigram inverted index.

1. Every rule's regular expression yields a Boolean query of mandatory trigrams
   (`trigrams.required_trigrams`). A rule without one is scanned over all texts.
2. `build_index` reads the texts once: it lists, for each trigram that some rule asks for, the
   documents that contain it (its posting list), and runs the rules without trigrams.
3. `candidates` intersects the postings of an alternative and unites the alternatives.
4. `verify` runs a rule's expression over the whole text of its candidates only.

Documents are identified by (doc_id, hash of the text). Postings and spans are small; whole
texts move only in the join with the candidates, which Spark broadcasts or filters by a Bloom
filter of the candidates. Postings are grouped by document, so a trigram that a third of
the documents contain makes no large group.

Defined results: a null or empty text has no spans. Repeated rows get equal spans. Spans are
in code points, end exclusive, ordered by start and then by the rule's position in the list.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.llm.common import annotate, row_key, table
from mentiongrid.llm.trigrams import required_trigrams
from mentiongrid.session import materialise

SPANS = "array<struct<start:int,kind:int,end:int>>"


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches; those whose `group` is shorter than `shortest` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    shortest: int = 0

    def spans(self, text: str, number: int) -> list[tuple[int, int, int]]:
        found = re.compile(self.pattern).finditer(text)
        return [(m.start(), number, m.end()) for m in found if m.end(self.group) - m.start(self.group) >= self.shortest]


def _either_case(words: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The secret formats. The first three are the base rules.
BASE_RULES = [
    Rule("assign", f"({_either_case('password|passwd|secret|token|api_?key')})" + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
]
# A key goes up to its END line. Without one it takes headers, lines of base64 and the token that ends them.
_GAP = r"""(?:\\[nr]|[\s>"',])"""
_TO_END = r"(?:[^-]|-{1,4}[^-])*+-----END [A-Z ]*PRIVATE KEY-----"
_BODY = rf"(?:[\r\n]+[A-Za-z]+-[A-Za-z]+:\x20[^\r\n]*)*(?:{_GAP}*[A-Za-z0-9+/=]{{16,}}(?:{_GAP}+[A-Za-z0-9+/=]{{16,}})*(?:{_GAP}+[A-Za-z0-9+/=]+)?)?"
MORE_RULES = [
    Rule("private_key", rf"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:{_TO_END}|{_BODY})"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("slack", r"xox[abpr]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}(?:\.[A-Za-z0-9_-]+)?"),
    Rule("bearer", r"[Bb]earer [A-Za-z0-9._~+/-]{20,}"),
]
RULES = BASE_RULES + MORE_RULES


def rule_queries(rules: Sequence[Rule]) -> dict[int, list[frozenset[str]] | None]:
    return {i: required_trigrams(r.pattern) for i, r in enumerate(rules)}


def build_index(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, text_hash, `postings` (numbers of the trigrams it has), `scanned`."""
    queries = rule_queries(rules)
    grams = vocabulary(queries)
    scan = [(i, r) for i, r in enumerate(rules) if queries[i] is None]
    # A run of the shortest allowed length is the same as a run that is long enough.
    quick = {i: re.compile(r"[0-9a-f]{%d}" % r.shortest) for i, r in scan if r.pattern == r"[0-9a-f]+" and r.shortest}

    def work(texts):
        for text in texts:
            text = text or ""
            folded = text.lower()
            spans = [s for i, r in scan if i not in quick or quick[i].search(text) for s in r.spans(text, i)]
            yield [n for n, gram in enumerate(grams) if gram in folded], spans

    keyed = documents.select(*row_key("text"), "text")
    found = annotate(keyed, ["doc_id", "text_hash"], ["text"], work, f"postings array<int>, scanned {SPANS}")
    return found.select("row.*", "postings", "scanned")


def vocabulary(queries: dict[int, list[frozenset[str]] | None]) -> list[str]:
    return sorted({gram for query in queries.values() for alternative in query or () for gram in alternative})


def postings(index: DataFrame) -> DataFrame:
    """The inverted index: (trigram, doc_id, text_hash)."""
    return index.select(F.explode("postings").alias("trigram"), "doc_id", "text_hash").distinct()


def candidates(posted: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, text_hash, rules): documents whose trigrams satisfy the query of a rule."""
    queries = rule_queries(rules)
    grams = vocabulary(queries)
    width = 62
    words = [
        F.bit_or(
            F.when((F.col("trigram") >= w) & (F.col("trigram") < w + width), F.call_function("shiftleft", F.lit(1).cast("long"), F.col("trigram") - w)).otherwise(F.lit(0).cast("long"))
        ).alias(f"has{w}")
        for w in range(0, max(1, len(grams)), width)
    ]
    has = posted.groupBy("doc_id", "text_hash").agg(*words)

    def satisfied(query: list[frozenset[str]]) -> Column:
        either = F.lit(False)
        for alternative in query:
            every = F.lit(True)
            for w in range(0, len(grams), width):
                mask = sum(1 << (grams.index(g) - w) for g in alternative if w <= grams.index(g) < w + width)
                every = every & (F.col(f"has{w}").bitwiseAND(F.lit(mask).cast("long")) == mask)
            either = either | every
        return either

    hit = [F.when(satisfied(q), F.lit(i)) for i, q in queries.items() if q is not None]
    if not hit:
        return has.select("doc_id", "text_hash", F.array().cast("array<int>").alias("rules")).where("false")
    return has.select("doc_id", "text_hash", F.array_compact(F.array(*hit)).alias("rules")).where(F.size("rules") > 0)


def verify(documents: DataFrame, chosen: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(doc_id, text_hash, verified): the spans of the candidate rules in the whole texts."""
    rules = list(rules)

    def work(texts, numbers):
        for text, which in zip(texts, numbers, strict=True):
            yield ([s for i in which for s in rules[i].spans(text, i)],)

    keyed = documents.where("text is not null").select(*row_key("text"), "text").alias("d")
    c = chosen.alias("c")
    same = F.col("d.text_hash").eqNullSafe(F.col("c.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("c.doc_id"))
    joined = keyed.join(c, same).select("d.doc_id", "d.text_hash", "d.text", "c.rules")
    found = annotate(joined, ["doc_id", "text_hash"], ["text", "rules"], work, f"verified {SPANS}")
    return found.where(F.size("verified") > 0).select("row.*", "verified").distinct()


def scan(documents: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """One row per document: doc_id, text_hash and all its `spans`."""
    index = materialise(build_index(documents, rules), "trigram-index")
    chosen = materialise(candidates(postings(index), rules), "trigram-candidates")
    verified = verify(documents, chosen, rules).alias("v")
    i = index.alias("i")
    same = F.col("i.text_hash").eqNullSafe(F.col("v.text_hash")) & F.col("i.doc_id").eqNullSafe(F.col("v.doc_id"))
    spans = F.array_sort(F.concat("i.scanned", F.coalesce("v.verified", F.array().cast(SPANS))))
    return i.join(verified, same, "left").select("i.doc_id", "i.text_hash", spans.alias("spans"))


def _written(spans: Column, rules: Sequence[Rule]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")


def _count(kind: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] < len(BASE_RULES))
    counts = [_count(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE_RULES)]
    return found.select(
        "doc_id", *counts, F.sha2(_written(base, RULES).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans"), RULES).alias("spans")
    )


def redact(documents: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[secret]") -> DataFrame:
    """`documents` with every span, overlapping ones together, replaced by `mark`; n_chars follows."""
    columns = documents.columns
    found = scan(documents.select("doc_id", "text"), rules).where(F.size("spans") > 0).distinct()
    # The row travels in a struct, so that no column of it can clash.
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("all"), "text", *row_key("text"))
    same = F.col("d.text_hash").eqNullSafe(F.col("s.text_hash")) & F.col("d.doc_id").eqNullSafe(F.col("s.doc_id"))
    joined = rows.alias("d").join(found.alias("s"), same, "left").select("d.all", "d.text", "s.spans")

    def work(texts, spans):
        for text, cuts in zip(texts, spans, strict=True):
            yield (text if not cuts else _cut(text, cuts, mark),)

    changed = annotate(joined, ["all"], ["text", "spans"], work, "clean string").select("row.all", "clean")
    clean = {"text": F.col("clean")}
    if "n_chars" in columns:
        same_text = F.col("clean").eqNullSafe(F.col("all.text"))
        clean["n_chars"] = F.when(same_text, F.col("all.n_chars")).otherwise(F.length("clean").cast(documents.schema["n_chars"].dataType))
    return changed.select(*[clean.get(c, F.col(f"all.`{c}`")).alias(c) for c in columns])


def _cut(text: str, spans: list[dict], mark: str) -> str:
    parts, at = [], 0
    for s in spans:
        if s["start"] >= at:
            parts += [text[at : s["start"]], mark]
        at = max(at, s["end"])
    return "".join([*parts, text[at:]])


QUERIES = {"op10_secret_scan": op10_secret_scan}
SQL: dict[str, str] = {}
