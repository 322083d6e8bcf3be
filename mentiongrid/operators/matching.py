"""Matching patterns against article texts: one term as an expression, a dictionary through its index."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentiongrid.functions.patterns import ALWAYS, fold_case
from mentiongrid.operators.dictionary import Term
from mentiongrid.operators.term_index import TermIndex, mentions
from mentiongrid.session import local_table

_FOLDED = "_folded"


def mention(text: Column | str, term: Term, folded: Column | None = None) -> Column:
    """Boolean: the text mentions the term (NULL for a NULL text).

    With `folded` (see `fold_case`) a substring test spares most texts the pattern.
    """
    text = F.col(text) if isinstance(text, str) else text
    verified = text.rlike(term.pattern)
    if folded is None or any(k.kind == ALWAYS for k in term.keys):
        return verified
    return _contains_any(folded, [k.literal for k in term.keys]) & verified


def _contains_any(folded: Column, literals: list[str]) -> Column:
    shortest = [a for a in literals if not any(b != a and b in a for b in literals)]
    condition = folded.contains(shortest[0])
    for literal in shortest[1:]:
        condition = condition | folded.contains(literal)
    return condition


def with_folded(df: DataFrame, text: str, unicode_case: bool = False) -> DataFrame:
    """Add the folded text unless a caller already did, so that it is computed once per article."""
    if _FOLDED in df.columns:
        return df
    return df.withColumn(_FOLDED, fold_case(F.col(text), unicode_case))


def match_terms(df: DataFrame, terms: list[Term], text: str, unicode_case: bool = False) -> DataFrame:
    """One row per (article, mentioned term): the columns of `df` without the text, `term_id` and `term_body`."""
    columns = [c for c in df.columns if c != text]
    index = TermIndex.of(terms, unicode_case=unicode_case)
    rows = mentions(df, index, text, columns).withColumn("term_id", F.explode(index.ids("_terms", 0)))
    bodies = local_table(df.sparkSession, [(t.id, t.body) for t in terms], {"term_id": "int", "term_body": "string"})
    return rows.join(bodies, "term_id").select(*(F.col(f"`{c}`") for c in columns), "term_id", "term_body")


def with_mentioned_ids(df: DataFrame, text: str, terms: list[Term], out: str, unicode_case: bool = False) -> DataFrame:
    """Add the ascending array of the ids of all mentioned terms; a NULL text mentions none."""
    index = TermIndex.of(terms, unicode_case=unicode_case)
    kept = [c for c in df.columns if c != out]
    found = mentions(df, index, text, kept).withColumn(out, index.ids("_terms", 0))
    return found.select(*(F.col(f"`{c}`") for c in dict.fromkeys([*df.columns, out])))
