"""Term dictionaries: reading them into compiled terms, validating, selecting.

A dictionary is a hand-written control table of at most some thousand rows. It is the
only data this package brings to the driver; article data never is.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mentiongrid.functions.patterns import Key, PatternError, index_keys, java_body, java_pattern
from mentiongrid.session import local_table


@dataclass(frozen=True)
class Term:
    """One usable dictionary row. `id` is the row's position, as names and patterns may repeat."""

    id: int
    label: str
    regex: str
    pattern: str
    body: str
    keys: tuple[Key, ...]
    attributes: tuple = field(default=())
    unicode_case: bool = False


def require_mode(terms: Iterable[Term], unicode_case: bool) -> None:
    """Terms compiled for one pattern mode must not meet texts folded for the other."""
    wrong = [t.label or t.regex for t in terms if t.unicode_case != unicode_case]
    if wrong:
        raise ValueError(f"compiled with unicode_case={not unicode_case}, used with {unicode_case}: {wrong[:5]}")


def compile_term(regex: str, label: str = "", term_id: int = 0, unicode_case: bool = False, attributes: tuple = ()) -> Term:
    return Term(
        term_id, label, regex,
        java_pattern(regex, unicode_case), java_body(regex, unicode_case),
        tuple(index_keys(regex, unicode_case)), attributes, unicode_case,
    )


def compile_terms(rows: Iterable[tuple], unicode_case: bool = False, skip_invalid: bool = False) -> list[Term]:
    """Terms from (label, regex, *attributes) rows.

    Rows whose pattern fails raise one error that names them all; only `skip_invalid` leaves
    them out. `validate_dictionary` lists them with the reason.
    """
    terms, bad = [], []
    for term_id, (label, regex, *attributes) in enumerate(rows):
        try:
            terms.append(compile_term(regex, label, term_id, unicode_case, tuple(attributes)))
        except PatternError as exc:
            bad.append(f"{label!r} ({regex!r}): {exc}")
    if bad and not skip_invalid:
        raise PatternError(f"{len(bad)} dictionary rows cannot be used: " + "; ".join(bad))
    return terms


def load_terms(
    dictionary: DataFrame, label: str, regex: str = "Regex", attributes: tuple[str, ...] = (), unicode_case: bool = False,
    skip_invalid: bool = False,
) -> list[Term]:
    """Compile a dictionary table. Rows are ordered by their values so that ids are stable."""
    columns = [label, regex, *attributes]
    rows = dictionary.select(*columns).orderBy(*columns).collect()
    return compile_terms([tuple(r) for r in rows], unicode_case, skip_invalid)


def require_columns(dictionary: DataFrame, *columns: str) -> DataFrame:
    missing = [c for c in columns if c not in dictionary.columns]
    if missing:
        raise ValueError(f"dictionary lacks the column(s) {', '.join(missing)}; it has {dictionary.columns}")
    return dictionary


def validate_dictionary(dictionary: DataFrame, regex: str = "Regex", unicode_case: bool = False) -> DataFrame:
    """Every dictionary row with its Java pattern, or with the reason why it is unusable.

    One bad pattern would fail the whole matching job, so bad rows are set apart first:
    filter on `pattern_error is null` / `is not null` for the valid / quarantined part.
    """

    @F.pandas_udf("pattern string, pattern_error string")
    def check(values: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([_check(v, unicode_case) for v in values], columns=["pattern", "pattern_error"])

    checked = require_columns(dictionary, regex).withColumn("_checked", check(F.col(regex)))
    return checked.select("*", "_checked.pattern", "_checked.pattern_error").drop("_checked")


def _check(regex, unicode_case):
    try:
        return java_pattern(regex, unicode_case), None
    except PatternError as exc:
        return None, str(exc)


def select_pattern(dictionary: DataFrame, contains: str, column: str = "Disease", regex: str = "Regex") -> str:
    """The pattern of the only row whose `column` contains a text."""
    rows = dictionary.filter(F.col(column).contains(contains)).select(regex).limit(2).collect()
    if len(rows) != 1:
        raise ValueError(f"expected one dictionary row containing {contains!r}, found {'more' if rows else 'none'}")
    return rows[0][0]


def terms_table(spark: SparkSession, terms: list[Term], key: str, columns: dict[str, str]) -> DataFrame:
    """(key, *attributes) of compiled terms; `columns` maps attribute names to types."""
    return local_table(spark, [(t.id, *t.attributes) for t in terms], {key: "int", **columns})
