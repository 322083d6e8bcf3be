"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mentiongrid.llm import collocations, decontam, langid, mixing, neardup, passages, quality, secrets, substrings, toxicity, urlfilter, warc, wordruns

_MODULES = (langid, decontam, warc, neardup, urlfilter, passages, mixing, toxicity, quality, secrets, substrings, wordruns, collocations)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {k: v for m in _MODULES for k, v in m.QUERIES.items()}
SQL: dict[str, str] = {k: v for m in _MODULES for k, v in m.SQL.items()}
