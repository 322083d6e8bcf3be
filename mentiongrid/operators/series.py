"""Time-series smoothing and group-mean imputation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def rolling_mean(
    df: DataFrame, series: Sequence[str], order: Sequence[str], column: str, n: int = 6, out: str | None = None
) -> DataFrame:
    """Mean over the current and the `n - 1` preceding rows; NULL until there are `n` values.

    A window per series: rows are already aggregated per period, so one series is short.
    """
    window = Window.partitionBy(*series).orderBy(*order).rowsBetween(1 - n, 0)
    mean = F.when(F.count(column).over(window) == n, F.avg(column).over(window))
    return df.withColumn(out or f"{column}_{n}m", mean)


def impute_group_mean(df: DataFrame, group: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace NULLs by the mean of the group's known values.

    The means come from a partially aggregated group-by joined back (one row per group, such
    as a year, so adaptive execution broadcasts them) instead of a window, which would gather
    each whole group in one task.
    """
    means = df.groupBy(*(F.col(g).alias(f"_{g}") for g in group)).agg(*(F.avg(c).alias(f"_mean_{c}") for c in columns))
    # NULL is a group of its own.
    same = reduce(lambda a, b: a & b, (F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group))
    joined = df.join(means, same, "left")
    filled = {c: F.coalesce(F.col(c), F.col(f"_mean_{c}")) for c in columns}
    return joined.select(*(filled.get(c, F.col(c)).alias(c) for c in df.columns))
