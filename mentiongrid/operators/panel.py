"""The gap-free panel: completion, rates, roll-ups and the key check."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

PANEL_KEYS = ("disease", "year", "month", "cbscode")
COUNTS = ("n_location", "n_both")


def rate(n_both: Column, n_location: Column) -> Column:
    """`n_both / n_location`, 0 where nothing was counted."""
    return F.when(n_location == 0, F.lit(0.0)).otherwise(n_both / n_location)


def panel_grid(counts: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Every combination of the observed values of `keys`.

    The last key should be the one with most values: its values stay rows spread over the
    cluster, and each is expanded by the small sets of the other keys, which arrive as one
    scalar. NULL is a key value like any other.
    """
    *small, spread = keys
    # Values in structs, as a set of bare values leaves NULL out.
    sets = counts.agg(F.struct(*(F.collect_set(F.struct(k)).alias(k) for k in small)))
    values = counts.select(spread).distinct()
    # Few rows that become many: spread by number, which adaptive execution leaves alone.
    tasks = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    grid = values.repartition(tasks, spread).withColumn("_sets", sets.scalar())
    for key in small:
        grid = grid.withColumn(key, F.explode(F.col("_sets")[key])).withColumn(key, F.col(key)[key])
    return grid.select(*keys)


def complete_panel(counts: DataFrame, keys: Sequence[str] = PANEL_KEYS, fill: Sequence[str] = COUNTS) -> DataFrame:
    """The grid of `keys` with its counts, missing ones set to 0.

    Rows of `counts` that share a key all stay (see `duplicate_keys`). `counts` is read three
    times, so pass a stored table, not the matching job itself.
    """
    facts = counts.select(*(F.col(k).alias(f"_{k}") for k in keys), *fill)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))
    return panel_grid(counts, keys).join(facts, same, "left").select(*keys, *fill).fillna(0, subset=list(fill))


def watched_panel(counts: DataFrame, keys: Sequence[str] = PANEL_KEYS, fill: Sequence[str] = COUNTS) -> tuple[DataFrame, Observation]:
    """`complete_panel` that tells, in the job that writes it, how many rows of `counts` share a key at most (`most`)."""
    shared = counts.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    seen = Observation("panel keys")
    panel = complete_panel(shared, keys, (*fill, "_n")).observe(seen, F.max("_n").alias("most"))
    return panel.drop("_n"), seen


def mention_rates(panel: DataFrame) -> DataFrame:
    """The monthly panel with its rate, in its published column order."""
    return panel.select(
        F.lower("disease").alias("disease"), "year", "month", "cbscode",
        rate(F.col("n_both"), F.col("n_location")).alias("mention_rate"),
        "n_location", "n_both",
    )


def yearly(panel: DataFrame) -> DataFrame:
    """Yearly panel: the ratio of the summed counts, not the mean of monthly rates."""
    sums = panel.groupBy("disease", "year", "cbscode").agg(*(F.sum(c).alias(c) for c in COUNTS))
    return sums.select(
        "disease", "year", "cbscode",
        rate(F.col("n_both"), F.col("n_location")).alias("mention_rate"),
        "n_location", "n_both",
    )


def mean_rate(panel: DataFrame, by: Sequence[str] = ("cbscode", "year")) -> DataFrame:
    """Unweighted mean of the monthly rates; NULL and NaN rates are left out."""
    usable = F.when(~F.isnan("mention_rate"), F.col("mention_rate"))
    return panel.groupBy(*by).agg(F.avg(usable).alias("mention_rate"))


def duplicate_keys(panel: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    """Keys that occur more than once, with their number of rows; empty for a proper panel."""
    return panel.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(panel: DataFrame, keys: Sequence[str] = PANEL_KEYS) -> DataFrame:
    if not duplicate_keys(panel, keys).isEmpty():
        raise ValueError(f"{', '.join(keys)} do not identify the rows")
    return panel
