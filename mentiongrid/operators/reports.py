"""Tables behind the published figures and maps."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentiongrid.fixed_values import AMBIGUOUS_PLACES
from mentiongrid.functions.interval import binomial_interval, clamp_interval, normalized
from mentiongrid.operators.panel import mean_rate
from mentiongrid.operators.series import impute_group_mean
from mentiongrid.session import materialise


def with_names(panel: DataFrame, names: DataFrame, key: str = "cbscode") -> DataFrame:
    """Attach place attributes; clashing columns of `names` are dropped, the panel's win."""
    extra = [c for c in names.columns if c != key and c not in panel.columns]
    return panel.join(names.select(key, *extra), key, "left")


def join_attributes(base: DataFrame, other: DataFrame, key: str, key_type: str = "string") -> DataFrame:
    """Left join on a key stored with different types; a shared column comes from `base`, else from `other`."""
    shared = [c for c in other.columns if c != key and c in base.columns]
    left = base.withColumn(key, F.col(key).cast(key_type))
    right = other.withColumn(key, F.col(key).cast(key_type)).withColumnsRenamed({c: f"_other_{c}" for c in shared})
    joined = left.join(right, key, "left")
    repaired = {c: F.coalesce(F.col(c), F.col(f"_other_{c}")) for c in shared}
    return joined.withColumns(repaired).drop(*(f"_other_{c}" for c in shared)) if shared else joined


def month_date(year: Column | str = "year", month: Column | str = "month") -> Column:
    return F.make_date(year, month, F.lit(1))


def series_report(
    panel: DataFrame, names: DataFrame, locations: Sequence[str], diseases: Sequence[str],
    coverage: float = 0.95, variant: str = "reference",
) -> DataFrame:
    """Monthly rates with intervals for a few places and topics."""
    named = names.filter(F.col("location").isin(*locations))
    rows = with_names(panel.filter(F.col("disease").isin(*diseases)), named).filter(F.col("location").isNotNull())
    rows = rows.withColumns({
        "date": month_date(),
        "normalized_mentions": normalized(F.col("n_both"), F.col("n_location")),
    })
    bounded = binomial_interval(rows, "n_both", "n_location", coverage, variant)
    return clamp_interval(bounded, "n_both", "normalized_mentions")


def map_report(panel: DataFrame, names: DataFrame, disease: str, first_year: int, last_year: int) -> DataFrame:
    """Mean rate per place and year of one topic, with the place's attributes."""
    chosen = panel.filter(F.col("year").between(first_year, last_year) & (F.col("disease") == disease))
    return with_names(mean_rate(chosen), names)


MAP_COLUMNS = ("n_both", "n_location", "lower", "upper", "width")


def uncertainty_map(
    counts: DataFrame, places: DataFrame, years: Sequence[int], most_mentions: int = 2500,
    coverage: float = 0.95, variant: str = "textbook", key: str = "cbscode",
) -> DataFrame:
    """Every place in every year with counts, interval and its width, as drawn on maps with their uncertainty.

    `counts` is (year, key, n_location, n_both) of one topic, at most one row per place and year. Places with `most_mentions` or
    more are left out of it, as their names are ambiguous. What is missing then is filled with the mean of the year's places.
    """
    known = counts.filter((F.col("n_location") < most_mentions) & F.col("year").isin(*years))
    known = binomial_interval(known.select("year", key, "n_both", "n_location"), "n_both", "n_location", coverage, variant)
    grid = places.withColumn("year", F.explode(F.array(*(F.lit(y) for y in years))))
    joined = grid.join(known.withColumn("width", F.col("upper") - F.col("lower")), ["year", key], "left")
    # A few rows per place that are read twice, for the means and to be filled with them.
    rows = materialise(joined.withColumns({c: F.col(c).cast("double") for c in MAP_COLUMNS}), "map-rows")
    filled = impute_group_mean(rows, ["year"], list(MAP_COLUMNS))
    return filled.withColumn("mention_rate", normalized(F.col("n_both"), F.col("n_location")))


def blank_ambiguous(df: DataFrame, name: str, column: str, pattern: str = AMBIGUOUS_PLACES) -> DataFrame:
    """NULL instead of counts for places whose name is also an ordinary word."""
    return df.withColumn(column, F.when(~F.coalesce(F.col(name).rlike(pattern), F.lit(False)), F.col(column)))


def population(men: DataFrame, women: DataFrame, key: str = "amsterdamcode") -> DataFrame:
    """Population by place from the two sexes' tables, largest first."""
    joined = men.join(women, key, "left")
    return joined.withColumn("pop", F.col("pop_m") + F.col("pop_f")).orderBy(F.desc("pop"), key)
