import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from mentiongrid.functions.interval import beta_cdf, beta_ppf, binomial_interval, clamp_interval, interval_bounds, normalized
from mentiongrid.operators.reports import blank_ambiguous, join_attributes, map_report, population, series_report, with_names

PANEL = "disease string, year int, month int, cbscode int, mention_rate double, n_location bigint, n_both bigint"


def integrated_cdf(x, a, b, steps=400_000):
    """Beta CDF by the midpoint rule after substituting t = u^2 (a >= 1/2)."""
    u = (np.arange(steps) + 0.5) / steps * math.sqrt(x)
    density = 2 * u ** (2 * a - 1) * (1 - u * u) ** (b - 1)
    return density.sum() * math.sqrt(x) / steps * math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))


@pytest.mark.parametrize("s, n", [(0, 10), (1, 3), (5, 10), (10, 10), (3, 1000), (0, 0)])
def test_quantiles_invert_an_independent_cdf(s, n):
    a, b = s + 0.5, n - s + 0.5
    for prob in (0.025, 0.5, 0.975):
        x = float(beta_ppf(prob, np.array([a]), np.array([b]))[0])
        if x < 0.999:
            assert integrated_cdf(x, a, b) == pytest.approx(prob, abs=2e-3 if b < 1 else 1e-5)
        assert float(beta_cdf(np.array([x]), np.array([a]), np.array([b]))[0]) == pytest.approx(prob, abs=1e-10)


def test_published_values():
    lower, upper = interval_bounds([0, 5], [10, 10])[0]
    assert upper == pytest.approx(0.217196, abs=1e-6) and 0 < lower < 1e-4
    low, high = interval_bounds([5], [10])[0]
    assert low == pytest.approx(1 - high, abs=1e-12)  # symmetric around 1/2
    arcsine = interval_bounds([0], [0])[0]  # Beta(1/2, 1/2) has a closed form
    assert arcsine == pytest.approx([math.sin(math.pi * p / 2) ** 2 for p in (0.025, 0.975)], abs=1e-9)


def test_large_counts_and_impossible_input():
    bounds = interval_bounds([100_000, 5, np.nan, -1], [2_000_000, 3, 1, 1])
    se = math.sqrt(0.05 * 0.95 / 2e6)
    assert bounds[0] == pytest.approx([0.05 - 1.96 * se, 0.05 + 1.96 * se], rel=1e-4)
    assert np.isnan(bounds[1:]).all()


def test_variants_and_coverage(spark):
    df = spark.createDataFrame([(0, 0), (0, 10), (10, 10), (3, 7), (None, 4)], "s bigint, n bigint")
    textbook = {(r.s, r.n): r for r in binomial_interval(df, "s", "n").collect()}
    reference = {(r.s, r.n): r for r in binomial_interval(df, "s", "n", variant="reference").collect()}
    narrow = {(r.s, r.n): r for r in binomial_interval(df, "s", "n", coverage=0.5).collect()}
    assert textbook[(0, 10)].upper == reference[(0, 10)].upper  # the same distribution without successes
    assert reference[(10, 10)].upper < textbook[(10, 10)].upper
    assert textbook[(3, 7)].lower < narrow[(3, 7)].lower < 3 / 7 < narrow[(3, 7)].upper < textbook[(3, 7)].upper
    assert textbook[(None, 4)].lower is None and textbook[(None, 4)].upper is None
    with pytest.raises(ValueError):
        binomial_interval(df, "s", "n", variant="x")


def test_clamping(spark):
    rows = [(0, 0.0, 0.1, 0.2), (1, 1.0, 0.9, 0.95), (1, 0.5, 0.6, 0.7), (1, 0.5, 0.3, 0.4), (0, float("nan"), 0.1, 0.9), (1, float("nan"), 0.1, 0.9)]
    df = spark.createDataFrame(rows, "s bigint, rate double, lower double, upper double")
    got = [(r.lower, r.upper) for r in clamp_interval(df, "s", "rate").collect()]
    assert got[:4] == [(0.0, 0.2), (0.9, 1.0), (0.5, 0.7), (0.3, 0.5)]
    assert got[4][0] == 0.0 and math.isnan(got[4][1]) and got[5][0] == 0.1 and math.isnan(got[5][1])
    zero = spark.range(1).select(normalized(F.lit(0), F.lit(0)).alias("r")).first().r
    assert math.isnan(zero)


@pytest.fixture(scope="module")
def panel(spark):
    rows = [(d, y, m, c, 0.5 if c == 1 else 0.0, 2 if c == 1 else 0, 1 if c == 1 else 0) for d in ("cholera", "smallpox", "typhus") for y in (1864, 1865) for m in (1, 2) for c in (1, 2, 3)]
    return spark.createDataFrame(rows, PANEL)


def test_reports(spark, panel):
    names = spark.createDataFrame([("Amsterdam", 1), ("Sluis", 2)], "location string, cbscode int")
    series = series_report(panel, names, ["Amsterdam", "Sluis"], ["cholera", "smallpox"]).collect()
    assert len(series) == 16 and {r.location for r in series} == {"Amsterdam", "Sluis"}
    inside = [r for r in series if r.cbscode == 1]
    assert all(r.lower <= r.normalized_mentions <= r.upper and r.date.day == 1 for r in inside)
    assert all(math.isnan(r.normalized_mentions) and r.lower == 0 for r in series if r.cbscode == 2)
    by_place = {(r.cbscode, r.year): (r.mention_rate, r.location) for r in map_report(panel, names, "cholera", 1864, 1864).collect()}
    assert by_place == {(1, 1864): (0.5, "Amsterdam"), (2, 1864): (0.0, "Sluis"), (3, 1864): (0.0, None)}
    blanked = blank_ambiguous(with_names(panel, names), "location", "n_both").collect()
    assert all((r.n_both is None) == (r.location == "Sluis") for r in blanked)


def test_attribute_joins(spark):
    base = spark.createDataFrame([(1, "a"), (2, None)], "code int, name string")
    other = spark.createDataFrame([("1", "x", 7), ("2", "y", 8)], "code string, name string, n int")
    assert sorted(tuple(r) for r in join_attributes(base, other, "code").select("code", "name", "n").collect()) == [("1", "a", 7), ("2", "y", 8)]
    men = spark.createDataFrame([(1, 5.0), (2, 9.0)], "amsterdamcode int, pop_m double")
    women = spark.createDataFrame([(1, 6.0)], "amsterdamcode int, pop_f double")
    assert [(r.amsterdamcode, r["pop"]) for r in population(men, women).collect()] == [(1, 11.0), (2, None)]
