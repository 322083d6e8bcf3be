"""Binomial (Jeffreys) intervals as quantiles of a beta distribution."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_lgamma = np.frompyfunc(math.lgamma, 1, 1)


def _log_gamma(x: np.ndarray) -> np.ndarray:
    return _lgamma(x).astype(float)


def _beta_fraction(a, b, x, eps=1e-15, max_steps=20_000):
    """Continued fraction of the incomplete beta function (modified Lentz), vectorised."""
    tiny = 1e-300
    c = np.ones_like(x)
    d = 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
    result = d.copy()
    active = np.ones(x.shape, bool)
    for m in range(1, max_steps):
        for numerator in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + numerator * d
            d = 1.0 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1.0 + numerator / np.where(np.abs(c) < tiny, tiny, c)
            step = np.where(active, c * d, 1.0)
            result = result * step
        active &= np.abs(step - 1.0) > eps
        if not active.any():
            break
    return result


def beta_cdf(x, a, b, log_norm=None):
    """Regularised incomplete beta function for arrays, 0 < x < 1; `log_norm` is the logarithm of 1 / B(a, b)."""
    x, a, b = (np.asarray(v, float) for v in (x, a, b))
    if log_norm is None:
        log_norm = _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
    swap = x > (a + 1.0) / (a + b + 2.0)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1.0 - x, x)
    front = np.exp(log_norm + p * np.log(y) + q * np.log1p(-y)) / p
    value = front * _beta_fraction(p, q, y)
    return np.where(swap, 1.0 - value, value)


def beta_ppf(prob: float, a, b):
    """Quantile of Beta(a, b): Newton steps kept inside a shrinking bracket."""
    a, b = np.asarray(a, float), np.asarray(b, float)
    low, high = np.zeros_like(a), np.ones_like(a)
    x = np.clip(a / (a + b), 1e-12, 1 - 1e-12)
    log_norm = _log_gamma(a + b) - _log_gamma(a) - _log_gamma(b)
    for _ in range(200):
        error = beta_cdf(x, a, b, log_norm) - prob
        low, high = np.where(error < 0, x, low), np.where(error < 0, high, x)
        density = np.exp(log_norm + (a - 1) * np.log(x) + (b - 1) * np.log1p(-x))
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            newton = x - error / density
        inside = (newton > low) & (newton < high)
        following = np.where(inside, newton, (low + high) / 2)
        done = np.abs(following - x) <= 1e-14 * np.maximum(x, 1e-300)
        x = following
        if done.all():
            break
    return x


def interval_bounds(successes, tries, coverage: float = 0.95, variant: str = "textbook"):
    """Lower and upper bound per (successes, tries); NaN where either is missing or impossible.

    Each distinct pair is computed once: counts repeat a lot.
    """
    pairs = np.column_stack([np.asarray(successes, float), np.asarray(tries, float)])
    unique, inverse = np.unique(pairs, axis=0, return_inverse=True)
    inverse = np.asarray(inverse).reshape(-1)
    s, n = unique[:, 0], unique[:, 1]
    a = s + 0.5
    b = (n if variant == "reference" else n - s) + 0.5
    valid = (a > 0) & (b > 0) & np.isfinite(a) & np.isfinite(b)
    bounds = np.full((len(unique), 2), np.nan)
    tail = (1.0 - coverage) / 2.0
    if valid.any():
        bounds[valid, 0] = beta_ppf(tail, a[valid], b[valid])
        bounds[valid, 1] = beta_ppf(1.0 - tail, a[valid], b[valid])
    return bounds[inverse]


def binomial_interval(
    df: DataFrame, successes: str, tries: str, coverage: float = 0.95, variant: str = "textbook"
) -> DataFrame:
    """Add `lower` and `upper` of the Jeffreys interval; NULL for missing or impossible counts.

    `variant="textbook"` uses Beta(s + 1/2, n - s + 1/2); `variant="reference"` uses
    Beta(s + 1/2, n + 1/2), the form behind the published tables.
    """
    if variant not in ("textbook", "reference"):
        raise ValueError("variant must be 'textbook' or 'reference'")

    @F.pandas_udf("lower double, upper double")
    def bounds(s: pd.Series, n: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(interval_bounds(s, n, coverage, variant), columns=["lower", "upper"])

    computed = df.withColumn("_bounds", bounds(F.col(successes).cast("double"), F.col(tries).cast("double")))
    return computed.withColumns({"lower": F.col("_bounds.lower"), "upper": F.col("_bounds.upper")}).drop("_bounds")


def normalized(n_both: Column, n_location: Column) -> Column:
    """`n_both / n_location`, NaN where nothing was counted."""
    return F.when(n_location == 0, F.lit(float("nan"))).otherwise(n_both / n_location)


def clamp_interval(df: DataFrame, successes: str, mean: str) -> DataFrame:
    """Make `lower` and `upper` enclose the observed rate and reach 0 and 1 at the extremes.

    A NaN rate counts as larger than every number, so it replaces the upper bound only.
    """
    observed = F.col(mean)
    lower = F.when(F.col(successes) == 0, F.lit(0.0)).otherwise(F.least("lower", observed))
    upper = F.when(observed == 1, F.lit(1.0)).otherwise(F.greatest("upper", observed))
    return df.withColumns({"lower": lower, "upper": upper})
