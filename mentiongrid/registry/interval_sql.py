"""The interval in SQL, from another formula than the operator's.

At half-integer parameters the beta distribution function is a finite sum that starts from the arcsine
law; its quantiles follow by bisection over the distinct counts.
"""

from __future__ import annotations

_CDF = """2 / pi() * asin(sqrt(x))
  - coalesce(list_sum(list_transform(range(0, s), lambda k:
      exp((k + 0.5) * ln(x) + 0.5 * ln(1 - x) + lgamma(k + 1) - lgamma(k + 0.5) - lgamma(0.5)) / (k + 0.5))), 0)
  + coalesce(list_sum(list_transform(range(0, f), lambda j:
      exp((s + 0.5) * ln(x) + (j + 0.5) * ln(1 - x) + lgamma(s + j + 1) - lgamma(s + 0.5) - lgamma(j + 0.5)) / (j + 0.5))), 0)"""


def with_interval(base_sql: str, columns: str, variant: str, lower: str = "lower", upper: str = "upper", digits: int = 6) -> str:
    """`base_sql` has n_both and n_location; `lower` and `upper` are expressions of the bounds."""
    misses = "n_location" if variant == "reference" else "n_location - n_both"
    return f"""WITH RECURSIVE base AS ({base_sql}),
counts AS (SELECT DISTINCT CAST(n_both AS BIGINT) AS s, CAST({misses} AS BIGINT) AS f FROM base WHERE n_both >= 0 AND {misses} >= 0),
bisect(s, f, p, low, high, step) AS (
  SELECT s, f, p, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE), 0 FROM counts, (VALUES (CAST(0.025 AS DOUBLE)), (CAST(0.975 AS DOUBLE))) AS tails(p)
  UNION ALL
  SELECT s, f, p, CASE WHEN reached < p THEN x ELSE low END, CASE WHEN reached < p THEN high ELSE x END, step + 1
  FROM (SELECT *, {_CDF} AS reached FROM (SELECT *, (low + high) / 2 AS x FROM bisect WHERE step < 48))),
bounds AS (
  SELECT s, f, MAX(low) FILTER (WHERE p < 0.5) AS lower, MAX(low) FILTER (WHERE p > 0.5) AS upper FROM bisect WHERE step = 48 GROUP BY s, f)
SELECT {columns}, round({lower}, {digits}) AS lower, round({upper}, {digits}) AS upper
FROM base LEFT JOIN bounds ON s = n_both AND f = {misses}"""
