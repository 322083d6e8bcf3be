r"""URL filters by a temporal join with dated lists, in DataFrame functions only.

A list is a log of dated entries (pattern, category, action, since): `add` makes a pattern active from that
day on, `remove` ends it. `intervals` turns the log into validity intervals; `evaluate` checks every
capture (url, fetched) against the entries active on its day.

A pattern is a host (`sub.example.org`), which also covers its subdomains, or a host with a leading path
(`example.org/a/b`), which covers whole path segments. A capture has one key for each pattern that could
cover it, from its host without subdomains to its whole path, so matching is by equality. The as-of
condition is an interval overlap. So that a key with many captures and many intervals is not compared
crosswise, intervals are cut at fixed periods of `period_days`, and captures and pieces meet on (key, period).

The longest active pattern of a capture decides; among equal patterns the category first in code-point order.
A category in `allowing` lets the capture pass, any other blocks it.

Defined results: entries without pattern, action or date are ignored; of several on one day for a
pattern and category `add` wins. A capture without url or date matches nothing and passes. Scheme, port, user
part, query and fragment are ignored, case of the host too. Repeated captures get equal results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mentiongrid.llm.common import table

PERIOD_DAYS = 90
#: Labels of a host and segments of a path that become keys; deeper ones are part of no pattern.
DEPTH = 8


def host_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)", 1)


def keys_of(url: Column) -> Column:
    """The patterns that could cover a url, shortest host first, longest path last."""
    labels = F.split(host_of(url), r"\.")
    n = F.size(labels)
    hosts = F.transform(F.sequence(F.lit(1), n), lambda k: F.array_join(F.slice(labels, n - k + 1, k), "."))
    segments = F.filter(F.split(path_of(url), "/"), lambda s: s != "")
    paths = F.transform(
        F.when(F.size(segments) > 0, F.sequence(F.lit(1), F.size(segments))).otherwise(F.array().cast("array<int>")),
        lambda k: F.concat_ws("/", host_of(url), F.array_join(F.slice(segments, F.lit(1), k), "/")),
    )
    return F.when(host_of(url) != "", F.concat(hosts, paths)).otherwise(F.array().cast("array<string>"))


def intervals(entries: DataFrame) -> DataFrame:
    """(pattern, category, starts, ends): active from `starts` to before `ends`, null if still active.

    A pattern's entries of one day are combined first, so a window holds one row per day.
    """
    usable = entries.where("pattern is not null and action in ('add', 'remove') and since is not null")
    daily = usable.groupBy("pattern", "category", "since").agg(F.bool_or(F.col("action") == "add").alias("active"))
    following = Window.partitionBy("pattern", "category").orderBy("since")
    spans = daily.select("pattern", "category", "active", F.col("since").alias("starts"), F.lead("since").over(following).alias("ends"))
    return spans.where("active").drop("active")


def _period(day: Column, period_days: int) -> Column:
    return F.floor(F.unix_date(day) / period_days).cast("int")


def evaluate(captures: DataFrame, spans: DataFrame, allowing=("allow",), period_days: int = PERIOD_DAYS) -> DataFrame:
    """(capture_id, blocked, pattern, category, active_since, n_active), one row per row (capture_id, url, fetched)."""
    captures = captures.select("capture_id", "url", "fetched")
    # Identical captures are evaluated once.
    distinct = captures.distinct()
    last = distinct.select(F.max("fetched")).scalar()
    keyed = distinct.where("url is not null and fetched is not null").select(
        "capture_id", "url", "fetched", _period(F.col("fetched"), period_days).alias("period"), F.explode(keys_of(F.col("url"))).alias("pattern")
    )
    # A piece per period up to the last capture: intervals that start later meet none.
    until = F.least(F.coalesce(F.date_sub("ends", 1), last), last)
    pieces = spans.where(F.col("starts") <= last).select(
        "pattern", "category", "starts", "ends",
        F.explode(F.sequence(_period(F.col("starts"), period_days), _period(F.greatest("starts", until), period_days))).alias("period"),
    )
    active = keyed.join(pieces, ["pattern", "period"]).where((F.col("fetched") >= F.col("starts")) & (F.col("ends").isNull() | (F.col("fetched") < F.col("ends"))))
    longest = F.min(F.struct((-F.length("pattern")).alias("rank"), "category", "pattern", "starts"))
    verdicts = active.groupBy("capture_id", "url", "fetched").agg(longest.alias("best"), F.count("*").alias("n_active"))
    c, v = captures.alias("c"), verdicts.alias("v")
    same = (F.col("c.capture_id").eqNullSafe(F.col("v.capture_id"))) & (F.col("c.url") == F.col("v.url")) & (F.col("c.fetched") == F.col("v.fetched"))
    category = F.col("v.best.category")
    blocked = F.col("v.best").isNotNull() & ~F.coalesce(category.isin(*allowing), F.lit(False))
    return c.join(v, same, "left").select(
        "c.capture_id", blocked.alias("blocked"), F.col("v.best.pattern").alias("pattern"), category.alias("category"),
        F.col("v.best.starts").alias("active_since"), F.coalesce("v.n_active", F.lit(0).cast("long")).alias("n_active"),
    )


# The pages table has neither fetch days nor lists, so both are derived from it: the day from
# page_id, the entries from the MD5 digests of the hosts, parent domains and first path segments it has.
_FIRST_DAY, _DAYS = "2020-01-01", 1461


def captures_of_pages(pages: DataFrame) -> DataFrame:
    day = F.date_add(F.lit(_FIRST_DAY).cast("date"), F.pmod(F.pmod("page_id", F.lit(_DAYS)) * 37, F.lit(_DAYS)).cast("int"))
    return pages.select(F.col("page_id").alias("capture_id"), "url", day.alias("fetched"))


def _hex(digest: Column, place: int) -> Column:
    """The value of one hexadecimal digit."""
    return F.conv(F.substring(digest, place, 1), 16, 10).cast("int")


def entries_of_pages(pages: DataFrame) -> DataFrame:
    """Entries (pattern, category, action, since) for about half of the patterns of the pages."""
    patterns = pages.where("url is not null").select(F.explode(F.slice(keys_of(F.col("url")), 1, DEPTH)).alias("pattern")).distinct()
    hashed = patterns.select("pattern", F.md5(F.col("pattern").cast("binary")).alias("m")).where(_hex(F.col("m"), 1) < 8)
    category = F.when(_hex(F.col("m"), 2) < 4, "allow").when(_hex(F.col("m"), 2) < 9, "adult").otherwise("spam")
    day = F.date_add(F.lit(_FIRST_DAY).cast("date"), (_hex(F.col("m"), 3) * 16 + _hex(F.col("m"), 4)) * 5)

    def entry(action: str, days: int, wanted: Column) -> Column:
        return F.when(wanted, F.struct(F.lit(action).alias("action"), F.date_add(day, days).alias("since")))

    always, later = F.lit(True), _hex(F.col("m"), 5) < 12
    events = F.array(entry("add", 0, always), entry("remove", 200, later), entry("add", 320, _hex(F.col("m"), 5) < 6))
    listed = hashed.select("pattern", category.alias("category"), F.explode(F.array_compact(events)).alias("e"))
    return listed.select("pattern", "category", "e.action", "e.since")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    found = evaluate(captures_of_pages(pages), intervals(entries_of_pages(pages)))
    return found.withColumnRenamed("capture_id", "page_id")


def _digit(place: int) -> str:
    return f"(strpos('0123456789abcdef', substr(m, {place}, 1)) - 1)"


OP5_SQL = f"""
WITH parts AS (
  SELECT row_number() OVER () AS row_id, page_id, url,
         DATE '{_FIRST_DAY}' + CAST((((page_id % {_DAYS}) + {_DAYS}) % {_DAYS} * 37) % {_DAYS} AS INTEGER) AS fetched,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^?#]*)', 1) AS path
  FROM pages),
split AS (
  SELECT *, string_split(host, '.') AS labels, list_filter(string_split(path, '/'), lambda s: s <> '') AS segments
  FROM parts WHERE host <> ''),
keyed AS (
  SELECT row_id, page_id, url, fetched, array_to_string(labels[len(labels) - k + 1:], '.') AS pattern, k AS place
  FROM split, unnest(range(1, len(labels) + 1)) AS r(k)
  UNION ALL
  SELECT row_id, page_id, url, fetched, host || '/' || array_to_string(segments[1:k], '/') AS pattern, len(labels) + k AS place
  FROM split, unnest(range(1, len(segments) + 1)) AS r(k)),
hashed AS (SELECT DISTINCT pattern, md5(pattern) AS m FROM keyed WHERE place <= {DEPTH}),
listed AS (
  SELECT pattern, m,
         CASE WHEN {_digit(2)} < 4 THEN 'allow' WHEN {_digit(2)} < 9 THEN 'adult' ELSE 'spam' END AS category,
         DATE '{_FIRST_DAY}' + CAST(({_digit(3)} * 16 + {_digit(4)}) * 5 AS INTEGER) AS day
  FROM hashed WHERE {_digit(1)} < 8),
spans AS (
  SELECT pattern, category, day AS starts, CASE WHEN {_digit(5)} < 12 THEN day + 200 END AS ends FROM listed
  UNION ALL
  SELECT pattern, category, day + 320, NULL FROM listed WHERE {_digit(5)} < 6),
active AS (
  SELECT k.row_id, k.pattern, s.category, s.starts,
         row_number() OVER (PARTITION BY k.row_id ORDER BY length(k.pattern) DESC, s.category) AS n,
         count(*) OVER (PARTITION BY k.row_id) AS n_active
  FROM keyed k JOIN spans s ON k.pattern = s.pattern AND k.fetched >= s.starts AND (s.ends IS NULL OR k.fetched < s.ends))
SELECT p.page_id, a.pattern IS NOT NULL AND a.category <> 'allow' AS blocked, a.pattern, a.category,
       a.starts AS active_since, CAST(coalesce(a.n_active, 0) AS BIGINT) AS n_active
FROM parts p LEFT JOIN (SELECT * FROM active WHERE n = 1) a USING (row_id)"""

QUERIES = {"op5_url_filter": op5_url_filter}
SQL = {"op5_url_filter": OP5_SQL}
