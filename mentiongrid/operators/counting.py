"""Mention counts: all place x topic pairs in one pass, and single pairs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mentiongrid.functions.patterns import fold_case, near_pattern
from mentiongrid.operators.dictionary import Term, compile_term
from mentiongrid.operators.matching import mention, with_folded
from mentiongrid.operators.term_index import TermIndex, id_list, mentions
from mentiongrid.session import materialise

TEXT = "article_text"
DATE = "newspaper_date"


def in_years(date: Column | str, start: int, end: int) -> Column:
    """Half-open range [start, end) of years as a range on the date itself, so that scans can prune."""
    date = F.col(date) if isinstance(date, str) else date
    return (date >= F.make_date(F.lit(start), F.lit(1), F.lit(1))) & (date < F.make_date(F.lit(end), F.lit(1), F.lit(1)))


def of_years(articles: DataFrame, start: int | None, end: int | None, date: str = DATE) -> DataFrame:
    """The articles of the years [start, end), or all without bounds.

    Where the articles are stored by `year`, the same range on that column skips whole
    partitions; the range on the date lets the remaining files skip row groups.
    """
    if start is None or end is None:
        return articles
    if "year" in articles.columns:
        articles = articles.filter((F.col("year") >= start) & (F.col("year") < end))
    return articles.filter(in_years(date, start, end))


def with_year_month(df: DataFrame, date: str = DATE, year: str = "year", month: str = "month") -> DataFrame:
    return df.withColumns({year: F.year(date), month: F.month(date)})


def mention_counts(
    articles: DataFrame,
    places: list[Term],
    topics: list[Term],
    by: Sequence[str] = ("year", "month"),
    max_chars: int = 0,
    text: str = TEXT,
    unicode_case: bool = False,
) -> DataFrame:
    """(place_id, *by, topic_id, n_location, n_both) for every place seen and every topic.

    A row exists for each topic wherever the place is mentioned at all, also with
    `n_both = 0`. With `max_chars` > 0 the two mentions must lie that close together.

    Rows with equal topics are counted first; only these counts are spread over all topics. So what is
    shuffled is reduced before, whatever share of all articles a place or month holds.
    """
    by = list(by)
    index = TermIndex.of(places, topics, unicode_case=unicode_case)
    found = mentions(articles.where(F.col(text).isNotNull()), index, text, by, max_chars)
    here = found.select(*by, _numbers("_terms", len(places)).alias("_places"), "_near" if max_chars else index.ids("_terms", 1).alias("topic_ids"))
    if max_chars:
        hits = here.select(*by, F.explode(F.arrays_zip("_places", "_near")).alias("_hit"))
        hits = hits.select(*by, F.col("_hit._places").alias("_place"), index.ids("_hit._near", 1).alias("topic_ids"))
    else:
        hits = here.select(*by, "topic_ids", F.explode("_places").alias("_place"))
    alike = hits.groupBy("_place", *by, "topic_ids").agg(F.count(F.lit(1)).alias("n"))
    spread = alike.select("*", F.explode(id_list([t.id for t in topics])).alias("topic_id"))
    both = F.sum(F.when(F.array_contains("topic_ids", F.col("topic_id")), F.col("n")).otherwise(0))
    counts = spread.groupBy("_place", *by, "topic_id").agg(F.sum("n").alias("n_location"), both.alias("n_both"))
    place_id = F.get(id_list([t.id for t in places]), F.col("_place")) if places else F.col("_place")
    return counts.select(place_id.alias("place_id"), *by, "topic_id", "n_location", "n_both")


def _numbers(terms: str, n_places: int) -> Column:
    """The numbers of places among those of all terms."""
    return F.filter(terms, lambda n: n < n_places)


def database_rows(counts: DataFrame, places: DataFrame, topics: DataFrame) -> DataFrame:
    """Attach dictionary attributes to `mention_counts` rows: the flat table.

    `places` is (place_id, location, cbscode, amsterdamcode), `topics` (topic_id, disease).
    """
    return (
        counts.join(places, "place_id").join(topics, "topic_id")
        .select("year", "month", "n_location", "n_both", "location", "cbscode", "amsterdamcode", F.lower("disease").alias("disease"))
    )


def with_pair_flags(
    articles: DataFrame, disease: str, location: str, max_chars: int = 0, text: str = TEXT, unicode_case: bool = True
) -> DataFrame:
    """Replace the text by the flags `disease`, `location` and `both` of one term pair.

    `both` is the AND of the flags, or with `max_chars` whether the two are that close.
    """
    topic, place = (compile_term(r, unicode_case=unicode_case) for r in (disease, location))
    folded = articles.withColumn("_folded", fold_case(F.col(text), unicode_case))
    kept = [c for c in articles.columns if c != text]
    flags = folded.select(
        *kept, text,
        mention(text, topic, F.col("_folded")).alias("disease"),
        mention(text, place, F.col("_folded")).alias("location"),
    )
    both = F.col("disease") & F.col("location")
    if max_chars:
        both = both & F.col(text).rlike(near_pattern(disease, location, max_chars, unicode_case))
    return flags.select(*kept, "disease", "location", both.alias("both"))


def _second_flag(articles: DataFrame, disease: str, location: str, max_chars: int, text: str, unicode_case: bool) -> DataFrame:
    """`both` for articles that mention the place: the topic, or with `max_chars` the two that close together."""
    folded = with_folded(articles, text, unicode_case)
    both = mention(text, compile_term(disease, unicode_case=unicode_case), F.col("_folded"))
    if max_chars:
        both = both & F.col(text).rlike(near_pattern(disease, location, max_chars, unicode_case))
    return folded.select(*(c for c in articles.columns if c != text), both.alias("both"))


def pair_counts(
    articles: DataFrame,
    disease: str,
    location: str,
    start: int | None = None,
    end: int | None = None,
    by: Sequence[str] = ("yr", "mo"),
    denominator: str = "total",
    max_chars: int = 0,
    unicode_case: bool = True,
    text: str = TEXT,
    date: str = DATE,
) -> DataFrame:
    """Counts of one term pair, by month, by year or (with `by=()`) over everything.

    `denominator="total"` counts all articles of the period and adds `n_total`;
    `denominator="location"` looks only at articles that mention the place.
    """
    if denominator not in ("total", "location"):
        raise ValueError("denominator must be 'total' or 'location'")
    dated = with_year_month(of_years(articles, start, end, date).select(date, text), date, "yr", "mo")
    if denominator == "location":
        # The place comes first: the topic is sought only where it is mentioned.
        folded = with_folded(dated, text, unicode_case)
        dated = folded.filter(mention(text, compile_term(location, unicode_case=unicode_case), F.col("_folded"))).drop("_folded")
        both = _second_flag(dated, disease, location, max_chars, text, unicode_case)
        counts = both.groupBy(*by).agg(F.count(F.lit(1)).alias("n_location"), F.count_if("both").alias("n_both"))
        return counts
    flags = with_pair_flags(dated, disease, location, max_chars, text, unicode_case)
    counters = [
        F.count_if("disease").alias("n_disease"),
        F.count_if("location").alias("n_location"),
        F.count_if("both").alias("n_both"),
    ]
    return flags.groupBy(*by).agg(F.count(F.lit(1)).alias("n_total"), *counters)


def pair_set_counts(
    articles: DataFrame,
    pairs: Sequence[tuple[str, str, str]],
    start: int | None = None,
    end: int | None = None,
    by: Sequence[str] = ("yr", "mo"),
    unicode_case: bool = True,
    text: str = TEXT,
    date: str = DATE,
) -> DataFrame:
    """`pair_counts` for many (label, disease, location) pairs, reading every text once.

    A pattern that several pairs share is tested once per article.
    """
    dated = with_year_month(of_years(articles, start, end, date).select(date, text), date, "yr", "mo")
    folded = dated.withColumn("_folded", fold_case(F.col(text), unicode_case))
    names = {regex: f"p{i}" for i, regex in enumerate(dict.fromkeys(r for _, *regexes in pairs for r in regexes))}
    flags = folded.select(*by, *(
        mention(text, compile_term(regex, unicode_case=unicode_case), F.col("_folded")).alias(name)
        for regex, name in names.items()
    ))
    both = {(names[d], names[p]) for _, d, p in pairs}
    counts = flags.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        *(F.count_if(name).alias(name) for name in names.values()),
        *(F.count_if(F.col(d) & F.col(p)).alias(f"{d}_{p}") for d, p in both),
    )
    per_pair = F.array(*(
        F.struct(
            F.lit(label).alias("label"), "n_total", F.col(names[d]).alias("n_disease"),
            F.col(names[p]).alias("n_location"), F.col(f"{names[d]}_{names[p]}").alias("n_both"),
        )
        for label, d, p in pairs
    ))
    return counts.select(*by, F.inline(per_pair))


def place_counts(
    articles: DataFrame,
    places: list[Term],
    topic: Term,
    by: Sequence[str] = ("year", "month"),
    max_chars: int = 0,
    text: str = TEXT,
    unicode_case: bool = True,
) -> DataFrame:
    """(place_id, *by, n_total, n_disease, n_location, n_both) for every place and every period.

    The index tells of every text its places and whether it has the topic; a row per period and number
    of the place, from -1 for all articles, is counted from that. The grid of all places and
    periods is built from numbers and joined to the counts, so a place without a mention has its zeros.
    """
    by = list(by)
    index = TermIndex.of(places, [topic], unicode_case=unicode_case)
    found = mentions(articles, index, text, by, max_chars)
    has_topic = F.array_contains("_terms", F.lit(len(places)))
    here = _numbers("_terms", len(places))
    close = F.filter(here, lambda n, i: F.size(F.get("_near", i)) > 0) if max_chars else F.when(has_topic, here)
    rows = found.select(*by, has_topic.alias("topic"), close.alias("close"), F.explode(F.concat(F.array(F.lit(-1)), here)).alias("_place"))
    both = F.when(F.col("_place") < 0, F.col("topic")).otherwise(F.coalesce(F.array_contains("close", F.col("_place")), F.lit(False)))
    counts = rows.groupBy("_place", *by).agg(F.count(F.lit(1)).alias("n"), F.count_if(both).alias("m"))
    totals = F.struct(*by, F.col("n").alias("n_total"), F.col("m").alias("n_disease"))
    return _dense(counts, places, totals, by)


def _dense(counts: DataFrame, places: list[Term], totals: Column, by: list[str]) -> DataFrame:
    """Counts of every place (by number) in every period, zeros included."""
    spark = counts.sparkSession
    counts = materialise(counts, "place-counts")  # read for the periods and for the places
    if by:
        listed = F.collect_list(totals)  # as many as there are periods
    else:
        listed = F.array(F.struct(F.coalesce(F.sum("n"), F.lit(0)).alias("n_total"), F.coalesce(F.sum("m"), F.lit(0)).alias("n_disease")))
    periods = counts.where("_place < 0").agg(listed.alias("p"))
    grid = spark.range(len(places)).withColumn("p", periods.scalar()).select(F.col("id").cast("int").alias("_place"), F.inline("p"))
    here = counts.where("_place >= 0").select(F.col("_place").alias("_here"), *(F.col(c).alias(f"_{c}") for c in by), "n", "m")
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by), F.col("_place") == F.col("_here"))
    place_id = F.get(id_list([t.id for t in places]), F.col("_place")) if places else F.col("_place")
    number = lambda n: F.coalesce(n, F.lit(0)).cast("bigint").alias(n)
    rows = grid.join(here, same, "left").withColumnsRenamed({"n": "n_location", "m": "n_both"})
    return rows.select(place_id.alias("place_id"), *by, *(number(c) for c in ("n_total", "n_disease", "n_location", "n_both")))


def place_shares(
    articles: DataFrame, places: list[Term], topic: Term, by: Sequence[str] = ("year", "month"),
    max_chars: int = 0, denominator: str = "location", **options,
) -> DataFrame:
    """(place_id, *by, n_both, n_total, normalized_mentions), 0 where nothing was counted.

    `n_total` is the number of articles that mention the place, or with
    `denominator="total"` of all articles.
    """
    counts = place_counts(articles, places, topic, by, max_chars, **options)
    n_total = F.col({"location": "n_location", "total": "n_total"}[denominator])
    return counts.select(
        "place_id", *by, "n_both", n_total.alias("n_total"),
        F.when(n_total == 0, F.lit(0.0)).otherwise(F.col("n_both") / n_total).alias("normalized_mentions"),
    )
