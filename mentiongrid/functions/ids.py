"""Identifiers, small record clean-ups and query texts, all as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mentiongrid.fixed_values import NAMESPACES, RESOLVER_PREFIX_PATTERN, RESOLVER_SUFFIX_PATTERN


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def article_id_from_file(path: Column) -> Column:
    """`DDD_000010_012_articletext.xml` -> `ddd:000010:mpeg21:a012`; NULL for names of another form."""
    parts = F.split(F.lower(file_name(path)), "_")
    head = F.array(F.get(parts, 0), F.get(parts, 1), F.lit("mpeg21"), F.concat(F.lit("a"), F.get(parts, 2)))
    tail = F.slice(parts, F.lit(5), F.greatest(F.size(parts) - 4, F.lit(0)))
    return F.when(F.size(parts) >= 4, F.array_join(F.concat(head, tail), ":"))


def clean_article_id(identifier: Column) -> Column:
    """Strip the resolver address before and the text suffix after an article id."""
    return F.regexp_replace(F.regexp_replace(identifier, RESOLVER_PREFIX_PATTERN, ""), RESOLVER_SUFFIX_PATTERN, "")


def newspaper_prefix(newspaper_id: Column) -> Column:
    return F.get(F.split(newspaper_id, ":"), 1)


def newspaper_number(newspaper_id: Column) -> Column:
    """The last two parts of the id."""
    parts = F.split(newspaper_id, ":")
    return F.when(F.size(parts) <= 2, newspaper_id).otherwise(F.concat_ws(":", F.slice(parts, -2, 2)))


def record_identifier(prefix: Column, number: Column) -> Column:
    """The identifier under which an issue's description is delivered."""
    upper = F.upper(prefix)
    return (
        F.when(prefix == "ddd", F.concat(F.lit("DDD:ddd:"), number))
        .when(prefix == "abcddd", F.concat(F.lit("KRANTEN:DDD:ddd:"), number))
        .otherwise(F.concat(F.lit("KRANTEN:"), upper, F.lit(":"), upper, F.lit(":"), number))
    )


def is_page_item(item_id: Column) -> Column:
    """Page scans are listed among the articles; their last id part starts with `p`."""
    return F.element_at(F.split(item_id, ":"), -1).startswith("p")


def standardize_values(df: DataFrame) -> DataFrame:
    """Join every list column into one text."""
    joined = {
        f.name: F.array_join(F.col(f.name).cast("array<string>"), ", ")
        for f in df.schema.fields
        if isinstance(f.dataType, T.ArrayType)
    }
    return df.withColumns(joined) if joined else df


def repair_namespace(content: Column) -> Column:
    """Declare the `xsi` namespace in issue descriptions that use it undeclared."""
    uri = NAMESPACES["xsi"]
    repaired = F.replace(content, F.lit("<didl:DIDL "), F.lit(f'<didl:DIDL xmlns:xsi="{uri}" '))
    return F.when(content.contains(uri), content).otherwise(repaired)


def auto_query(name: Column) -> Column:
    """Lower-cased name with its last two characters replaced by a wildcard."""
    return F.concat(F.left(F.lower(name), F.greatest(F.length(name) - 2, F.lit(0))), F.lit("*"))


def choose_query(manual: Column, name: Column) -> Column:
    return F.coalesce(manual, auto_query(name))


def last_word(name: Column) -> Column:
    """The last word of a name, NULL if the name does not end in one."""
    return F.nullif(F.regexp_extract(name, r"(?i) ?(\w+)$", 1), F.lit(""))


def month_query(query: Column, year: Column, month: Column) -> Column:
    """A search text limited to one month."""
    first = F.make_date(year, month, F.lit(1))
    day = lambda d: F.date_format(d, "yyyy-MM-dd")
    return F.concat(query, F.lit(' AND date within "'), day(first), F.lit(" "), day(F.last_day(first)), F.lit('"'))
