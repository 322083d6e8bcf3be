"""Explicit schemas of all stored tables; nothing is inferred from files."""

ARTICLE_TEXTS = "article_id string, article_title string, article_text string"
ARTICLE_META = "newspaper_id string, article_id string, article_subject string"
NEWSPAPER_META = (
    "newspaper_id string, newspaper_name string, newspaper_location string, newspaper_date date, "
    "newspaper_years_digitalised string, newspaper_years_issued string, newspaper_language string, "
    "newspaper_temporal string, newspaper_publisher string, newspaper_spatial string"
)
COMBINED = (
    "newspaper_id string, article_id string, article_subject string, article_title string, article_text string, "
    "newspaper_name string, newspaper_location string, newspaper_date date, newspaper_years_digitalised string, "
    "newspaper_years_issued string, newspaper_language string, newspaper_temporal string, "
    "newspaper_publisher string, newspaper_spatial string"
)
PARTITIONED = COMBINED + ", year int"
DISEASE_TERMS = "Label string, Disease string, `Type ` string, Regex string"
LOCATION_TERMS = "name string, Regex string, cbscode int, amsterdamcode int"
MUNICIPALITIES = "Regex string, name string, cbscode int, amsterdamcode int, pop int"
DATABASE_FLAT = (
    "year int, month int, n_location bigint, n_both bigint, location string, cbscode int, amsterdamcode int, disease string"
)
DATABASE = "disease string, year int, month int, cbscode int, mention_rate double, n_location bigint, n_both bigint"
DATABASE_YEARLY = "disease string, year int, cbscode int, mention_rate double, n_location bigint, n_both bigint"
MONTH_COUNTS = "year int, month int, count bigint"
GEO = "struct<objects:struct<nld:struct<geometries:array<struct<properties:struct<name:string,cbscode:int>>>>>>"
