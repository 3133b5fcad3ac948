"""Schemas of inputs and results. Nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _fields(*pairs) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in pairs])


SEEDS = _fields(("domain", S))
CRAWL_CALENDAR = _fields(("year", I), ("crawl", S))
PAGE_INDEX = _fields(
    ("domain", S), ("crawl", S), ("url_path", S), ("warc_filename", S),
    ("warc_record_offset", L), ("warc_record_length", L),
)
# Column names of the public crawl index table.
CRAWL_INDEX_TABLE = _fields(
    ("url_host_registered_domain", S), ("url_path", S), ("warc_filename", S),
    ("warc_record_offset", L), ("warc_record_length", L), ("crawl", S), ("subset", S),
)
PAGE_RECORDS = _fields(("domain", S), ("crawl", S), ("url_path", S), ("response", S), ("header", S))
LIVE_RECORDS = _fields(("link", S), ("content", S), ("header", S))
HEADERS = T.MapType(S, T.ArrayType(S))
ELEMENT = _fields(("pos", I), ("parent", I), ("last", I), ("tag", S), ("attrs", T.MapType(S, S)), ("text", S))
MARKUP_ITEM = _fields(("syntax", S), ("seq", I), ("item", S))
RULES = _fields(
    ("tech", S), ("field", S), ("key", S), ("selector", S), ("pattern", S), ("version_tpl", S), ("confidence", I),
)
IMPLIES = _fields(("tech", S), ("implied", S))
TECH_CATEGORIES = _fields(("tech", S), ("pos", I), ("cat_id", I))
CATEGORIES = _fields(("cat_id", I), ("name", S), ("groups", T.ArrayType(I)), ("priority", I))
CLASS_LABELS = _fields(("id", I), ("literal", S))

PRODUCTS = _fields(
    ("domain", S), ("url", S), ("archive_year", S), ("detected_language", S), ("product_title", S),
    ("product_description", S), ("brand", S), ("price", D), ("currency", S), ("product_schema", B),
    ("last_update", T.DateType()),
)
LINKS = _fields(("domain", S), ("archive_year", S), ("external_link", S), ("count", L), ("last_update", T.DateType()))
SOCIAL = _fields(("domain", S), ("archive_year", S), ("social_platform", S), ("social_link", S),
                 ("last_update", T.DateType()))
TECHNOLOGY = _fields(("domain", S), ("archive_year", S), ("technology", S), ("version", S),
                     ("categories", T.ArrayType(S)), ("last_update", T.DateType()))
TRACKING = _fields(
    ("domain", S), ("archive_year", S), ("archive_record_count_unique", L), ("archive_record_count_checked", L),
    ("total_record_count_unique", L), ("total_record_count_checked", L), ("product_count_schema", L),
    ("product_count_pattern", L), ("last_update", T.DateType()),
)

# Key columns of the keep-latest upsert per result table (query_year is the partition).
RESULT_KEYS = {
    "products": ["query_year", "domain", "url"],
    "links": ["query_year", "domain", "external_link"],
    "social": ["query_year", "domain", "social_platform", "social_link"],
    "technology": ["query_year", "domain", "technology"],
    "tracking": ["domain"],
}
RESULT_SCHEMAS = {
    "products": PRODUCTS, "links": LINKS, "social": SOCIAL, "technology": TECHNOLOGY, "tracking": TRACKING,
}
