"""Registered queries over files: each writes given tables to the shared folder with Spark and reads them back through a source or sink."""

from __future__ import annotations

import datetime
import uuid

from pyspark.sql import functions as F

from pageprism import schemas
from pageprism.catalog.frames import CAPTURES_SQL, PAGE_INDEX_SQL, SHOP_SQL, captures, page_index, shop_pages, table
from pageprism.operators.index import select_index
from pageprism.operators.rules import bodies, categories, checked_rules, implies_table, rule_table
from pageprism.plans import acquire
from pageprism.plans.report import page_facts
from pageprism.session import shared_folder
from pageprism.sources import tables
from pageprism.sources.rule_files import sample_rules
from pageprism.sources.snapshots import manifest

OLD, NEW = datetime.date(2024, 1, 1), datetime.date(2024, 6, 1)
SEED_SHARE = 3
WANTED_CRAWLS = ["CC-MAIN-2024-10", "CC-MAIN-2024-22"]


def _folder(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/pageprism/{name}-{uuid.uuid4().hex}"


def _seed_file(spark, sf_dir):
    """Every third domain of the page index as a CSV file without header, with a second column."""
    path = _folder(spark, "seeds")
    domains = page_index(spark, sf_dir).select("domain").distinct().where(F.length("domain") % SEED_SHARE == 0)
    domains.select("domain", F.lit("x").alias("note")).write.csv(path, header=False)
    return path


def _crawl_table(spark, sf_dir):
    """Public form of the index, partitioned by crawl and subset; every fifth capture is of another subset."""
    path = _folder(spark, "crawl-index")
    rows = captures(spark, sf_dir).withColumn("subset", F.when(F.col("warc_record_offset") % 5 == 0, "robotstxt").otherwise("warc"))
    rows.withColumnRenamed("domain", "url_host_registered_domain").write.partitionBy("crawl", "subset").parquet(path)
    return path


def seed_scan(spark, sf_dir):
    return tables.read_seeds(spark, _seed_file(spark, sf_dir))


def index_csv_scan(spark, sf_dir):
    """Query result of the crawl index as CSV files with header."""
    path = _folder(spark, "index-csv")
    page_index(spark, sf_dir).write.csv(path, header=True)
    return tables.read_index_csv(spark, path)


def crawl_index_scan(spark, sf_dir):
    """Two crawls and one subset of the crawl index, as one scan of the six columns."""
    return select_index(tables.read_crawl_index(spark, _crawl_table(spark, sf_dir)), WANTED_CRAWLS)


def index_acquisition(spark, sf_dir):
    """Seeds against the crawl index, hits into the local index, twice: its rows, and how many each run added."""
    seeds, index, local = _seed_file(spark, sf_dir), _crawl_table(spark, sf_dir), _folder(spark, "local-index")
    first = acquire.run(spark, seeds, index, local, year=2024)
    again = acquire.run(spark, seeds, index, local, year=2024)
    return tables.read_index(spark, local).groupBy("crawl", "domain").agg(F.count(F.lit(1)).alias("rows")).withColumns(
        {"added": F.lit(first["rows_added"]), "added_again": F.lit(again["rows_added"])})


def index_files(spark, sf_dir):
    """Local index after two upserts that overlap."""
    path, index = _folder(spark, "index"), captures(spark, sf_dir)
    tables.upsert_index(spark, index.where(F.col("warc_record_offset") % 3 < 2), path)
    tables.upsert_index(spark, index.where(F.col("warc_record_offset") % 3 > 0), path)
    return tables.read_index(spark, path)


def index_files_of_crawls(spark, sf_dir):
    """Some crawls of the local index; the parts of others aren't read."""
    path = _folder(spark, "index")
    tables.upsert_index(spark, captures(spark, sf_dir), path)
    return tables.read_index(spark, path, crawls=WANTED_CRAWLS).groupBy("crawl").agg(F.count(F.lit(1)).alias("rows"))


def _links(spark, sf_dir, day, factor):
    orders = table(spark, sf_dir, "orders")
    return orders.groupBy(F.concat(F.lit("c"), (F.col("o_custkey") % 97).cast("string")).alias("domain"), F.col("o_orderpriority").alias("external_link")).agg(
        (F.count(F.lit(1)) * factor).alias("count")).select("domain", F.lit("2024").alias("archive_year"), "external_link", "count",
                                                            F.lit(day).alias("last_update"))


def result_files(spark, sf_dir):
    """Link table of two query years: an older run, a newer one over some domains, and one that comes too late to count."""
    path = _folder(spark, "links")
    old, new = _links(spark, sf_dir, OLD, 1), _links(spark, sf_dir, NEW, 10)
    tables.upsert_results(spark, "links", old, path, "2024")
    tables.upsert_results(spark, "links", new.where(F.col("domain").endswith("1")), path, "2024")
    tables.upsert_results(spark, "links", _links(spark, sf_dir, OLD, 100).where(F.col("domain").endswith("11")), path, "2024")
    tables.upsert_results(spark, "links", old.where(F.col("domain").endswith("2")), path, "2023")
    return tables.read_results(spark, "links", path)


def result_versions(spark, sf_dir):
    """Rows of each version of a result table, read after all were written."""
    path = _folder(spark, "links")
    for suffix in ("1", "2", "3"):
        tables.upsert_results(spark, "links", _links(spark, sf_dir, NEW, 1).where(F.col("domain").endswith(suffix)), path, "2024")
    seen = None
    for version in (1, 2, 3):
        rows = tables.read_results(spark, "links", path, version).agg(F.count(F.lit(1)).alias("rows"))
        rows = rows.select(F.lit(version).alias("version"), "rows", F.lit(manifest(spark, path, version).rows).alias("noted"))
        seen = rows if seen is None else seen.union(rows)
    return seen


def tracking_files(spark, sf_dir):
    """Tracking table, whose key is the domain alone: a second run replaces the rows of its domains in whatever year."""
    path = _folder(spark, "tracking")
    counts = _links(spark, sf_dir, OLD, 1).groupBy("domain").agg(F.sum("count").alias("n"))

    def run(day, factor):
        longs = [f.name for f in schemas.TRACKING.fields if f.dataType.typeName() == "long"]
        return counts.select("domain", F.lit("2024").alias("archive_year"), *[(F.col("n") * factor).cast("long").alias(c) for c in longs],
                             F.lit(day).alias("last_update"))

    tables.upsert_results(spark, "tracking", run(OLD, 1), path, "2023")
    tables.upsert_results(spark, "tracking", run(NEW, 2).where(F.col("domain").endswith("1")), path, "2024")
    return tables.read_results(spark, "tracking", path).select("domain", "total_record_count_checked", "product_count_schema", "last_update")


def _rule_folder(spark, sf_dir):
    """Two rule files made from ``part``; the later one has a broken pattern for some technologies and takes the place of the earlier one there."""
    path = _folder(spark, "rules")
    part = table(spark, sf_dir, "part").where("p_partkey <= 200 OR p_size = 1")
    name = F.concat(F.lit('"T'), F.col("p_partkey"), F.lit('"'))
    first = F.concat(name, F.lit(': {"cats": ['), F.col("p_size") % 4, F.lit('], "html": "'), F.col("p_brand"), F.lit(r'\\;version:\\1\\;confidence:'),
                     F.col("p_size"), F.lit('", "meta": "Gen '), F.col("p_partkey"), F.lit('", "headers": {"X-Brand": ["a'), F.col("p_size"),
                     F.lit('", "b"]}, "implies": ["T1\\\\;confidence:50"], "dom": {"a.x": {"exists": ""}}}'))
    second = F.concat(name, F.lit(': {"html": ["(broken", "fine'), F.col("p_partkey"), F.lit('"]}'))
    for file, entry, rows in (("a", first, part), ("b", second, part.where("p_partkey % 10 = 0"))):
        body = rows.agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list(entry)), ","), F.lit("}")).alias("value"))
        body.coalesce(1).write.text(f"{path}/{file}")
    return path


def _read_rules(spark, sf_dir):
    """All rule files of two folders, as one table of texts named by folder."""
    path = _rule_folder(spark, sf_dir)
    files = None
    for name in ("a", "b"):
        one = spark.read.text(f"{path}/{name}", wholetext=True).select(F.lit(f"{name}.json").alias("file"), F.regexp_replace("value", r"\n$", "").alias("text"))
        files = one if files is None else files.union(one)
    return files


def rule_files(spark, sf_dir):
    """Rules of both files: which count, and which are rejected since their pattern doesn't compile."""
    rules = checked_rules(rule_table(bodies(_read_rules(spark, sf_dir))))
    return rules.select("tech", "field", "key", "selector", "pattern", "version_tpl", "confidence", "valid")


def rule_implies(spark, sf_dir):
    """Implied names without their confidence tag."""
    return implies_table(bodies(_read_rules(spark, sf_dir)))


def category_files(spark, sf_dir):
    """Categories as a JSON file made from ``nation``, read as text."""
    path = _folder(spark, "categories")
    nation = table(spark, sf_dir, "nation")
    entry = F.concat(F.lit('"'), F.col("n_nationkey"), F.lit('": {"name": "'), F.col("n_name"), F.lit('", "groups": ['), F.col("n_regionkey"),
                     F.lit('], "priority": '), F.col("n_nationkey") % 7, F.lit("}"))
    nation.agg(F.concat(F.lit("{"), F.array_join(F.collect_list(entry), ","), F.lit("}")).alias("value")).coalesce(1).write.text(path)
    files = spark.read.text(path, wholetext=True).select(F.lit("c.json").alias("file"), F.col("value").alias("text"))
    found = categories(files)
    return found.select("cat_id", "name", F.array_join(F.col("groups").cast("array<string>"), ",").alias("groups"), "priority")


def failed_pages(spark, sf_dir):
    """Shop pages of which some failed (null) or came empty: they keep their row, without product, links or technologies of the page."""
    k = F.col("page_id")
    shop = shop_pages(spark, sf_dir).withColumn("response", F.when(k % 5 == 0, None).when(k % 7 == 0, "").otherwise(F.col("response")))
    facts = page_facts(shop.withColumn("header", F.lit(None).cast("string")), sample_rules(spark))
    return facts.select("page_id", F.size("links").alias("links"), F.col("product_schema").isNotNull().alias("product"),
                        (F.size(F.filter("hits", lambda h: h["field"] != "url")) > 0).alias("technology"))


def previous_results(spark, sf_dir):
    """First run, on tables that were never written, and a second one on what the first left."""
    path = _folder(spark, "social")
    rows = table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), (F.col("s_suppkey") % 10).cast("string")).alias("domain"), F.lit("2024").alias("archive_year"), F.lit("twitter").alias("social_platform"),
        F.col("s_name").alias("social_link"), F.lit(NEW).alias("last_update"))
    nothing = tables.read_results(spark, "social", path).count()
    tables.upsert_results(spark, "social", rows, path, "2024")
    tables.upsert_results(spark, "social", rows, path, "2024")
    return tables.read_results(spark, "social", path).groupBy("domain").agg(F.count(F.lit(1)).alias("accounts")).withColumn("before", F.lit(nothing).cast("long"))


QUERIES = {f.__name__: f for f in (
    seed_scan, index_csv_scan, crawl_index_scan, index_acquisition, index_files, index_files_of_crawls, result_files, result_versions,
    tracking_files, rule_files, rule_implies, category_files, failed_pages, previous_results)}

_SEEDS_SQL = f"seeds AS (SELECT DISTINCT domain FROM page_index WHERE length(domain) % {SEED_SHARE} = 0)"
_LINK_SQL = "SELECT 'c' || (o_custkey % 97) AS domain, o_orderpriority AS external_link, count(*) AS n FROM orders GROUP BY ALL"
_PART_SQL = "SELECT * FROM part WHERE p_partkey <= 200 OR p_size = 1"
_CRAWLS_SQL = ", ".join(f"'{c}'" for c in WANTED_CRAWLS)
ORACLES = {
    "seed_scan": f"WITH {PAGE_INDEX_SQL}, {_SEEDS_SQL} SELECT domain FROM seeds",
    "index_csv_scan": f"WITH {PAGE_INDEX_SQL} SELECT * FROM page_index",
    "crawl_index_scan": f"WITH {CAPTURES_SQL} SELECT * FROM captures WHERE crawl IN ({_CRAWLS_SQL}) AND warc_record_offset % 5 <> 0",
    "index_acquisition": f"""WITH {CAPTURES_SQL}, {_SEEDS_SQL}, hits AS (SELECT DISTINCT * FROM captures WHERE warc_record_offset % 5 <> 0 AND domain IN (FROM seeds))
      SELECT crawl, domain, count(*) AS rows, (SELECT CAST(count(*) AS INTEGER) FROM hits) AS added, 0 AS added_again FROM hits GROUP BY ALL""",
    "index_files": f"WITH {CAPTURES_SQL} SELECT DISTINCT * FROM captures",
    "index_files_of_crawls": f"WITH {CAPTURES_SQL} SELECT crawl, count(*) AS rows FROM (SELECT DISTINCT * FROM captures) WHERE crawl IN ({_CRAWLS_SQL}) GROUP BY ALL",
    "result_files": f"""WITH l AS ({_LINK_SQL})
      SELECT domain, '2024' AS archive_year, external_link, CAST(CASE WHEN domain LIKE '%1' THEN n * 10 ELSE n END AS BIGINT) AS count,
             CASE WHEN domain LIKE '%1' THEN DATE '2024-06-01' ELSE DATE '2024-01-01' END AS last_update, '2024' AS query_year FROM l
      UNION ALL SELECT domain, '2024', external_link, n, DATE '2024-01-01', '2023' FROM l WHERE domain LIKE '%2'""",
    "result_versions": f"""WITH l AS ({_LINK_SQL}), v(version) AS (VALUES (1), (2), (3))
      SELECT version, count(*) AS rows, CAST(count(*) AS INTEGER) AS noted FROM v JOIN l ON CAST(right(domain, 1) AS INTEGER) BETWEEN 1 AND version GROUP BY ALL""",
    "tracking_files": f"""WITH l AS (SELECT domain, CAST(sum(n) AS BIGINT) AS n FROM ({_LINK_SQL}) GROUP BY ALL)
      SELECT domain, CASE WHEN domain LIKE '%1' THEN n * 2 ELSE n END AS total_record_count_checked,
             CASE WHEN domain LIKE '%1' THEN n * 2 ELSE n END AS product_count_schema,
             CASE WHEN domain LIKE '%1' THEN DATE '2024-06-01' ELSE DATE '2024-01-01' END AS last_update FROM l""",
    "rule_files": f"""WITH p AS ({_PART_SQL}), kept AS (SELECT * FROM p WHERE p_partkey % 10 <> 0), later AS (SELECT * FROM p WHERE p_partkey % 10 = 0)
      SELECT 'T' || p_partkey AS tech, 'html' AS field, '' AS key, '' AS selector, p_brand AS pattern, '\\1' AS version_tpl, p_size AS confidence, TRUE AS valid FROM kept
      UNION ALL SELECT 'T' || p_partkey, 'meta', 'generator', '', 'Gen ' || p_partkey, NULL, 100, TRUE FROM kept
      UNION ALL SELECT 'T' || p_partkey, 'headers', 'x-brand', '', unnest(['a' || p_size, 'b']), NULL, 100, TRUE FROM kept
      UNION ALL SELECT 'T' || p_partkey, 'dom', '', 'a.x', '', NULL, 100, TRUE FROM kept
      UNION ALL SELECT 'T' || p_partkey, 'html', '', '', 'fine' || p_partkey, NULL, 100, TRUE FROM later
      UNION ALL SELECT 'T' || p_partkey, 'html', '', '', '(broken', NULL, 100, FALSE FROM later""",
    "rule_implies": f"SELECT 'T' || p_partkey AS tech, 'T1' AS implied FROM ({_PART_SQL}) WHERE p_partkey % 10 <> 0",
    "category_files": "SELECT CAST(n_nationkey AS INTEGER) AS cat_id, n_name AS name, CAST(n_regionkey AS VARCHAR) AS groups, "
                      "CAST(n_nationkey % 7 AS INTEGER) AS priority FROM nation",
    "failed_pages": f"""WITH {SHOP_SQL}, f AS (SELECT *, k % 5 = 0 OR k % 7 = 0 AS failed FROM shop_products)
      SELECT k AS page_id, CASE WHEN failed THEN 0 ELSE CAST(6 + k % 2 AS INTEGER) END AS links,
             CASE WHEN failed THEN FALSE ELSE product_schema IS NOT NULL END AS product, NOT failed AS technology FROM f""",
    "previous_results": "SELECT 's' || (s_suppkey % 10) AS domain, count(DISTINCT s_name) AS accounts, CAST(0 AS BIGINT) AS before FROM supplier GROUP BY ALL",
}
