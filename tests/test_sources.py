"""Files: seeds, index, results, records, acquisition, streaming."""

import datetime

import pytest
from pyspark.sql import functions as F

from pageprism import schemas
from pageprism.catalog.frames import shop_pages
from pageprism.plans import acquire
from pageprism.plans.report import from_archive, from_table, shop_report, write_report
from pageprism.sources import tables
from pageprism.sources.records import fetch_records, merged_reads, write_records
from pageprism.sources.rule_files import read_rules, sample_rules
from pageprism.streaming.upserts import stream_products

SF = "/root/testdata/sf0.001"


def day():
    return F.lit(datetime.date(2024, 6, 1))


def test_seeds_and_index_csv(spark, tmp_path):
    (tmp_path / "seeds.csv").write_text("a.com,ignored\nb.com\n")
    assert sorted(r.domain for r in tables.read_seeds(spark, str(tmp_path / "seeds.csv")).collect()) == ["a.com", "b.com"]
    (tmp_path / "i.csv").write_text("domain,crawl,url_path,warc_filename,warc_record_offset,warc_record_length\na.com,c,/x,f,1,2\n")
    assert [tuple(r) for r in tables.read_index_csv(spark, str(tmp_path / "i.csv")).collect()] == [("a.com", "c", "/x", "f", 1, 2)]


def test_acquisition_twice_adds_nothing(spark, tmp_path):
    rows = [(d, f"/{i}", "f", i, 10, "CC-MAIN-2024-10" if i % 2 else "CC-MAIN-2024-18", "warc") for i, d in enumerate(["a.com", "b.com", "c.com"] * 5)]
    spark.createDataFrame(rows, schemas.CRAWL_INDEX_TABLE).write.partitionBy("crawl", "subset").parquet(str(tmp_path / "table"))
    (tmp_path / "seeds.csv").write_text("a.com\nb.com\n")
    args = (spark, str(tmp_path / "seeds.csv"), str(tmp_path / "table"), str(tmp_path / "local"))
    assert acquire.run(*args)["rows_added"] == 10
    assert acquire.run(*args, year=2024) == {"rows_before": 10, "rows_after": 10, "rows_added": 0}


def test_previous_results_may_be_missing(spark, tmp_path):
    assert tables.read_results(spark, "links", str(tmp_path / "none")).count() == 0


def test_result_upserts(spark, tmp_path):
    def link(host, count, day):
        return ("d", "2024", host, count, datetime.date(2024, 1, day))

    path = str(tmp_path / "links")
    tables.upsert_results(spark, "links", spark.createDataFrame([link("x", 1, 1), link("x", 1, 1), link("y", 1, 3)], schemas.LINKS), path, "2024")
    tables.upsert_results(spark, "links", spark.createDataFrame([link("x", 5, 1), link("y", 5, 2)], schemas.LINKS), path, "2024")
    tables.upsert_results(spark, "links", spark.createDataFrame([link("x", 7, 1)], schemas.LINKS), path, "2023")
    rows = sorted((r.query_year, r.external_link, r["count"]) for r in tables.read_results(spark, "links", path).collect())
    assert rows == [("2023", "x", 7), ("2024", "x", 5), ("2024", "y", 1)]


def test_records_round_trip(spark, tmp_path):
    rows = [("d", "c", f"/{i}", f"HTTP/1.1 200 OK\r\nN: {i}", f"<p>{i} é</p>\r\n\r\nrest") for i in range(20)]
    pages = spark.createDataFrame(rows, "domain string, crawl string, url_path string, header string, response string").repartition(3)
    located, root = write_records(pages, str(tmp_path / "archive"))
    got = sorted(tuple(r) for r in fetch_records(located, root).select("domain", "crawl", "url_path", "header", "response").collect())
    assert got == sorted(rows)
    broken = located.withColumn("warc_record_offset", F.col("warc_record_offset") + 1)
    assert fetch_records(broken, root).where("response IS NULL").count() == 20
    lost = located.withColumn("warc_filename", F.lit("gone"))
    assert fetch_records(lost, root, missing="null").where("response IS NULL").count() == 20
    with pytest.raises(Exception, match="gone"):
        fetch_records(lost, root).count()
    nowhere = located.withColumn("warc_record_offset", F.when(F.col("url_path") != "/3", F.col("warc_record_offset")))
    assert {r.url_path for r in fetch_records(nowhere, root).where("response IS NOT NULL").collect()} == {f"/{i}" for i in range(20)} - {"/3"}


def test_live_pages_take_the_shape_of_records(spark):
    live = spark.createDataFrame([("https://shop.com/p/1?x=2", "<p>", "A: 1")], schemas.LIVE_RECORDS)
    row = tables.live_as_pages(live).first()
    assert (row.domain, row.crawl, row.url_path, row.response) == ("shop.com", "LIVE-CRAWL", "/p/1?x=2", "<p>")


def test_rule_metadata(spark):
    from pageprism.operators.rules import bodies, metadata_table
    from pageprism.sources.rule_files import texts

    files = texts(spark, {"a.json": '{"T": {"website": "w", "saas": true, "pricing": "low"}}'})
    row = metadata_table(bodies(files)).first()
    assert (row.tech, row.website, row.saas, row.oss, row.pricing) == ("T", "w", True, None, ["low"])


def test_rule_folder(spark, tmp_path):
    (tmp_path / "rules").mkdir()
    (tmp_path / "rules" / "a.json").write_text('{"T": {"html": "x", "cats": [1]}}')
    (tmp_path / "rules" / "notes.txt").write_text("no rules")
    rules = read_rules(spark, str(tmp_path / "rules"))
    assert [(r.tech, r.pattern) for r, _ in rules.rows] == [("T", "x")]


def test_report_from_archive_equals_report_from_table(spark, tmp_path):
    shop = shop_pages(spark, SF)
    located, root = write_records(shop, str(tmp_path / "archive"))
    seeds, rules = shop.select("domain").distinct(), sample_rules(spark)
    one = shop_report(shop.drop("response", "header"), from_table(shop), seeds, rules, day(), store=False)
    two = shop_report(located, from_archive(root), seeds, rules, day())
    for name in ("products", "tracking"):
        assert sorted(map(str, getattr(one, name).collect())) == sorted(map(str, getattr(two, name).collect()))
    write_report(spark, two, str(tmp_path / "out"), 2024)
    first = {n: tables.read_results(spark, n, f"{tmp_path}/out/{n}").count() for n in schemas.RESULT_SCHEMAS}
    write_report(spark, two, str(tmp_path / "out"), 2024)
    again = {n: tables.read_results(spark, n, f"{tmp_path}/out/{n}").count() for n in schemas.RESULT_SCHEMAS}
    assert first == again and all(first.values())


def test_stream(spark, tmp_path):
    pages = shop_pages(spark, SF).select(*schemas.PAGE_RECORDS.fieldNames())
    pages.write.parquet(str(tmp_path / "pages"))
    args = (spark, str(tmp_path / "pages"), str(tmp_path / "products"), str(tmp_path / "state"), sample_rules(spark), "2024", day())
    stream_products(*args).awaitTermination(300)
    count = tables.read_results(spark, "products", str(tmp_path / "products")).count()
    assert count == sum(k % 4 < 3 or k % 3 < 2 for k in range(shop_pages(spark, SF).count()))


def test_report_covers_every_page_of_a_large_domain(spark):
    pages = spark.range(6100).select(
        F.lit("big.example.com").alias("domain"), F.lit("CC-MAIN-2024-10").alias("crawl"),
        F.concat(F.lit("/product/"), F.col("id").cast("string")).alias("url_path"), F.lit("f").alias("warc_filename"),
        F.col("id").alias("warc_record_offset"), F.lit(1).cast("long").alias("warc_record_length"),
        F.concat(F.lit("<title>T</title><p>price: 5.00 currency: eur <a href='https://out"), F.col("id"), F.lit(".example.org/'>x</a>")).alias("response"),
        F.lit("HTTP/1.1 200 OK").alias("header"))
    rep = shop_report(pages.drop("response", "header"), from_table(pages), pages.select("domain").distinct(), sample_rules(spark), day())
    row = rep.tracking.first()
    assert row.archive_record_count_unique == row.archive_record_count_checked == row.product_count_pattern == 6100
    assert rep.products.count() == rep.links.count() == 6100


def test_page_contents_are_never_broadcast(spark):
    key = F.col("id")
    pages = spark.range(50).select(
        F.lit("a.example.com").alias("domain"), F.concat(F.lit("/p/"), key).alias("url_path"), F.lit("CC-MAIN-2024-10").alias("crawl"), F.lit("f").alias("warc_filename"),
        key.alias("warc_record_offset"), F.repeat(F.lit("x"), 1000).alias("response"), F.lit("HTTP/1.1 200 OK").alias("header"))
    wanted = pages.where("warc_record_offset % 2 = 0").drop("response", "header").withColumn("rn", F.col("warc_record_offset")).union(
        pages.limit(1).drop("response", "header").withColumns({"url_path": F.lit("/gone"), "rn": F.lit(1).cast("long")}))
    taken = from_table(pages)(wanted)
    assert "BuildLeft" not in taken._jdf.queryExecution().optimizedPlan().toString() + taken._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.url_path, r.rn, len(r.response)) for r in taken.collect()) == sorted((f"/p/{i}", i, 1000) for i in range(0, 50, 2))
