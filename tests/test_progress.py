"""Budget and streak over arriving files against the same pages in one batch."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from pageprism.operators.budget import Limits, apply_budget
from pageprism.operators.ranking import shuffle_key
from pageprism.sources.snapshots import manifest
from pageprism.streaming import progress

LIMITS = Limits(batch_size=5, max_pages=40, max_products=12, relevance_check=20, relevance_threshold=10.0, dom_limit=3)


def arrivals(spark):
    """Pages of seven domains in five drops; one domain has no products, one has many, one has no name."""
    page = spark.range(600).withColumn("d", (F.col("id") * 7 % 11 % 7).cast("int"))
    return page.select(
        F.when(F.col("d") < 6, F.concat(F.lit("d"), F.col("d").cast("string"))).alias("domain"), F.concat(F.lit("/p/"), F.col("id")).alias("url_path"),
        F.when(F.col("d") == 1, False).when(F.col("d") == 2, True).when(F.col("id") % 9 == 0, None).otherwise(F.col("id") % 4 == 0).alias("is_product"),
        F.when(F.col("id") % 5 > 0, F.array(F.concat(F.lit("t"), (F.col("id") % 97 % 13).cast("string")))).otherwise(F.array().cast("array<string>")).alias("technologies"),
        (F.col("id") % 5).alias("drop"))


def in_one_batch(pages):
    order = Window.partitionBy("domain").orderBy("drop", shuffle_key("url_path"), "url_path")
    ranked = pages.withColumn("rn", F.row_number().over(order).cast("long"))
    rows = sorted(ranked.collect(), key=lambda r: r.rn)
    known, last, streaks = {}, {}, {}
    for r in rows:
        new = set(r.technologies) - known.setdefault(r.domain, set())
        known[r.domain] |= new
        if new:
            last[r.domain] = r.rn
        streaks[r.url_path] = (r.rn, r.rn - last.get(r.domain, 0), len({x for x in known[r.domain]}))
    checked = {r.url_path: r.needs_live for r in apply_budget(ranked, LIMITS).collect()}
    return streaks, checked


def test_five_drops_equal_one_batch(spark, tmp_path):
    pages = arrivals(spark).cache()
    for drop in range(5):
        pages.where(F.col("drop") == drop).drop("drop").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        progress.stream_progress(spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), LIMITS).awaitTermination(300)
    streaks, checked = in_one_batch(pages)
    found = progress.read_snapshot(spark, str(tmp_path / "out" / "pages"), progress.PAGES).collect()
    assert {r.url_path: (r.rn, r.streak) for r in found} == {k: v[:2] for k, v in streaks.items()}
    assert all(r.paused == (r.streak > LIMITS.dom_limit) for r in found)
    out = progress.checked_pages(spark, str(tmp_path / "out"), LIMITS).collect()
    assert {r.url_path: r.needs_live for r in out} == checked and 0 < len(checked) < 600
    version = manifest(spark, str(tmp_path / "out" / "state")).version
    progress.advance(spark, pages.drop("drop"), str(tmp_path / "out"), 0, LIMITS, stream=str(tmp_path / "state"))
    assert manifest(spark, str(tmp_path / "out" / "state")).version == version


def test_a_batch_that_failed_between_its_writes_is_finished(spark, tmp_path, monkeypatch):
    pages = arrivals(spark).drop("drop").limit(60).cache()
    path, real, calls = str(tmp_path / "out"), progress.upsert, []

    def failing(*args, **kwargs):
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return real(*args, **kwargs)

    monkeypatch.setattr(progress, "upsert", failing)
    try:
        progress.advance(spark, pages, path, 0, LIMITS)
    except RuntimeError:
        pass
    progress.advance(spark, pages, path, 0, LIMITS)
    found = progress.read_snapshot(spark, f"{path}/pages", progress.PAGES)
    assert found.count() == 60 and found.select("domain", "rn").distinct().count() == 60
    state = progress.read_snapshot(spark, f"{path}/state", progress.STATE)
    assert state.where("kind = 'batch'").agg(F.sum("pages")).first()[0] == 60
