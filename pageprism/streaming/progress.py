"""Page budget and novelty streak over pages that arrive in batches.

The state of all domains is a versioned table: pages and products of each batch of a domain, and the place where each technology was seen first. A micro-batch
numbers its pages behind those that came before, writes their rows, and then moves the state on, each once: a micro-batch that runs again after a
failure finds the state as it was, or finds its work done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from pageprism.operators.budget import Limits, budget_ends
from pageprism.operators.ranking import rank_by_hash, salted_join, shuffle_key
from pageprism.session import stored
from pageprism.sources.snapshots import manifest, read_snapshot, upsert

BUCKETS = 64
ARRIVALS = T.StructType([T.StructField("domain", T.StringType()), T.StructField("url_path", T.StringType()), T.StructField("is_product", T.BooleanType()),
                         T.StructField("technologies", T.ArrayType(T.StringType()))])
STATE = T.StructType([T.StructField("domain", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("name", T.StringType()),
                      T.StructField("pages", T.LongType()), T.StructField("products", T.LongType()), T.StructField("first", T.LongType())])
PAGES = T.StructType([T.StructField("domain", T.StringType()), T.StructField("url_path", T.StringType()), T.StructField("is_product", T.BooleanType()),
                      T.StructField("rn", T.LongType()), T.StructField("batch", T.LongType()), T.StructField("streak", T.LongType()),
                      T.StructField("known", T.IntegerType()), T.StructField("paused", T.BooleanType())])


def _part():
    return F.coalesce(F.pmod(F.xxhash64("domain"), F.lit(BUCKETS)).cast("string"), F.lit(""))


def _merged(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.union(new).groupBy("domain", "kind", "name").agg(
        F.sum("pages").alias("pages"), F.sum("products").alias("products"), F.min("first").alias("first"))


def advance(spark: SparkSession, arrived: DataFrame, path: str, number: int, limits: Limits = Limits(), seed: int = 0, stream: str = "pages") -> None:
    """Takes in micro-batch ``number`` (``ARRIVALS``): its pages follow those of earlier ones, among themselves in seeded order. A null domain is a domain of
    its own; a product flag of null counts as none."""
    state_path, pages_path = f"{path}/state", f"{path}/pages"
    if manifest(spark, state_path).batches.get(stream, -1) >= number:
        return
    state = read_snapshot(spark, state_path, STATE)
    so_far = state.where("kind = 'batch'").groupBy(F.col("domain").alias("_domain")).agg(F.sum("pages").alias("_before"))
    keyed = arrived.select(*ARRIVALS.fieldNames()).withColumn("_order", shuffle_key("url_path", seed=seed))
    ranked = rank_by_hash(keyed, ["domain"], "_order", ["url_path"]).drop("_order", "total")
    ranked = stored(ranked.join(so_far, F.col("domain").eqNullSafe(F.col("_domain")), "left").withColumn(
        "rn", F.col("rn") + F.coalesce("_before", F.lit(0))).drop("_domain", "_before").withColumn(
        "batch", F.floor((F.col("rn") - 1) / limits.batch_size)), "arrived")
    seen = state.where("kind = 'technology'").select("domain", F.col("name").alias("_tech"), F.col("first").alias("_rn"))
    here = ranked.select("domain", "rn", F.explode("technologies").alias("_tech")).groupBy("domain", "_tech").agg(F.min("rn").alias("_rn"))
    firsts = stored(seen.union(here).groupBy("domain", "_tech").agg(F.min("_rn").alias("_rn")), "firsts")
    news = firsts.groupBy(F.coalesce("domain", F.lit("")).alias("_key"), F.col("domain").isNull().alias("_none")).agg(F.collect_list("_rn").alias("_news"))
    past = F.filter(F.coalesce("_news", F.array().cast("array<long>")), lambda n: n <= F.col("rn"))
    rows = salted_join(ranked.withColumns({"_key": F.coalesce("domain", F.lit("")), "_none": F.col("domain").isNull()}), news, ["_key", "_none"], "left").withColumns(
        {"streak": F.col("rn") - F.coalesce(F.array_max(past), F.lit(0)), "known": F.size(past)}).withColumn("paused", F.col("streak") > limits.dom_limit)
    upsert(spark, pages_path, rows.select(*PAGES.fieldNames()), _part(), PAGES, lambda old, new: old.union(new), batch=(stream, number))
    sums = ranked.groupBy("domain", F.lit("batch").alias("kind"), F.col("batch").cast("string").alias("name")).agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(F.coalesce("is_product", F.lit(False))).alias("products"), F.lit(None).cast("long").alias("first"))
    none = F.lit(None).cast("long")
    marks = here.select("domain", F.lit("technology").alias("kind"), F.col("_tech").alias("name"), none.alias("pages"), none.alias("products"),
                        F.col("_rn").alias("first"))
    upsert(spark, state_path, sums.union(marks), _part(), STATE, _merged, batch=(stream, number))


def checked_pages(spark: SparkSession, path: str, limits: Limits = Limits()) -> DataFrame:
    """Pages so far that the budget lets through, with ``needs_live``; as ``apply_budget`` over all pages in their order of arrival."""
    sums = read_snapshot(spark, f"{path}/state", STATE).where("kind = 'batch'").select(
        F.col("domain").alias("_domain"), F.col("name").cast("long").alias("_batch"), F.col("pages").alias("_n"), F.col("products").alias("_hits"))
    pages = read_snapshot(spark, f"{path}/pages", PAGES)
    joined = pages.join(budget_ends(sums, limits), F.col("domain").eqNullSafe(F.col("_domain")))
    return joined.where(F.col("_last").isNull() | (F.col("batch") <= F.col("_last"))).withColumn("needs_live", F.col("_last").isNull()).drop("_domain", "_last")


def stream_progress(spark: SparkSession, folder: str, path: str, checkpoint: str, limits: Limits = Limits(), files_per_batch: int = 1) -> StreamingQuery:
    """Page files (``ARRIVALS``) as they arrive."""
    arrived = spark.readStream.schema(ARRIVALS).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    return (arrived.writeStream.foreachBatch(lambda batch, number: advance(batch.sparkSession, batch, path, number, limits, stream=checkpoint))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
