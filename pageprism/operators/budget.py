"""How many pages of a domain are looked at: order, batches, caps, stop rules, novelty."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.operators.ranking import rank_by_hash, salted_join, shuffle_key
from pageprism.session import stored


@dataclass(frozen=True)
class Limits:
    batch_size: int = fixed.BATCH_SIZE
    max_pages: int = fixed.MAX_PAGES
    max_products: int = fixed.MAX_PRODUCTS
    relevance_check: int = fixed.RELEVANCE_CHECK
    relevance_threshold: float = fixed.RELEVANCE_THRESHOLD
    dom_limit: int = fixed.DOM_LIMIT

    @property
    def most_pages(self) -> int:
        """A domain never gets more pages: the cap is tested between batches, and inclusively."""
        return (self.max_pages // self.batch_size + 1) * self.batch_size


def order_number(*by: str, seed: int = 0) -> Column:
    """The seeded order as a number of the row itself: 60 bits of its key, without a sort or a shuffle."""
    return F.conv(F.substring(shuffle_key(*by, seed=seed), 1, 15), 16, 10).cast("long")


def shuffled(df: DataFrame, by: list[str] = ("url_path",), seed: int = 0, limit: int | None = None) -> DataFrame:
    """Pages of a domain in a seeded pseudo-random order: columns ``rn`` and ``total``."""
    return rank_by_hash(df.withColumn("_order", shuffle_key(*by, seed=seed)), ["domain"], "_order",
                        list(by), limit).drop("_order")


def page_batches(df: DataFrame, by: list[str] = ("url_path",), seed: int = 0, limits: Limits = Limits()) -> DataFrame:
    """Shuffled pages with their batch number and the share of the domain that is done behind them."""
    return shuffled(df, by, seed).withColumns({
        "batch": F.floor((F.col("rn") - 1) / limits.batch_size),
        "progress": F.col("rn") * 100.0 / F.col("total"),
    })


def per_domain_limit(df: DataFrame, n: int, by: list[str] = ("url_path",), seed: int = 0) -> DataFrame:
    """The first ``n`` pages of every domain in shuffled order."""
    return shuffled(df, by, seed, limit=n)


def candidates(index: DataFrame, by: list[str] = ("url_path",), seed: int = 0, limits: Limits = Limits()) -> DataFrame:
    """The pages of a domain that the budget can reach at all; cheap, before any page is fetched."""
    return shuffled(index, by, seed, limit=limits.most_pages)


def budget_ends(sums: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(_domain, _last): the batch with which a domain stops, null without a stop, from ``_domain, _batch, _n`` (pages) and ``_hits`` (products)."""
    pages, products = F.col("_pages"), F.col("_products")
    stop = (
        (pages > limits.max_pages) | (products > limits.max_products)
        | ((pages >= limits.max_products) & (products == 0))
        | ((pages >= limits.relevance_check) & (products * 100.0 / pages < limits.relevance_threshold))
    )
    over = Window.partitionBy("_domain").orderBy("_batch").rowsBetween(Window.unboundedPreceding, 0)
    return sums.withColumns({"_pages": F.sum("_n").over(over), "_products": F.sum("_hits").over(over)}).groupBy("_domain").agg(
        F.min(F.when(stop, F.col("_batch"))).alias("_last"))


def apply_budget(ranked: DataFrame, limits: Limits = Limits(), product: str = "is_product") -> DataFrame:
    """Pages that get checked, out of candidates with ``rn``, ``total`` and a product flag.

    Batches run until one ends with too many pages or products, or with at least
    ``relevance_check`` pages of which too few were products. ``needs_live`` marks domains whose
    records were used up without any stop. Pages are folded to one row per batch before the domain's windows, which
    so have ``most_pages / batch_size`` narrow rows at most; the verdict, one row per domain, is joined to the pages.
    """
    batched = ranked.withColumn("batch", F.floor((F.col("rn") - 1) / limits.batch_size))
    sums = batched.groupBy(F.col("domain").alias("_domain"), F.col("batch").alias("_batch")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.coalesce(F.col(product), F.lit(False))).alias("_hits"))
    return (
        batched.join(budget_ends(sums, limits), F.col("domain").eqNullSafe(F.col("_domain")))
        .where(F.col("_last").isNull() | (F.col("batch") <= F.col("_last")))
        .withColumn("needs_live", F.col("_last").isNull())
        .drop("_domain", "_last")
    )


def page_budget(df: DataFrame, product: str = "is_product", by: list[str] = ("url_path",), seed: int = 0,
                limits: Limits = Limits()) -> DataFrame:
    """Order, candidates and stop rules in one go, for pages whose product flag is known."""
    return apply_budget(stored(candidates(df, by, seed, limits), "candidates"), limits, product)


def needs_live(seeds: DataFrame, checked: DataFrame) -> DataFrame:
    """Domains that get a live top-up: records used up with few products, or no records at all."""
    verdict = checked.groupBy("domain").agg(F.bool_and("needs_live").alias("_live"))
    return seeds.select("domain").distinct().join(verdict, "domain", "left").where(
        F.coalesce("_live", F.lit(True))).select("domain")


def few_products(seeds: DataFrame, pages: DataFrame, most: int = fixed.MAX_PRODUCTS,
                 product: str = "is_product") -> DataFrame:
    """Domains whose pages, all of them, hold at most ``most`` products; seeds without pages are among them."""
    found = pages.groupBy("domain").agg(F.count_if(F.col(product)).alias("_n"))
    return seeds.select("domain").distinct().join(found, "domain", "left").where(
        F.coalesce("_n", F.lit(0)) <= most).select("domain")


def novelty_streak(df: DataFrame, technologies: str = "technologies", by: list[str] = ("url_path",), seed: int = 0,
                   limits: Limits = Limits()) -> DataFrame:
    """Pages since the last one that showed a new technology of its domain (``streak``), technologies
    known so far (``known``) and whether element checks pause (``paused``).

    The pages with something new are few, at most one per technology, so each domain's list of
    them is small; the pages are joined to it with salt.
    """
    ranked = stored(shuffled(df, by, seed), "ranked")
    firsts = (
        ranked.select("domain", "rn", F.explode(technologies).alias("_tech"))
        .groupBy("domain", "_tech").agg(F.min("rn").alias("_rn"))
        .groupBy("domain").agg(F.collect_list("_rn").alias("_news"))
    )
    past = F.filter(F.coalesce("_news", F.array().cast("array<long>")), lambda n: n <= F.col("rn"))
    return (
        salted_join(ranked, firsts, ["domain"], "left")
        .withColumns({
            "streak": F.col("rn") - F.coalesce(F.array_max(past), F.lit(0)),
            "known": F.size(past),
        })
        .withColumn("paused", F.col("streak") > limits.dom_limit)
        .drop("_news")
    )
