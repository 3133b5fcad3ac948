"""Links of pages: external, internal, hosts, social accounts, live pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pageprism.functions.social import social_accounts
from pageprism.functions.urls import (
    authority, canonical_link, is_page_link, is_page_path, resolve_link, same_site, site_root, strip_www,
)
from pageprism.operators.dedupe import keep_first
from pageprism.operators.rows import unnest, unnest_positions


def page_links(pages: DataFrame, links: str = "links") -> DataFrame:
    """One row per link of a page: its position and target."""
    keep = [c for c in pages.columns if c != links]
    return unnest_positions(pages, keep, F.col(links), "pos", "href")


def external_links(links: DataFrame, match: str = "host") -> DataFrame:
    """Absolute links that leave the domain."""
    return links.where(F.col("href").startswith("http") & ~same_site("href", "domain", match))


def distinct_links(links: DataFrame) -> DataFrame:
    """Exact targets once per domain."""
    return links.select("domain", "href").distinct()


def link_hosts(links: DataFrame) -> DataFrame:
    """Distinct external targets per foreign host; the domain itself and bad URLs are left out."""
    return (
        distinct_links(links)
        .withColumn("external_link", strip_www(authority("href")))
        .where(F.col("external_link").isNotNull() & (F.col("external_link") != F.col("domain")))
        .groupBy("domain", "external_link")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def internal_links(links: DataFrame, page_url: str = "url", relative: bool = True, match: str = "host") -> DataFrame:
    """Canonical targets on the same domain, once per page: what a crawler would follow.

    ``relative`` also follows relative links, resolved against the root of the page's site.
    """
    absolute = F.col("href").startswith("http")
    inside = absolute & same_site("href", "domain", match)
    if relative:
        target = resolve_link(site_root(page_url, "domain"), "href")
        wanted = is_page_link("href") & (inside | ~absolute)
    else:
        target, wanted = canonical_link("href"), inside
    return (
        links.where(wanted).select("domain", page_url, target.alias("link"))
        .where(is_page_path("link")).distinct()
    )


def social_links(links: DataFrame, order: list[str] = ("pos",)) -> DataFrame:
    """Social accounts per domain. An account is listed once, under the first platform that claims it."""
    found = unnest(links, ["domain", *order], social_accounts("href"), "_s").select(
        "domain", *order, F.col("_s.rank").alias("_rank"),
        F.col("_s.platform").alias("social_platform"), F.col("_s.account").alias("social_link"))
    return keep_first(found, ["domain", "social_link"], [*order, "_rank"]).select(
        "domain", "social_platform", "social_link")


def live_only(live: DataFrame, archive: DataFrame, link: str = "link", url: str = "url") -> DataFrame:
    """Live pages whose link the archive does not hold."""
    known = archive.select("domain", F.col(url).alias(link)).distinct()
    return live.join(known, ["domain", link], "left_anti")


def archive_and_live(archive: DataFrame, live: DataFrame) -> DataFrame:
    """Both page sets in one frame, marked by ``origin``."""
    return archive.withColumn("origin", F.lit("archive")).unionByName(
        live.withColumn("origin", F.lit("live")), allowMissingColumns=True)
