"""Link frontier: breadth-first pages of each domain over a stored page/link table.

Links lie in folders by a hash of (domain, page), and a round reads only those that its front hashes to. A round is one write: the new pages, as few
files as their size asks for, whose number and folders are observed in that write. Known pages are the rounds so far; every eight
folders of them are merged into one, so a walk of many rounds reads few files and rewrites a page once per power of eight of its rounds.
"""

from __future__ import annotations

import itertools
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism.operators.ranking import rank_by_hash, shuffle_key
from pageprism.session import shared_folder, stored

BUCKETS = 64
MERGED = 8
_BUCKET = "_bucket"


@dataclass(frozen=True)
class _Stored:
    """A table in folders by bucket, and which buckets it has."""

    path: str
    buckets: frozenset
    schema: T.StructType

    def folders(self, wanted: frozenset) -> list[str]:
        return [f"{self.path}/{_BUCKET}={b}" for b in sorted(self.buckets & wanted)]


def _store(df: DataFrame, name: str, page: str, buckets: int) -> _Stored:
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/pageprism/{name}-{uuid.uuid4().hex}"
    placed = df.withColumn(_BUCKET, F.pmod(F.xxhash64("domain", page), F.lit(buckets)).cast("int"))
    placed.hint("rebalance", _BUCKET).write.partitionBy(_BUCKET).parquet(path)
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
    return _Stored(path, frozenset(int(n.split("=")[1]) for n in names if n.startswith(_BUCKET)), df.schema)


def _read(spark, tables: list[_Stored], wanted: frozenset) -> DataFrame:
    folders = [f for t in tables for f in t.folders(wanted)]
    schema = tables[0].schema
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


@dataclass(frozen=True)
class _Round:
    """Pages of some rounds, stored; how many, and as the bits of ``mask`` the buckets (modulo 64) that hold their links."""

    path: str
    rows: int
    mask: int
    schema: T.StructType

    def leads_to(self, table: _Stored) -> frozenset:
        return frozenset(b for b in table.buckets if self.mask >> b % 64 & 1)


def _store_round(df: DataFrame, buckets: int) -> _Round:
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/pageprism/front-{uuid.uuid4().hex}"
    bit = F.expr(f"shiftleft(1L, CAST(pmod(xxhash64(domain, page), {buckets}) % 64 AS INT))")
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows"), F.coalesce(F.bit_or(bit), F.lit(0)).alias("mask")).write.parquet(path)
    return _Round(path, seen.get["rows"], seen.get["mask"] & (1 << 64) - 1, df.schema)


def _read_rounds(spark, rounds: list[_Round]) -> DataFrame:
    return spark.read.schema(rounds[0].schema).parquet(*[r.path for r in rounds])


def _add(spark, levels: list[list[_Round]], new: _Round, buckets: int) -> None:
    """Adds a round; a level that is full becomes one folder of the next."""
    for i in itertools.count():
        if i == len(levels):
            levels.append([])
        levels[i].append(new)
        if len(levels[i]) < MERGED:
            break
        new = _store_round(_read_rounds(spark, levels[i]), buckets)
        levels[i] = []


def frontier(links: DataFrame, roots: DataFrame, cap: int | None = None, seed: int = 0, buckets: int = BUCKETS) -> DataFrame:
    """Pages reached from the root of each domain: ``domain, page, depth, position``.

    ``links`` has ``domain, source, target``, ``roots`` has ``domain, page``. Each round follows the links of the last round's pages and drops
    pages that are known. Rounds go on until no domain has new pages. With ``cap`` (a live crawl takes
    ``fixed.MAX_LIVE_RECORDS``) a domain ends with its first ``cap`` pages, by depth and seeded order. Every round is stored, so the plan
    does not grow with the rounds. Nulls in any column take no part.
    """
    spark = links.sparkSession
    edges = _store(links.select("domain", "source", "target").dropna().distinct(), "links", "source", buckets)
    first = roots.select("domain", "page").dropna().distinct()
    counted = first.withColumns({"depth": F.lit(0), "used": F.count(F.lit(1)).over(Window.partitionBy("domain")) if cap is not None else F.lit(0).cast("long")})
    front, levels = _store_round(counted, buckets), []
    _add(spark, levels, front, buckets)
    for depth in itertools.count(1):
        if not front.rows:
            break
        pages = _read_rounds(spark, [front])
        if cap is not None:
            pages = pages.where(F.col("used") < cap)
        found = _read(spark, [edges], front.leads_to(edges)).join(
            pages.select("domain", F.col("page").alias("source"), "used"), ["domain", "source"]).select("domain", F.col("target").alias("page"), "used").distinct()
        known = _read_rounds(spark, [r for level in levels for r in level]).select("domain", "page")
        fresh = found.join(known, ["domain", "page"], "left_anti")
        if cap is not None:  # one count per domain of the front
            fresh = stored(fresh, "found")
            added = fresh.groupBy("domain").agg(F.count(F.lit(1)).alias("_added"))
            fresh = fresh.join(added, "domain").withColumn("used", F.col("used") + F.col("_added"))
        front = _store_round(fresh.select("domain", "page", F.lit(depth).alias("depth"), "used"), buckets)
        if front.rows:
            _add(spark, levels, front, buckets)
    return _placed(_read_rounds(spark, [r for level in levels for r in level]).select("domain", "page", "depth"), cap, seed)


def _placed(found: DataFrame, cap: int | None, seed: int) -> DataFrame:
    """Adds ``position`` by depth and seeded order, in each domain from 1; with ``cap`` the first ones."""
    before = Window.partitionBy("domain").orderBy("depth").rowsBetween(Window.unboundedPreceding, -1)
    offsets = found.groupBy("domain", "depth").agg(F.count(F.lit(1)).alias("_n")).withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    ranked = rank_by_hash(found.withColumn("_order", shuffle_key("page", seed=seed)), ["domain", "depth"], "_order", ["page"], limit=cap)
    placed = ranked.join(offsets.drop("_n"), ["domain", "depth"]).select(
        "domain", "page", "depth", (F.col("rn") + F.col("_before")).cast("long").alias("position"))
    return placed if cap is None else placed.where(F.col("position") <= cap)


def on_asked_domain(pages: DataFrame, url: str = "link") -> DataFrame:
    """Answered pages whose final URL is still on the asked domain."""
    from pageprism.functions.urls import same_site

    return pages.where(same_site(url, "domain"))
