"""Social accounts in links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageprism import fixed


def social_accounts(link) -> Column:
    """Link -> ``array<struct<platform, rank, account>>``: one entry per platform that fits, in
    platform order, cut behind the account part and without a trailing slash."""
    link = F.col(link) if isinstance(link, str) else link
    found = []
    for rank, (platform, include, exclude, keep) in enumerate(fixed.SOCIAL_PLATFORMS):
        account = F.regexp_replace(F.regexp_extract(link, keep, 0), "/$", "")
        hit = link.rlike(include)
        if exclude:
            hit = hit & ~link.rlike(exclude)
        found.append(F.when(hit & (account != ""), F.struct(
            F.lit(platform).alias("platform"), F.lit(rank).alias("rank"), account.alias("account"))))
    return F.array_compact(F.array(*found))
