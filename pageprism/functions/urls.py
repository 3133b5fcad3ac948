"""URL functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageprism import fixed

_QUERY_OR_FRAGMENT = r"(\?.+)|(#.+)"
_AUTHORITY = r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_query(url) -> Column:
    """URL without query string and fragment. A bare trailing ``?`` or ``#`` stays."""
    return F.regexp_replace(_col(url), _QUERY_OR_FRAGMENT, "")


def normalize_url(domain, url_path) -> Column:
    """``https://`` + domain + path, trailing slashes stripped, then query and fragment dropped."""
    return drop_query(F.rtrim(F.concat(F.lit("https://"), _col(domain), _col(url_path)), F.lit("/")))


def canonical_link(url) -> Column:
    """Form in which followed links are compared: no query, no fragment, no spaces."""
    return F.replace(drop_query(url), F.lit(" "), F.lit(""))


def authority(url) -> Column:
    """``host[:port]`` of an absolute URL; null when there is none or its brackets do not match."""
    part = F.regexp_extract(_col(url), _AUTHORITY, 1)
    broken = part.contains("[") != part.contains("]")
    return F.when((part != "") & ~broken, part)


def url_host(url) -> Column:
    """Host of an absolute URL, without user and port, lower-cased."""
    no_user = F.regexp_replace(authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(no_user, r":\d*$", ""))


def strip_www(host) -> Column:
    """Host without a ``www.``/``ww1.``/``w3.`` label, as long as a dot remains behind it."""
    host = _col(host)
    return F.regexp_replace(host, r"^(?:www?\d*|w\d)\.(?=[^.]+\.)", "")


def url_path(url) -> Column:
    """Everything behind the authority."""
    return F.regexp_replace(_col(url), _AUTHORITY, "")


def same_site(url, domain, match: str = "host") -> Column:
    """Is ``url`` on ``domain``? ``match='substring'`` only asks for the text to occur in the URL."""
    url, domain = _col(url), _col(domain)
    if match == "substring":
        return url.contains(domain)
    host = F.coalesce(url_host(url), F.lit(""))
    return (host == F.lower(domain)) | host.endswith(F.concat(F.lit("."), F.lower(domain)))


def site_root(url, domain) -> Column:
    """Scheme and host when the page is on the domain, else the URL without trailing slashes."""
    url = _col(url)
    root = F.regexp_extract(url, r"^(https?://[^/]+)(?:/.*)?$", 1)
    return F.when(same_site(url, domain) & (root != ""), root).otherwise(F.rtrim(url, F.lit("/")))


def resolve_link(root, href) -> Column:
    """Absolute form of a link: absolute links stay, everything else is appended to the site root."""
    href = _col(href)
    return canonical_link(F.when(href.startswith("http"), href).otherwise(F.concat(_col(root), href)))


def is_page_path(path) -> Column:
    """False for paths that end in a file suffix. Case-sensitive; a null path counts as a page."""
    suffixes = "|".join(re.escape(s) for s in fixed.FILE_SUFFIXES)
    return ~F.coalesce(_col(path).rlike(rf"(?:{suffixes})\z"), F.lit(False))


def is_product_path(path) -> Column:
    """True when the path carries one of the product markers."""
    return F.coalesce(_col(path).rlike("|".join(fixed.PRODUCT_MARKERS)), F.lit(False))


def is_page_link(href) -> Column:
    """False for mail, phone, script, data and same-page links."""
    prefixes = "|".join(re.escape(p) for p in fixed.NON_PAGE_PREFIXES)
    return ~_col(href).rlike(f"^(?:{prefixes})")


def crawl_id(week) -> Column:
    return F.concat(F.lit(fixed.CRAWL_PREFIX), _col(week))
