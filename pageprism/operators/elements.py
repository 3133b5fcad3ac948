"""Element trees of pages.

Most operators read markup tokens (functions.markup_text). A tree is only needed for microdata and for selectors that look at text or
at neighbours; only those pages get one, inside the JVM (functions.tree).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageprism.functions.binding import column, let
from pageprism.functions.tree import microdata_sql, own_text_sql, tree, tree_sql
from pageprism.operators.rows import unnest


def page_elements(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    """One row per element: ``pos, parent, last`` (number of its last descendant), ``tag, attrs`` and the element's own text. Empty and
    null pages have no rows."""
    found = unnest(pages, [key], tree(html), "_e")
    return found.select(key, "_e.pos", "_e.parent", "_e.last", "_e.tag", "_e.attrs", column(own_text_sql("_e")).alias("text"))


def element_array(html: str, needed: Column) -> Column:
    """Element tree of a page as an array of structs; null where it is not ``needed``."""
    return F.when(needed, tree(html))


def microdata_items(html: str) -> Column:
    """``array<string>`` of JSON texts. Only pages that mention ``itemscope`` are parsed."""
    items = let(tree_sql(html), microdata_sql)
    return column(f"CASE WHEN contains(lower({html}), 'itemscope') THEN {items} ELSE CAST(array() AS ARRAY<STRING>) END")
