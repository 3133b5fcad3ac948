"""HTML as an array of markup tokens, made by one regular expression inside the JVM.

A token is a whole start tag; for script, style, title and textarea it runs to the end tag, and
comments are swallowed, so markup inside scripts and comments is never taken for markup.
"""

from __future__ import annotations

import re

from pyspark.sql import Column

from pageprism.functions.binding import column, each, let, only, q
from pageprism.functions.text import clean_text_sql, plain_references_sql, unescape_kept_sql

# Possessive repeats keep the matcher iterative on tags and pages of any length.
_ATTRS = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    rf"|<(script|style|title|textarea)(?=[\s/>]){_ATTRS}>.*?(?:</\1\s*>|\z)"
    rf"|<[a-z]{_ATTRS}>"
    r"|<[a-z][^>]*+>"
)


def tokens(html: str) -> Column:
    """``array<string>`` of the markup tokens of a page, in document order, without comments, with plain
    references (see ``functions.text``)."""
    found = f"regexp_extract_all(coalesce({html}, ''), {q(_TOKEN)}, 0)"
    return column(each(only(found, lambda t: f"NOT startswith({t}, '<!')"), plain_references_sql))


def is_tag(token: str, name: str) -> str:
    """Is a token a start tag of this (lower-case) name? The pattern only runs on tokens that begin like it."""
    begins = f"lower(substr({token}, 1, {len(name) + 1})) = {q('<' + name)}"
    return f"({begins} AND {token} RLIKE {q(rf'(?i)^<{re.escape(name)}[\s/>]')})"


def attribute(token: str, name: str) -> str:
    """Value of an attribute of a start tag: ``''`` when it has no value, null when it is missing. The patterns only run on
    tokens that hold the name in some way."""
    held = f"contains(lower({token}), {q(name.lower())})"
    name = re.escape(name)
    other = (rf"""[\s/]+(?!{name}[\s=/>])[^\s=/>]++"""
             r"""(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?+""")
    head = rf"(?is)^<[a-z][^\s/>]*+(?:{other})*+[\s/]+{name}(?=[\s=/>])"
    quoted = rf"""{head}\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
    unquoted = r"""(?s)^(["'])(.*)\1$"""
    value = let(f"regexp_extract({token}, {q(quoted)}, 1)", lambda raw: (
        f"CASE WHEN {raw} <> '' THEN {unescape_kept_sql(f'regexp_replace({raw}, {q(unquoted)}, {q('$2')})')} "
        f"WHEN {token} RLIKE {q(head)} THEN '' END"))
    return f"CASE WHEN {held} THEN {value} END"


def tags(toks: str, name: str) -> str:
    return only(toks, lambda t: is_tag(t, name))


def attribute_values(toks: str, tag: str, name: str) -> str:
    """Values of one attribute over all tags of a kind, in document order; missing ones left out."""
    return only(each(tags(toks, tag), lambda t: attribute(t, name)), lambda v: f"{v} IS NOT NULL")


def anchors(toks: str) -> Column:
    """Link targets of a page in document order."""
    return column(attribute_values(toks, "a", "href"))


def script_sources_sql(toks: str) -> str:
    return attribute_values(toks, "script", "src")


def script_sources(toks: str) -> Column:
    return column(script_sources_sql(toks))


def _meta_pairs(toks: str, key: str, lower: bool = False) -> str:
    def pair(t: str) -> str:
        name = f"lower({attribute(t, key)})" if lower else attribute(t, key)
        return f"named_struct('name', {name}, 'content', {attribute(t, 'content')})"

    return only(each(tags(toks, "meta"), pair), lambda p: f"{p}.name IS NOT NULL AND {p}.content IS NOT NULL")


def meta_map_sql(toks: str) -> str:
    return let(_meta_pairs(toks, "name", lower=True), lambda pairs: (
        f"map_from_entries(filter({pairs}, (p, i) -> NOT exists(slice({pairs}, i + 2, size({pairs})), "
        "o -> o.name = p.name)))"))


def meta_map(toks: str) -> Column:
    """Named meta tags as ``map<string,string>``: names lower-cased, the last one wins."""
    return column(meta_map_sql(toks))


def property_map(toks: str) -> Column:
    """Namespaced property meta tags (``og:title``) as a map; the first non-empty value wins."""
    filled = only(_meta_pairs(toks, "property"), lambda p: f"contains({p}.name, ':') AND trim({p}.content) <> ''")
    return column(let(filled, lambda pairs: (
        f"map_from_entries(filter({pairs}, (p, i) -> NOT exists(slice({pairs}, 1, i), o -> o.name = p.name)))")))


def linked_data(toks: str) -> Column:
    """Texts of the JSON-LD scripts of a page."""
    scripts = only(tags(toks, "script"), lambda t: (
        f"contains({t}, 'ld+json') AND lower(trim({attribute(t, 'type')})) = 'application/ld+json'"))
    return column(each(scripts, lambda t: (
        f"regexp_replace(regexp_replace({t}, {q(rf'(?is)^<script{_ATTRS}>')}, ''), {q(r'(?i)</script\s*>$')}, '')")))


def page_head(toks: str) -> Column:
    """``struct<language, page_title, page_description, page_keywords>`` of a page."""
    def read(head: str) -> str:
        title = (f"regexp_replace(regexp_replace(try_element_at({tags(head, 'title')}, 1), "
                 f"{q(rf'(?is)^<title{_ATTRS}>')}, ''), {q(r'(?i)</title\s*>$')}, '')")

        def named(pairs: str, name: str) -> str:
            return f"try_element_at({only(pairs, lambda p: f'{p}.name = {q(name)}')}, 1).content"

        language = f"element_at(split(try_element_at({attribute_values(toks, 'html', 'lang')}, 1), '[-_]'), 1)"
        texts = let(_meta_pairs(head, "name"), lambda pairs: (
            f"array(nullif({title}, ''), {named(pairs, 'description')}, {named(pairs, 'keywords')})"))
        return let(each(texts, clean_text_sql), lambda t: (
            f"named_struct('language', {language}, 'page_title', {t}[0], 'page_description', {t}[1], "
            f"'page_keywords', {t}[2])"))

    body = f"CAST(array_position({each(toks, lambda t: is_tag(t, 'body'))}, true) AS INT)"
    head = let(body, lambda b: f"CASE WHEN {b} > 0 THEN slice({toks}, 1, {b} - 1) ELSE {toks} END")
    return column(let(head, read))
