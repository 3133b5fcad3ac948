"""Structured markup: OpenGraph, microdata and JSON-LD items in one shape, and the product fields in them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.functions.binding import column, each, first, let, only, q
from pageprism.functions.markup_text import linked_data, property_map
from pageprism.functions.price import clean_price_sql, plain_number_sql
from pageprism.functions.text import clean_text_sql
from pageprism.operators.elements import microdata_items
from pageprism.operators.rows import unnest

SYNTAXES = ["opengraph", "microdata", "jsonld"]
FIELDS = ["product_title", "product_description", "brand", "price", "currency"]
_NONE = "CAST(array() AS ARRAY<VARIANT>)"


def _get(v: str, *keys) -> str:
    path = "$" + "".join(f"[{k}]" if isinstance(k, int) else f"['{k}']" for k in keys)
    return f"try_variant_get({v}, {q(path)}, 'variant')"


def _items(v: str) -> str:
    """Elements of an array value; null when it is none."""
    return f"try_variant_get({v}, '$', 'array<variant>')"


def _fields(v: str) -> str:
    """Fields of an object value; null when it is none."""
    return f"try_variant_get({v}, '$', 'map<string,variant>')"


def _is_object(v: str) -> str:
    return f"coalesce(startswith(schema_of_variant({v}), 'OBJECT'), false)"


def _text(v: str) -> str:
    """A value, only when it is a string."""
    return let(v, lambda x: f"CASE WHEN schema_of_variant({x}) = 'STRING' THEN try_variant_get({x}, '$', 'string') END")


def _shown(v: str) -> str:
    """A scalar as text; numbers in plain shortest form."""
    def read(x: str) -> str:
        number = plain_number_sql(f"try_variant_get({x}, '$', 'double')")
        return let(f"schema_of_variant({x})", lambda kind: (
            f"CASE WHEN {kind} IN ('STRING', 'BIGINT') THEN try_variant_get({x}, '$', 'string') "
            f"WHEN {kind} IN ('DOUBLE', 'FLOAT') OR startswith({kind}, 'DECIMAL') THEN {number} END"))

    return let(v, read)


def _keys(names: list[str]) -> str:
    return f"array({', '.join(q(n) for n in names)})"


def _levels(v: str) -> str:
    """Field maps of the item, of its offers object and of each offer in its list, in this order."""
    parts = f"concat(array({v}, {_get(v, 'offers')}), coalesce({_items(_get(v, 'offers'))}, {_NONE}))"
    return only(each(parts, _fields), lambda m: f"{m} IS NOT NULL")


def _any_text(levels: str, names: list[str]) -> str:
    """First text under one of the names, level by level."""
    return first(f"flatten({each(levels, lambda m: each(_keys(names), lambda k: _text(f'try_element_at({m}, {k})')))})")


def _any_shown(fields: str, names: list[str]) -> str:
    return first(each(_keys(names), lambda k: _shown(f"try_element_at({fields}, {k})")))


def _brand(levels: str) -> str:
    """Brand text, the name inside a brand object, or the brand name of a nested ``object``."""
    def read(b: str) -> str:
        return f"coalesce({_text(b)}, {_text(_get(b, 'name'))}, {_text(_get(b, 'brand', 'name'))})"

    own = first(each(_keys(fixed.BRAND_KEYS), lambda k: let(f"try_element_at({levels}[0], {k})", read)))
    return f"coalesce({own}, {_any_text(f'slice({levels}, 2, size({levels}))', fixed.BRAND_KEYS)})"


def _offer(v: str) -> str:
    """The offers object, or the first offer of the list (or of the list inside it)."""
    return let(_get(v, "offers"), lambda o: (
        f"try_element_at({only(f'array({o}, {_get(o, 0)}, {_get(o, 0, 0)})', _is_object)}, 1)"))


def _trusted(offer: str, name: str, own: str) -> str:
    """Value of an offer that names its currency; else of the item; else of an offer without currency."""
    shown = _shown(_get(offer, name))
    return (f"CASE WHEN {_shown(_get(offer, 'priceCurrency'))} IS NOT NULL THEN {shown} "
            f"ELSE coalesce({own}, {shown}) END")


def product_fields(v: str) -> str:
    """Struct of the fields of one item, by field name; empty offers lists and objects without a name give nulls."""
    def read(levels: str) -> str:
        own = f"{levels}[0]"

        def with_offer(offer: str) -> str:
            currency = (f"CASE WHEN {offer} IS NOT NULL THEN {_shown(_get(offer, 'priceCurrency'))} "
                        f"ELSE {_any_shown(own, fixed.CURRENCY_KEYS)} END")
            price = _trusted(offer, "price", _any_shown(own, fixed.PRICE_KEYS))
            # One cleaning expression for all texts keeps the plan small.
            texts = each(f"array({_any_text(levels, fixed.TITLE_KEYS)}, {_any_text(levels, fixed.DESCRIPTION_KEYS)}, "
                         f"{_brand(levels)})", clean_text_sql)
            return let(texts, lambda t: (
                f"named_struct('product_title', {t}[0], 'product_description', {t}[1], 'brand', {t}[2], "
                f"'price', {clean_price_sql(price)}, 'currency', {currency})"))

        return let(_offer(v), with_offer)

    return let(_levels(v), read)


def extra_fields(v: str) -> str:
    """Struct of category, lowest and highest price of one item."""
    def read(levels: str) -> str:
        def with_offer(offer: str) -> str:
            low, high = (clean_price_sql(_trusted(offer, n, _any_shown(f"{levels}[0]", [n]))) for n in ("lowPrice", "highPrice"))
            return (f"named_struct('category', {clean_text_sql(_any_text(levels, fixed.CATEGORY_KEYS))}, "
                    f"'low_price', {low}, 'high_price', {high})")

        return let(_offer(v), with_offer)

    return let(_levels(v), read)


def _parsed(texts: str) -> str:
    return only(each(texts, lambda t: f"try_parse_json({t})"), lambda v: f"{v} IS NOT NULL")


def _type_list(v: str) -> str:
    return f"try_variant_get({v}, {q("$['@type']")}, 'array<string>')"


def _types(v: str) -> str:
    """Which product types an item has, in their order: texts match by substring, lists by membership."""
    return let(_text(_get(v, "@type")), lambda text: let(_type_list(v), lambda listed: each(
        _keys(fixed.PRODUCT_TYPES),
        lambda t: f"coalesce(contains({text}, {t}), array_contains({listed}, {t}), false)")))


def described_products(scripts: str) -> str:
    """Products among JSON-LD scripts: first item of a list, main entity of a page, type Product only."""
    heads = each(_parsed(scripts), lambda v: f"CASE WHEN {_items(v)} IS NOT NULL THEN {_get(v, 0)} ELSE {v} END")
    entities = each(heads, lambda v: let(_get(v, "mainEntity"), lambda e: (
        f"CASE WHEN {_is_object(e)} THEN {e} ELSE {v} END")))
    return only(entities, lambda v: (
        f"coalesce({_text(_get(v, '@type'))} = 'Product', array_contains({_type_list(v)}, 'Product'), false)"))


def markup_columns(pages: DataFrame, toks: str = "tokens", html: str = "html") -> DataFrame:
    """Adds ``opengraph``, ``microdata`` and ``jsonld``, each an ``array<variant>`` in document order."""
    work = pages.withColumns({
        "_micro": microdata_items(html),
        "_props": property_map(toks),
        "_scripts": linked_data(toks),
    })
    typed = ("CASE WHEN map_contains_key(_props, 'og:type') THEN map_concat(map('@type', _props['og:type']), "
             "map_filter(_props, (k, v) -> k <> 'og:type')) ELSE _props END")
    listed = f"flatten({each(_parsed('_scripts'), lambda v: f'coalesce({_items(v)}, array({v}))')})"
    return work.withColumns({
        "opengraph": column(f"CASE WHEN size(_props) > 0 THEN array(to_variant_object({typed})) ELSE {_NONE} END"),
        "microdata": column(_parsed("_micro")),
        "jsonld": column(f"CASE WHEN size(_scripts) > 0 THEN concat({listed}, {described_products('_scripts')}) "
                         f"ELSE {_NONE} END"),
    }).drop("_micro", "_props", "_scripts")


def markup_items(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """One row per item: ``key, syntax, seq, item`` (variant)."""
    parts = ", ".join(f"transform({s}, (v, i) -> named_struct('syntax', '{s}', 'seq', i, 'item', v))" for s in SYNTAXES)
    return unnest(pages, [key], column(f"concat({parts})"), "_i").select(
        key, "_i.syntax", "_i.seq", "_i.item")


def candidates(items: str) -> str:
    """Items that may describe the product, best first. A product group stands for its variants;
    the blocks of graphs come before the items when there are several items, else behind them."""
    def variants(head: str) -> str:
        listed = let(_get(head, "hasVariant"), lambda v: (
            f"coalesce({_items(v)}, CASE WHEN {_is_object(v)} THEN array({v}) END)"))
        return f"CASE WHEN {_text(_get(head, '@type'))} = 'ProductGroup' THEN {listed} END"

    def ordered(grouped: str) -> str:
        blocks = f"flatten({each(grouped, lambda v: f'coalesce({_items(_get(v, '@graph'))}, {_NONE})')})"
        return let(blocks, lambda b: (
            f"CASE WHEN size({grouped}) > 1 THEN concat({b}, {grouped}) ELSE concat({grouped}, {b}) END"))

    return let(f"coalesce({let(f'try_element_at({items}, 1)', variants)}, {items})", ordered)


def _longest(picks: str, field: str) -> str:
    """Longest text wins, the earliest among equals."""
    shown = plain_number_sql(f"p.{field}") if field == "price" else f"p.{field}"
    return (f"array_max(transform({picks}, (p, i) -> CASE WHEN p.{field} IS NOT NULL THEN "
            f"named_struct('n', length({shown}), 'r', -i, 'v', p.{field}) END)).v")


def merge_markup(pages: DataFrame) -> DataFrame:
    """Adds the five product fields from the three item columns, inside the row: no shuffle.

    Per syntax and type the first fitting candidate speaks; each field takes its best value on its own.
    """
    # All syntaxes and types go through the same expressions, by number, which keeps the plan small.
    listed = f"array({', '.join(SYNTAXES)})"
    numbered = (f"flatten(transform({listed}, (items, n) -> transform({candidates('items')}, "
                f"v -> named_struct('syntax', n, 'types', {_types('v')}, 'item', v))))")
    fit = only(numbered, lambda c: f"array_contains({c}.types, true)")
    described = each("_fit", lambda c: (
        f"named_struct('syntax', {c}.syntax, 'types', {c}.types, 'fields', {product_fields(f'{c}.item')})"))
    picks = (f"flatten(transform(sequence(0, {len(SYNTAXES) - 1}), n -> transform(sequence(0, {len(fixed.PRODUCT_TYPES) - 1}), "
             "k -> try_element_at(filter(_described, d -> d.syntax = n AND d.types[k]), 1).fields)))")
    work = pages.withColumn("_fit", column(fit)).withColumn("_described", column(described)).withColumn(
        "_picks", column(f"CASE WHEN size(_described) > 0 THEN {picks} END"))
    return work.withColumns({f: column(_longest("_picks", f)) for f in FIELDS}).drop("_fit", "_described", "_picks")
