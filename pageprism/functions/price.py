"""Prices and currencies."""

from __future__ import annotations

from pyspark.sql import Column

from pageprism import fixed
from pageprism.functions.binding import column, let, q
from pageprism.functions.text import clean_text_sql


def clean_price_sql(text: str) -> str:
    def number(n: str) -> str:
        dotted = f"CASE WHEN {n} RLIKE {q(',[0-9]{2}$')} THEN replace({n}, ',', '.') ELSE {n} END"
        return f"try_cast(regexp_replace({dotted}, {q('[,.](?=[0-9]{3}(?:[^0-9]|$))')}, '') AS DOUBLE)"

    def read(packed: str) -> str:
        found = q(r"[+-]?\d++(?:[,.]\d++)++(?:[eE][+-]?\d+)?|\d++(?:[eE][+-]?\d+)?")
        refused = q(r"\D+\.|^\.")
        return (f"CASE WHEN NOT {packed} RLIKE {refused} THEN "
                + let(f"regexp_extract({packed}, {found}, 0)", number) + " END")

    return let(f"regexp_replace({text}, {q(chr(91) + ' ' + chr(160) + chr(39) + chr(93))}, '')", read)


def clean_price(text: str) -> Column:
    """Number in a price text, whatever its separators mean; null when it is not a price.

    ``,dd`` at the end is a decimal comma; a separator in front of exactly three digits is a
    thousands separator. Texts with letters right before a dot, or a leading dot, are refused.
    """
    return column(clean_price_sql(text))


def plain_number_sql(value: str) -> str:
    """Number as shortest decimal text without an exponent, at least one decimal (``900.0``)."""
    fixed_point = f"CAST(try_cast({value} AS DECIMAL(38,10)) AS STRING)"
    return f"regexp_replace(regexp_replace({fixed_point}, '0+$', ''), {q('[.]$')}, '.0')"


def _matched(lowered: str, needed: str, pattern: str) -> str:
    """First group of the first match; pages without the text that each match contains are not searched."""
    return (f"CASE WHEN contains({lowered}, {q(needed)}) THEN "
            f"nullif(regexp_extract({lowered}, {q('(?U)' + pattern)}, 1), '') END")


def html_price(lowered: str) -> Column:
    """First usable price in a lower-cased page, trying the patterns in order."""
    found = [let(_matched(lowered, *p), lambda m: f"CASE WHEN {m} IS NOT NULL THEN nullif({clean_price_sql(m)}, 0D) END")
             for p in fixed.PRICE_PATTERNS]
    return column(f"coalesce({', '.join(found)})")


def html_currency(lowered: str) -> Column:
    """First currency in a lower-cased page, trying the patterns in order."""
    found = ", ".join(_matched(lowered, *p) for p in fixed.CURRENCY_PATTERNS)
    # Only the last pattern can match text that needs cleaning, so cleaning the first match is enough.
    return column(f"nullif({clean_text_sql(f'coalesce({found})')}, '')")
