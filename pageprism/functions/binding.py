"""SQL fragments for row expressions.

Expressions with many lambdas are written as SQL text: one fragment is parsed once, while every lambda of
the Column API costs several round trips to the JVM. Fragments are plain strings, so they nest.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_numbers = itertools.count()


def q(text: str) -> str:
    """SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def fresh(stem: str = "v") -> str:
    return f"_{stem}{next(_numbers)}"


def let(value: str, body: Callable[[str], str]) -> str:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    name = fresh()
    return f"element_at(transform(array({value}), {name} -> {body(name)}), 1)"


def each(values: str, body: Callable[[str], str]) -> str:
    name = fresh()
    return f"transform({values}, {name} -> {body(name)})"


def only(values: str, test: Callable[[str], str]) -> str:
    name = fresh()
    return f"filter({values}, {name} -> {test(name)})"


def first(values: str) -> str:
    """First element that is not null; null when there is none."""
    return f"try_element_at({only(values, lambda v: f'{v} IS NOT NULL')}, 1)"


def column(fragment: str) -> Column:
    return F.expr(fragment)
