"""CSS selectors as predicates. Supported: tag, ``*``, ``#id``, ``.class``, attribute tests, ``:not``, comma lists, and the combinators
for descendants, children (``>``) and siblings (``+``, ``~``). Elements are numbered as nested intervals, so combinators compare numbers."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pageprism.functions.binding import fresh, let, q
from pageprism.functions.markup_text import attribute, is_tag
from pageprism.functions.tree import inner_text_sql

_PART = re.compile(
    r"""(?P<tag>\*|[a-zA-Z][\w-]*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)"""
    r"""|\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[*^$~|]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<uq>[^\]\s]+))\s*)?\]"""
    r"""|:not\((?P<no>(?:\[[^\]]*\]|[^)\[])*)\)""")


@dataclass(frozen=True)
class Compound:
    tag: str | None
    tests: tuple  # (attribute, operator, value)
    negated: tuple = ()  # compounds that must not fit

    def literals(self) -> list[str]:
        return [v for _, _, v in self.tests if v and not set(v) & set("&<>\"'")]


@dataclass(frozen=True)
class Selector:
    steps: tuple  # compounds from left to right
    combinators: tuple  # one of " ", ">", "+", "~" in front of each step but the first

    @property
    def simple(self) -> bool:
        return len(self.steps) == 1

    def literal(self) -> str:
        """Longest text that must occur in any page with a match; '' when there is none."""
        return max((v for s in self.steps for v in s.literals()), key=len, default="")

    def start_tags(self) -> list[str]:
        """Starts of lower-case tags that must all occur in any page with a match."""
        return sorted({"<" + s.tag for s in self.steps if s.tag})


def _compound(text: str) -> Compound:
    tag, tests, negated, at = None, [], [], 0
    while at < len(text):
        m = _PART.match(text, at)
        if not m:
            raise ValueError(f"unsupported selector: {text}")
        at = m.end()
        if m["tag"]:
            tag = None if m["tag"] == "*" else m["tag"].lower()
        elif m["id"]:
            tests.append(("id", "=", m["id"]))
        elif m["cls"]:
            tests.append(("class", "~=", m["cls"]))
        elif m["no"] is not None:
            inner = parse(m["no"])
            if not inner or not all(s.simple for s in inner):
                raise ValueError(f"unsupported selector: {text}")
            negated += [s.steps[0] for s in inner]
        else:
            value = next((m[g] for g in ("dq", "sq", "uq") if m[g] is not None), None)
            value = value if value is None else re.sub(r"\\(.)", r"\1", value)
            tests.append((m["attr"].lower(), m["op"], value))
    return Compound(tag, tuple(tests), tuple(negated))


def parse(text: str) -> list[Selector]:
    """Alternatives of a selector list."""
    whole = r"""(?:\[[^\]]*\]|:not\((?:\[[^\]]*\]|[^)\[])*\))"""
    out = []
    for part in re.findall(rf"(?:{whole}|[^,\[])+", text):
        tokens = re.findall(rf"[>+~]|(?:{whole}|[^\s>+~\[])+", part.strip())
        steps, combinators, pending = [], [], " "
        for token in tokens:
            if token in ">+~":
                pending = token
                continue
            if steps:
                combinators.append(pending)
            steps.append(_compound(token))
            pending = " "
        if not steps or pending != " ":
            raise ValueError(f"unsupported selector: {text}")
        out.append(Selector(tuple(steps), tuple(combinators)))
    return out


def _test(value: str, op: str | None, wanted: str | None) -> str:
    if op is None:
        return f"{value} IS NOT NULL"
    text = q(wanted)
    hit = {
        "=": f"{value} = {text}",
        "*=": f"contains({value}, {text})",
        "^=": f"startswith({value}, {text})",
        "$=": f"endswith({value}, {text})",
        "~=": f"array_contains(split({value}, {q(chr(92) + 's+')}), {text})",
        "|=": f"rlike({value}, {q('^' + re.escape(wanted) + '(?:-|$)')})",
    }[op]
    return f"coalesce({hit}, false)"


def _all(tests: list[str], negated: list[str]) -> str:
    return " AND ".join([f"({t})" for t in tests] + [f"NOT ({t})" for t in negated]) or "true"


def on_token(compound: Compound, token: str) -> str:
    """Does a start tag fit? Used with functions.markup_text.tokens."""
    tests = [is_tag(token, compound.tag)] if compound.tag else []
    tests += [_test(attribute(token, name), op, wanted) for name, op, wanted in compound.tests]
    return _all(tests, [on_token(c, token) for c in compound.negated])


def _on_element(compound: Compound, element: str) -> str:
    tests = [f"{element}.tag = {q(compound.tag)}"] if compound.tag else []
    tests += [_test(f"try_element_at({element}.attrs, {q(name)})", op, wanted) for name, op, wanted in compound.tests]
    return _all(tests, [_on_element(c, element) for c in compound.negated])


def on_element(selector: Selector, element: str, elements: str) -> str:
    """Does an element of a tree fit, its ancestors and siblings included?"""
    def fits(step: int, e: str) -> str:
        hit = f"({_on_element(selector.steps[step], e)})"
        if step == 0:
            return hit
        combinator = selector.combinators[step - 1]
        if combinator == ">":
            parent = f"try_element_at({elements}, CASE WHEN {e}.parent >= 0 THEN {e}.parent + 1 END)"
            return f"{hit} AND {let(parent, lambda p: f'({p} IS NOT NULL AND {fits(step - 1, p)})')}"
        other = fresh("o")
        where = {" ": f"{other}.last >= {e}.pos", "~": f"{other}.parent = {e}.parent",
                 "+": f"{other}.parent = {e}.parent AND {other}.last = {e}.pos - 1"}[combinator]
        before = f"slice({elements}, 1, {e}.pos)"  # all that begin before the element
        return f"{hit} AND exists({before}, {other} -> {where} AND {fits(step - 1, other)})"

    return fits(len(selector.steps) - 1, element)


def element_text(element: str, elements: str) -> str:
    """Text of an element and its descendants in document order."""
    return inner_text_sql(element, elements)
