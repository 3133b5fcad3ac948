"""Technology detection: rules become literal predicates, so each pattern compiles once per task and
pages are never multiplied by rules."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageprism.functions.binding import column, each, let, only, q
from pageprism.functions.markup_text import attribute, meta_map, script_sources
from pageprism.operators import selectors
from pageprism.operators.elements import element_array
from pageprism.operators.rows import unnest
from pageprism.operators.rules import RuleSet

CHUNK = 50
HIT = "array<struct<technology:string,version:string,confidence:int,field:string>>"


def required_literal(pattern: str) -> str:
    """Longest lower-case ASCII text that every match of a pattern contains; '' when unknown."""
    if "|" in pattern or "(?" in pattern.replace("(?:", "(") or r"\Q" in pattern:
        return ""
    bare = re.sub(r"\\x\{[^}]*\}|\\x..|\\u....|\\c.|\\0[0-7]{1,3}|\\[pPN](?:\{[^}]*\}|.)|\\k<[^>]*>|\\\d+|\\[a-zA-Z]|\[(?:\\.|[^\]\\])*\]|\\(.)", lambda m: m[1] if m[1] in tuple("./-_:") else "\0", pattern)
    while (shorter := re.sub(r"\([^()]*\)[*?+]?(?:\{[^}]*\})?", "\0", bare)) != bare:
        bare = shorter
    # A quantifier makes the character in front of it optional or repeated.
    bare = re.sub(r".(?:[*?]|\{[^}]*\})[?+]?|[.^$\0()]|(?<=.)\+[?+]?", "\0", pattern and bare, flags=re.S)
    runs = [r for r in bare.split("\0") if r.isascii()]
    best = max(runs, key=len, default="").lower()
    return best if len(best) >= 3 else ""


def version(text: str, pattern: str, template: str | None, groups: int) -> str:
    """Version from the groups of a match: ``\\1``, or ``\\1?a:b`` by whether the group matched."""
    if not template:
        return "CAST(NULL AS STRING)"

    def group(n: int) -> str:
        return f"regexp_extract({text}, {q(pattern)}, {n})" if n <= groups else "''"

    def fill(tpl: str) -> str:
        parts = [p for p in re.split(r"(\\\d)", tpl) if p]
        return "concat(" + ", ".join(group(int(p[1])) if re.fullmatch(r"\\\d", p) else q(p) for p in parts) + ")"

    choice = re.fullmatch(r"\\(\d)\?([^:]*):(.*)", template)
    if choice:
        value = f"CASE WHEN {group(int(choice[1]))} <> '' THEN {fill(choice[2])} ELSE {fill(choice[3])} END"
    else:
        value = fill(template)
    return f"nullif(trim({value}), '')"


def _hit(rule, text: str, pattern: str, groups: int, present: str) -> str:
    return (f"CASE WHEN {present} THEN named_struct('technology', {q(rule.tech)}, "
            f"'version', {version(text, pattern, rule.version_tpl, groups)}, "
            f"'confidence', {rule.confidence}, 'field', {q(rule.field)}) END")


def _listed(hits: list[str]) -> Column:
    if not hits:
        return column(f"CAST(array() AS {HIT})")
    parts = [f"array_compact(array({', '.join(hits[i:i + CHUNK])}))" for i in range(0, len(hits), CHUNK)]
    return column(f"flatten(array({', '.join(parts)}))")


def _flagged(pattern: str, ignore_case: bool) -> str:
    return f"(?i){pattern}" if ignore_case else pattern


def _value_hit(rule, values: str, pattern: str, groups: int) -> str:
    """Hit of a rule over several texts: the version comes from the first one that fits."""
    fit = only(values, lambda v: f"rlike({v}, {q(pattern)})")
    return let(f"try_element_at({fit}, 1)", lambda v: _hit(rule, v, pattern, groups, f"{v} IS NOT NULL"))


def html_hits(rules: RuleSet, url: str = "url", html: str = "html", lowered: str | None = None,
              ignore_case: bool = True) -> Column:
    """URL and page-text rules. A required literal is looked for before the pattern runs."""
    hits = []
    for rule, groups in rules.rows:
        if rule.field not in ("url", "html"):
            continue
        text = url if rule.field == "url" else html
        pattern = _flagged(rule.pattern, ignore_case)
        present = f"rlike({text}, {q(pattern)})"
        literal = required_literal(rule.pattern)
        if literal and rule.field == "html" and lowered:
            present = f"CASE WHEN contains({lowered}, {q(literal)}) THEN {present} END"
        hits.append(_hit(rule, text, pattern, groups, present))
    return _listed(hits)


def header_hits(rules: RuleSet, headers: str = "headers", ignore_case: bool = True) -> Column:
    """Header rules: by lower-cased name, any of the repeated values."""
    return _listed([
        _value_hit(rule, f"try_element_at({headers}, {q(rule.key)})", _flagged(rule.pattern, ignore_case), groups)
        for rule, groups in rules.rows if rule.field == "headers"])


def meta_hits(rules: RuleSet, metas: str = "metas", sources: str = "sources", ignore_case: bool = True) -> Column:
    """Meta-tag and script-source rules over a meta map and a list of script sources."""
    hits = []
    for rule, groups in rules.rows:
        pattern = _flagged(rule.pattern, ignore_case)
        if rule.field == "meta":
            text = f"try_element_at({metas}, {q(rule.key)})"
            hits.append(_hit(rule, text, pattern, groups, f"rlike({text}, {q(pattern)})"))
        elif rule.field == "scriptSrc":
            hits.append(_value_hit(rule, sources, pattern, groups))
    return _listed(hits)


def _dom_rules(rules: RuleSet):
    for rule, groups in rules.rows:
        if rule.field == "dom":
            for selector in selectors.parse(rule.selector):
                yield rule, groups, selector


def _needs_tree(rule, selector) -> bool:
    return not selector.simple or rule.key == "#text"


def element_hits(rules: RuleSet, toks: str = "tokens", html: str = "html", tree: str | None = None,
                 ignore_case: bool = True) -> Column:
    """Selector rules. One-step selectors are decided on start tags; selectors with a text clause or
    with several steps on the element tree in column ``tree``. A text that the selector needs is
    looked for in the page before any tag is tested."""
    hits = []
    for rule, groups, selector in _dom_rules(rules):
        pattern = _flagged(rule.pattern, ignore_case) if rule.key else ""
        if not _needs_tree(rule, selector):
            fit = only(toks, lambda t: selectors.on_token(selector.steps[0], t))
            values = each(fit, lambda t: attribute(t, rule.key)) if rule.key else fit
        elif tree is None:
            continue
        else:
            fit = only(tree, lambda e: selectors.on_element(selector, e, tree))
            if rule.key == "":
                values = each(fit, lambda e: f"{e}.tag")
            elif rule.key == "#text":
                values = each(fit, lambda e: selectors.element_text(e, tree))
            else:
                values = each(fit, lambda e: f"try_element_at({e}.attrs, {q(rule.key)})")
        hit = _value_hit(rule, values, pattern, groups)
        literal = selector.literal()
        hits.append(f"CASE WHEN contains({html}, {q(literal)}) THEN {hit} END" if literal else hit)
    return _listed(hits)


def _may_match(selector, html: str) -> str:
    """Test that each page with a match of a selector passes: its text and the tags of all its steps occur."""
    texts = [f"contains({html}, {q(selector.literal())})"] if selector.literal() else []
    return " AND ".join(texts + [f"contains(lower({html}), {q(t)})" for t in selector.start_tags()]) or f"{html} IS NOT NULL"


def with_tree(pages: DataFrame, rules: RuleSet, html: str = "html") -> DataFrame:
    """Adds ``tree`` when a rule needs it, filled only for pages in which such a rule can match."""
    needed = [s for r, _, s in _dom_rules(rules) if _needs_tree(r, s)]
    if not needed:
        return pages
    gates = sorted({_may_match(s, html) for s in needed})
    return pages.withColumn("tree", element_array(html, column(" OR ".join(f"({g})" for g in gates))))


def page_technologies(pages: DataFrame, rules: RuleSet, ignore_case: bool = True, elements: bool = True) -> DataFrame:
    """Adds ``hits`` to pages with ``url, html, headers, tokens``: one struct per rule that fits."""
    work = pages.withColumns({
        "_lowered": F.lower("html"), "_metas": meta_map("tokens"), "_sources": script_sources("tokens")})
    parts = [html_hits(rules, lowered="_lowered", ignore_case=ignore_case),
             header_hits(rules, ignore_case=ignore_case),
             meta_hits(rules, "_metas", "_sources", ignore_case=ignore_case)]
    if elements:
        work = with_tree(work, rules)
        parts.append(element_hits(rules, tree="tree" if "tree" in work.columns else None, ignore_case=ignore_case))
    return work.withColumn("hits", F.concat(*parts)).drop("_lowered", "_metas", "_sources", "tree")


def detected(pages: DataFrame, keys: list[str]) -> DataFrame:
    """Technologies per key: greatest version text, total confidence over the rows."""
    return (
        unnest(pages, keys, F.col("hits"), "_h")
        .groupBy(*keys, F.col("_h.technology").alias("technology"))
        .agg(F.max("_h.version").alias("version"), F.sum("_h.confidence").alias("confidence"))
    )


def with_implied(found: DataFrame, implies: DataFrame, keys: list[str], hops: int = 1) -> DataFrame:
    """Adds implied technologies, ``hops`` steps far, without a version of their own. What is found is read once: the steps are taken in the
    rules, and each technology brings those that it implies."""
    edges = implies.select(F.col("tech").alias("technology"), "implied").distinct()
    reached = front = edges
    for _ in range(hops - 1):
        front = front.join(edges.select(F.col("technology").alias("implied"), F.col("implied").alias("_next")), "implied").select(
            "technology", F.col("_next").alias("implied")).distinct()
        reached = reached.unionByName(front)
    brought = reached.groupBy("technology").agg(F.collect_set("implied").alias("_implied"))
    none = F.lit(None).cast("string")
    rows = F.concat(F.array(F.struct("technology", "version")), F.coalesce(
        F.transform("_implied", lambda i: F.struct(i.alias("technology"), none.alias("version"))), F.array().cast("array<struct<technology:string,version:string>>")))
    known = found.select(*keys, "technology", "version").join(brought if hops else brought.limit(0), "technology", "left")
    return known.select(*keys, F.explode(rows).alias("_r")).groupBy(*keys, F.col("_r.technology").alias("technology")).agg(
        F.max("_r.version").alias("version"))


def with_categories(found: DataFrame, tech_categories: DataFrame) -> DataFrame:
    """Adds category names in rule order; an empty list for unknown technologies."""
    named = tech_categories.groupBy(F.col("tech").alias("technology")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "name"))).alias("_c"))
    return found.join(named, "technology", "left").withColumn(
        "categories", F.coalesce(F.transform("_c", lambda c: c["name"]), F.array().cast("array<string>"))
    ).drop("_c")
