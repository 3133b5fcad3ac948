"""Technology rules as a table of any length: pages meet only the rules that may fit, by an index over pieces of the rules' texts.

Most patterns can't match without a certain text. Of each rule's text the piece of ``GRAM`` characters that fewest rules share goes into the index. Pages give
their different pieces, which a bit map first thins out to those that any rule has; the rest are joined with the index. So each page gets the short
list of rules whose piece it holds, and only on these the text and then the pattern is tried. Rules whose text is shorter than a piece are tried on every page.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism.functions.binding import column, each, let, only, q
from pageprism.operators.rules import bodies, rule_table
from pageprism.operators.technology import required_literal
from pageprism.session import stored

GRAM = 4
WORD = "[a-z0-9]+"
INNER_WORD = "(?<=[^a-z0-9])[a-z0-9]+(?=[^a-z0-9])"
#: Rules that may share a word of the index; those of more frequent words are indexed by their pieces.
MOST_SHARED = 64
#: Behind the name of a field: its words instead of its pieces.
WORDS = "#"
#: Bits of the map of indexed pieces and words, 128 KB as a literal of the plan.
MAP_BITS = 1 << 20
MOST_GROUPS = 9
HIT = "struct<technology:string,version:string,confidence:int,field:string>"
FIELDS = ("url", "html")


@F.pandas_udf(T.StringType())
def _literals(patterns: pd.Series) -> pd.Series:
    return patterns.map(lambda p: required_literal(p or ""))


@F.pandas_udf(T.IntegerType())
def _groups(patterns: pd.Series) -> pd.Series:
    def count(pattern: str | None) -> int:
        found, at, inside, p = 0, 0, False, pattern or ""
        while at < len(p):
            if p[at] == "\\":
                at += 1
            elif inside:
                inside = p[at] != "]"
            elif p[at] == "[":
                inside = True
                at += p[at + 1:at + 2] == "]" or 2 * (p[at + 1:at + 3] == "^]")
            elif p[at] == "(":
                found += p[at + 1:at + 2] != "?" or p[at + 1:at + 3] == "?<" and p[at + 3:at + 4] not in ("=", "!")
            at += 1
        return found

    return patterns.map(count)


def indexable(rules: DataFrame) -> DataFrame:
    """Rules on the address or the text of a page, ready for ``matches``: ``rule`` (a number), ``tech, field, pattern, version_tpl, confidence,
    literal, groups``. Patterns that don't compile are left out; ``invalid`` lists them."""
    wanted = rules.where(F.col("field").isin(*FIELDS) & F.col("pattern").isNotNull())
    valid = wanted.where(F.expr("try_reflect('java.util.regex.Pattern', 'compile', pattern)").isNotNull())
    named = valid.dropDuplicates(["tech", "field", "pattern", "version_tpl", "confidence"])
    return named.select(F.xxhash64("tech", "field", "pattern", F.coalesce("version_tpl", F.lit("")), "confidence").alias("rule"), "tech", "field", "pattern",
                        "version_tpl", "confidence", _literals("pattern").alias("literal"), _groups("pattern").alias("groups"))


def invalid(rules: DataFrame) -> DataFrame:
    """Rules whose pattern doesn't compile."""
    return rules.where(F.expr("try_reflect('java.util.regex.Pattern', 'compile', pattern)").isNull() & F.col("pattern").isNotNull())


def rules_of_files(files: DataFrame) -> DataFrame:
    """Rule table of ``file, text`` rows, without passing the driver."""
    return indexable(rule_table(bodies(files)))


def grams(text: str) -> str:
    """Different pieces of ``GRAM`` characters of a text, each start once: one pass of a pattern per offset."""
    parts = [f"regexp_extract_all(substr({text}, {k + 1}), {q('(?s).{%d}' % GRAM)}, 0)" for k in range(GRAM)]
    return f"array_distinct(concat({', '.join(parts)}))"


def words(text: str, pattern: str = WORD) -> str:
    return f"array_distinct(regexp_extract_all({text}, {q(pattern)}, 0))"


def _rarest(rules: DataFrame, pieces: str) -> DataFrame:
    """(rule, field, b): for each rule the piece that fewest rules have, with their number."""
    found = rules.select("rule", "field", F.explode(column(pieces)).alias("gram"))
    shared = found.groupBy("field", "gram").agg(F.count(F.lit(1)).alias("n"))
    return found.join(shared, ["field", "gram"]).groupBy("rule", "field").agg(F.min(F.struct("n", "gram")).alias("b"))


def rarest_grams(rules: DataFrame) -> DataFrame:
    """(field, gram, rule): for each rule the inner word of its text that fewest rules have (``field`` with ``WORDS``), if they are few, else the
    piece that fewest have."""
    long = rules.where(F.length("literal") >= GRAM)
    by_word = _rarest(long, words("literal", INNER_WORD)).where(F.col("b.n") <= MOST_SHARED)
    by_piece = _rarest(long.join(by_word.select("rule"), "rule", "left_anti"), grams("literal"))
    return by_word.withColumn("field", F.concat("field", F.lit(WORDS))).unionByName(by_piece).select("field", F.col("b.gram").alias("gram"), "rule")


def _bit(gram: str) -> str:
    return f"pmod(xxhash64({gram}), {MAP_BITS})"


def bit_map(index: DataFrame) -> bytes:
    """Which pieces occur in the index, by hash; of fixed size."""
    bits = index.select(column(_bit("concat(field, gram)")).alias("bit")).distinct()
    words = bits.groupBy((F.col("bit") / 8).cast("long").alias("byte")).agg(F.expr("bit_or(shiftleft(1, CAST(bit % 8 AS INT)))").alias("v"))
    out = bytearray(MAP_BITS // 8)
    for r in words.collect():
        out[r.byte] = r.v
    return bytes(out)


def _in_map(gram: str, field: str, table: bytes) -> str:
    byte = lambda b: f"conv(hex(substring(X'{table.hex()}', CAST({b} DIV 8 AS INT) + 1, 1)), 16, 10)"
    return let(_bit(f"concat({q(field)}, {gram})"), lambda b: f"(CAST({byte(b)} AS INT) & shiftleft(1, CAST({b} % 8 AS INT))) <> 0")


def candidates(pages: DataFrame, key: str, rules: DataFrame, index: DataFrame, table: bytes) -> DataFrame:
    """(key, rules): for each page the rules whose piece it holds."""
    def pieces(kind: str) -> str:
        text = f"coalesce(lower({kind.removesuffix(WORDS)}), '')"
        return each(only(words(text) if kind.endswith(WORDS) else grams(text), lambda g: _in_map(g, kind, table)),
                    lambda g: f"named_struct('field', {q(kind)}, 'gram', {g})")

    # Kinds that no rule is indexed by need no pass over the pages.
    kinds = sorted(r.field for r in index.select("field").distinct().collect())
    listed = [pieces(kind) for kind in kinds] or ["CAST(array() AS ARRAY<STRUCT<field: STRING, gram: STRING>>)"]
    held = pages.select(key, F.explode(column(f"concat({', '.join(listed)})")).alias("p")).select(key, "p.field", "p.gram")
    fields = ["rule", "tech", "field", "pattern", "version_tpl", "confidence", "literal", "groups"]
    found = held.join(index, ["field", "gram"]).select(key, "rule").join(rules.select(*fields), "rule")
    return found.groupBy(key).agg(F.collect_list(F.struct(*fields)).alias("rules"))


def _version(rule: str, text: str) -> str:
    """Version by the rule's template: ``\\1`` stands for a group, ``\\1?a:b`` chooses by whether it matched."""
    def group(n: int) -> str:
        return f"CASE WHEN {rule}.groups >= {n} THEN regexp_extract({text}, concat('(?i)', {rule}.pattern), {n}) ELSE '' END"

    def filled(template: str) -> str:
        for n in range(1, MOST_GROUPS + 1):
            mark = q(f"\\{n}")
            template = let(template, lambda t, n=n, mark=mark: f"CASE WHEN contains({t}, {mark}) THEN replace({t}, {mark}, {group(n)}) ELSE {t} END")
        return template

    choice = q(r"^\\(\d)\?([^:]*):(.*)$")
    chosen = " ".join(f"WHEN {n} THEN {group(n)}" for n in range(1, MOST_GROUPS + 1))
    picked = (f"CASE WHEN {rule}.version_tpl RLIKE {choice} THEN CASE WHEN (CASE CAST(regexp_extract({rule}.version_tpl, {choice}, 1) AS INT) {chosen} ELSE '' END) <> '' "
              f"THEN regexp_extract({rule}.version_tpl, {choice}, 2) ELSE regexp_extract({rule}.version_tpl, {choice}, 3) END ELSE {rule}.version_tpl END")
    return f"CASE WHEN {rule}.version_tpl IS NOT NULL THEN nullif(trim({filled(picked)}), '') END"


def _hits(rules: str) -> Column:
    def fits(r: str) -> str:
        text = f"CASE WHEN {r}.field = 'url' THEN url ELSE html END"
        lowered = f"CASE WHEN {r}.field = 'url' THEN lower(url) ELSE _lowered END"
        return f"contains({lowered}, {r}.literal) AND rlike({text}, concat('(?i)', {r}.pattern))"

    def hit(r: str) -> str:
        text = f"CASE WHEN {r}.field = 'url' THEN url ELSE html END"
        return (f"CAST(named_struct('technology', {r}.tech, 'version', {let(text, lambda t: _version(r, t))}, "
                f"'confidence', {r}.confidence, 'field', {r}.field) AS {HIT})")

    return column(each(only(rules, lambda r: f"coalesce({fits(r)}, false)"), hit))


def matches(pages: DataFrame, rules: DataFrame, key: str = "page_id") -> DataFrame:
    """``key, technology, version, confidence, field``: rules of ``indexable`` that fit the ``url`` or the ``html`` of a page (case ignored).

    The rules and the index are stored; only a bit map of fixed size becomes part of the plan. Spark joins by the sizes that it sees. Pages
    with a null key have no rows.
    """
    rules = stored(rules, "rules")
    index = stored(rarest_grams(rules), "rule-index")
    table = bit_map(index)
    short = rules.where(F.length("literal") < GRAM).agg(F.collect_list(F.struct("rule", "tech", "field", "pattern", "version_tpl", "confidence", "literal", "groups"))
                                                          .alias("always"))
    work = pages.select(key, "url", "html").where(F.col(key).isNotNull())
    listed = candidates(work, key, rules, index, table)
    joined = work.withColumn("_one", F.lit(1)).join(short.withColumn("_one", F.lit(1)), "_one").join(listed, key, "left")
    tried = joined.withColumn("_lowered", F.lower("html")).withColumn(
        "_rules", F.concat(F.coalesce("rules", F.expr("slice(always, 1, 0)")), F.col("always")))
    found = tried.select(key, F.explode_outer(_hits("_rules")).alias("h")).where("h IS NOT NULL")
    return found.select(key, "h.technology", "h.version", "h.confidence", "h.field")
