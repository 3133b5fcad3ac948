"""Technology rules: from JSON texts to a long table, and from the table to driver-side rows."""

from __future__ import annotations

from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pageprism.operators import selectors

MAX_RULE_ROWS = 100_000


def split_pattern(raw: Column) -> dict[str, Column]:
    r"""``regex\;version:..\;confidence:..`` as the columns pattern, version_tpl and confidence."""
    parts = F.split(raw, r"\\;")
    tags = F.slice(parts, 2, F.size(parts))

    def tag(name: str) -> Column:
        hits = F.filter(tags, lambda t: t.startswith(f"{name}:"))
        return F.substr(F.try_element_at(hits, F.lit(-1)), F.lit(len(name) + 2))

    return {
        "pattern": F.element_at(parts, 1),
        "version_tpl": tag("version"),
        "confidence": F.coalesce(tag("confidence").try_cast("int"), F.lit(100)),
    }


def _text(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _list(v: Column) -> Column:
    """A text or a list of texts as ``array<string>``; empty for anything else."""
    many = F.try_variant_get(v, "$", "array<string>")
    return F.coalesce(many, F.array_compact(F.array(_text(v))), F.array().cast("array<string>"))


def _map(v: Column) -> Column:
    return F.map_entries(F.coalesce(
        F.try_variant_get(v, "$", "map<string,variant>"), F.create_map().cast("map<string,variant>")))


def _rows(name: str, key: Column, selector: Column, patterns: Column) -> Column:
    return F.transform(patterns, lambda p: F.struct(
        F.lit(name).alias("field"), key.alias("key"), selector.alias("selector"), p.alias("raw")))


def _plain(body: Column, name: str) -> Column:
    value = F.try_variant_get(body, f"$.{name}", "variant")
    return _rows(name, F.lit(""), F.lit(""), _list(value))


def _keyed(body: Column, name: str, bare_key: str | None = None) -> Column:
    value = F.try_variant_get(body, f"$.{name}", "variant")
    keyed = F.flatten(F.transform(_map(value), lambda e: _rows(name, F.lower(e["key"]), F.lit(""), _list(e["value"]))))
    if bare_key is None:
        return keyed
    return F.concat(keyed, _rows(name, F.lit(bare_key), F.lit(""), _list(value)))


def _dom(body: Column) -> Column:
    """Selectors: a text or a list asks for existence; an object asks for clauses per selector.
    The key is ``''`` for existence, ``#text`` for text patterns and else the attribute name."""
    value = F.try_variant_get(body, "$.dom", "variant")
    present = F.array(F.lit(""))
    simple = F.flatten(F.transform(_list(value), lambda s: _rows("dom", F.lit(""), s, present)))

    def clauses(e: Column) -> Column:
        clause = e["value"]
        exists = F.try_variant_get(clause, "$.exists", "variant")
        texts = _list(F.try_variant_get(clause, "$.text", "variant"))
        attrs = _map(F.try_variant_get(clause, "$.attributes", "variant"))
        # A clause that asks for nothing in particular asks for existence.
        bare = exists.isNotNull() | F.exists(texts, lambda t: F.split(t, r"\\;")[0] == "")
        real = F.filter(texts, lambda t: F.split(t, r"\\;")[0] != "")
        none = F.array().cast("array<string>")
        return F.concat(
            _rows("dom", F.lit(""), e["key"], F.when(bare, present).otherwise(none)),
            _rows("dom", F.lit("#text"), e["key"], real),
            F.flatten(F.transform(attrs, lambda a: _rows("dom", F.lower(a["key"]), e["key"], _list(a["value"])))),
        )

    return F.concat(simple, F.flatten(F.transform(_map(value), clauses)))


def bodies(files: DataFrame) -> DataFrame:
    """``file, text`` of rule files -> ``tech, body``; a later file replaces a technology as a whole."""
    entries = files.select("file", F.explode(F.from_json("text", "map<string,variant>")).alias("tech", "body"))
    last = entries.groupBy("tech").agg(F.max("file").alias("file"))
    return entries.join(last, ["tech", "file"]).select("tech", "body")


def rule_table(bodies_: DataFrame) -> DataFrame:
    """Long rule table: one row per pattern."""
    body = F.col("body")
    rows = F.concat(
        *[_plain(body, n) for n in ("url", "html", "text", "scriptSrc", "scripts")],
        _keyed(body, "headers"), _keyed(body, "meta", "generator"), _dom(body),
    )
    long = bodies_.select("tech", F.explode(rows).alias("_r"))
    return long.select("tech", "_r.field", "_r.key", "_r.selector",
                       *[c.alias(n) for n, c in split_pattern(F.col("_r.raw")).items()])


def implies_table(bodies_: DataFrame) -> DataFrame:
    """``tech, implied``, confidence tags stripped."""
    names = _list(F.try_variant_get("body", "$.implies", "variant"))
    return bodies_.select("tech", F.explode(names).alias("_i")).select(
        "tech", F.element_at(F.split("_i", r"\\;"), 1).alias("implied"))


def category_table(bodies_: DataFrame) -> DataFrame:
    """``tech, pos, cat_id`` in the order of the rule file."""
    ids = F.coalesce(F.try_variant_get("body", "$.cats", "array<int>"), F.array().cast("array<int>"))
    return bodies_.select("tech", F.posexplode(ids).alias("pos", "cat_id"))


def metadata_table(bodies_: DataFrame) -> DataFrame:
    """Descriptive fields of the technologies."""
    def get(name: str, kind: str = "string") -> Column:
        return F.try_variant_get("body", f"$.{name}", kind).alias(name)

    return bodies_.select("tech", get("website"), get("description"), get("icon"), get("cpe"),
                          get("saas", "boolean"), get("oss", "boolean"),
                          _list(F.try_variant_get("body", "$.pricing", "variant")).alias("pricing"))


@dataclass(frozen=True)
class RuleSet:
    """Rules as driver-side rows (they become literal expressions) and small dimension tables."""

    rows: list
    implies: DataFrame
    tech_categories: DataFrame
    rejected: list = field(default_factory=list)


def _groups(spark: SparkSession, pattern: str) -> int | None:
    """Number of groups of a pattern, None when it does not compile."""
    try:
        return spark._jvm.java.util.regex.Pattern.compile(pattern).matcher("").groupCount()
    except Exception:
        return None


def _readable(selector: str | None) -> bool:
    if selector is None:
        return True
    try:
        selectors.parse(selector)
    except ValueError:
        return False
    return True


@F.pandas_udf(T.BooleanType())
def _parses(chosen: pd.Series) -> pd.Series:
    return chosen.map(_readable).astype(bool)


def checked_rules(rules: DataFrame) -> DataFrame:
    """Rule table with ``valid``: whether the pattern compiles and the selector can be read. Rules stay on the cluster, so their number has no limit."""
    compiled = F.expr("try_reflect('java.util.regex.Pattern', 'compile', pattern)").isNotNull()
    return rules.withColumn("valid", F.col("pattern").isNotNull() & compiled & _parses("selector"))


def load_rules(files: DataFrame, category_files: DataFrame | None = None) -> RuleSet:
    """Rule set of ``file, text`` rows. Patterns that do not compile and selectors that can't be read are reported in
    ``rejected``."""
    spark = files.sparkSession
    parsed = bodies(files)
    rows = rule_table(parsed).orderBy("tech", "field", "selector", "key", "pattern").limit(MAX_RULE_ROWS + 1).collect()
    if len(rows) > MAX_RULE_ROWS:
        raise ValueError(f"more than {MAX_RULE_ROWS} rules")
    good, rejected = [], []
    for row in rows:
        groups = _groups(spark, row.pattern)
        (good if groups is not None and _readable(row.selector) else rejected).append((row, groups))
    named = category_table(parsed)
    if category_files is not None:
        named = named.join(categories(category_files).select("cat_id", "name"), "cat_id")
    else:
        named = named.withColumn("name", F.col("cat_id").cast("string"))
    return RuleSet(good, _local(implies_table(parsed)), _local(named.select("tech", "pos", "name")),
                   [r for r, _ in rejected])


def _local(df: DataFrame) -> DataFrame:
    """A rule dimension as driver-side rows, so that no query parses the rule files again."""
    rows = df.limit(MAX_RULE_ROWS + 1).collect()
    if len(rows) > MAX_RULE_ROWS:
        raise ValueError(f"more than {MAX_RULE_ROWS} rules")
    return df.sparkSession.createDataFrame(rows, df.schema)


def categories(files: DataFrame) -> DataFrame:
    """``cat_id, name, groups, priority`` of category files."""
    entries = files.select(F.explode(F.from_json(
        "text", "map<string,struct<name:string,groups:array<int>,priority:int>>")).alias("id", "c"))
    return entries.select(F.col("id").cast("int").alias("cat_id"), "c.name",
                          F.coalesce("c.groups", F.array().cast("array<int>")).alias("groups"),
                          F.coalesce("c.priority", F.lit(0)).alias("priority"))
