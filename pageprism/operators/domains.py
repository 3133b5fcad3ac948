"""Registered domains by public suffix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.functions.binding import column, each, let, q


def _last(labels: Column, n) -> Column:
    return F.array_join(F.slice(labels, -n, n), ".")


def suffix_table(suffixes: DataFrame) -> DataFrame:
    """Rules by their last label: ``_top``, ``_rules`` (one text, a rule per line) and ``_depth`` (labels of the longest one). A compact form of the
    tree of labels read from the right: a host needs one branch of it, and finds its rules there by text."""
    rule = F.lower(F.trim(F.rtrim(F.trim("suffix"), F.lit("."))))
    rules = suffixes.where("suffix IS NOT NULL").select(rule.alias("_rule")).where(F.col("_rule") != "").distinct()
    return rules.groupBy(F.substring_index("_rule", ".", -1).alias("_top")).agg(
        F.concat(F.lit("\n"), F.array_join(F.sort_array(F.collect_list("_rule")), "\n"), F.lit("\n")).alias("_rules"),
        F.max(F.size(F.split("_rule", r"\."))).alias("_depth"))


def _suffix_size(labels: str, rules: str, depth: str) -> str:
    """Number of labels of the public suffix of a host, by the rules of its last label."""
    def sizes(k: str) -> str:
        def found(tail: str) -> str:
            has = lambda mark: f"contains({rules}, concat({q(chr(10) + mark)}, {tail}, {q(chr(10))}))"
            return (f"CASE WHEN {has('!')} THEN named_struct('exception', true, 'size', {k} - 1) "
                    f"WHEN size({labels}) > {k} AND {has('*.')} THEN named_struct('exception', false, 'size', {k} + 1) "
                    f"WHEN {has('')} THEN named_struct('exception', false, 'size', {k}) END")

        return let(f"array_join(slice({labels}, -{k}, {k}), '.')", found)

    most = f"least(size({labels}), coalesce({depth}, 1))"
    return f"coalesce(array_max({each(f'sequence(1, {most})', sizes)}).size, 1)"


def registered_domain(df: DataFrame, host: str, out: str, suffixes: DataFrame | None = None) -> DataFrame:
    """Public suffix of ``host`` plus one label, as column ``out``.

    ``suffixes`` has a string column ``suffix`` with the rules of a public suffix list: names, ``*.`` rules and ``!``
    exceptions, of any length. An exception wins, then the longest rule; without any rule the last label is the
    suffix. Null for addresses, for hosts that are a suffix themselves and for null. The list is joined once, by the last label, which has
    at most one row there, so rows are never multiplied. Without ``suffixes`` a short built-in list is used inside the row.
    """
    labels = F.split(F.lower(F.rtrim(F.col(host), F.lit("."))), r"\.")
    work = df.withColumn("_labels", labels)
    if suffixes is None:
        known = F.array(*[F.lit(s) for s in fixed.PUBLIC_SUFFIXES])
        longest = max(s.count(".") + 1 for s in fixed.PUBLIC_SUFFIXES)
        count = F.size("_labels")
        size = F.coalesce(*[F.when((count >= k) & F.array_contains(known, _last(F.col("_labels"), F.lit(k))), k) for k in range(longest, 0, -1)], F.lit(1))
    else:
        branch = suffix_table(suffixes)
        work = work.withColumn("_top", F.element_at("_labels", -1)).join(branch, "_top", "left")
        size = column(_suffix_size("_labels", "_rules", "_depth"))
    address = F.element_at("_labels", -1).rlike(r"^[0-9]*$") | F.col(host).contains(":")
    sized = work.withColumn("_size", size)
    return sized.select(*df.columns, F.when(~address & (F.size("_labels") > F.col("_size")), _last(F.col("_labels"), F.col("_size") + 1)).alias(out))
