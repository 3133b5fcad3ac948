"""Mixing sources by temperature into budgeted blocks. DataFrame functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageprism.llm.common import table
from pageprism.llm.line_rules import words
from pageprism.session import stored

TARGET_ENTROPY = 0.9
MOST_REPETITIONS = 4.0
BLOCK_TOKENS = 1 << 18
SEED = 1
STEPS = 30
STEPS_PER_PASS = 5


def order_hash(*columns: Column) -> Column:
    """60 bits of an MD5 sum over columns; null counts as empty."""
    joined = F.concat_ws("/", *[F.coalesce(c.cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("long")


def token_count(text: Column) -> Column:
    """Words of a text, one at least, so that every document takes room."""
    return F.greatest(F.size(words(text)).cast("long"), F.lit(1).cast("long"))


def source_shares(sized: DataFrame) -> DataFrame:
    """Tokens, documents and token share per source; a hot source is folded before the shuffle."""
    sources = sized.groupBy("mix_source").agg(F.sum("tokens").alias("source_tokens"), F.count(F.lit(1)).alias("source_docs"))
    sources = stored(sources, "mix-sums")
    total = sources.agg(F.sum("source_tokens")).first()[0] or 1
    return sources.withColumn("share", F.col("source_tokens") / F.lit(float(total)))


def _sums(share: Column, exponent: float) -> list[Column]:
    """Over sources, at an exponent: the sum of powers, that of powers times their logarithms, the most and least repetitions up to a common
    factor, and the number of sources."""
    power = F.pow(share, F.lit(exponent))
    return [F.sum(power), F.sum(power * F.ln(power)), F.max(F.pow(share, F.lit(exponent - 1))), F.min(F.pow(share, F.lit(exponent - 1))), F.count(F.lit(1))]


def find_exponent(sources: DataFrame, target: float = TARGET_ENTROPY, repetitions: float = MOST_REPETITIONS) -> float:
    """Smallest exponent in [0, 1], by bisection, at which the entropy of the weights is at most ``target`` times the greatest one and no
    source comes more than ``repetitions`` times as often as the least repeated one.

    Both fall as the exponent grows. Each pass over the sources tries the inner points of ``STEPS_PER_PASS`` steps at once, and only sums come back.
    """
    low, high = 0.0, 1.0
    share = F.col("share")
    for _ in range(STEPS // STEPS_PER_PASS):
        n = 1 << STEPS_PER_PASS
        points = [low + (high - low) * i / n for i in range(1, n)]
        row = sources.agg(*[c.alias(f"s{i}_{j}") for i, e in enumerate(points) for j, c in enumerate(_sums(share, e))]).first()
        met = [_ok(*[row[f"s{i}_{j}"] for j in range(5)], target, repetitions) for i in range(len(points))]
        step = (high - low) / n
        first = next((i for i, ok in enumerate(met) if ok), len(points))
        low, high = low + step * first, low + step * (first + 1)
    return high


def _ok(total, logs, most, least, n, target, repetitions) -> bool:
    if not n or n < 2:
        return True
    entropy = math.log(total) - logs / total
    return entropy <= target * math.log(n) and most <= repetitions * least


def running_tokens(rows: DataFrame, keys: list[str]) -> DataFrame:
    """``before``: tokens of the rows of the same ``keys`` with a lesser (mix_order, doc_id). Sums run over buckets of the hash order and then inside
    each; a source has as many buckets as a bucket has documents, about, so one with a third of all rows is no single task."""
    bucket = F.floor(F.col("mix_order") / F.lit(float(1 << 60)) * F.ceil(F.sqrt("source_docs")))
    rows = rows.withColumn("bucket", bucket)
    earlier = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy(*keys, "bucket").orderBy("mix_order", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy(*keys, "bucket").agg(F.sum("tokens").alias("held"))
    sums = sums.select(*keys, "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("ahead"))
    return rows.join(sums, [*keys, "bucket"]).withColumn("before", F.col("ahead") + F.coalesce(F.sum("tokens").over(inside), F.lit(0))).drop("bucket", "ahead")


def quotas(sources: DataFrame, exponent: float, budget_tokens: int | None = None) -> DataFrame:
    """Per source ``quota`` (tokens), ``whole`` (full passes) and ``rest`` (tokens of the last, partial pass)."""
    powers = sources.withColumn("power", F.pow("share", F.lit(exponent)))
    weighted = powers.withColumn("weight", F.col("power") / F.lit(powers.agg(F.sum("power")).first()[0] or 1.0))
    if budget_tokens is None:
        budget = weighted.agg(F.max(F.col("source_tokens") / F.col("weight"))).first()[0] or 0.0
        quota = F.greatest(F.round(F.col("weight") * F.lit(budget)).cast("long"), F.col("source_tokens"))
    else:
        quota = F.round(F.col("weight") * F.lit(float(budget_tokens))).cast("long")
    return weighted.withColumn("quota", quota).select("mix_source", "source_tokens", "source_docs", "weight", "quota", F.floor(F.col("quota") / F.col("source_tokens")).alias("whole"),
                          (F.col("quota") % F.col("source_tokens")).alias("rest"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumns({"tokens": token_count(F.col("text")), "mix_source": F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))})


def plan(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, repetitions: float = MOST_REPETITIONS, budget_tokens: int | None = None,
         seed: int = SEED) -> DataFrame:
    """One row per source: its quota, its full passes, and ``cut``: in the last pass documents up to that place in the pass's order take part.

    Weights are token shares to the power of the exponent that ``find_exponent`` gives, normalised. Their budget is ``budget_tokens``; by default
    the least one at which every source comes once as a whole, so that no document is lost. A source without a last pass has cut -1.
    """
    narrow = stored(_sized(docs).select("doc_id", "mix_source", "tokens"), "mix-rows")
    sources = source_shares(narrow)
    quota = quotas(sources, find_exponent(sources, target_entropy, repetitions), budget_tokens)
    last = narrow.join(quota.where("rest > 0"), "mix_source").withColumn("mix_order", order_hash(F.lit(seed), F.col("whole"), F.col("doc_id")))
    cuts = running_tokens(last, ["mix_source"]).where(F.col("before") < F.col("rest")).groupBy("mix_source").agg(F.max("mix_order").alias("cut"))
    return stored(quota.join(cuts, "mix_source", "left").withColumn("cut", F.coalesce("cut", F.lit(-1).cast("long"))), "mix-plan")


def repeat(docs: DataFrame, planned: DataFrame, seed: int = SEED) -> DataFrame:
    """Documents once per pass in which they take part, with tokens, epoch and mix_order. The plan, one narrow row per source, is joined; texts
    are not moved unless there are too many sources to send them to every task."""
    each = _sized(docs).join(planned, "mix_source").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("whole"))))
    each = each.withColumn("mix_order", order_hash(F.lit(seed), F.col("epoch"), F.col("doc_id")))
    return each.where((F.col("epoch") < F.col("whole")) | (F.col("mix_order") <= F.col("cut")))


def mix(docs: DataFrame, target_entropy: float = TARGET_ENTROPY, repetitions: float = MOST_REPETITIONS, budget_tokens: int | None = None,
        block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """doc_id, source, tokens, epoch, block, position: documents as often and in the blocks that the source weights ask for.

    A source's quota is filled by whole passes over its documents, each in an order of its own, and the beginning of one more; a document is in if it begins
    inside the quota. Quotas are spread evenly over blocks of ``block_tokens`` tokens, and a block is shuffled: (block, position) is the order of training.

    Null is a source of its own; a null or empty text counts as one token; a null doc_id has one place in the order. Repeated rows are mixed each, and
    those of one doc_id are in or out together. Extra columns are left out; an empty table gives no rows.
    """
    return _dealt(docs.select("doc_id", "text", "source"), target_entropy, repetitions, budget_tokens, block_tokens, seed).select(
        "doc_id", "source", "tokens", "epoch", "block", "position")


def _dealt(rows: DataFrame, target_entropy: float = TARGET_ENTROPY, repetitions: float = MOST_REPETITIONS, budget_tokens: int | None = None,
           block_tokens: int = BLOCK_TOKENS, seed: int = SEED) -> DataFrame:
    """Rows of ``mix`` with all columns of ``rows`` but the text."""
    planned = plan(rows, target_entropy, repetitions, budget_tokens, seed)
    chosen = running_tokens(repeat(rows, planned, seed).drop("text"), ["mix_source", "epoch"])
    n_blocks = planned.agg(F.ceil(F.sum("quota") / block_tokens)).first()[0] or 0
    share = (F.col("epoch") * F.col("source_tokens") + F.col("before")) / F.col("quota")
    dealt = chosen.withColumn("block", F.least(F.floor(share * n_blocks), F.lit(n_blocks - 1)))
    place = Window.partitionBy("block").orderBy(order_hash(F.lit(seed), F.lit("block"), F.col("epoch"), F.col("doc_id")), "doc_id", "epoch", "source", "tokens")
    return dealt.withColumn("position", F.row_number().over(place))


def mixed_texts(docs: DataFrame, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Documents with all their columns, as often as ``mix`` has them and in its order: dealt by ranges of (block, position) and sorted by them."""
    numbered = stored(docs.withColumn("mix_row", F.monotonically_increasing_id()), "mix-docs")
    order = _dealt(numbered.select("doc_id", "text", "source", "mix_row"), block_tokens=block_tokens)
    order = stored(order.select("mix_row", "block", "position"), "mix-order")
    placed = numbered.join(order, "mix_row").repartitionByRange("block", "position").sortWithinPartitions("block", "position")
    return placed.select(*docs.columns)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"))


OP1_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, source, coalesce('=' || source, '') AS s,
    greatest(len(regexp_extract_all(coalesce(text, ''), '[^ \t-\r]+')), 1)::BIGINT AS tokens FROM documents),
src AS (SELECT s, sum(tokens)::BIGINT AS t, count(*) AS n FROM d GROUP BY s),
shares AS (SELECT *, t / sum(t) OVER ()::DOUBLE AS p FROM src),
all_p AS (SELECT list(p) AS ps FROM shares),
b AS (SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high UNION ALL
    SELECT step + 1, CASE WHEN ok THEN low ELSE mid END, CASE WHEN ok THEN mid ELSE high END
    FROM (SELECT step, low, high, mid, len(ps) < 2 OR (ln(total) - logs / total <= {TARGET_ENTROPY} * ln(len(ps)) AND most <= {MOST_REPETITIONS} * least) AS ok
        FROM (SELECT step, low, high, (low + high) / 2 AS mid, ps, list_sum(list_transform(ps, lambda p: pow(p, (low + high) / 2))) AS total,
            list_sum(list_transform(ps, lambda p: pow(p, (low + high) / 2) * ln(pow(p, (low + high) / 2)))) AS logs,
            list_max(list_transform(ps, lambda p: pow(p, (low + high) / 2 - 1))) AS most,
            list_min(list_transform(ps, lambda p: pow(p, (low + high) / 2 - 1))) AS least
            FROM b, all_p WHERE step < {STEPS}))),
w AS (SELECT s, t, n, pow(p, high) / sum(pow(p, high)) OVER () AS w FROM shares, (SELECT high FROM b WHERE step = {STEPS})),
q AS (SELECT s, t, greatest(round(w * max(t / w) OVER ())::BIGINT, t) AS quota FROM w),
plan AS (SELECT s, t, quota, quota // t AS whole, quota % t AS rest FROM q),
passes AS (SELECT d.*, t, quota, whole, rest, unnest(range(0, whole + 1)) AS epoch FROM d JOIN plan USING (s)),
hashed AS (SELECT *, ('0x' || substr(md5(concat_ws('/', '{SEED}', epoch, coalesce(doc_id::VARCHAR, ''))), 1, 15))::BIGINT AS h FROM passes),
running AS (SELECT *, coalesce(sum(tokens) OVER (PARTITION BY s, epoch ORDER BY h, doc_id, tokens ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM hashed),
cuts AS (SELECT s, max(h) AS cut FROM running WHERE epoch = whole AND before < rest GROUP BY s),
chosen AS (SELECT r.* FROM running r LEFT JOIN cuts USING (s) WHERE epoch < whole OR h <= cut),
n AS (SELECT ceil(sum(quota) / {BLOCK_TOKENS})::BIGINT AS n_blocks FROM plan),
dealt AS (SELECT doc_id, source, tokens, epoch,
    least(floor((epoch * t + before)::DOUBLE / quota * n_blocks)::BIGINT, n_blocks - 1) AS block FROM chosen, n)
SELECT doc_id, source, tokens, epoch, block, row_number() OVER (PARTITION BY block ORDER BY
    ('0x' || substr(md5(concat_ws('/', '{SEED}', 'block', epoch, coalesce(doc_id::VARCHAR, ''))), 1, 15))::BIGINT, doc_id, epoch, source, tokens)::INTEGER AS position
FROM dealt
"""
