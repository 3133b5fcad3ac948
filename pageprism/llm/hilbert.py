"""Shards along a Hilbert curve through several metadata dimensions. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pageprism.llm.common import table
from pageprism.session import stored

SHARDS = 24
BITS = 6


def curve_steps(dimensions: int) -> list[tuple[int, int]]:
    """(next state, digit) by state and cell: how the curve enters and leaves each of the 2^n cells of a cube. A state is the
    corner where the curve enters and the axis along which it leaves, as ``corner * n + axis``."""
    n, size = dimensions, 1 << dimensions
    turn = lambda x, by: ((x >> by % n) | (x << (n - by % n))) & (size - 1)  # noqa: E731  to the right

    def entry(w):
        return 0 if w == 0 else (half := 2 * ((w - 1) // 2)) ^ half >> 1

    def axis(w):
        """Axis between a cell and the next one: the number of ones at the end."""
        odd = w - 1 if w and w % 2 == 0 else w
        return 0 if w == 0 else (~odd & (odd + 1)).bit_length() - 1

    steps = []
    for state in range(size * n):
        corner, direction = divmod(state, n)
        for cell in range(size):
            gray = turn(cell ^ corner, direction + 1)
            digit, shift = gray, gray >> 1
            while shift:
                digit ^= shift
                shift >>= 1
            after = corner ^ turn(entry(digit), n - (direction + 1) % n)
            steps.append((after * n + (direction + axis(digit) + 1) % n, digit))
    return steps


def curve_index(dimensions: list[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of a point with ``bits`` bits in each dimension, digit by digit from the top."""
    n = len(dimensions)
    if not 2 <= n * bits <= 62:
        raise ValueError("two dimensions at least, and 62 bits in all at most")
    packed = curve_steps(n)
    following = F.array(*[F.lit(s) for s, _ in packed])
    digits = F.array(*[F.lit(d) for _, d in packed])

    def cell(bit: Column) -> Column:
        out = F.lit(0)
        for i, d in enumerate(dimensions):
            out = out.bitwiseOR(F.shiftleft(F.call_function("getbit", d.cast("int"), bit).cast("int"), i))
        return out

    cells = F.transform(F.sequence(F.lit(bits - 1), F.lit(0), F.lit(-1)), cell)
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, c: Column) -> Column:
        where = acc["state"] * (1 << n) + c
        return F.struct(F.get(following, where).alias("state"), (F.shiftleft(acc["at"], n) + F.get(digits, where)).alias("at"))

    return F.aggregate(cells, start, step, lambda acc: acc["at"])


def hashed_code(value: Column, bits: int = BITS) -> Column:
    """Code of a name; null is a name of its own."""
    first = F.conv(F.substring(F.md5(F.coalesce(value, F.lit("\0"))), 1, 4), 16, 10).cast("int")
    return F.shiftright(first, 16 - bits)


def size_code(size: Column, bits: int = BITS) -> Column:
    """Two codes for each power of two."""
    length = F.length(F.bin(size))
    half = F.when(length < 2, 0).otherwise(F.call_function("shiftrightunsigned", size, F.greatest(length - 2, F.lit(0))).bitwiseAND(F.lit(1)).cast("int"))
    return F.least(2 * length + half, F.lit((1 << bits) - 1)).cast("int")


def range_code(value: Column, low: int, high: int, bits: int = BITS) -> Column:
    """Share of the way from ``low`` to ``high``; null is at the start."""
    steps = 1 << bits
    scaled = F.floor((value.cast("double") - F.lit(float(low))) / F.lit(float(high - low + 1)) * steps)
    return F.coalesce(F.least(F.greatest(scaled, F.lit(0)), F.lit(steps - 1)).cast("int"), F.lit(0))


def shard(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """(doc_id, size, text_crc32, curve, shard, slot): documents in the order of a Hilbert curve through source, language, size and doc_id, cut into
    ``shards`` runs whose row counts differ by one at most.

    Rows are dealt by ranges of (curve, doc_id, checksum), so a hot source, language or text is split wherever those differ; row numbers are
    those inside a range plus the rows before it. Only narrow rows are shuffled, once. size: UTF-8 bytes of the text (null: none) plus 8. Null
    names and ids have codes of their own; repeated rows get slots of their own; extra columns are left out; an empty table gives no rows.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text).alias("text_crc32"))
    low, high = docs.agg(F.min(F.col("doc_id").cast("long")), F.max(F.col("doc_id").cast("long"))).first()
    point = [hashed_code(F.col("source"), bits), hashed_code(F.col("lang"), bits), size_code(F.col("size"), bits), range_code(F.col("doc_id"), low or 0, high or 0, bits)]
    placed = rows.select("doc_id", "size", "text_crc32", *[c.alias(f"c{i}") for i, c in enumerate(point)])
    placed = placed.select("doc_id", "size", "text_crc32", curve_index([F.col(f"c{i}") for i in range(len(point))], bits).alias("curve"))
    order = ["curve", "doc_id", "text_crc32", "size"]
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    numbered = stored(sorted_.select("*", F.shiftrightunsigned("at", 33).alias("run"), F.col("at").bitwiseAND(F.lit((1 << 33) - 1)).alias("nth")).drop("at"), "curve")
    runs = numbered.groupBy("run").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    firsts = runs.select("run", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy(F.lit(1))).alias("total"))
    ranked = numbered.join(F.broadcast(firsts), "run").withColumn("rank", F.col("first") + F.col("nth"))
    return cut(ranked, shards).select("doc_id", "size", "text_crc32", "curve", "shard", "slot")


def cut(ranked: DataFrame, shards: int) -> DataFrame:
    """Shard and slot from ``rank`` and ``total``: the first ``total % shards`` shards hold one row more."""
    each = F.floor(F.col("total") / shards)
    more = F.col("total") % shards
    long = more * (each + 1)
    short = F.col("rank") - long
    in_long = F.col("rank") < long
    return ranked.withColumns({
        "shard": F.when(in_long, F.floor(F.col("rank") / (each + 1))).otherwise(more + F.floor(short / F.greatest(each, F.lit(1)))).cast("int"),
        "slot": F.when(in_long, F.col("rank") % (each + 1)).otherwise(short % F.greatest(each, F.lit(1))).cast("long"),
    })


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shard(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
