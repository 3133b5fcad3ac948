"""Quality rules over whole texts, and lines that too many documents of a host share. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pageprism.llm.common import table
from pageprism.session import stored

BLANK = " \t\n\x0b\x0c\r"
BLANKS = "[ \\t-\\r]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
LINE_DOCUMENTS = 50
LEAST_KEPT_PERCENT = 30


def words(text: Column) -> Column:
    """Runs of other characters than ASCII blanks; no words for null."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANK))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, BLANKS))


def line_hash(line: Column) -> Column:
    """Hash of a line in lower case, with runs of digits as one sign and runs of blanks as one."""
    plain = F.regexp_replace(F.lower(F.btrim(line, F.lit(BLANK))), "[0-9]+", "0")
    return F.xxhash64(F.regexp_replace(plain, BLANKS, " "))


def with_repeated_words(docs: DataFrame, found: str) -> DataFrame:
    """``n_repeat_words``: words of the array ``found`` in a window of three that it holds twice or more. Windows are
    compared by 64-bit hashes inside the row: sorted with their positions where some are equal, else there are none."""
    hashes = F.expr(f"CASE WHEN size({found}) < {WINDOW} THEN cast(array() AS array<bigint>) ELSE "
                    f"transform(slice({found}, 1, size({found}) - {WINDOW - 1}), (x, i) -> xxhash64(x, {found}[i + 1], {found}[i + 2])) END")
    ordered = F.expr("CASE WHEN size(array_distinct(_h)) = size(_h) THEN cast(array() AS array<struct<h:bigint,i:int>>) "
                     "ELSE array_sort(transform(_h, (h, i) -> struct(h, i))) END")
    repeated = F.expr("array_sort(transform(filter(_s, (x, k) -> coalesce(x.h = get(_s, k - 1).h, false) "
                      "OR coalesce(x.h = get(_s, k + 1).h, false)), x -> x.i))")
    covered = F.expr(f"CASE WHEN size(_at) = 0 THEN 0L ELSE aggregate(zip_with(slice(_at, 2, size(_at)), slice(_at, 1, size(_at) - 1), "
                     f"(b, a) -> least(b - a, {WINDOW})), {WINDOW}L, (n, d) -> n + d) END")
    staged = docs.withColumn("_h", hashes).withColumn("_s", ordered).withColumn("_at", repeated)
    return staged.withColumn("n_repeat_words", covered).drop("_h", "_s", "_at")


def base_rules(docs: DataFrame) -> DataFrame:
    """Given columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, and ``lines``: hash and words of
    every line that has words. A null text has none."""
    text = F.coalesce(F.col("text"), F.lit(""))
    with_lines = docs.withColumns({"_w": words(text), "_lines": F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(BLANK)) != "")})
    counted = with_repeated_words(with_lines, "_w").withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "lines": F.transform("_lines", lambda x: F.struct(line_hash(x).alias("h"), F.size(words(x)).alias("n"))),
    }).drop("_w", "_lines")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    return counted.withColumn("base_failed", failed)


def judge(docs: DataFrame, line_documents: int = LINE_DOCUMENTS, least_kept_percent: int = LEAST_KEPT_PERCENT) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, removed_words and kept.

    A line is in excess if more than ``line_documents`` different texts of a host (``source``; null is a host of its own) hold it in normalised
    form: copies of a text count once, so being copied alone condemns nobody. Such lines are taken out of every document of the host;
    a document that keeps under ``least_kept_percent`` of its words is depleted. kept: neither failed nor depleted.

    A line that half of all documents share is folded before the shuffle, to one row per task and text; lines in excess are few
    (each has ``line_documents`` texts) and meet the lines in a join that splits hot keys. Null and empty texts fail on n_words. Repeated
    rows are judged each and alike. Extra columns are left out; an empty table gives no rows.
    """
    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("source").cast("string").alias("source"))
    measured = base_rules(rows.withColumns({"row": F.monotonically_increasing_id(), "copy": F.xxhash64("text")}))
    measured = stored(measured.drop("text"), "measured")
    lines = measured.select("row", "copy", "source", F.explode("lines").alias("line")).select(
        "row", "copy", F.xxhash64("source", "line.h").alias("key"), F.col("line.n").alias("n"))
    copies = lines.select("key", "copy").distinct().groupBy("key").agg(F.count(F.lit(1)).alias("texts"))
    excess = copies.where(F.col("texts") > line_documents).select("key")
    removed = lines.join(excess, "key").groupBy("row").agg(F.sum("n").cast("long").alias("removed"))
    judged = measured.drop("lines", "copy", "source").join(removed, "row", "left").withColumn("removed_words", F.coalesce("removed", F.lit(0).cast("long")))
    depleted = 100 * (F.col("n_words") - F.col("removed_words")) < least_kept_percent * F.col("n_words")
    return judged.withColumn("kept", ~F.col("base_failed") & ~depleted).drop("row", "removed")


def op5_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "removed_words")


OP5_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, regexp_extract_all(text, '[^ \\t-\\r]+') AS w,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM d),
windows AS (SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS s
    FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT r, count(*) AS n FROM (SELECT DISTINCT r, i + unnest([0, 1, 2]) AS p FROM twice) GROUP BY r),
line AS (SELECT r, source, text, unnest(lines) AS line FROM split),
plain AS (SELECT r, source, text, len(regexp_extract_all(line, '[^ \\t-\\r]+')) AS n,
    regexp_replace(regexp_replace(lower(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))), '[0-9]+', '0', 'g'),
        '[ \\t-\\r]+', ' ', 'g') AS line FROM line),
excess AS (SELECT source, line FROM plain GROUP BY source, line HAVING count(DISTINCT text) > {LINE_DOCUMENTS}),
removed AS (SELECT p.r, sum(p.n) AS n FROM plain p JOIN excess e ON p.line = e.line AND p.source IS NOT DISTINCT FROM e.source GROUP BY p.r),
counted AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(c.n, 0) AS n_repeat_words, coalesce(x.n, 0)::BIGINT AS removed_words
    FROM split LEFT JOIN covered c USING (r) LEFT JOIN removed x USING (r)),
judged AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATED_PERCENT} * n_words AS base_failed FROM counted)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 100 * (n_words - removed_words) >= {LEAST_KEPT_PERCENT} * n_words AS kept, removed_words FROM judged
"""
