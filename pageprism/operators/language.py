"""Language of a text: by its script, by function words, and by n-gram profiles that are learned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.functions.binding import column, let, only, q
from pageprism.operators.rows import unnest
from pageprism.session import stored

_WORD = r"\p{L}+"
#: Words that are sent to every task when rows are scored.
FREQUENT_WORDS = 100_000

#: Scripts that one language of the web mostly has, and the languages of those that several share: the first whose own letters occur, else the last.
SCRIPTS = {
    "Greek": "el", "Hebrew": "he", "Thai": "th", "Hangul": "ko", "Devanagari": "hi", "Bengali": "bn", "Tamil": "ta", "Telugu": "te", "Gujarati": "gu",
    "Gurmukhi": "pa", "Kannada": "kn", "Malayalam": "ml", "Sinhala": "si", "Khmer": "km", "Lao": "lo", "Georgian": "ka", "Armenian": "hy", "Ethiopic": "am",
}
SHARED_SCRIPTS = {
    "Cyrillic": (("uk", "іїєґ"), ("be", "ў"), ("mk", "ѓќѕ"), ("sr", "ђјљњћџ"), ("kk", "әғқңөұүһ"), ("ru", "ыэё"), ("bg", "ъ"), ("ru", "")),
    "Arabic": (("ur", "ٹڈڑےں"), ("fa", "پچژگ"), ("ar", "")),
}
#: Japanese mixes kana with Chinese characters; a tenth of kana tells it.
KANA_SHARE = 10


def words(text: str) -> str:
    return f"regexp_extract_all(lower({text}), {q(_WORD)}, 0)"


def word_scores(text: str) -> str:
    """``array<struct<score, rank, lang>>``: function words of each language in the text."""
    known = {lang: listed.split() for lang, listed in sorted(fixed.STOP_WORDS.items())}
    every = sorted({w for listed in known.values() for w in listed})

    def listed(ws: list[str]) -> str:
        return "(" + ", ".join(q(w) for w in ws) + ")"

    def scores(found: str) -> str:
        rows = [f"named_struct('score', size({only(found, lambda w: f'{w} IN {listed(own)}')}), 'rank', {-rank}, "
                f"'lang', {q(lang)})" for rank, (lang, own) in enumerate(known.items())]
        return f"array({', '.join(rows)})"

    return let(only(words(text), lambda w: f"{w} IN {listed(every)}"), scores)


def script_language(text: str) -> str:
    """SQL for the language that the script of most letters tells; ``latin`` where most are Latin or there are none, null for an unknown script."""
    def share(t: str) -> str:
        # A text has few different characters; by these all scripts but its own are ruled out without a walk over the text. No script here has ASCII characters.
        return let(f"array_join(array_distinct(split(regexp_replace({t}, {q('[' + chr(92) + 'x00-' + chr(92) + 'x7F]+')}, ''), '')), '')", lambda d: most(t, d))

    def most(t: str, different: str) -> str:
        count = lambda name: f"length(regexp_replace({t}, {q(f'[^' + chr(92) + 'p{Is' + name + '}]+')}, ''))"
        held = lambda *names: f"{different} RLIKE {q('[' + ''.join(chr(92) + 'p{Is' + n + '}' for n in names) + ']')}"
        rows = [f"CASE WHEN {held(name)} THEN named_struct('n', {count(name)}, 'lang', {q(lang)}) END" for name, lang in SCRIPTS.items()]
        for name, languages in SHARED_SCRIPTS.items():
            own = " ".join(f"WHEN {different} RLIKE {q(f'(?iu)[{letters}]')} THEN {q(lang)}" for lang, letters in languages[:-1])
            rows.append(f"CASE WHEN {held(name)} THEN named_struct('n', {count(name)}, 'lang', CASE {own} ELSE {q(languages[-1][0])} END) END")
        kana = f"length(regexp_replace({t}, {q('[^' + chr(92) + 'p{IsHiragana}' + chr(92) + 'p{IsKatakana}]+')}, ''))"
        east = let(kana, lambda k: let(count("Han"), lambda h: (
            f"named_struct('n', {k} + {h}, 'lang', CASE WHEN {k} * {KANA_SHARE} >= {k} + {h} THEN 'ja' ELSE 'zh' END)")))
        rows.append(f"CASE WHEN {held('Hiragana', 'Katakana', 'Han')} THEN {east} END")
        best = f"array_max(array({', '.join(rows)}))"
        letters = f"length(regexp_replace({t}, {q('[^' + chr(92) + 'p{L}]+')}, ''))"
        return (f"CASE WHEN {count('Latin')} * 2 >= {letters} THEN 'latin' ELSE "
                f"{let(best, lambda b: f'CASE WHEN {b}.n * 2 >= {letters} THEN {b}.lang END')} END")

    # Most texts have Latin letters alone and need no counts.
    return f"CASE WHEN {text} RLIKE {q('[^' + chr(92) + 'x00-' + chr(92) + 'x{24F}]')} THEN {let(text, share)} ELSE 'latin' END"


def detect_language(text: str) -> Column:
    """Language that the script tells; for Latin letters that with the most function words, the first by code among equals. Null for no text and for a
    script that isn't known; ``en`` when no function word occurs at all. Stays inside the row."""
    best = let(f"array_max({word_scores(text)})", lambda b: f"CASE WHEN {b}.score > 0 THEN {b}.lang ELSE 'en' END")
    by_script = let(script_language(text), lambda s: f"CASE WHEN {s} = 'latin' THEN {best} ELSE {s} END")
    return column(f"CASE WHEN {text} IS NOT NULL THEN {by_script} END")


def _ngrams(df: DataFrame, text: str, keep: list[str], n: int) -> DataFrame:
    """Counts of character n-grams of the words of each row, words padded by a space on both sides.

    Words are counted first, so a repeated word is cut into n-grams once, and no expression ever
    walks over a whole text per n-gram.
    """
    counted = unnest(df, keep, column(words(text)), "_w").groupBy(*keep, "_w").agg(
        F.count(F.lit(1)).alias("_c"))
    return counted.select(*keep, "_c", F.explode(_grams_of("_w", n)).alias("gram")).groupBy(*keep, "gram").agg(
        F.sum("_c").alias("n"))


def _grams_of(word: str, n: int) -> Column:
    padded = F.concat(F.lit(" "), F.col(word), F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(padded) - (n - 1), F.lit(1))),
                       lambda i: F.substring(padded, i, F.lit(n)))


def learn_profile(labelled: DataFrame, text: str = "text", lang: str = "lang", n: int = 3,
                  size: int | None = None) -> DataFrame:
    """Naive Bayes weights of n-grams: ``gram, weights`` with one weight per language. All n-grams count unless
    ``size`` asks for the most frequent ones of each language."""
    counts = _ngrams(labelled.select(F.col(lang).alias("lang"), text), text, ["lang"], n)
    # In two steps, so that no task ever holds all n-grams of a language.
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("gram"), F.lit(64))).orderBy(F.desc("n"), "gram")
    top = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    kept = counts
    for window in (part, top) if size else ():
        kept = kept.withColumn("_r", F.row_number().over(window)).where(F.col("_r") <= size).drop("_r")
    totals = kept.groupBy("lang").agg(F.sum("n").alias("total"))
    languages = totals.agg(F.sort_array(F.collect_list(F.struct("lang", "total"))).alias("languages"))
    grams = kept.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("counts"))
    size_of = grams.agg(F.count(F.lit(1)).alias("v"))
    facts = languages.withColumn("_one", F.lit(1)).join(size_of.withColumn("_one", F.lit(1)), "_one")
    weights = F.transform("languages", lambda x: F.struct(
        x["lang"].alias("lang"),
        F.log((F.coalesce(F.try_element_at("counts", x["lang"]), F.lit(0)) + 1.0) / (x["total"] + F.col("v")))
        .alias("weight")))
    # One row of facts: broadcasting it has a fixed size.
    return grams.withColumn("_one", F.lit(1)).join(F.broadcast(facts), "_one").select(
        "gram", weights.alias("weights"))


def word_scores_of(df: DataFrame, profile: DataFrame, languages: list[str], text: str = "text", n: int = 3) -> DataFrame:
    """``_w, _c`` and one column ``_s0, _s1, ...`` per language: every word of the texts that has a known n-gram, how often it occurs, and the sum of
    the weights of its n-grams."""
    vocabulary = unnest(df, [], column(words(text)), "_w").groupBy("_w").agg(F.count(F.lit(1)).alias("_c"))
    grams = vocabulary.select("_w", "_c", F.explode(_grams_of("_w", n)).alias("gram"))
    sums = [F.sum(F.col("weights")[i]["weight"]).alias(f"_s{i}") for i in range(len(languages))]
    return grams.join(profile, "gram").groupBy("_w").agg(F.first("_c").alias("_c"), *sums)


def score_languages(df: DataFrame, profile: DataFrame, key: str, text: str = "text", n: int = 3) -> DataFrame:
    """``key, lang_detected``: best-scoring language per row, null for a row without a known n-gram.

    A word's score is the sum over its n-grams, so each different word is scored once, and rows meet words instead of n-grams. The
    ``FREQUENT_WORDS`` most frequent words at most are sent to every task and the scores of a row fold there; the others, each of them rare, are
    joined by word.
    """
    one = profile.select(F.transform("weights", lambda w: w["lang"]).alias("languages")).first()
    languages = one.languages if one else []
    if not languages:
        return df.select(key).distinct().withColumn("lang_detected", F.lit(None).cast("string"))
    scores = [f"_s{i}" for i in range(len(languages))]
    known = stored(word_scores_of(df, profile, languages, text, n), "word-scores")
    size = known.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum("_c"), F.lit(0)).alias("total")).first()
    often = F.lit(True) if size.words <= FREQUENT_WORDS else F.col("_c") * FREQUENT_WORDS > size.total
    frequent = F.broadcast(known.where(often).drop("_c"))
    tokens = unnest(df, [key], column(words(text)), "_w")
    met = tokens.join(frequent, "_w")
    if size.words > FREQUENT_WORDS:
        met = met.unionByName(tokens.join(frequent.select("_w"), "_w", "left_anti").join(known.where(~often).drop("_c"), "_w"))
    summed = met.groupBy(key).agg(*[F.sum(s).alias(s) for s in scores])
    best = F.array_max(F.array(*[F.struct(F.col(s).alias("score"), F.lit(lang).alias("lang")) for s, lang in zip(scores, languages)]))
    return df.select(key).distinct().join(summed.select(key, best["lang"].alias("lang_detected")), key, "left")
