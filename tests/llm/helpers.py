"""Small inputs with the cases that every operator must stand."""

LONG = "lorem ipsum dolor " * 9000
DOCS_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids int, count int, start int"


def odd_docs(spark):
    """Nulls in any column, empty and very long texts, ties and repeated rows, extra columns with clashing names."""
    rows = [
        (1, "The quick brown fox. Été İstanbul ΣΑΣ", "en", "a", 10), (2, None, "en", "a", None), (3, "", None, None, 0),
        (4, " \n\t ", "fr", "b", 4), (5, LONG, "de", "b", len(LONG)), (5, LONG, "de", "b", len(LONG)), (None, "kein Schlüssel", "de", "a", 3),
        (7, "The quick brown fox. Été İstanbul ΣΑΣ", None, "a", 10), (8, "<|STARTOFTEXT|> a <|endoftext|> x y\u0085z", "en", None, 9),
        (9, "x" * 50_000, "es", "a", 50_000), (-3, "é ́a KK 12,3's don't 🙂", "es", "c", 1),
    ]
    return spark.createDataFrame([(*r, 7, 7, 7) for r in rows], DOCS_SCHEMA)
