"""Registered queries over archive files and charsets."""

from __future__ import annotations

from pyspark.sql import functions as F

from pageprism.catalog.frames import PAGE_INDEX_SQL, page_index, table
from pageprism.functions.charset import to_single_byte, with_text
from pageprism.operators.rows import spread
from pageprism.sources.archive import read_archive
from pageprism.sources.records import write_records

LATIN = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "".join(chr(0x430 + i) for i in range(len(LATIN)))
KANA = "".join(chr(0x3041 + i) for i in range(len(LATIN)))
KANA_TRAILS = "".join(chr(0x9F + i) for i in range(len(LATIN)))
#: By doc_id modulo 9: charset, text, where it is declared.
CASES = [
    ("cp1252", "western", "header", "iso-8859-1"), ("cp1251", "cyrillic", "meta", "windows-1251"), ("koi8-r", "cyrillic", "", ""),
    ("cp932", "kana", "meta", "Shift_JIS"), ("cp1251", "cyrillic", "", ""), ("cp932", "kana", "", ""), ("utf-8", "western", "meta", "latin1"),
    ("cp1252", "western", "", ""), ("koi8-r", "cyrillic", "header", "KOI8-R"),
]


def warc_scan(spark, sf_dir):
    """Given pages written as archive records and found again without their places in the files."""
    pages = table(spark, sf_dir, "pages").withColumnRenamed("html", "response").join(
        page_index(spark, sf_dir).select(F.col("warc_record_offset").alias("page_id"), "domain", "crawl", "url_path"), "page_id")
    _, root = write_records(pages.withColumn("header", F.concat(F.lit("HTTP/1.1 200 OK\r\nX-Page: "), F.col("page_id").cast("string"))))
    found = read_archive(spark, root)
    return found.select("type", "target_uri", "header", F.md5("body").alias("digest"), F.length("body").cast("long").alias("bytes"))


def _encoded(spark, sf_dir):
    """doc_id, bytes and HTTP header of every document in one of nine forms."""
    docs = spread(table(spark, sf_dir, "documents"))
    case = F.col("doc_id") % len(CASES)
    plain = F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-z ]", "")
    western = F.concat(F.lit("plain words and €é "), F.regexp_replace(F.coalesce("text", F.lit("")), "[^a-zA-ZÀ-ÿ ]", ""))
    cyrillic = F.translate(plain, LATIN, CYRILLIC)
    kana = F.encode(F.translate(F.regexp_replace(plain, "([a-z])", "\x82$1"), LATIN, KANA_TRAILS), "ISO-8859-1")
    data, header = F.lit(None).cast("binary"), F.lit("HTTP/1.1 200 OK")
    for i, (charset, text, place, label) in enumerate(CASES):
        body = (kana if text == "kana" else F.encode(western, "UTF-8") if charset == "utf-8"
                else to_single_byte(western if text == "western" else cyrillic, charset))
        if place == "meta":
            body = F.concat(F.encode(F.lit(f'<meta charset="{label}">'), "UTF-8"), body)
        data = F.when(case == i, body).otherwise(data)
        if place == "header":
            header = F.when(case == i, f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset={label}").otherwise(header)
    return docs.select("doc_id", data.alias("data"), header.alias("header"))


def decode_pages(spark, sf_dir):
    """Charset and text of documents in four alphabets, declared in a header, in a meta tag or not at all."""
    found = with_text(_encoded(spark, sf_dir), "data", "text", "header", charset="charset")
    return found.select("doc_id", "charset", F.md5(F.encode("text", "UTF-8")).alias("digest"))


QUERIES = {f.__name__: f for f in (warc_scan, decode_pages)}


def _text_sql(charset: str, text: str, place: str, label: str) -> str:
    plain = "regexp_replace(coalesce(text, ''), '[^a-z ]', '', 'g')"
    value = {"western": "'plain words and €é ' || regexp_replace(coalesce(text, ''), '[^a-zA-ZÀ-ÿ ]', '', 'g')",
             "cyrillic": f"translate({plain}, '{LATIN}', '{CYRILLIC}')", "kana": f"translate({plain}, '{LATIN}', '{KANA}')"}[text]
    return f"'<meta charset=\"{label}\">' || {value}" if place == "meta" else value


_CASE_SQL = " ".join(f"WHEN {i} THEN {_text_sql(*case)}" for i, case in enumerate(CASES))
_CHARSET_SQL = " ".join(f"WHEN {i} THEN '{case[0]}'" for i, case in enumerate(CASES))
ORACLES = {
    "warc_scan": f"WITH {PAGE_INDEX_SQL} SELECT 'response' AS type, 'https://' || domain || url_path AS target_uri, "
                 "'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'X-Page: ' || page_id AS header, md5(html) AS digest, "
                 "CAST(strlen(html) AS BIGINT) AS bytes FROM page_index JOIN pages ON page_id = warc_record_offset",
    "decode_pages": f"""WITH t AS (SELECT doc_id, CASE doc_id % {len(CASES)} {_CASE_SQL} END AS value FROM documents)
      SELECT doc_id, CASE WHEN regexp_matches(value, '[^\\x00-\\x7f]') THEN CASE doc_id % {len(CASES)} {_CHARSET_SQL} END ELSE 'utf-8' END AS charset,
             md5(value) AS digest FROM t""",
}
