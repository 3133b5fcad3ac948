"""Bytes of pages to text, in any charset that the Encoding Standard names.

The charset is that of a byte-order mark, else UTF-8 if the bytes are valid UTF-8, else the one that the HTTP header declares, else the one that a
meta tag declares, else a guess by the frequencies of bytes. Single-byte charsets are look-ups inside the JVM; only pages in
multi-byte charsets of East Asia go through Python's decoders, in Arrow batches.
"""

from __future__ import annotations

import codecs
import functools
from encodings.aliases import aliases

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Charsets of one byte a character whose first half is ASCII.
SINGLE = ("cp1250 cp1251 cp1252 cp1253 cp1254 cp1255 cp1256 cp1257 cp1258 cp874 cp866 koi8-r koi8-u mac-roman mac-cyrillic iso8859-2 iso8859-3 "
          "iso8859-4 iso8859-5 iso8859-6 iso8859-7 iso8859-8 iso8859-10 iso8859-13 iso8859-14 iso8859-15 iso8859-16").split()
MULTI = "cp932 euc_jp iso2022_jp gb18030 big5hkscs cp949 hz".split()
#: Labels that the web uses for a larger charset than their name says.
WIDER = {"latin-1": "cp1252", "iso8859-1": "cp1252", "ascii": "cp1252", "iso8859-9": "cp1254", "iso8859-11": "cp874", "tis-620": "cp874",
         "shift_jis": "cp932", "gb2312": "gb18030", "gbk": "gb18030", "big5": "big5hkscs", "euc_kr": "cp949"}
UNDECLARED = "iso-8859-1"
HEAD_BYTES = 4096
REPLACEMENT = "�"

_UPPER_HALF = "".join(map(chr, range(0x80, 0x100)))


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once; keeps expressions small."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cases(pairs) -> Column:
    """CASE of (condition, value) pairs."""
    case = F
    for condition, value in pairs:
        case = case.when(condition, value)
    return case


def _key(label: str) -> str:
    return label.lower().replace("-", "").replace("_", "").replace(":", "").replace(" ", "")


@functools.lru_cache(maxsize=1)
def labels() -> dict[str, str]:
    """Charsets by their labels, in small letters and without separators: Python's names and aliases of each, after widening."""
    known = {}
    names = set(SINGLE) | set(MULTI) | set(WIDER) | set(aliases) | {x.replace("cp125", "windows-125") for x in SINGLE}
    for name in names | {"utf-8", "utf-16", "utf-16le", "utf-16be", "x-sjis", "x-gbk", "x-mac-cyrillic", "windows-31j", "windows-874", "ks_c_5601-1987", "dos-874"}:
        extra = {"x-sjis": "shift_jis", "x-gbk": "gbk", "x-mac-cyrillic": "mac-cyrillic", "windows-31j": "cp932", "windows-874": "cp874",
                 "ks_c_5601-1987": "cp949", "dos-874": "cp874"}
        try:
            found = codecs.lookup(extra.get(name, name)).name
        except LookupError:
            continue
        for wanted in (*SINGLE, *MULTI, *WIDER, "utf-8", "utf-16", "utf-16-le", "utf-16-be"):
            if codecs.lookup(wanted).name == found:
                by_name = {codecs.lookup(k).name: v for k, v in WIDER.items()}
                known[_key(name)] = by_name.get(found, wanted)
    return known


def canonical(label) -> Column:
    """Charset of a label; null for an unknown one."""
    groups: dict[str, list[str]] = {}
    for key, charset in labels().items():
        groups.setdefault(charset, []).append(key)
    bare = F.regexp_replace(F.lower(_col(label)), r"[-_:\s]", "")
    return _let(bare, lambda b: _cases((b.isin(sorted(keys)), F.lit(charset)) for charset, keys in sorted(groups.items())))


def header_charset(header) -> Column:
    """Label in the Content-Type line of an HTTP header; null without one."""
    found = F.regexp_extract(_col(header), r"(?im)^content-type\s*:[^\r\n]*?;\s*charset\s*=\s*[\"']?([^\s;\"',]+)", 1)
    return F.nullif(found, F.lit(""))


def meta_charset(head) -> Column:
    """Label that a page declares in a meta tag; null without one. ``head`` is the page read as Latin-1, which works before the charset is known."""
    head = _col(head)
    direct = F.regexp_extract(head, r"(?is)<meta\b[^>]*?\scharset\s*=\s*[\"']?\s*([^\s\"'/>;]+)", 1)
    typed = F.regexp_extract(head, r"(?is)<meta\b[^>]*?\bcontent\s*=\s*[\"'][^\"'>]*?charset=\s*([^\s\"'/>;]+)", 1)
    return F.coalesce(F.nullif(direct, F.lit("")), F.nullif(typed, F.lit("")))


def declared_charset(head) -> Column:
    """Charset that a page declares in a meta tag, lower-cased; ISO-8859-1 when it declares none."""
    return F.lower(F.coalesce(meta_charset(head), F.lit(UNDECLARED)))


def guessed_charset(latin) -> Column:
    """Charset by the frequencies of bytes, for a page read as Latin-1 that declares none and is no UTF-8.

    Multi-byte charsets of East Asia are told by the structure of their byte pairs and by the frequent lead bytes of their kana, hangul and
    common ideographs; Cyrillic ones by which range holds the small letters, where high bytes are as frequent as letters of text;
    all else is windows-1252.
    """
    def of_high(latin: Column, high: Column) -> Column:
        n = F.length(high)
        count = lambda text, pattern: F.length(F.regexp_replace(text, f"[^{pattern}]+", ""))
        # Letters of text: ASCII letters outside of tags.
        letters = count(F.regexp_replace(latin, r"(?s)<[^>]*+>", ""), "a-zA-Z")
        sjis = F.rlike(latin, F.lit(r"(?s)^(?:[\x00-\x7f\xa1-\xdf]|[\x81-\x9f\xe0-\xfc][\x40-\x7e\x80-\xfc])*+$")) & (
            count(high, r"\x81-\x9f") * 5 >= n)
        pairs = F.rlike(latin, F.lit(r"(?s)^(?:[\x00-\x7f]|[\xa1-\xfe][\xa1-\xfe])*+$"))
        cyrillic = _let(F.struct(count(high, r"\xe0-\xff").alias("a"), count(high, r"\xc0-\xdf").alias("b")), lambda c: F.when(
            (c["a"] + c["b"]) * 10 >= n * 8, F.when(c["a"] >= c["b"], "cp1251").otherwise("koi8-r")))

        def of_lead(lead: Column) -> Column:
            kana = count(lead, r"\xa4\xa5") * 10 >= F.length(lead) * 2
            return (F.when(kana, "euc_jp").when(cyrillic.isNotNull(), None).when(count(lead, r"\xb0-\xc8") * 10 >= F.length(lead) * 8, "cp949")
                    .when(count(lead, r"\xa1-\xf7") * 10 >= F.length(lead) * 9, "gb18030"))

        east = F.when(pairs, _let(F.regexp_replace(high, r"(?s)(.)(.)", "$1"), of_lead))
        return F.when(sjis, "cp932").when(n * 3 >= letters + n, F.coalesce(east, cyrillic, F.lit("cp1252"))).otherwise("cp1252")

    return _let(_col(latin), lambda latin: _let(F.regexp_replace(latin, r"[\x00-\x7f]+", ""), lambda high: of_high(latin, high)))


def page_charset(data, header=None) -> Column:
    """Charset of the bytes of a page, by the rules above. ``header`` is the HTTP header text, if there is one."""
    data = _col(data)
    latin = F.decode(data, "ISO-8859-1")
    declared = canonical(meta_charset(F.substring(latin, 1, HEAD_BYTES)))
    if header is not None:
        declared = F.coalesce(canonical(header_charset(header)), declared)
    mark = F.hex(F.substring(data, 1, 2))
    return (F.when(data.isNull(), None).when(mark == "FFFE", "utf-16-le").when(mark == "FEFF", "utf-16-be")
            .when(F.is_valid_utf8(data.cast("string")), "utf-8")
            .otherwise(F.coalesce(F.nullif(declared, F.lit("utf-8")), guessed_charset(latin))))


def single_byte_table(charset: str) -> str:
    """Characters of the bytes 128 to 255; bytes that the charset leaves out are control characters in the windows ones, else U+FFFD."""
    def text(b: int) -> str:
        try:
            return bytes([b]).decode(charset)
        except UnicodeDecodeError:
            return chr(b) if b < 0xA0 and charset.startswith("cp125") else REPLACEMENT

    return "".join(map(text, range(0x80, 0x100)))


def from_single_byte(data, charset: str) -> Column:
    """Text of bytes in a charset of one byte a character."""
    return F.translate(F.decode(_col(data), "ISO-8859-1"), _UPPER_HALF, single_byte_table(charset))


def to_single_byte(text, charset: str) -> Column:
    """Bytes of a text in such a charset. Only for texts whose characters it has."""
    pairs = [(c, chr(0x80 + i)) for i, c in enumerate(single_byte_table(charset)) if c != REPLACEMENT]
    return F.encode(F.translate(_col(text), "".join(c for c, _ in pairs), "".join(b for _, b in pairs)), "ISO-8859-1")


@F.pandas_udf(T.StringType())
def _multi_byte(data: pd.Series, charset: pd.Series) -> pd.Series:
    return pd.Series([None if b is None else bytes(b).decode(c, "replace") for b, c in zip(data, charset)])


def decoded(data, charset) -> Column:
    """Text of bytes in the given charset (a column); bad bytes are replaced. A byte-order mark is left out."""
    data, charset = _col(data), _col(charset)
    even = F.substring(data, F.lit(1), (F.length(data) - F.length(data) % 2).cast("int"))

    def in_row(c: Column) -> Column:
        wide = (("utf-16", "UTF-16"), ("utf-16-le", "UTF-16LE"), ("utf-16-be", "UTF-16BE"))
        return _cases([(c == "utf-8", F.make_valid_utf8(data.cast("string"))), *((c == name, from_single_byte(data, name)) for name in SINGLE),
                       *((c == name, F.decode(even, java)) for name, java in wide)]).otherwise(F.make_valid_utf8(data.cast("string")))

    text = F.when(charset.isin(MULTI), _multi_byte(F.when(charset.isin(MULTI), data), charset)).otherwise(_let(charset, in_row))
    return F.regexp_replace(text, "^\ufeff", "")


def with_text(df: DataFrame, data: str, out: str, header: str | None = None, charset: str | None = None) -> DataFrame:
    """Adds the text of the bytes in ``data`` as ``out``, null for null, and with ``charset`` the charset under that name. Columns of these names are replaced."""
    name = charset or "_charset"
    found = df.withColumn(name, page_charset(data, header)).withColumn(out, decoded(data, name))
    return found if charset else found.drop(name)
