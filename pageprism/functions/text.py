"""Text functions: entities, tag stripping, cleaning, product text."""

from __future__ import annotations

import functools
import html
import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageprism import fixed
from pageprism.functions.binding import column, each, let, q


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _table(entries: dict[str, str]) -> str:
    return "\n" + "".join(f"{name}={text}\n" for name, text in entries.items())


@functools.lru_cache(maxsize=1)
def _named() -> str:
    """All names of HTML 5 that end in a semicolon, as ``<name>=<text>`` lines. Line feeds are spelled as U+0001."""
    return _table({n[:-1]: t.replace("\n", "\x01") for n, t in html.entities.html5.items() if n.endswith(";")})


@functools.lru_cache(maxsize=1)
def _bare() -> dict[str, str]:
    """Names that are also read without a semicolon."""
    return {n: t for n, t in html.entities.html5.items() if not n.endswith(";")}


@functools.lru_cache(maxsize=1)
def _numbers() -> str:
    """Numbers that HTML reads as windows-1252."""
    return _table({str(c): bytes([c]).decode("cp1252", errors="ignore") or chr(c) for c in range(0x80, 0xA0)})


def _entry(table: str, name: str) -> str:
    """Text of a name; null when unknown. Looked up in one literal, which keeps plans small."""
    text = q(table)
    key = f"concat('\\n', {name}, '=')"
    return let(key, lambda k: f"CASE WHEN contains({text}, {k}) THEN "
                              f"substring_index(substring_index({text}, {k}, -1), '\\n', 1) END")


def _code_point(code: str) -> str:
    """Text of a code point. Zero, surrogates and numbers beyond Unicode become U+FFFD; control characters and those
    that are none at all vanish."""
    valid = f"{code} > 0 AND {code} <= 1114111 AND NOT {code} BETWEEN 55296 AND 57343"
    none = (f"{code} BETWEEN 1 AND 8 OR {code} = 11 OR {code} BETWEEN 14 AND 31 OR {code} = 127 OR "
            f"{code} BETWEEN 64976 AND 65007 OR ({code} <= 1114111 AND {code} % 65536 >= 65534)")
    return (f"CASE WHEN {none} THEN '' ELSE "
            f"decode(unhex(lpad(hex(CASE WHEN {valid} THEN {code} ELSE 65533 END), 8, '0')), 'UTF-32') END")


def _numeric(name: str) -> str:
    def number(digits: str, value: str) -> str:
        # More digits than any code point has are beyond Unicode.
        return let(f"regexp_extract({name}, {q(digits)}, 1)", lambda d: (
            f"CASE WHEN length({d}) > 9 THEN 1114112 WHEN {d} <> '' THEN CAST({value.format(d)} AS BIGINT) END"))

    return let(f"coalesce({number('^#0*([0-9]+)$', '{}')}, {number('^#[xX]0*([0-9a-fA-F]+)$', 'conv({}, 16, 10)')})",
               lambda code: f"CASE WHEN {code} BETWEEN 128 AND 159 THEN {_entry(_numbers(), f'CAST({code} AS STRING)')} "
                            f"ELSE {_code_point(code)} END")


_REFERENCE = r"^&(#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]{0,31}(?=;));?"


#: Characters that a tag needs as references, and how they are spelled in tokens; the ampersand is decoded last.
_KEPT = {"<": "&lt;", ">": "&gt;", '"': "&quot;", "'": "&#39;", " ": "&#32;", "\t": "&#9;", "\n": "&#10;", "\f": "&#12;",
         "\r": "&#13;", "&": "&amp;"}


def _kept(value: str) -> str:
    cases = " ".join(f"WHEN {q(c)} THEN {q(r)}" for c, r in _KEPT.items())
    return let(value, lambda v: f"CASE {v} {cases} ELSE {v} END")


def _decoded(piece: str, in_tag: bool) -> str:
    """A piece of text that starts with a character reference. In a tag a name without a semicolon is none when a letter,
    a digit or an equals sign follows (it is a parameter of a link)."""
    keep = _kept if in_tag else str

    def named(n: str) -> str:
        value = (f"CASE WHEN startswith({n}, '#') THEN {_numeric(n)} "
                 f"ELSE replace({_entry(_named(), n)}, '\\u0001', '\\n') END")
        return f"CASE WHEN {n} <> '' THEN concat({keep(value)}, regexp_replace({piece}, {q(_REFERENCE)}, '')) END"

    def bare(n: str) -> str:
        value = _entry(_table(_bare()), n)
        return f"CASE WHEN {n} <> '' THEN concat({keep(value)}, substr({piece}, length({n}) + 2)) END"

    longest_first = "|".join(sorted(_bare(), key=lambda n: (-len(n), n)))
    end = "(?![a-zA-Z0-9=])" if in_tag else ""
    return "coalesce({}, {}, {})".format(
        let(f"regexp_extract({piece}, {q(_REFERENCE)}, 1)", named),
        let(f"regexp_extract({piece}, {q(f'^&({longest_first}){end}')}, 1)", bare),
        piece)


def _all_decoded(text: str, in_tag: bool = False) -> str:
    pieces = each(f"split({text}, '(?=&)')", lambda p: f"CASE WHEN startswith({p}, '&') THEN {_decoded(p, in_tag)} ELSE {p} END")
    return f"array_join({pieces}, '')"


#: References of most pages; a page without others needs no search in the table. The ampersand comes last.
FREQUENT = "lt gt quot nbsp #39 copy reg trade middot bull hellip mdash ndash lsquo rsquo ldquo rdquo laquo raquo euro times amp".split()


def unescape_sql(text: str) -> str:
    def decode(t: str) -> str:
        # The frequent references are replaced as they are; the ampersand goes last.
        common = t
        for name in FREQUENT:
            common = f"replace({common}, {q(f'&{name};')}, {q(html.unescape(f'&{name};'))})"
        rare = q(rf"&(?!(?:{'|'.join(FREQUENT)});)[#a-zA-Z]")
        return (f"CASE WHEN NOT contains({t}, '&') THEN {t} WHEN {t} RLIKE {rare} THEN {_all_decoded(t)} "
                f"ELSE {common} END")

    return let(text, decode)


def plain_references_sql(token: str) -> str:
    """A tag whose references are decoded but for those characters that would change the tag: they get one spelling,
    which ``unescape_kept_sql`` decodes. So the table of names is searched once per page and not once per attribute."""
    kept = "|".join(r[1:-1] for r in _KEPT.values())
    rare = q(rf"&(?!(?:{kept});)(?:#|[a-zA-Z][a-zA-Z0-9]*+(?!=))")
    return (f"CASE WHEN contains({token}, '&') AND NOT {token} RLIKE '(?i)^<(?:script|style|title|textarea)' AND {token} RLIKE {rare} "
            f"THEN {_all_decoded(token, in_tag=True)} ELSE {token} END")


def unescape_kept_sql(text: str) -> str:
    """Decodes the references that tags keep, in one pass: the ampersand goes last."""
    def decode(t: str) -> str:
        plain = t
        for character, name in _KEPT.items():
            plain = f"replace({plain}, {q(name)}, {q(character)})"
        return f"CASE WHEN contains({t}, '&') THEN {plain} ELSE {t} END"

    return let(text, decode)


def unescape_html(text: str) -> Column:
    """Replaces decimal, hexadecimal and named character references of HTML 5, in one pass.

    ``text`` is a column name or SQL expression, as in all functions here that take a ``str``.
    """
    return column(unescape_sql(text))


def strip_html(text) -> Column:
    """Removes tags; a tag never spans lines."""
    return F.regexp_replace(_col(text), "<.*?>", "")


def clean_text_sql(text: str) -> str:
    bare = f"regexp_replace(regexp_replace({text}, '<.*?>', ''), {q('(?U)^\\s+|\\s+$')}, '')"
    return unescape_sql(f"regexp_replace(replace({bare}, '\\n', ' '), ' +', ' ')")


def clean_text(text: str) -> Column:
    """Tags out, trimmed, line feeds to spaces, runs of spaces collapsed, entities decoded once."""
    return column(clean_text_sql(text))


def drop_placeholder(text) -> Column:
    """Trimmed text; null for texts that stand for a missing value."""
    trimmed = F.regexp_replace(_col(text), r"(?U)^\s+|\s+$", "")
    return F.when(~F.lower(trimmed).isin(fixed.PLACEHOLDERS), trimmed)


def product_text(title, description) -> Column:
    """``title. description`` from the parts that carry a value; null when neither does."""
    return F.nullif(F.concat_ws(". ", drop_placeholder(title), drop_placeholder(description)), F.lit(""))


def primary_language(tag) -> Column:
    """First subtag of a language tag."""
    return F.element_at(F.split(_col(tag), "[-_]"), 1)


def is_translatable(lang) -> Column:
    return F.coalesce(_col(lang).isin(fixed.TRANSLATABLE), F.lit(False))


def translation_input(lang, text) -> Column:
    """The text when its language can be translated, else null."""
    return F.when(is_translatable(lang), _col(text))
