"""HTTP header blocks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pageprism.functions.binding import column, each, let, only, q


def parse_headers(text: str) -> Column:
    """Header text -> ``map<string, array<string>>`` with lower-cased names.

    Lines are split once at ``": "``; repeated names keep every value in order; the HTTP status
    line is kept under ``status``.
    """
    def entry(line: str) -> str:
        name = f"lower(substring_index({line}, ': ', 1))"
        value = f"substr({line}, locate(': ', {line}) + 2)"
        return (f"CASE WHEN contains({line}, ': ') THEN named_struct('name', {name}, 'value', {value}) "
                f"ELSE named_struct('name', 'status', 'value', {line}) END")

    def grouped(entries: str) -> str:
        def values(name: str) -> str:
            return each(only(entries, lambda e: f"{e}.name = {name}"), lambda e: f"{e}.value")

        names = f"array_distinct({each(entries, lambda e: f'{e}.name')})"
        return let(names, lambda n: f"map_from_arrays({n}, {each(n, values)})")

    lines = only(f"split(trim({text}), {q(chr(92) + 'r' + chr(92) + 'n|' + chr(92) + 'n|' + chr(92) + 'r')})",
                 lambda s: f"contains({s}, ': ') OR contains({s}, 'HTTP/')")
    return column(let(each(lines, entry), grouped))


def header_text(headers) -> Column:
    """Header map -> text, one line per value."""
    headers = F.col(headers) if isinstance(headers, str) else headers
    lines = F.flatten(F.transform(
        F.map_entries(headers),
        lambda e: F.transform(e["value"], lambda v: F.concat(e["key"], F.lit(": "), v)),
    ))
    return F.array_join(lines, "\n")


def status_code(headers: str) -> Column:
    """Numeric status from the kept status line."""
    return column(f"try_cast(regexp_extract(element_at(try_element_at({headers}, 'status'), -1), "
                  f"{q('^HTTP/[^ ]+ +([0-9]{3})')}, 1) AS INT)")
