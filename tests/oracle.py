"""Runs a registered query and its SQL twin and compares rows, order aside."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _plain(v.asDict())
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_rows = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    kinds = dict(zip(names, [str(d[1]) for d in result.description]))
    at = [names.index(n) for n in order]
    want = Counter(tuple(_plain(r[i]) for i in at) for r in want_rows)
    have = Counter(tuple(_plain(v) for v in r) for r in df.select(*order).collect())
    if want == have:
        spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        same = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "BOOLEAN": "boolean", "VARCHAR": "string",
                "DATE": "date", "NUMBER": None, "STRING": "string"}
        bad = {n: (spark_kinds[n], kinds[n]) for n in order
               if same.get(kinds[n]) and same[kinds[n]] != spark_kinds[n]}
        return f"types {bad}" if bad else None
    return (f"{sum(have.values())} rows, want {sum(want.values())}; "
            f"extra {list((have - want).items())[:2]}; missing {list((want - have).items())[:2]}")
