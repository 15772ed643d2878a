"""Compare a registered query with its SQL in DuckDB on the same parquet files."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb

KINDS = {"INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
         "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean", "TINYINT": "tinyint"}


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _text(v):
    if isinstance(v, Decimal):
        return format(v, "f")
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    return repr(v)


def _rows(rows, names, order):
    at = [names.index(n) for n in order]
    return Counter(tuple(_text(r[i]) for i in at) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, types and rows; empty when all agree."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    types = {d[0]: str(d[1]) for d in cur.description}
    got = dict(df.dtypes)
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} / {sorted(names)}"]
    for n in names:
        want = types[n]
        want = f"decimal scale {want.split(',')[1].rstrip(')').strip()}" if want.startswith("DECIMAL") else KINDS.get(want, want)
        have = got[n]
        have = f"decimal scale {have.split(',')[1].rstrip(')')}" if have.startswith("decimal") else have
        if want != have:
            out.append(f"type of {n}: spark {have} / sql {want}")
    order = sorted(names)
    a = _rows([tuple(r) for r in df.collect()], df.columns, order)
    b = _rows(cur.fetchall(), names, order)
    if a != b:
        n, m = sum(a.values()), sum(b.values())
        out.append(f"rows {n} / {m}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}")
    elif not a:
        out.append("EMPTY")
    return out
