"""Run a query and its check side by side."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")


def checking_engine(sf: str):
    con = duckdb.connect()
    for file in sorted((DATA / sf).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def _plain(value):
    if isinstance(value, float) and (math.isnan(value) or value == 0):
        return None if math.isnan(value) else 0.0
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    table = [tuple(_plain(r[k]) for k in order) for r in rows]
    return [columns[k] for k in order], sorted(table, key=lambda r: tuple((v is None, str(type(v)), v) if v is not None else (True, "", 0) for v in r))


def differences(spark, con, query, sql, sf):
    """Empty when both give the same rows; otherwise a short description."""
    df = query(spark, str(DATA / sf))
    columns, ours = as_rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names, theirs = as_rows([d[0] for d in cur.description], cur.fetchall())
    if columns != names:
        return f"columns {columns} / {names}"
    if ours == theirs:
        return ""
    mine, other = set(ours), set(theirs)
    lines = [f"rows {len(ours)} / {len(theirs)}, only ours {len(mine - other)}, only check {len(other - mine)}"]
    cells = {}
    for a, b in zip(ours, theirs):
        for c, x, y in zip(columns, a, b):
            if x != y:
                cells.setdefault(c, (x, y))
    lines.append(f"first differing cells {cells}")
    return "; ".join(lines)
