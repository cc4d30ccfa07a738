"""Run a registered query and its SQL on the same folder and compare them."""

from __future__ import annotations

import os

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations"]
_KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT", "string": "VARCHAR", "boolean": "BOOLEAN",
}


def oracle_rows(sql: str, folder: str):
    con = duckdb.connect()
    for t in TABLES:
        path = f"{folder}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    kinds = {c[0]: str(c[1]) for c in result.description}
    return names, kinds, result.fetchall()


def difference(df, sql: str, folder: str) -> str | None:
    """None if both agree on columns, types and rows, else what differs."""
    names, kinds, expected = oracle_rows(sql, folder)
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wrong = {n: (t, kinds[n]) for n, t in df.dtypes if _KINDS.get(t) != kinds[n]}
    if wrong:
        return f"types {wrong}"
    order = sorted(names)
    key = lambda row: [(v is not None, v) if not isinstance(v, bool) else (True, int(v)) for v in row]
    got = sorted((tuple(r[c] for c in order) for r in df.collect()), key=key)
    at = [names.index(c) for c in order]
    want = sorted((tuple(r[i] for i in at) for r in expected), key=key)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows, e.g. {order}: {bad[0][0]} != {bad[0][1]}" if bad else None
