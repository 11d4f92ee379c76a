"""Compares a registered query with its SQL twin."""

from __future__ import annotations

import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).split(".")[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def sorted_rows(columns: list[str], rows: list) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in rows), key=repr)


TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "TIMESTAMP": "timestamp_ntz",
    "DATE": "date",
    "BOOLEAN": "boolean",
}


def differences(spark, con, build, sql: str, sf_dir: str) -> list[str]:
    df = build(spark, sf_dir)
    want = con.execute(sql)
    names = [d[0] for d in want.description]
    if sorted(df.columns) != sorted(names):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    kinds = {d[0]: TYPES.get(str(d[1]), str(d[1])) for d in want.description}
    if kinds != dict(df.dtypes):
        return [f"types {sorted(set(kinds.items()) ^ set(df.dtypes))}"]
    got_rows = sorted_rows(df.columns, df.collect())
    want_rows = sorted_rows(names, want.fetchall())
    out = []
    if len(got_rows) != len(want_rows):
        out.append(f"{len(got_rows)} rows != {len(want_rows)}")
    bad = [(g, w) for g, w in zip(got_rows, want_rows, strict=False) if g != w]
    if bad:
        out.append(f"{len(bad)} rows differ, first: {sorted(df.columns)} {bad[0]}")
    return out
