"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-8]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    return v


def spark_rows(df) -> list[tuple]:
    names = sorted(df.columns)
    return sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=repr)


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = sorted((tuple(_plain(r[i]) for i in order) for r in result.fetchall()), key=repr)
    return sorted(names), rows


def difference(df, con, sql: str) -> str | None:
    names, want = duck_rows(con, sql)
    if sorted(df.columns) != names:
        return f"columns {sorted(df.columns)} != {names}"
    got = spark_rows(df)
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(want)} rows differ in {names}: {bad[0][0]} != {bad[0][1]}"
    types = [(n, t) for n, t in df.dtypes if t.startswith(("timestamp", "decimal"))]
    return f"engine-specific types {types}" if types else None
