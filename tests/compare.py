"""Run a catalog query on Spark and its SQL on DuckDB, and say how they differ."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from pathlib import Path

import duckdb

from daybook import catalog


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else repr(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def difference(spark, con, folder: str, key: str) -> str | None:
    df = catalog.queries()[key](spark, folder)
    ours = [tuple(r) for r in df.collect()]
    rel = con.sql(catalog.oracle_sql()[key])
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} against {sorted(rel.columns)}"
    kinds = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
        "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
    }
    theirs_kinds = dict(zip(rel.columns, map(str, rel.types)))
    bad = {n: (k, theirs_kinds[n]) for n, k in df.dtypes if kinds.get(k) != theirs_kinds[n]}
    if bad:
        return f"types {bad}"
    a, b = _rows(df.columns, ours), _rows(rel.columns, rel.fetchall())
    if a == b:
        return None if ours else "no rows"
    names = sorted(df.columns)
    return (f"{len(ours)} rows against {sum(b.values())}; {names}; only here {list((a - b).items())[:3]}; "
            f"only there {list((b - a).items())[:3]}")
