"""Compare Spark queries with their SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import pathlib
from collections import Counter

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in pathlib.Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def difference(df, con, sql) -> str | None:
    """None if both agree, else what differs."""
    names = sorted(df.columns)
    ours = Counter(tuple(row) for row in df.select(*names).collect())
    result = con.execute(sql)
    theirs_names = [d[0] for d in result.description]
    if sorted(theirs_names) != names:
        return f"columns {names} != {sorted(theirs_names)}"
    order = [theirs_names.index(n) for n in names]
    theirs = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    if ours == theirs:
        return None
    more, less = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"only ours {list(more)[:3]}; only theirs {list(less)[:3]}"
    )
