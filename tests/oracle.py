"""Compare a registered query with its SQL in DuckDB, as bags of rows."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for file in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def differences(con, df, sql: str) -> list[str]:
    """Empty when both give the same columns and the same rows."""
    names = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*names).toLocalIterator())
    result = con.execute(f"SELECT * FROM ({sql}) q")
    theirs = [c[0] for c in result.description]
    if sorted(theirs) != names:
        return [f"columns {names} against {sorted(theirs)}"]
    order = [theirs.index(n) for n in names]
    expected = Counter(tuple(row[i] for i in order) for row in result.fetchall())
    found = [f"only Spark ({n}x): {row}"[:600] for row, n in list((got - expected).items())[:3]]
    found += [f"only SQL ({n}x): {row}"[:600] for row, n in list((expected - got).items())[:3]]
    if found:
        found.insert(0, f"{sum(got.values())} rows against {sum(expected.values())}")
    return found
