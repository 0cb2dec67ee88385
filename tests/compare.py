"""Order-free comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = """region nation customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations""".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str, show: int = 3) -> str:
    """Empty if both results hold the same rows under the same column names."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    expected = Counter(tuple(row) for row in cursor.fetchall())
    actual = Counter(tuple(row) for row in df.select(*names).collect())
    if expected == actual:
        return ""
    missing, extra = expected - actual, actual - expected
    lines = [f"{sum(actual.values())} rows, expected {sum(expected.values())}"]
    for row in sorted(missing, key=repr)[:show]:
        near = min(extra, key=lambda other: sum(a != b for a, b in zip(row, other)), default=None)
        if near:
            lines.append(str([(n, a, b) for n, a, b in zip(names, row, near) if a != b]) + f" at {row[:2]}")
        else:
            lines.append(f"missing {row}")
    for row in sorted(extra, key=repr)[:show]:
        lines.append(f"extra {row}")
    return "\n".join(lines)
