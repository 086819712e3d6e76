"""Compare a Spark result with the same result from DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v + 0.0      # -0.0 and 0.0 are one value
    return v


def _bag(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> list[str]:
    """Differences in columns, row count or values; empty if equal."""
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    theirs = rel.fetchall()
    ours = [tuple(r) for r in df.collect()]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    spark_types = dict(df.dtypes)
    same = {
        "double": "DOUBLE", "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR",
        "boolean": "BOOLEAN",
    }
    problems = [
        f"type of {n}: {spark_types[n]} != {t}" for n, t in zip(names, types)
        if same.get(spark_types[n]) != t
    ]
    if len(ours) != len(theirs):
        problems.append(f"rows {len(ours)} != {len(theirs)}")
    a, b = _bag(ours, df.columns), _bag(theirs, names)
    if a != b:
        problems.append(
            f"{sum((a - b).values())} rows differ, e.g. {list((a - b))[:2]} / {list((b - a))[:2]}"
        )
    return problems
