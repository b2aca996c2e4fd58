"""Run registered queries in Spark and DuckDB and compare the values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{folder}/{name}.parquet"
        if Path(path).exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return repr(value + 0.0)
    return repr(value)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(_plain(r[k]) for k in order) for r in rows)


def difference(df, connection, sql: str) -> str | None:
    """None if equal, else a description of the first difference."""
    columns = df.columns
    mine = canonical(columns, [tuple(r) for r in df.collect()])
    result = connection.execute(sql)
    names = [c[0] for c in result.description]
    theirs = canonical(names, result.fetchall())
    if sorted(columns) != sorted(names):
        return f"columns {sorted(set(columns) ^ set(names))}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} != {len(theirs)}"
    if mine != theirs:
        wrong = [(a, b) for a, b in zip(mine, theirs) if a != b]
        return f"{len(wrong)} rows differ, e.g.\n  spark {wrong[0][0]}\n  duck  {wrong[0][1]}"
    return None


def main(folder: str, *names: str) -> int:
    from patronflow.session import get_session

    from .oracle import ORACLE
    from .queries import QUERIES

    spark = get_session(master="local[8]", **{
        "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    connection = duck(folder)
    bad = 0
    for name, run in QUERIES.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        start = time.time()
        try:
            wrong = difference(run(spark, folder), connection, ORACLE[name])
        except Exception as error:
            wrong = f"{type(error).__name__}: {str(error)[:600]}"
        bad += wrong is not None
        print(f"{'FAIL' if wrong else 'ok  '} {name} {time.time() - start:.2f}s {wrong or ''}",
              flush=True)
    print("missing oracle:", sorted(set(QUERIES) - set(ORACLE)),
          "unused:", sorted(set(ORACLE) - set(QUERIES)))
    return bad


if __name__ == "__main__":
    sys.exit(main(*sys.argv[1:]))
