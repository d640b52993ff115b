"""Run registered queries and their SQL side by side: ``python tests/oracle_check.py [sf_dir] [name ...]``."""

from __future__ import annotations

import os
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if os.path.exists(f"{sf_dir}/{name}.parquet"):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


SPARK_TYPES = {
    "VARCHAR": "string",
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
    "TIMESTAMP_NS": "timestamp_ntz",
    "BOOLEAN": "boolean",
}


def _text(value) -> str:
    return f"{value:.9g}" if isinstance(value, float) else str(value)


def _bag(rows, order: list[int]) -> list[tuple[str, ...]]:
    return sorted(tuple(_text(row[i]) for i in order) for row in rows)


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty when both sides agree in column names, types and rows, in any row order."""
    rel = con.sql(sql)
    theirs = {c: SPARK_TYPES.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
    ours = {f.name: f.dataType.simpleString() for f in spark_df.schema}
    if ours != theirs:
        return f"schema {sorted(set(ours.items()) ^ set(theirs.items()))}"
    names = sorted(ours)
    a = _bag(spark_df.collect(), [spark_df.columns.index(c) for c in names])
    b = _bag(rel.fetchall(), [rel.columns.index(c) for c in names])
    if a == b:
        return ""
    only_a = next(iter(set(a) - set(b)), None)
    only_b = next(iter(set(b) - set(a)), None)
    return f"rows {len(a)} and {len(b)}; {names}; only ours {only_a}; only sql {only_b}"


def main() -> int:
    import __spark_entry__ as e
    from streamlake.session import local_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(e.queries())
    spark = local_session("oracle-check", 8)
    con = connect(sf_dir)
    bad = 0
    for name in names:
        start = time.time()
        try:
            df = e.queries()[name](spark, sf_dir)
            sql = e.oracle_sql().get(name)
            verdict = compare(df, con, sql) if sql else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += bool(verdict) and not verdict.startswith("rows only")
        print(f"{'ok ' if not verdict else '   '} {name:28s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print(f"{bad} of {len(names)} differ")
    return bad


if __name__ == "__main__":
    raise SystemExit(main())
