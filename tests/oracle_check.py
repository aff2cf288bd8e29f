"""Runs every named query next to its SQL in DuckDB and compares rows, types and values.

    python tests/oracle_check.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def sort_key(row):
    return [(v is None, str(type(v)), v if v is not None else 0) for v in row]


def compare(df, con, sql: str) -> str:
    """'' when equal, else the first difference."""
    names = sorted(df.columns)
    got = df.select(*[f"`{n}`" for n in names]).collect()
    con.execute(sql)
    have = [d[0] for d in con.description]
    kinds = {d[0]: str(d[1]) for d in con.description}
    want = con.fetchall()
    if sorted(have) != names:
        return f"columns {names} != {sorted(have)}"
    types = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    bad = {n: (types[n], kinds[n]) for n in names if types[n] != kinds[n]}
    if bad:
        return f"types {bad}"
    order = [have.index(n) for n in names]
    got = sorted((tuple(r) for r in got), key=sort_key)
    want = sorted((tuple(r[i] for i in order) for r in want), key=sort_key)
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    for g, w in zip(got, want):
        if g != w or any(isinstance(v, float) and math.copysign(1, v) != math.copysign(1, u) for v, u in zip(g, w)):
            return f"values {names}: {g} != {w}"
    return ""


def main(sf_dir: str, names: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from tests.conftest import make_session

    spark, con, failed = make_session(), connect(sf_dir), 0
    sqls = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            result = compare(df, con, sqls[name]) if name in sqls else f"rows only: {df.count()}"
        except Exception as error:  # report and go on with the next query
            result = f"error {type(error).__name__}: {str(error)[:600]}"
        ok = not result or result.startswith("rows only")
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name:28s} {time.time() - start:6.2f}s {result}", flush=True)
    print("failed:", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1], sys.argv[2:]) > 0)
