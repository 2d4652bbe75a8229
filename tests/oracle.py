"""Run registered queries against their oracle SQL: ``python tests/oracle.py [sf] [name ...]``."""

from __future__ import annotations

import sys
import time
from collections import Counter
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def kind(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return "bool"
    if isinstance(v, int):
        return "int"
    if isinstance(v, float):
        return "float"
    if isinstance(v, (Decimal, datetime, date, str)):
        return type(v).__name__
    return repr(type(v))


def rows_of(columns, data) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((kind(r[i]), r[i]) for i in order) for r in data)


def compare(spark, con, build, sql: str, sf_dir: str) -> str | None:
    """None when equal, else what differs."""
    df = build(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} vs {sorted(names)}"
    want = rows_of(names, cur.fetchall())
    if got == want:
        return None
    extra, lacking = list((got - want).items())[:2], list((want - got).items())[:2]
    return (
        f"rows {sum(got.values())} vs {sum(want.values())}; differing {sum((got - want).values())}\n"
        f"    spark  {extra}\n    oracle {lacking}\n    {sorted(names)}"
    )


def main(argv) -> int:
    from tests.session import session

    import __spark_entry__ as entry

    sf_dir = f"/root/testdata/sf{argv[0] if argv else '0.01'}"
    spark, con = session(), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    names = argv[1:] or list(queries)
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in oracle:
                problem = compare(spark, con, queries[name], oracle[name], sf_dir)
            else:
                n = len(queries[name](spark, sf_dir).collect())
                problem = None if n else "no rows"
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += problem is not None
        note = "ok" if problem is None else f"FAIL {problem}"
        print(f"{name:28s} {time.time() - start:6.1f}s {'' if name in oracle else '(rows only) '}{note}", flush=True)
    print(f"{len(names) - bad} of {len(names)} good")
    return bad


if __name__ == "__main__":
    sys.exit(min(1, main(sys.argv[1:])))
