"""Runs registered queries beside their SQL and reports differences. Usage: python -m checks.compare [sf] [name ...]"""

from __future__ import annotations

import os
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def sql_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def lines(rows, names) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(repr(row[i]) for i in order) for row in rows)


def difference(df, con, sql: str) -> str | None:
    got = df.collect()
    result = con.execute(sql)
    want, names = result.fetchall(), [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    a, b = lines(got, df.columns), lines(want, names)
    if len(a) != len(b):
        return f"{len(a)} and {len(b)} rows"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    if wrong:
        return f"{len(wrong)} of {len(a)} rows differ, first {wrong[0][0]} and {wrong[0][1]}"
    return None


def main(argv: list[str]) -> int:
    from checks import oracle, queries
    from checks.session import local_session
    sf_dir = f"/root/testdata/{argv[0] if argv else 'sf0.01'}"
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    con, sqls, bad = sql_connection(sf_dir), oracle.build(), 0
    for name, fn in queries.build().items():
        if argv[1:] and not any(name.startswith(p) for p in argv[1:]):
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                problem = difference(df, con, sqls[name])
                note = "ok" if problem is None else f"DIFFERS {problem}"
            else:
                problem, note = None, f"rows {df.count()}"
        except Exception as e:  # noqa: BLE001
            problem = note = f"FAILED {type(e).__name__} {str(e)[:1500]}"
        bad += problem is not None
        print(f"{name:32s} {time.time() - start:6.2f}s {note}", flush=True)
    print(f"{bad} problems")
    return bad


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
