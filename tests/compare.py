"""Run a registered query and its SQL twin over the same tables and compare the rows."""

from __future__ import annotations

import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(folder: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return repr(round(v, 6))
    return None if v is None else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None when both sides agree, else a short account."""
    left_names, left = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    right_names, right = rows_of([d[0] for d in cur.description], cur.fetchall())
    if left_names != right_names:
        return f"columns {left_names} / {right_names}"
    if left != right:
        return (f"{sum(left.values())} / {sum(right.values())} rows; only Spark {list((left - right))[:2]}; "
                f"only SQL {list((right - left))[:2]}")
    return None


if __name__ == "__main__":
    from marketloom.queries import all_queries
    from marketloom.session import local_session

    folder = f"/root/testdata/{sys.argv[1]}"
    wanted = sys.argv[2:]
    spark, con = local_session(), duck(folder)
    bad = 0
    for name, q in all_queries().items():
        if wanted and name not in wanted:
            continue
        t = time.time()
        try:
            df = q(spark, folder)
            problem = differences(df, con, q.oracle) if q.oracle else None
            n = "" if problem else df.count()
        except Exception as exc:
            problem, n = f"{type(exc).__name__}: {str(exc)[:1500]}", ""
        bad += problem is not None
        print(f"{'BAD' if problem else 'ok ':4}{time.time() - t:6.1f}s {name} {n} {problem or ''}", flush=True)
    print(f"{bad} bad")
