"""Run queries against their check SQL: ``python tests/check_queries.py [sf] [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb  # noqa: E402

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from maskloom.plans.tables import GIVEN  # noqa: E402


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in GIVEN:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{v:.6g}" if abs(v) < 1e6 else f"{v:.9g}"
    if isinstance(v, int):
        return f"{float(v):.6g}" if abs(v) < 1e6 else str(v)
    return str(v)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(df, con, sql):
    """Return an error text, or None if both sides agree."""
    got = df.collect()
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    want = cur.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(got)
    a, b = rows_of(df.columns, got), rows_of(names, want)
    if a != b:
        return f"rows {len(got)} vs {len(want)}; only spark {list((a - b).items())[:3]}; only sql {list((b - a).items())[:3]}; cols {sorted(names)}", len(got)
    ints = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN"}
    odd = [f"{c}:{t}/{kinds[c]}" for c, t in df.dtypes if t in ints and ints[t] not in kinds[c].upper() and kinds[c].upper() not in ("STRING", "NUMBER", "BOOL")]
    return ("TYPES " + ", ".join(odd) if odd else None), len(got)


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from maskloom.session import local_session

    sf = argv[0] if argv else "0.001"
    only = argv[1:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sqls, bad = oracle_sql(), 0
    for name, run in queries().items():
        if only and not any(name == o or (o.endswith("*") and name.startswith(o[:-1])) for o in only):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            err, n = compare(df, con, sqls[name]) if name in sqls else (None, df.count())
        except Exception as exc:  # report and go on
            err, n = f"{type(exc).__name__}: {str(exc)[:700]}", -1
        bad += bool(err)
        print(f"{'BAD ' if err else 'ok  '} {name} n={n} {time.time() - start:.1f}s{'' if name in sqls else ' (rows only)'} {err or ''}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
