"""Compare a registered query with its SQL counterpart, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else float(f"{v:.10g}")
    if isinstance(v, bool) or v is None:
        return v
    if isinstance(v, int):
        return float(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, sf_dir: str, name: str, fn, sql: str) -> str | None:
    """None when equal, else what differs."""
    df = fn(spark, sf_dir)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for join in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        if join in plan:
            return f"plan holds a {join}"
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    rel = con.sql(sql)
    theirs = _rows(rel.columns, rel.fetchall())
    if sorted(df.columns) != sorted(rel.columns):
        return f"columns {sorted(df.columns)} != {sorted(rel.columns)}"
    kinds = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE", "timestamp": "TIMESTAMP"}
    spark_types = {c: kinds.get(t, t) for c, t in df.dtypes}
    duck_types = dict(zip(rel.columns, map(str, rel.types)))
    odd = {c: (spark_types[c], duck_types[c]) for c in spark_types if spark_types[c] != duck_types[c]}
    if odd:
        print(f"    note {name}: types {odd}", file=sys.stderr)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        a, b = different[0]
        cells = [(n, x, y) for n, x, y in zip(sorted(df.columns), a, b) if x != y]
        return f"{len(different)} of {len(ours)} rows differ, first: {[(n, str(x)[:200], str(y)[:200]) for n, x, y in cells]}"
    return None


def main(argv):
    sys.path.insert(0, __file__.rsplit("/tests/", 1)[0])
    import __spark_entry__ as entry
    from tests.conftest import make_spark

    sf_dir, only = argv[0], argv[1:]
    spark, con = make_spark(), connect(sf_dir)
    bad = 0
    for name, fn in entry.queries().items():
        if only and name not in only:
            continue
        t = time.time()
        try:
            sql = entry.oracle_sql().get(name)
            if sql is None:
                print(f"{name}: rows only, {fn(spark, sf_dir).count()}")
                continue
            problem = compare(spark, con, sf_dir, name, fn, sql)
        except Exception as e:  # noqa: BLE001
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name}: {'ok' if problem is None else 'DIFFERS ' + problem}  ({time.time() - t:.1f}s)", flush=True)
    print(f"{bad} differ")


if __name__ == "__main__":
    main(sys.argv[1:])
