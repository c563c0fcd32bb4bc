"""Run a registered query and its SQL on the same files and compare the results as bags of rows."""

from __future__ import annotations

import datetime as dt
import math
import sys
import time

import duckdb

from tenorgrid.sources.schemas import TEST_TABLES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TEST_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9) + 0.0
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    return v


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(con, entry, df):
    rel = con.execute(entry.sql)
    cols = [d[0] for d in rel.description]
    types = [str(d[1]) for d in rel.description]
    expected = bag(cols, rel.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    problems = []
    if sorted(cols) != sorted(df.columns):
        problems.append(f"columns differ: {sorted(set(cols) ^ set(df.columns))}")
    if len(got) != len(expected):
        problems.append(f"rows: {len(got)} against {len(expected)}")
    if not problems and got != expected:
        names = sorted(cols)
        a, b = [x for x in got if x not in set(expected)][:2], [x for x in expected if x not in set(got)][:2]
        n = sum(x != y for x, y in zip(got, expected))
        problems.append(f"{n} rows differ, e.g.\n   {list(zip(names, a[0])) if a else None}\n   {list(zip(names, b[0])) if b else None}")
    small = dict(zip(cols, types))
    odd = [c for c, t in df.dtypes if not _alike(t, small.get(c, ""))]
    return problems, [f"{c}: {dict(df.dtypes)[c]} against {small.get(c)}" for c in odd], len(got)


def _alike(spark_type: str, duck: str) -> bool:
    table = {"bigint": {"BIGINT"}, "int": {"INTEGER"}, "double": {"DOUBLE"}, "string": {"VARCHAR"}, "date": {"DATE"},
             "boolean": {"BOOLEAN"}, "timestamp": {"TIMESTAMP"}}
    return duck.upper() in table.get(spark_type, {duck.upper()})


if __name__ == "__main__":
    from tenorgrid.catalog import REGISTRY
    from tenorgrid.session import build_session

    folder = sys.argv[1]
    names = sys.argv[2:] or list(REGISTRY)
    spark = build_session("local[8]", 8, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name in names:
        t0 = time.time()
        try:
            problems, odd, n = compare(con, REGISTRY[name], REGISTRY[name](spark, folder))
        except Exception as ex:  # report and go on with the other queries
            problems, odd, n = [f"{type(ex).__name__}: {str(ex)[:700]}"], [], -1
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} rows={n} {time.time() - t0:.2f}s {'; '.join(problems)} {odd or ''}", flush=True)
    print("failed:", bad)
