"""Side-by-side check of a catalogue query against its DuckDB oracle, the way
the driver does it: row count, column names, order-insensitive values."""

from __future__ import annotations

import math
import sys
import time

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 9)
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark, name: str, sf_dir: str, con=None) -> dict:
    from __spark_entry__ import oracle_sql, queries
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = queries()[name](spark, sf_dir)
    s_cols = sdf.columns
    s_rows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    res = {"name": name, "spark_rows": len(s_rows), "spark_sec": round(t1 - t0, 2)}
    sql = oracle_sql().get(name)
    if sql is None:
        res["oracle"] = "none"
        return res
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    res["duck_rows"] = len(d_rows)
    res["cols_match"] = sorted(s_cols) == sorted(d_cols)
    if not res["cols_match"]:
        res["cols"] = (sorted(s_cols), sorted(d_cols))
    a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
    res["values_match"] = a == b
    if not res["values_match"]:
        sa, sb = set(map(repr, a)), set(map(repr, b))
        res["only_spark"] = sorted(sa - sb)[:3]
        res["only_duck"] = sorted(sb - sa)[:3]
    return res


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from threadloom.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark("local[8]")
    from __spark_entry__ import queries
    con = duck(sf)
    bad = 0
    for n in (names or sorted(queries())):
        try:
            r = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            r = {"name": n, "error": repr(e)[:800]}
        ok = r.get("oracle") == "none" or (r.get("cols_match") and r.get("values_match"))
        bad += not ok
        print(("OK  " if ok else "BAD ") + repr(r), flush=True)
    print("failures:", bad)
