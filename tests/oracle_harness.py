"""Local stand-in for the driver's correctness gate.

Runs each Spark query and its DuckDB oracle on the same parquet tables and
compares row count, column names, column types and an order-insensitive
hash of the values.

    python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb
import pandas as pd

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "smallint": "SMALLINT", "float": "FLOAT", "date": "DATE"}


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = f"{sf_dir}/{t}.parquet"
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return "∅"
    if isinstance(v, float):
        if math.isnan(v):
            return "∅"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        r = round(v, 6) + 0.0
        return repr(int(r)) if r.is_integer() and abs(r) < 2 ** 53 else repr(r)
    if isinstance(v, bool):
        return repr(v)
    if isinstance(v, int):
        return repr(v)
    if hasattr(v, "item"):
        return _norm(v.item())
    return repr(v)


def value_hash(pdf: pd.DataFrame) -> str:
    cols = sorted(pdf.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in pdf[cols].to_dict("records"))
    return hashlib.sha1("\n".join(rows).encode()).hexdigest()


def compare(spark_df, con, sql: str) -> dict:
    t0 = time.time()
    s_pdf = spark_df.toPandas()
    t1 = time.time()
    d_rel = con.sql(sql)
    d_types = dict(zip(d_rel.columns, [str(t) for t in d_rel.types]))
    d_pdf = d_rel.df()
    s_types = {f.name: f.dataType.simpleString() for f in spark_df.schema.fields}
    res = {"spark_sec": round(t1 - t0, 2), "rows": (len(s_pdf), len(d_pdf))}
    res["cols_match"] = sorted(s_pdf.columns) == sorted(d_pdf.columns)
    type_diffs = {c: (s_types.get(c), d_types.get(c)) for c in s_types
                  if SPARK_TO_DUCK.get(s_types.get(c), s_types.get(c)) != d_types.get(c)}
    res["type_diffs"] = type_diffs
    res["rows_match"] = len(s_pdf) == len(d_pdf)
    res["hash_match"] = res["cols_match"] and value_hash(s_pdf) == value_hash(d_pdf)
    if res["cols_match"] and not res["hash_match"]:
        cols = sorted(s_pdf.columns)
        s_rows = {"|".join(_norm(r[c]) for c in cols) for r in s_pdf[cols].to_dict("records")}
        d_rows = {"|".join(_norm(r[c]) for c in cols) for r in d_pdf[cols].to_dict("records")}
        res["only_spark"] = sorted(s_rows - d_rows)[:3]
        res["only_duck"] = sorted(d_rows - s_rows)[:3]
        res["cols"] = cols
    elif not res["cols_match"]:
        res["cols"] = (sorted(s_pdf.columns), sorted(d_pdf.columns))
    return res


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    import __spark_entry__ as e
    from creditspark.session import get_spark
    spark = get_spark()
    qs, os_ = e.queries(), e.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(qs):
        if k not in qs:
            print(k, "NOT REGISTERED")
            bad += 1
            continue
        try:
            df = qs[k](spark, sf_dir)
            if k in os_:
                r = compare(df, con, os_[k])
                ok = r["hash_match"] and not r["type_diffs"]
            else:
                t0 = time.time()
                n = df.count()
                r = {"rows_only": n, "sec": round(time.time() - t0, 2)}
                ok = True
        except Exception as ex:  # noqa: BLE001
            r, ok = {"error": repr(ex)[:600]}, False
        bad += 0 if ok else 1
        print(("OK  " if ok else "FAIL"), k, r, flush=True)
    print(f"{len(keys or qs) - bad}/{len(keys or qs)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
