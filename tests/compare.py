"""Run registered queries against their SQL in DuckDB: ``python tests/compare.py [sf_dir] [name ...]``."""

from __future__ import annotations

import datetime as dt
import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def views(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in sorted(glob.glob(f"{sf}/*.parquet")):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _norm(v):
    if isinstance(v, float):
        return 0.0 if v == 0 else v
    if isinstance(v, (dt.datetime, dt.date)):
        return str(v)
    return v


def rows(names, data):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted((tuple(_norm(r[k]) for k in order) for r in data), key=repr)


TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP", "date": "DATE", "smallint": "SMALLINT", "float": "FLOAT",
}


def check(spark, con, sf, fn, sql):
    """None when Spark and DuckDB agree, else what differs."""
    df = fn(spark, sf)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    types = {d[0]: str(d[1]) for d in res.description}
    want = rows(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    bad_types = [(c, t, types[c]) for c, t in df.dtypes if TYPES.get(t, t) != types[c]]
    if bad_types:
        return f"types {bad_types}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    if got != want:
        diff = [(g, w) for g, w in zip(got, want) if g != w]
        return f"{len(diff)} rows differ, columns {sorted(names)}: {diff[:2]}"
    return None


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as e

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = sys.argv[2:]
    spark, con = session(), views(sf)
    sqls, bad = e.oracle_sql(), 0
    for name, fn in e.queries().items():
        if only and not any(name.startswith(o) for o in only):
            continue
        start = time.time()
        try:
            if name in sqls:
                why = check(spark, con, sf, fn, sqls[name])
            else:
                n = fn(spark, sf).count()
                why = None if n else "no rows"
        except Exception as x:
            why = f"{type(x).__name__}: {str(x)[:1200]}"
        bad += why is not None
        print(f"{'ok ' if why is None else 'BAD'} {name} {time.time() - start:.1f}s {'' if name in sqls else '(rows only) '}{why or ''}", flush=True)
    print(f"{bad} bad")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
