"""Compare every registered query with its DuckDB oracle (row count, column
names, order-insensitive values).  Also runnable as a script:

    python tests/oracle.py /root/testdata/sf0.01 [key ...]
"""

from __future__ import annotations

import math
import os
import sys

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


STRICT = os.environ.get("ORACLE_STRICT") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if STRICT else float(f"{v:.10g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=repr)


#: Spark type -> DuckDB type of the same values.
_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE", "float": "FLOAT",
}


def compare(spark, con, sf_dir: str, key: str, query, sql: str) -> tuple[bool, str]:
    df = query(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(sql)
    d_cols = list(rel.columns)
    d_rows = rel.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"columns differ: spark={sorted(s_cols)} duckdb={sorted(d_cols)}"
    s_types = {f.name: _TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema.fields}
    d_types = {c: str(t) for c, t in zip(d_cols, rel.types)}
    if s_types != d_types:
        return False, f"types differ: spark={s_types} duckdb={d_types}"
    if len(s_rows) != len(d_rows):
        return False, f"row count spark={len(s_rows)} duckdb={len(d_rows)}"
    a, b = _rows(s_cols, s_rows), _rows(d_cols, d_rows)
    if a != b:
        for x, y in zip(a, b):
            if x != y:
                return False, f"first differing row:\n  spark ={str(x)[:400]}\n  duckdb={str(y)[:400]}"
    return True, f"{len(s_rows)} rows"


def main(argv):
    import __spark_entry__ as E
    from vigil.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:] or list(E.queries())
    if os.environ.get("ORACLE_PLAIN_SESSION") == "1":
        # a session with Spark's defaults only (200 shuffle partitions, ANSI, local time zone)
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false").getOrCreate()
        spark.sparkContext.setLogLevel("ERROR")
    else:
        spark = local_session()
    con = duck(sf_dir)
    qs, sqls = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys:
        if k not in sqls:
            print(f"{k:28s} (no oracle)")
            continue
        try:
            ok, msg = compare(spark, con, sf_dir, k, qs[k], sqls[k])
        except Exception as e:  # report and go on
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        bad += not ok
        print(f"{k:28s} {'OK ' if ok else 'BAD'} {msg}")
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
