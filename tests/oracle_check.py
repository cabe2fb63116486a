"""Run registered queries in Spark and their SQL oracles in DuckDB and compare.

Usage: python tests/oracle_check.py [sf_dir] [query ...]
Prints one line per query: status, row counts, and the first difference.
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from retainspark.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if hasattr(v, "item"):
        return v.item()
    return v


def _key(row):
    return tuple((0, "") if v is None else (1, str(v)) for v in row)


_SPARK_TO_ARROW = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "double",
                   "StringType": "string", "BooleanType": "bool", "DateType": "date32",
                   "TimestampNTZType": "timestamp", "TimestampType": "timestamp", "FloatType": "float",
                   "ShortType": "int16", "ByteType": "int8"}


def type_mismatches(spark_schema, arrow_schema) -> dict:
    """Column → (spark type, duckdb type) where the result types differ."""
    def arrow_name(t):
        s = str(t)
        return "timestamp" if s.startswith("timestamp") else ("string" if s == "large_string" else s)
    sp = {f.name: _SPARK_TO_ARROW.get(type(f.dataType).__name__, str(f.dataType)) for f in spark_schema.fields}
    dk = {f.name: arrow_name(f.type) for f in arrow_schema}
    return {k: (sp.get(k), dk.get(k)) for k in set(sp) | set(dk) if sp.get(k) != dk.get(k)}


def compare(spark_rows, spark_cols, duck_rows, duck_cols):
    if sorted(spark_cols) != sorted(duck_cols):
        return f"columns differ: spark={spark_cols} duck={duck_cols}"
    order = sorted(spark_cols)
    si = [spark_cols.index(c) for c in order]
    di = [duck_cols.index(c) for c in order]
    a = sorted([tuple(_norm(r[i]) for i in si) for r in spark_rows], key=_key)
    b = sorted([tuple(_norm(r[i]) for i in di) for r in duck_rows], key=_key)
    if len(a) != len(b):
        return f"rowcount spark={len(a)} duck={len(b)}"
    for x, y in zip(a, b):
        if x != y:
            diffs = [(order[k], x[k], y[k]) for k in range(len(order)) if x[k] != y[k]]
            return f"value differs: {diffs[:4]}"
    return None


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    import __spark_entry__ as E
    from retainspark.session import build_session
    spark = build_session(cpus=8, shuffle_partitions=8)
    qs, orc = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            rows = [tuple(r) for r in df.collect()]
            cols = df.columns
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in orc:
            print(f"ROWS {name}: {len(rows)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(orc[name])
            dcols = [d[0] for d in res.description]
            drows = res.fetchall()
            types = type_mismatches(df.schema, con.sql(orc[name]).to_arrow_table().schema)
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        msg = compare(rows, cols, drows, dcols) or (f"types differ: {types}" if types else None)
        if msg:
            bad += 1
            print(f"FAIL {name}: {msg}")
        else:
            print(f"OK   {name}: {len(rows)} rows {ts:.1f}s")
    spark.stop()
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
