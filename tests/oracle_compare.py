"""Local check: run each registered Spark query and its DuckDB oracle on the
same parquet tables and compare row count, column names and values.

    python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from ledgerspark.session import TABLES, get_spark  # noqa: E402


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    import __spark_entry__ as entry
    spark = get_spark()
    qs, oracles = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        t0 = time.time()
        try:
            df = fn(spark, sf_dir)
            cols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        sql = oracles.get(name)
        if sql is None:
            print(f"ROWS {name}: {len(srows)} rows ({ts:.1f}s, no oracle)")
            continue
        try:
            cur = con.execute(sql)
            ocols = [d[0] for d in cur.description]
            orows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        if sorted(cols) != sorted(ocols):
            print(f"FAIL {name}: columns {sorted(cols)} vs {sorted(ocols)}")
            bad += 1
            continue
        a, b = _rows(srows, cols), _rows(orows, ocols)
        if a != b:
            bad += 1
            diff = [x for x in a if x not in set(b)][:3]
            diff2 = [x for x in b if x not in set(a)][:3]
            print(f"FAIL {name}: {len(a)} vs {len(b)} rows; spark-only {diff}; oracle-only {diff2}")
        else:
            print(f"OK   {name}: {len(a)} rows ({ts:.1f}s)")
    print(f"{bad} failing")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
