"""Compare every registered query with its DuckDB oracle.

Usage: python tools/oracle_check.py [SF_DIR] [key ...]

Rows are compared as multisets after sorting columns by name; doubles are
compared after rounding to 9 decimals.  Prints one line per key and exits
non-zero on any mismatch.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import duckdb  # noqa: E402

from verity.plans.catalog import ORACLES, QUERIES  # noqa: E402
from verity.session import local_session  # noqa: E402
from verity.sources.tables import DRIVER_TABLES  # noqa: E402


def norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        return f"{round(v, 9):.9f}"
    if hasattr(v, "item"):
        return norm(v.item())
    return str(v)


def rows(df_pd):
    cols = sorted(df_pd.columns)
    out = []
    for rec in df_pd[cols].itertuples(index=False):
        out.append(tuple(norm(None if (isinstance(x, float) and math.isnan(x)) else x) for x in rec))
    return cols, sorted(out)


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in DRIVER_TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def main() -> int:
    args = sys.argv[1:]
    sf_dir = args[0] if args and "/" in args[0] else "/root/testdata/sf0.01"
    keys = [a for a in args if "/" not in a] or list(QUERIES)
    spark = local_session(8)
    con = duck(sf_dir)
    bad = 0
    for k in keys:
        t = time.time()
        try:
            sdf = QUERIES[k](spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t
        if k not in ORACLES:
            print(f"ROWS {k}: {len(sdf)} rows (no oracle) spark {ts:.2f}s")
            continue
        try:
            ddf = con.execute(ORACLES[k]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {k}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sr = rows(sdf)
        dc, dr = rows(ddf)
        if sc != dc:
            print(f"FAIL {k}: columns spark={sc} duck={dc}")
            bad += 1
            continue
        if sr != dr:
            diff_s = [r for r in sr if r not in set(dr)][:3]
            diff_d = [r for r in dr if r not in set(sr)][:3]
            print(f"FAIL {k}: rows spark={len(sr)} duck={len(dr)}\n  spark-only {str(diff_s)[:600]}\n"
                  f"  duck-only {str(diff_d)[:600]}")
            bad += 1
            continue
        types = {c: (str(sdf[c].dtype), str(ddf[c].dtype)) for c in sc if str(sdf[c].dtype) != str(ddf[c].dtype)}
        print(f"OK   {k}: {len(sr)} rows spark {ts:.2f}s" + (f" dtype-diff {types}" if types else ""))
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
