"""Run registered queries against their DuckDB oracles (like the driver's check).

usage: python scripts/check_oracles.py [sf_dir] [name ...]
"""

from __future__ import annotations

import sys
import time
import traceback

import duckdb

sys.path.insert(0, ".")

from strobe.plans.compare import canonical as rows  # noqa: E402
from strobe.plans.registry import ORACLES, QUERIES, load_all  # noqa: E402
from strobe.plans.tables import TABLES  # noqa: E402
from strobe.session import get_session  # noqa: E402


def main() -> int:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    load_all()
    spark = get_session("local[8]")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    bad = 0
    for name in names or list(QUERIES):
        t = time.time()
        try:
            sdf = QUERIES[name](spark, sf)
            pdf = sdf.toPandas()
            took = time.time() - t
            if name not in ORACLES:
                print(f"{name:28s} rows={len(pdf):7d} (no oracle) {took:6.1f}s")
                continue
            odf = con.execute(ORACLES[name]).df()
            sc, sr = rows(pdf)
            oc, orow = rows(odf)
            ok = sc == oc and len(sr) == len(orow) and sr == orow
            status = "OK " if ok else "BAD"
            print(f"{name:28s} {status} spark={len(sr):7d} oracle={len(orow):7d} {took:6.1f}s")
            if not ok:
                bad += 1
                if sc != oc:
                    print("   cols spark", sc, "\n   cols oracle", oc)
                else:
                    diff_s = [r for r in sr if r not in set(orow)][:3]
                    diff_o = [r for r in orow if r not in set(sr)][:3]
                    print("   spark-only", diff_s, "\n   oracle-only", diff_o)
                    print("   dtypes", dict(pdf.dtypes.astype(str)), dict(odf.dtypes.astype(str)))
        except Exception as exc:  # noqa: BLE001
            bad += 1
            print(f"{name:28s} ERR {type(exc).__name__}: {str(exc)[:300]}")
            traceback.print_exc(limit=3)
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
