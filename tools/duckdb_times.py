"""Time the DuckDB twins of the registered queries (single-node reference).

Usage: python tools/duckdb_times.py [sf_dir]  -> one JSON line
"""

from __future__ import annotations

import json
import sys
import time

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from ledgerlens.oracle import ORACLE  # noqa: E402
from tools.oracle_check import duck  # noqa: E402


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    con = duck(sf_dir)
    times = {}
    for name, sql in ORACLE.items():
        t0 = time.perf_counter()
        con.execute(sql).fetchall()
        times[name] = round(time.perf_counter() - t0, 3)
    print(json.dumps({"engine": "duckdb", "value": round(sum(times.values()), 3), "queries": times}))


if __name__ == "__main__":
    main()
