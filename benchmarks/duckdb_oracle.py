"""

Usage: python benchmarks/duckdb_oracle.py [sf_dir] [repeats]
"""

from __future__ import annotations

import os
import statistics
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from kiln.plans.registered import ORACLE_SQL  # noqa: E402

TABLES = ("customer", "orders", "events")


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    repeats = int(sys.argv[2]) if len(sys.argv) > 2 else 5
    con = duckdb.connect(config={"threads": 1})
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    for name, sql in ORACLE_SQL.items():
        times = []
        for _ in range(repeats + 1):
            t0 = time.perf_counter()
            con.execute(sql).to_arrow_table()
            times.append(time.perf_counter() - t0)
        print(f"{name} {statistics.median(times[1:]):.3f}")


if __name__ == "__main__":
    main()
