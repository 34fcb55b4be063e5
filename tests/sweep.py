"""Run every registered query against its oracle, like the driver's check.

    python -m tests.sweep [--sf /root/testdata/sf0.01] [name ...]

Exact comparison (doubles bit-identical, decimals by value) plus column types; the rows
of queries without SQL are only counted.
"""

from __future__ import annotations

import argparse
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args()

    from pyspark.sql import SparkSession

    import __spark_entry__ as E
    from tests.oracle_compare import compare, duck, type_diff

    spark = (SparkSession.builder.master("local[8]")
             .config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    queries, sql, con = E.queries(), E.oracle_sql(), duck(a.sf)
    bad = []
    for name, fn in queries.items():
        if a.names and name not in a.names:
            continue
        t = time.time()
        try:
            df = fn(spark, a.sf)
            if name not in sql:
                ok, detail = True, ""
                print(f"{name}: {df.count()} rows, no SQL")
            else:
                types = type_diff(df, sql[name], con)
                r = compare(df, sql[name], a.sf, con)
                ok = r["match"] and not types
                detail = "" if ok else json.dumps({"types": types, **r}, default=str)[:1500]
        except Exception as e:  # noqa: BLE001 - report and continue
            ok, detail = False, str(e)[:800]
        if not ok:
            bad.append(name)
        print(f"{name:24s} {time.time() - t:6.1f}s {'OK' if ok else detail}", flush=True)
    print("BAD", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
