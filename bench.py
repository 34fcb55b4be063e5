"""Benchmark: the full daily run plus the dashboard reports at one scale.

Runs on local[$BENCH_CPUS] over $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line with per-stage seconds.
"""

from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from martforge.config import FIXTURE_CONFIG
    from martforge.plans import reports as R
    from martforge.plans.pipeline import run_pipeline
    from martforge.session import build_session, shared_dir
    from martforge.sources.fixture import fixture_sources

    spark = build_session(
        f"local[{cpus}]", app="martforge-bench",
        shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", max(8, cpus * 2))),
        spark__driver__memory=os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        spark__eventLog__enabled="false",
    )
    # Under the session's spark.checkpoint.dir (a temp folder only when unset).
    root = shared_dir(spark, f"bench-{uuid.uuid4().hex[:8]}")
    timings: dict[str, float] = {}
    t0 = time.time()
    res = run_pipeline(spark, fixture_sources(spark, sf_dir), FIXTURE_CONFIG, root)
    timings.update({f"run_{k}": v for k, v in res.seconds.items()})
    total_pipeline = time.time() - t0

    vam = res.table(spark, "vendas_ano_mes")
    vloc = res.table(spark, "vendas_localidade")
    reports = {
        "report_kpi_cards": lambda: R.kpi_cards(vam),
        "report_monthly_series": lambda: R.monthly_series(vam),
        "report_top_states": lambda: R.top_states(vloc, k=FIXTURE_CONFIG.top_states),
        "report_top_cities": lambda: R.top_cities(vloc, k=FIXTURE_CONFIG.top_cities),
    }
    for name, build in reports.items():
        t = time.time()
        build().collect()
        timings[name] = round(time.time() - t, 3)
    total = time.time() - t0
    out = {
        "metric": "daily_run_plus_reports_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": timings,
        "run_sec": round(total_pipeline, 3),
        "rows": res.counts,
        "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
