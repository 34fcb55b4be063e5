"""Command line: ``spark-submit -m martforge run|report ...`` (or ``python -m``).

    python -m martforge run --sf-dir /root/testdata/sf0.1 --root /shared/sales --ds 1998-06-15
    python -m martforge run --jdbc-url jdbc:postgresql://host/db --root s3a://b/sales --ds 2024-05-01
    python -m martforge run --update --sf-dir /root/testdata/sf0.1 --root /shared/sales-live
    python -m martforge report --root /shared/sales [--ano 2001]
"""

from __future__ import annotations

import argparse
import json
from datetime import date


def _years(s: str | None):
    return tuple(int(x) for x in s.split(",") if x.strip()) if s else None


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="martforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="build dims, fact, lake month and marts; publish")
    r.add_argument("--root", required=True, help="shared-storage URI for warehouse/lake/marts")
    src = r.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of driver parquet tables (fixture sources)")
    src.add_argument("--jdbc-url", help="JDBC URL of the transactional database")
    r.add_argument("--jdbc-user")
    r.add_argument("--jdbc-password")
    r.add_argument("--ds", help="logical run date YYYY-MM-DD (selects the lake month)")
    r.add_argument("--run-date", help="load stamp YYYY-MM-DD (default: today)")
    r.add_argument("--calendar", help="START,END dates of dim_tempo (default 2015-01-01,2026-12-31;"
                                      " 'auto' spans the invoice years)")
    r.add_argument("--years", help="aggregation years, comma separated (default: all)")
    r.add_argument("--lake-fallback", help="second lake URI used when the first write fails")
    r.add_argument("--strict-pct", action="store_true", help="fail on percentages that do not fit their column")
    r.add_argument("--num-partitions", type=int, help="concurrent connections of JDBC reads and writes")
    r.add_argument("--input-gb", type=float, help="size of a JDBC source, for the partition counts")
    r.add_argument("--mart-jdbc-url", help="also write the marts to this database")
    r.add_argument("--mart-mode", choices=("overwrite", "append"), default="overwrite")
    r.add_argument("--update", action="store_true", help="compute only what changed since the last update of --root "
                                                         "(tables and marts; no lake month, no run folder)")
    q = sub.add_parser("report", help="print the dashboard data of the published run")
    q.add_argument("--root", required=True)
    q.add_argument("--ano", type=int)
    a = p.parse_args(argv)

    from martforge.session import build_session, input_state, sizing

    spark = build_session()
    if a.cmd == "run":
        from martforge.config import FIXTURE_CONFIG, PipelineConfig
        from martforge.plans.pipeline import deliver_marts, run_pipeline
        from martforge.sources import fixture_sources, jdbc_sources

        cfg = FIXTURE_CONFIG if a.sf_dir else PipelineConfig()
        if a.calendar == "auto":
            cfg = cfg.with_(calendar_start=None, calendar_end=None)
        elif a.calendar:
            lo, hi = a.calendar.split(",")
            cfg = cfg.with_(calendar_start=date.fromisoformat(lo), calendar_end=date.fromisoformat(hi))
        cfg = cfg.with_(ds=a.ds or cfg.ds, strict_pct=a.strict_pct, aggregation_years=_years(a.years),
                        run_date=date.fromisoformat(a.run_date) if a.run_date else
                        (cfg.run_date if a.sf_dir else None))
        size = sum(n for _, n, _ in input_state(spark, a.sf_dir)) if a.sf_dir else int((a.input_gb or 0) * 1e9)
        if size:
            for k, v in sizing(size, spark.sparkContext.defaultParallelism).items():
                spark.conf.set(k, v)
        props = {k: v for k, v in (("user", a.jdbc_user), ("password", a.jdbc_password)) if v}
        if a.sf_dir:
            sources = fixture_sources(spark, a.sf_dir)
        else:
            sources = jdbc_sources(spark, a.jdbc_url, props, num_partitions=a.num_partitions)
        if a.update:
            from martforge.plans.incremental import update

            done = update(spark, sources, cfg, a.root)
            print(json.dumps({"update": done.state.number, "days": len(done.days), "ranges": sorted(done.ranges),
                              "counts": done.counts}))
            spark.stop()
            return 0
        res = run_pipeline(spark, sources, cfg, a.root, lake_fallback=a.lake_fallback)
        delivered = (deliver_marts(spark, res, a.mart_jdbc_url, properties=props, mode=a.mart_mode,
                                   num_partitions=a.num_partitions) if a.mart_jdbc_url else {})
        print(json.dumps({"run_id": res.run_id, "counts": res.counts, "seconds": res.seconds,
                          "metrics": res.metrics, "delivered": delivered,
                          "warnings": res.warnings, "lake": res.lake_location}))
    else:
        from martforge.plans.incremental import Store
        from martforge.plans.pipeline import read_published
        from martforge.plans.reports import dashboard

        store = Store(spark, a.root)
        read = store.read if store.state() else lambda name: read_published(spark, a.root, name)
        parts = dashboard(read("vendas_ano_mes"), read("vendas_localidade"), a.ano)
        for name, df in parts.items():
            print(f"== {name}")
            df.show(df.count(), truncate=False)  # one row per month or listed place
    spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
