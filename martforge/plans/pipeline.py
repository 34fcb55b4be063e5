"""End-to-end daily run: dimensions -> fact -> lake month -> marts -> checks.

Layout of one run (all under ``root``, a shared-storage URI)::

    root/runs/<run_id>/staging/<relation>   source snapshot (optional)
    root/runs/<run_id>/warehouse/<table>    dims + fact + the fact's lines with a fault (rejeitos)
    root/runs/<run_id>/mart/<table>         the two marts
    root/keys/<dim>/                        surrogate keys given so far (shared by runs)
    root/lake/data/<id>/ano=YYYY/mes=M/     month partitions (shared by runs), named by lake/_commits
    root/_PUBLISHED/<run_id>/               one entry per published run

A run's fact goes with its own dimensions, so a run is published as a whole:
after every table and the checks succeeded, the lake month is exported and an
entry of its own is added. Readers take the newest complete entry and keep
seeing the previous run until then; a failed publish leaves earlier entries
alone (the original job truncated tables in place, so readers could see them
empty). ``plans/incremental.py`` updates tables in place of rebuilding them.

Every table is materialised once and read back before the next stage, as
the original job does through its warehouse. Reading back gives the
planner real file sizes: small dimensions get broadcast when the fact is
joined to them, large ones a shuffle join. Row counts come from
``DataFrame.observe`` while writing, without a second pass.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from martforge.config import PipelineConfig
from martforge.operators import quality as Q
from martforge.operators.sinks import jdbc_write, write_folder
from martforge.operators.versions import VersionedTable
from martforge.plans import dims as D
from martforge.plans import fact as FT
from martforge.plans import lake as L
from martforge.plans import marts as M
from martforge.schemas import TABLES
from martforge.session import completed_writes, released
from martforge.sources.calendar import resolve_calendar
from martforge.sources.tables import SourceTables

PUBLISHED = "_PUBLISHED"


@dataclass
class RunResult:
    run_id: str
    run_root: str
    lake_root: str
    lake_location: str | None
    cfg: PipelineConfig
    counts: dict[str, int] = field(default_factory=dict)
    seconds: dict[str, float] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)
    # Null keys, lines outside the calendar, percentages that did not fit.
    metrics: dict[str, int] = field(default_factory=dict)
    sources: SourceTables | None = None

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        sub = "mart" if name.startswith("vendas_") else "warehouse"
        return spark.read.parquet(f"{self.run_root}/{sub}/{name}")


# Relations read more than once (calendar bounds, dimensions, fact, first addresses).
# Everything else is read exactly once, so snapshotting it would only add a
# full extra write (the item table is the largest input of all).
SHARED_SOURCES = ("nota_fiscal", "produto", "endereco")


def parallel(tasks: dict, max_workers: int = 8) -> dict:
    """Run independent Spark actions concurrently (one job per thread).

    Spark schedules jobs from several threads side by side; small jobs that
    would each leave most cores idle then fill the cluster together."""
    from concurrent.futures import ThreadPoolExecutor

    if not tasks:
        return {}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {k: pool.submit(fn) for k, fn in tasks.items()}
        return {k: f.result() for k, f in futures.items()}


def stage_sources(src: SourceTables, path: str, names=SHARED_SOURCES) -> SourceTables:
    """Snapshot the shared source relations once (the extract step)."""
    spark = src.nota_fiscal.sparkSession

    def snap(name: str):
        def run():
            getattr(src, name).write.mode("overwrite").parquet(f"{path}/{name}")
            return spark.read.parquet(f"{path}/{name}")
        return run

    with released(spark):
        staged = parallel({n: snap(n) for n in names})
    return SourceTables(**{n: staged.get(n, getattr(src, n)) for n in src.names()})


def _materialise(df: DataFrame, path: str, name: str, counts: dict[str, int],
                 sort_by: list[str] | None = None, metrics: dict | None = None,
                 seen: dict | None = None) -> DataFrame:
    counts[name] = write_folder(df, path, TABLES[name], sort_by=sort_by, metrics=metrics, seen=seen)
    return df.sparkSession.read.parquet(path)


def run_pipeline(spark: SparkSession, src: SourceTables, cfg: PipelineConfig, root: str, *,
                 run_id: str | None = None, stage: bool = True,
                 lake_fallback: str | None = None, publish: bool = True,
                 stable_keys: bool = True) -> RunResult:
    """``stable_keys``: entities keep the surrogate keys of earlier runs under ``root``, new ones
    get the next; without, the keys of each run are numbered anew from 1."""
    run_id = run_id or time.strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:6]
    run_root = f"{root.rstrip('/')}/runs/{run_id}"
    lake_root = f"{root.rstrip('/')}/lake"
    counts: dict[str, int] = {}
    secs: dict[str, float] = {}
    metrics: dict[str, int] = {}

    def tick(label: str, t0: float) -> float:
        t1 = time.time()
        secs[label] = round(t1 - t0, 3)
        return t1

    t = time.time()
    if stage:
        src = stage_sources(src, f"{run_root}/staging")
        t = tick("extract", t)
    cfg = resolve_calendar(src, cfg)

    wh = f"{run_root}/warehouse"

    def keyed(name: str):
        return lambda: D.write_keyed_dimension(
            name, src, cfg, lambda df: _materialise(df, f"{wh}/{name}", name, counts),
            key_map(name) if stable_keys else None)

    def key_map(name: str) -> VersionedTable:
        return VersionedTable(spark, f"{root.rstrip('/')}/keys/{name}")

    tasks = {"dim_tempo": lambda: _materialise(D.dim_tempo(spark, cfg), f"{wh}/dim_tempo",
                                               "dim_tempo", counts)}
    tasks.update({name: keyed(name) for name in D.KEYED_DIMENSIONS})
    tasks["slots"] = lambda: FT.day_slots(src.nota_fiscal, cfg)
    dims = parallel(tasks)
    slots, n_slots = dims.pop("slots")
    t = tick("dimensions", t)

    def keep(name: str, df: DataFrame) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{run_root}/staging/lookup_{name}")
        return spark.read.parquet(f"{run_root}/staging/lookup_{name}")

    found = parallel({
        "person": lambda: keep("person", FT.person_lookup(dims["dim_cliente"], dims["dim_localidade"])),
        "product": lambda: keep("product", FT.product_lookup(src.produto, dims["dim_produto"])),
    })
    # Dealt by day and sorted by calendar key (then product): the month filter
    # of the lake export skips the files of other months by their statistics.
    fact = _materialise(FT.fato_venda(src, dims, cfg, found, lambda df: FT.by_day(df, slots, n_slots)), f"{wh}/fato_venda", "fato_venda",
                        counts, sort_by=["sk_tempo", "sk_produto"], metrics=FT.fact_metrics(), seen=metrics)
    if counts["fato_venda"] == 0:
        # Nothing to aggregate: stop before the marts; the previous
        # publication stays current.
        raise Q.ValidationError("fato_venda is empty: the sources have no invoice items")
    t = tick("fact", t)

    def duplicated_keys() -> list[str]:
        # A natural key held by two dimension rows fans fact rows out; the dims
        # are small, so checking them is cheaper than re-counting the source join.
        dup = Q.duplicate_keys({n: (dims[n], [D.KEYED_DIMENSIONS[n][2][-1]])
                                for n in D.KEYED_DIMENSIONS})
        return [f"{r['tabela']}: {r['chaves_duplicadas']} duplicated natural keys"
                for r in dup.where("chaves_duplicadas > 0").collect()]

    def rejects() -> int:
        # The counts of the fact's write tell whether it has to be read for them.
        faulty = FT.rejected_lines(fact) if any(metrics[k] for k in FT.fact_metrics()) else spark.createDataFrame([], TABLES["rejeitos"])
        return write_folder(faulty, f"{wh}/rejeitos", TABLES["rejeitos"])

    mart = f"{run_root}/mart"
    # One pre-aggregate of the fact feeds both marts; it is small (months x
    # locations) and kept for the two writes so the fact is scanned once.
    pre = M.month_location_sums(fact, dims["dim_tempo"], cfg).persist()
    try:
        done = parallel({
            "key_check": duplicated_keys,
            "rejects": rejects,
            **({f"keys_{n}": lambda n=n: D.record_keys(n, dims[n], key_map(n)) for n in D.KEYED_DIMENSIONS}
               if stable_keys else {}),
            "vendas_ano_mes": lambda: _materialise(
                M.vendas_ano_mes(fact, dims["dim_tempo"], cfg, pre=pre),
                f"{mart}/vendas_ano_mes", "vendas_ano_mes", counts),
            "vendas_localidade": lambda: _materialise(
                M.vendas_localidade(fact, dims["dim_tempo"], dims["dim_localidade"], cfg, pre=pre),
                f"{mart}/vendas_localidade", "vendas_localidade", counts,
                metrics=M.location_metrics(), seen=metrics),
        })
    finally:
        pre.unpersist()
    metrics["rejeitos"] = done["rejects"]
    t = tick("marts", t)

    warnings = Q.assert_valid(Q.validation_report(Q.counts_frame(spark, counts)))
    warnings += done["key_check"]
    warnings += [f"{k}: {n}" for k, n in sorted(metrics.items()) if n and k.endswith("_fora")]

    # The shared lake changes only after the checks. A month without sales changes nothing.
    location = None
    if cfg.ds:
        ano, mes = L.month_of(cfg.ds)
        rows = L.lake_month(fact, dims["dim_tempo"], dims["dim_localidade"], cfg, ano, mes)
        wrote = (L.write_lake_with_fallback(rows, lake_root, lake_fallback) if lake_fallback
                 else L.LakeWrite(lake_root, L.write_lake(rows, lake_root)))
        counts["lake_month"] = wrote.rows
        location = wrote.location if wrote.rows else None
        if wrote.reason:
            warnings.append(f"lake fallback used: {wrote.reason}")
    t = tick("lake", t)
    if publish:
        # Tiny one-line text file written by a JVM-only plan (no Python worker).
        safe = run_id.replace("'", "")
        spark.sql(f"SELECT '{safe}' AS run_id").coalesce(1).write.mode("errorifexists").text(
            f"{root.rstrip('/')}/{PUBLISHED}/{run_id}")
    tick("publish", t)
    return RunResult(run_id, run_root, lake_root, location, cfg, counts, secs, warnings, metrics, src)


def deliver_marts(spark: SparkSession, res: RunResult, url: str, *, properties: dict | None = None,
                  mode: str = "overwrite", num_partitions: int | None = None) -> dict[str, str]:
    """Write the marts of a run to the relational database that the dashboard reads.

    ``overwrite`` refreshes each table and keeps its definition, ``append`` adds rows;
    a table that is absent is created from the mart's schema."""
    done = {}
    for name in ("vendas_ano_mes", "vendas_localidade"):
        jdbc_write(res.table(spark, name), url, name, mode=mode, properties=properties,
                   num_partitions=num_partitions)
        done[name] = mode
    return done


def current_run(spark: SparkSession, root: str) -> str | None:
    """Id of the run published last (None before the first): the newest entry whose
    write completed."""
    done = completed_writes(spark, f"{root.rstrip('/')}/{PUBLISHED}")
    return max(done, key=lambda e: (e[1], e[0]))[0] if done else None


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    run_id = current_run(spark, root)
    if run_id is None:
        raise FileNotFoundError(f"no published run under {root}")
    sub = "mart" if name.startswith("vendas_") else "warehouse"
    return spark.read.parquet(f"{root.rstrip('/')}/runs/{run_id}/{sub}/{name}")
