"""Month export to the hive-partitioned Parquet lake (ano=/mes=).

The month's calendar keys form one contiguous range (the calendar key is the
day offset), so the month filter becomes a range predicate on the fact's
sk_tempo that reaches the Parquet scan (the fact is dealt by month and sorted
when written, so files of other months are skipped by their statistics). Each executor writes its own
files straight into a new folder of the lake, and a commit file
(``operators/versions.py``) makes it the month's, so a rerun of the same day is idempotent
and a reader never meets a half written month. ``VersionedTable.vacuum`` deletes replaced months.
"""

from __future__ import annotations

import calendar as _cal
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.operators.versions import DATA, Part, Version, VersionedTable
from martforge.schemas import LAKE_ROW, conform
from martforge.session import delete_path, folder_entries, path_exists

PARTITION_COLS = ["ano", "mes"]


def month_of(ds: str) -> tuple[int, int]:
    d = datetime.strptime(ds, "%Y-%m-%d")
    return d.year, d.month


def month_sk_range(cfg: PipelineConfig, ano: int, mes: int) -> tuple[int, int]:
    first = date(ano, mes, 1)
    last = date(ano, mes, _cal.monthrange(ano, mes)[1])
    return (first - cfg.calendar_start).days + 1, (last - cfg.calendar_start).days + 1


def lake_month(fact: DataFrame, dim_tempo: DataFrame, dim_localidade: DataFrame,
               cfg: PipelineConfig, ano: int, mes: int) -> DataFrame:
    lo, hi = month_sk_range(cfg, ano, mes)
    cal = F.broadcast(
        dim_tempo.where((F.col("ano") == ano) & (F.col("mes") == mes))
        .select("sk_tempo", "data", F.col("ano").cast("int").alias("ano"),
                F.col("mes").cast("int").alias("mes")))
    loc = dim_localidade.select(F.col("sk_localidade").alias("_sl"), "sigla_estado", "cidade")
    rows = (
        fact.where(F.col("sk_tempo").between(lo, hi))
        .select("sk_tempo", "sk_localidade", "quantidade", "valor_unitario", "valor_venda_real")
        .join(cal, "sk_tempo", "inner")
        .join(loc, F.col("_sl") == F.col("sk_localidade"), "left")
    )
    return conform(rows, LAKE_ROW)


def _months(spark: SparkSession, base: str, folders: list[str]) -> dict[str, int]:
    """Rows of the months below ``base``, from the footers of their files (no column is read)."""
    found = (spark.read.schema(LAKE_ROW).option("basePath", base).parquet(*folders)
             .groupBy(*PARTITION_COLS).count().collect())
    return {month_key(r["ano"], r["mes"]): r["count"] for r in found}


def month_key(ano: int, mes: int) -> str:
    return f"ano={ano}/mes={mes}"


def _plain_months(spark: SparkSession, root: str) -> list[Part]:
    """The months of a lake that has no commits yet: folders ano=/mes= right below its root."""
    folders = [f"{y.name}/{m.name}" for y in folder_entries(spark, root) if y.folder and y.name.startswith("ano=")
               for m in folder_entries(spark, f"{root}/{y.name}") if m.folder and m.name.startswith("mes=")]
    if not folders:
        return []
    return [Part(k, n, k) for k, n in sorted(_months(spark, root, [f"{root}/{f}" for f in folders]).items())]


def write_lake(rows: DataFrame, root: str, *, compression: str = "snappy") -> int:
    """Write the months of ``rows`` (one, in a daily run) aside as ``data/<id>/ano=/mes=`` and make
    them current by one commit file, in place of these months alone. A reader finds the old month
    or the new one, never a part of it or none; a writer that dies before its commit changes
    nothing. Returns the rows written; without rows nothing changes. Months that an earlier
    release wrote as plain ``ano=/mes=`` folders are taken into the first commit as they are.

    The month is a filtered slice of the fact scan; the REBALANCE hint lets AQE
    merge the slices into files of the advisory size instead of one small file
    per fact split."""
    spark, table = rows.sparkSession, VersionedTable(rows.sparkSession, root)
    folder = f"{DATA}/{uuid.uuid4().hex}"
    base = f"{table.path}/{folder}"
    (rows.hint("rebalance").write.mode("errorifexists").partitionBy(*PARTITION_COLS)
     .option("compression", compression).parquet(base))
    new = [Part(f"{folder}/{k}", n, k) for k, n in sorted(_months(spark, base, [base]).items())]
    if not new:
        delete_path(spark, base)
        return 0
    replaced = {p.key for p in new}

    def parts(now: Version | None) -> list[Part]:
        old = now.parts if now else _plain_months(spark, table.path)
        return [*(p for p in old if p.key not in replaced), *new]

    table.change(LAKE_ROW, parts)
    return sum(p.rows for p in new)


@dataclass(frozen=True)
class LakeWrite:
    """Where a month went, its rows, and why the primary lake was not used."""

    location: str
    rows: int
    reason: str | None = None


def write_lake_with_fallback(rows: DataFrame, primary: str, fallback: str) -> LakeWrite:
    """Write to ``primary``; if that fails, write to ``fallback`` and keep the reason.
    What is wrong with the rows themselves fails there too and is raised."""
    try:
        return LakeWrite(primary, write_lake(rows, primary))
    except Exception as e:  # noqa: BLE001 - any storage failure falls back
        reason = f"{type(e).__name__}: {str(e).strip().splitlines()[0][:300] if str(e).strip() else ''}"
        return LakeWrite(fallback, write_lake(rows, fallback), reason)


def read_lake_month(spark: SparkSession, root: str, ano: int, mes: int) -> DataFrame:
    """One month of the lake's current version with the lake's fixed schema, from the
    month's own folder alone; a lake without that month, or none at all, has no rows."""
    root, key = root.rstrip("/"), month_key(ano, mes)
    version = VersionedTable(spark, root).current()
    folder = next((p.folder for p in version.parts if p.key == key), None) if version else key
    if folder is None or not path_exists(spark, f"{root}/{folder}"):
        return spark.createDataFrame([], LAKE_ROW)
    base = f"{root}/{folder.removesuffix(key)}".rstrip("/")
    return spark.read.schema(LAKE_ROW).option("basePath", base).parquet(f"{root}/{folder}")


def lake_months(spark: SparkSession, root: str) -> dict[tuple[int, int], int]:
    """(year, month) -> rows of the months in the lake's current version, from its commit file."""
    version = VersionedTable(spark, root).current()
    parts = version.parts if version else _plain_months(spark, root.rstrip("/"))
    named = (([int(x.split("=")[1]) for x in p.key.split("/")], p.rows) for p in parts)
    return {(y, m): n for (y, m), n in sorted(named)}
