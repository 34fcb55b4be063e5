"""Load checks: row counts, critical-table assertions, key uniqueness."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Tables whose emptiness fails the run, and the one that only warns.
CRITICAL_TABLES = ("dim_cliente", "dim_localidade", "vendas_ano_mes")
WARN_TABLES = ("vendas_localidade",)
REPORT_ORDER = ("dim_tempo", "dim_produto", "dim_cliente", "dim_vendedor", "dim_localidade",
                "fato_venda", "lake_month", "vendas_ano_mes", "vendas_localidade")


class ValidationError(AssertionError):
    pass


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(tabela, linhas): one row per table, all counted in one plan."""
    parts = [df.agg(F.count(F.lit(1)).cast("bigint").alias("linhas"))
             .select(F.lit(name).alias("tabela"), "linhas") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def counts_frame(spark: SparkSession, counts: dict[str, int | None]) -> DataFrame:
    """(tabela, linhas) from counts gathered while writing; missing -> 0.

    Built as an inline VALUES table, so no Python worker is involved."""
    names = [n for n in REPORT_ORDER if n in counts] + [n for n in counts if n not in REPORT_ORDER]
    if not names:
        return spark.sql("SELECT CAST(NULL AS STRING) AS tabela, CAST(0 AS BIGINT) AS linhas LIMIT 0")
    values = ", ".join(f"('{n.replace(chr(39), '')}', {int(counts.get(n) or 0)})" for n in names)
    return spark.sql(f"SELECT tabela, CAST(linhas AS BIGINT) AS linhas "
                     f"FROM VALUES {values} AS t(tabela, linhas)")


def validation_report(counts: DataFrame) -> DataFrame:
    """Adds status: FAIL for an empty critical table, WARN for an empty
    location mart, OK otherwise."""
    empty = F.coalesce(F.col("linhas"), F.lit(0)) == 0
    status = (F.when(F.col("tabela").isin(*CRITICAL_TABLES) & empty, F.lit("FAIL"))
              .when(F.col("tabela").isin(*WARN_TABLES) & empty, F.lit("WARN"))
              .otherwise(F.lit("OK")))
    return counts.select("tabela", F.coalesce(F.col("linhas"), F.lit(0)).alias("linhas"),
                         status.alias("status"))


def assert_valid(report: DataFrame) -> list[str]:
    """Raise when any critical table is empty; return warnings."""
    rows = report.where(F.col("status") != "OK").collect()  # at most a few rows
    fails = [r["tabela"] for r in rows if r["status"] == "FAIL"]
    if fails:
        raise ValidationError("empty critical table(s): " + ", ".join(fails))
    return [r["tabela"] for r in rows if r["status"] == "WARN"]


def duplicate_keys(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """(tabela, chaves_duplicadas): natural keys held by more than one row."""
    parts = []
    for name, (df, keys) in tables.items():
        dup = df.groupBy(*keys).count().where(F.col("count") > 1)
        parts.append(dup.agg(F.count(F.lit(1)).cast("bigint").alias("chaves_duplicadas"))
                     .select(F.lit(name).alias("tabela"), "chaves_duplicadas"))
    return reduce(DataFrame.unionByName, parts)


def guard_empty_month(rows: DataFrame, ano: int, mes: int) -> DataFrame:
    """(ano, mes, linhas, acao): an empty month is skipped, not written."""
    n = rows.agg(F.count(F.lit(1)).cast("bigint").alias("linhas"))
    return n.select(F.lit(ano).alias("ano"), F.lit(mes).alias("mes"), "linhas",
                    F.when(F.col("linhas") == 0, F.lit("ignorar")).otherwise(F.lit("gravar"))
                    .alias("acao"))
