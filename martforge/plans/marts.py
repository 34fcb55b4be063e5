"""Data marts: sales by year/month and by year/state/city.

Both marts are served from one pre-aggregate of the fact at
(year, month, location key) grain:

* the calendar (bounded by its date range) is broadcast and the optional
  year filter is applied on it, so the fact scan is pruned by the join;
* partial aggregation runs map-side, so the shuffle carries at most one row
  per (month, location) per task instead of the fact rows, and a hot
  location never concentrates fact rows in one task;
* the location dimension meets the pre-aggregate, not the fact.

Facts without a calendar key disappear (inner join), as in the original.
Sums of an all-NULL group are 0, not NULL. Rows of the location mart whose
year/state/city is NULL are dropped before grouping.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.functions.measures import attainment_pct, pct_overflowed
from martforge.operators.keys import dense_key
from martforge.schemas import MONEY, PCT_ATTAINMENT, VENDAS_ANO_MES, VENDAS_LOCALIDADE, conform
from martforge.session import written

LOCATION_KEYS = ["ano", "sigla_estado", "estado", "cidade"]


def run_stamp(cfg: PipelineConfig | None) -> Column:
    if cfg is not None and cfg.run_date is not None:
        return F.lit(cfg.run_date)
    return F.current_date()


def calendar_months(dim_tempo: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    cal = dim_tempo.select("sk_tempo", F.col("ano").cast("int").alias("ano"),
                           F.col("mes").cast("int").alias("mes"))
    if cfg is not None and cfg.aggregation_years:
        cal = cal.where(F.col("ano").isin(list(cfg.aggregation_years)))
    return F.broadcast(cal)


def fact_star_inner(fact: DataFrame, dim_tempo: DataFrame,
                    cfg: PipelineConfig | None = None) -> DataFrame:
    """fact x calendar (inner): the rows every mart and the lake start from."""
    return fact.join(calendar_months(dim_tempo, cfg), "sk_tempo", "inner")


def _sums(qty: str, real: str, exp: str) -> list[Column]:
    return [
        F.coalesce(F.sum(qty), F.lit(0)).cast("bigint").alias("qtde_vendida"),
        F.coalesce(F.sum(real), F.lit(0)).alias("valor_total_real"),
        F.coalesce(F.sum(exp), F.lit(0)).alias("valor_total_esperado"),
    ]


def month_location_sums(fact: DataFrame, dim_tempo: DataFrame,
                        cfg: PipelineConfig | None = None) -> DataFrame:
    """Shared pre-aggregate: (ano, mes, sk_localidade) -> three sums."""
    return (
        fact_star_inner(fact.select("sk_tempo", "sk_localidade", "quantidade",
                                    "valor_unitario", "valor_venda_real"), dim_tempo, cfg)
        .groupBy("ano", "mes", "sk_localidade")
        .agg(F.sum("quantidade").alias("_q"), F.sum("valor_venda_real").alias("_r"),
             F.sum("valor_unitario").alias("_e"))
    )


def vendas_ano_mes(fact: DataFrame, dim_tempo: DataFrame, cfg: PipelineConfig | None = None,
                   pre: DataFrame | None = None) -> DataFrame:
    pre = pre if pre is not None else month_location_sums(fact, dim_tempo, cfg)
    g = pre.groupBy("ano", "mes").agg(*_sums("_q", "_r", "_e"))
    g = g.withColumn("data_atualizacao", run_stamp(cfg))
    # At most 12 rows per year: number the months inside each year.
    keyed = dense_key(g, "id", ["ano", "mes"], buckets=1)
    return conform(keyed, VENDAS_ANO_MES)


def vendas_localidade(fact: DataFrame, dim_tempo: DataFrame, dim_localidade: DataFrame,
                      cfg: PipelineConfig | None = None, pre: DataFrame | None = None,
                      stamp: bool = True) -> DataFrame:
    pre = pre if pre is not None else month_location_sums(fact, dim_tempo, cfg)
    per_year = (
        pre.where(F.col("sk_localidade").isNotNull())
        .groupBy("ano", "sk_localidade")
        .agg(F.sum("_q").alias("_q"), F.sum("_r").alias("_r"), F.sum("_e").alias("_e"))
    )
    loc = dim_localidade.select("sk_localidade", "sigla_estado", "estado", "cidade")
    g = (
        per_year.join(loc, "sk_localidade", "inner")
        .dropna(subset=LOCATION_KEYS)
        .groupBy(*LOCATION_KEYS)
        .agg(*_sums("_q", "_r", "_e"))
    )
    real = F.col("valor_total_real").cast(MONEY)
    exp = F.col("valor_total_esperado").cast(MONEY)
    pct = attainment_pct(real, exp, 1)
    strict = bool(cfg and cfg.strict_pct)
    g = g.withColumn("pct_atingimento", pct.cast(PCT_ATTAINMENT) if strict else pct.try_cast(PCT_ATTAINMENT))
    if stamp:
        g = g.withColumn("data_atualizacao", run_stamp(cfg))
    # Read several times for the keys, and far smaller than what it is summed from.
    keyed = dense_key(written(g, "mart-localidade"), "id", LOCATION_KEYS)
    out = conform(keyed, VENDAS_LOCALIDADE)
    return out if stamp else out.drop("data_atualizacao")


def location_metrics() -> dict:
    """Counted while the location mart is written: attainments that do not fit."""
    lost = pct_overflowed(F.col("pct_atingimento"), F.col("valor_total_real"), F.col("valor_total_esperado"))
    return {"pct_atingimento_fora": F.coalesce(F.sum(F.when(lost, 1).otherwise(0)), F.lit(0))}


def build_marts(fact: DataFrame, dim_tempo: DataFrame, dim_localidade: DataFrame,
                cfg: PipelineConfig | None = None) -> tuple[DataFrame, DataFrame]:
    """Both marts over one shared pre-aggregate plan."""
    pre = month_location_sums(fact, dim_tempo, cfg)
    return (vendas_ano_mes(fact, dim_tempo, cfg, pre=pre),
            vendas_localidade(fact, dim_tempo, dim_localidade, cfg, pre=pre))


def add_column_if_absent(df: DataFrame, name: str, dtype: str,
                         value: Column | None = None) -> DataFrame:
    """Additive schema evolution: add ``name`` when the table lacks it."""
    if name in df.columns:
        return df if value is None else df.withColumn(name, value.cast(dtype))
    return df.withColumn(name, (value if value is not None else F.lit(None)).cast(dtype))
