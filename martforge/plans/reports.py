"""Read-side reports over the two marts (KPI cards, monthly series, rankings).

Every report takes an optional year; ``None`` selects the latest year in
the mart (the dashboard's default), resolved inside the plan with a scalar
subquery rather than a driver round trip. Rankings re-aggregate the mart
(sum of sums) and recompute attainment from the sums, never averaging the
stored percentages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martforge.functions.format import (attainment_band, deviation_sign, direction_label,
                                        fmt_int_dot, fmt_money, fmt_pct, month_label,
                                        rank_intensity, rank_label, target_label)
from martforge.functions.measures import attainment_pct, avg_ticket, guarded_pct


def years_available(mart: DataFrame) -> DataFrame:
    return mart.select("ano").where(F.col("ano").isNotNull()).distinct()


def default_year(mart: DataFrame) -> DataFrame:
    """Latest year (no row for an empty mart)."""
    return years_available(mart).orderBy(F.col("ano").desc()).limit(1)


def year_filter(mart: DataFrame, ano: int | None, source: DataFrame | None = None) -> DataFrame:
    if ano is not None:
        return mart.where(F.col("ano") == F.lit(ano))
    latest = (source if source is not None else mart).select(F.max("ano"))
    return mart.where(F.col("ano") == latest.scalar())


def monthly_series(vam: DataFrame, ano: int | None = None, all_years: bool = False) -> DataFrame:
    """Monthly mart with deviation, attainment, month label and status classes."""
    df = vam if all_years else year_filter(vam, ano)
    real, exp = F.col("valor_total_real"), F.col("valor_total_esperado")
    pct = attainment_pct(real, exp, 1)
    return df.select(
        "id", "ano", "mes", "qtde_vendida", "valor_total_real", "valor_total_esperado",
        (real - exp).cast("decimal(18,2)").alias("desvio"),
        pct.alias("pct_ating"),
        month_label(F.col("mes")).alias("nome_mes"),
        attainment_band(pct).alias("status_ating"),
        deviation_sign(real - exp).alias("status_desvio"),
    ).orderBy("ano", "mes")


def kpi_cards(vam: DataFrame, ano: int | None = None) -> DataFrame:
    """The five KPI cards of a year as one row (no row if the year is absent)."""
    df = year_filter(vam, ano)
    best_key = F.struct(F.col("valor_total_real"), -F.col("mes"))
    g = df.groupBy("ano").agg(
        F.coalesce(F.sum("valor_total_real"), F.lit(0)).cast("decimal(18,2)").alias("receita_real"),
        F.coalesce(F.sum("valor_total_esperado"), F.lit(0)).cast("decimal(18,2)").alias("meta_esperada"),
        F.coalesce(F.sum("qtde_vendida"), F.lit(0)).cast("bigint").alias("qtde_total"),
        F.max_by(F.col("mes"), best_key).alias("melhor_mes_num"),
        F.max_by(F.col("valor_total_real"), best_key).alias("melhor_valor"),
    )
    real, exp, qty = F.col("receita_real"), F.col("meta_esperada"), F.col("qtde_total")
    dev = (real - exp).cast("decimal(18,2)")
    pct = guarded_pct(real, exp)
    ticket = avg_ticket(real, qty)
    return g.select(
        "ano", "receita_real", "meta_esperada", "qtde_total",
        dev.alias("desvio_total"),
        pct.alias("pct_geral"),
        ticket.alias("ticket_medio"),
        month_label(F.col("melhor_mes_num")).alias("melhor_mes"),
        "melhor_valor",
        fmt_money(real).alias("receita_fmt"),
        direction_label(dev).alias("desvio_fmt"),
        deviation_sign(dev).alias("desvio_cor"),
        fmt_money(exp).alias("meta_fmt"),
        fmt_int_dot(qty).alias("qtde_fmt"),
        F.concat(F.lit("ticket médio "), fmt_money(ticket)).alias("ticket_fmt"),
        fmt_pct(pct, 1).alias("pct_fmt"),
        target_label(pct).alias("meta_label"),
        fmt_money(F.col("melhor_valor")).alias("melhor_fmt"),
    )


def best_month(vam: DataFrame, ano: int | None = None) -> DataFrame:
    """Month with the highest realised value (earliest on ties), per year."""
    df = vam if ano is None else year_filter(vam, ano)
    key = F.struct(F.col("valor_total_real"), -F.col("mes"))
    return df.groupBy("ano").agg(
        F.max_by("mes", key).alias("mes"),
        month_label(F.max_by("mes", key)).alias("nome_mes"),
        F.max_by("valor_total_real", key).alias("valor_total_real"),
    )


def _group_totals(loc: DataFrame, key: str) -> DataFrame:
    return (
        loc.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.coalesce(F.sum("valor_total_real"), F.lit(0)).cast("decimal(18,2)")
             .alias("valor_total_real"),
             F.coalesce(F.sum("valor_total_esperado"), F.lit(0)).cast("decimal(18,2)")
             .alias("valor_total_esperado"))
    )


def _top(df: DataFrame, key: str, k: int) -> DataFrame:
    # Largest first, NULLs last, key ascending on ties: a TakeOrderedAndProject
    # over at most one row per key.
    return df.orderBy(F.col("valor_total_real").desc_nulls_last(), F.col(key).asc()).limit(k)


def top_states(vloc: DataFrame, ano: int | None = None, k: int = 10) -> DataFrame:
    """Top-k states by realised value with attainment, bar intensity and label."""
    top = _top(_group_totals(year_filter(vloc, ano), "sigla_estado"), "sigla_estado", k)
    pct = attainment_pct(F.col("valor_total_real"), F.col("valor_total_esperado"), 1)
    asc = Window.orderBy(F.col("valor_total_real").asc_nulls_first(), F.col("sigla_estado").desc())
    everyone = Window.partitionBy(F.lit(1))
    i = (F.row_number().over(asc) - 1)
    n = F.count(F.lit(1)).over(everyone)
    return top.select(
        "sigla_estado", "valor_total_real", "valor_total_esperado", pct.alias("pct"),
        i.alias("posicao"), rank_intensity(i, n).alias("intensidade"),
        rank_label(F.col("valor_total_real"), pct).alias("rotulo"),
    ).orderBy("valor_total_real")


def top_cities(vloc: DataFrame, ano: int | None = None, k: int = 20) -> DataFrame:
    """Top-k cities (by name only: homonyms of different states merge) and the
    mean expected value over the listed cities (the dashed reference line)."""
    top = _top(_group_totals(year_filter(vloc, ano), "cidade"), "cidade", k)
    everyone = Window.partitionBy(F.lit(1))
    return top.select(
        "cidade", "valor_total_real", "valor_total_esperado",
        # exact decimal sum, then one division (no order-dependent float sum)
        (F.sum("valor_total_esperado").over(everyone).cast("double")
         / F.count(F.lit(1)).over(everyone)).alias("media_meta"),
    ).orderBy(F.col("valor_total_real").desc())


def state_rank_intensity(vloc: DataFrame, ano: int | None = None, k: int = 10) -> DataFrame:
    return top_states(vloc, ano, k).select("sigla_estado", "posicao", "intensidade")


def dashboard(vam: DataFrame, vloc: DataFrame, ano: int | None = None,
              top_states_k: int = 10, top_cities_k: int = 20) -> dict[str, DataFrame]:
    """Everything the dashboard shows for one year (default: the latest)."""
    return {
        "kpi_cards": kpi_cards(vam, ano),
        "monthly_series": monthly_series(vam, ano),
        "top_states": top_states(vloc, ano, top_states_k),
        "top_cities": top_cities(vloc, ano, top_cities_k),
    }
