"""Hand-made frames for the hazard tests (one per hazard, a few rows each)."""

from datetime import date
from decimal import Decimal as Dm

from martforge.config import PipelineConfig
from martforge.schemas import DIM_LOCALIDADE, FATO_VENDA, VENDAS_ANO_MES, VENDAS_LOCALIDADE

CFG = PipelineConfig(calendar_start=date(2020, 1, 1), calendar_end=date(2020, 12, 31),
                     run_date=date(2021, 1, 1), ds="2020-03-10")


def fact_rows(spark, rows):
    """rows: (sk_tempo, sk_localidade, quantidade, valor_unitario, valor_venda_real)."""
    full = [(t, 1, 1, 1, loc, 100 + i, q, None if u is None else Dm(u),
             None if r is None else Dm(r), Dm("0.00"), Dm("0.00"))
            for i, (t, loc, q, u, r) in enumerate(rows)]
    return spark.createDataFrame(full, FATO_VENDA)


def localidade(spark, rows):
    """rows: (sk_localidade, sigla_estado, estado, cidade)."""
    full = [(sk, sk * 100, sk, "Rua", "1", None, "00000000", "B", cid, est, sig)
            for sk, sig, est, cid in rows]
    return spark.createDataFrame(full, DIM_LOCALIDADE)


def vam(spark, rows):
    """rows: (ano, mes, qtde, real, esperado)."""
    full = [(i + 1, a, m, q, Dm(r), Dm(e), date(2021, 1, 1)) for i, (a, m, q, r, e) in enumerate(rows)]
    return spark.createDataFrame(full, VENDAS_ANO_MES)


def vloc(spark, rows):
    """rows: (ano, sigla, estado, cidade, real, esperado)."""
    full = [(i + 1, a, s, e, c, 1, Dm(r), Dm(x), None, date(2021, 1, 1))
            for i, (a, s, e, c, r, x) in enumerate(rows)]
    return spark.createDataFrame(full, VENDAS_LOCALIDADE)
