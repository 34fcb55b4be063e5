"""Fixed target schemas of the warehouse, lake and marts.

Dimension/fact keys are 64-bit: the surrogate keys of a dimension built from
billions of people do not fit a 32-bit INTEGER. The calendar key stays 32-bit
because its size is bounded by the calendar range. Summed quantities are also
64-bit for the same reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
PCT_DISCOUNT = T.DecimalType(5, 2)
PCT_ATTAINMENT = T.DecimalType(6, 1)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


DIM_TEMPO = _s(
    ("sk_tempo", T.IntegerType()), ("data", T.DateType()), ("ano", T.ShortType()),
    ("mes", T.ShortType()), ("trimestre", T.ShortType()), ("nome_mes", T.StringType()),
    ("dia_semana", T.StringType()), ("is_fim_semana", T.BooleanType()),
)
DIM_PRODUTO = _s(
    ("sk_produto", T.LongType()), ("id_produto", T.LongType()), ("nome", T.StringType()),
    ("categoria", T.StringType()), ("preco_tabela", MONEY),
)
DIM_CLIENTE = _s(
    ("sk_cliente", T.LongType()), ("id_pessoa", T.LongType()), ("nome", T.StringType()),
    ("cpf_cnpj", T.StringType()), ("tipo_cliente", T.StringType()),
)
DIM_VENDEDOR = _s(
    ("sk_vendedor", T.LongType()), ("id_pessoa", T.LongType()), ("nome", T.StringType()),
)
DIM_LOCALIDADE = _s(
    ("sk_localidade", T.LongType()), ("id_endereco", T.LongType()), ("id_pessoa", T.LongType()),
    ("rua", T.StringType()), ("numero", T.StringType()), ("complemento", T.StringType()),
    ("cep", T.StringType()), ("bairro", T.StringType()), ("cidade", T.StringType()),
    ("estado", T.StringType()), ("sigla_estado", T.StringType()),
)
FATO_VENDA = _s(
    ("sk_tempo", T.IntegerType()), ("sk_produto", T.LongType()), ("sk_cliente", T.LongType()),
    ("sk_vendedor", T.LongType()), ("sk_localidade", T.LongType()), ("id_nota", T.LongType()),
    ("quantidade", T.IntegerType()), ("valor_unitario", MONEY), ("valor_venda_real", MONEY),
    ("desconto", MONEY), ("pct_desconto", PCT_DISCOUNT),
)
# Lines of the fact with a fault: what is wrong and the percentage as computed.
REJEITOS = T.StructType([*FATO_VENDA.fields, *_s(("pct_calculado", T.DecimalType(38, 2)), ("motivos", T.StringType()))])
# Lake rows; ano/mes are the directory partition columns, not file columns.
LAKE_ROW = _s(
    ("data", T.DateType()), ("quantidade", T.IntegerType()), ("valor_unitario", MONEY),
    ("valor_venda_real", MONEY), ("sigla_estado", T.StringType()), ("cidade", T.StringType()),
    ("ano", T.IntegerType()), ("mes", T.IntegerType()),
)
VENDAS_ANO_MES = _s(
    ("id", T.LongType()), ("ano", T.IntegerType()), ("mes", T.IntegerType()),
    ("qtde_vendida", T.LongType()), ("valor_total_real", MONEY),
    ("valor_total_esperado", MONEY), ("data_atualizacao", T.DateType()),
)
VENDAS_LOCALIDADE = _s(
    ("id", T.LongType()), ("ano", T.ShortType()), ("sigla_estado", T.StringType()),
    ("estado", T.StringType()), ("cidade", T.StringType()), ("qtde_vendida", T.LongType()),
    ("valor_total_real", MONEY), ("valor_total_esperado", MONEY),
    ("pct_atingimento", PCT_ATTAINMENT), ("data_atualizacao", T.DateType()),
)

TABLES = {
    "dim_tempo": DIM_TEMPO,
    "dim_produto": DIM_PRODUTO,
    "dim_cliente": DIM_CLIENTE,
    "dim_vendedor": DIM_VENDEDOR,
    "dim_localidade": DIM_LOCALIDADE,
    "fato_venda": FATO_VENDA,
    "rejeitos": REJEITOS,
    "vendas_ano_mes": VENDAS_ANO_MES,
    "vendas_localidade": VENDAS_LOCALIDADE,
}


def cast_col(c: Column | str, t: T.DataType, *, strict: bool = True) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return col.cast(t) if strict else col.try_cast(t)


def conform(df: DataFrame, schema: T.StructType, *, strict: bool = True) -> DataFrame:
    """Project ``df`` onto ``schema``: exact column order, explicit casts.

    Columns missing from ``df`` are added as typed NULLs (additive schema
    evolution); extra columns are dropped.
    """
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        src = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(cast_col(src, f.dataType, strict=strict).alias(f.name))
    return df.select(*cols)
