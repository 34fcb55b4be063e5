"""The five dimensions (calendar, product, customer, seller, location).

Join strategy: none of the joins here carries a broadcast hint unless the
side is bounded by construction. Spark's size estimate (file sizes for
materialised tables) and AQE's runtime statistics pick broadcast for small
lookups and a shuffle join otherwise.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.operators.keymap import OCCURRENCE, extend_key_map, map_schema, occurrences, with_stable_key
from martforge.operators.keys import dense_key, first_per_key
from martforge.operators.versions import VersionedTable
from martforge.schemas import (DIM_CLIENTE, DIM_LOCALIDADE, DIM_PRODUTO, DIM_TEMPO,
                               DIM_VENDEDOR, conform)
from martforge.session import stored
from martforge.sources.calendar import calendar_days
from martforge.sources.tables import SourceTables

# Fixed discriminator values of dim_cliente.tipo_cliente.
TIPO_FISICA = "Pessoa Fisica"
TIPO_JURIDICA = "Pessoa Juridica"


def dim_tempo(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Daily calendar. The calendar is gap-free, so the surrogate key is the
    day offset from the first date + 1: no ranking pass is needed."""
    days = calendar_days(spark, cfg.calendar_start, cfg.calendar_end)
    d = F.col("data")
    out = days.select(
        (F.datediff(d, F.lit(cfg.calendar_start)) + 1).alias("sk_tempo"),
        d.alias("data"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        F.quarter(d).alias("trimestre"),
        F.date_format(d, "MMMM").alias("nome_mes"),
        F.date_format(d, "EEEE").alias("dia_semana"),
        (F.weekday(d) >= 5).alias("is_fim_semana"),
    )
    return conform(out, DIM_TEMPO)


def produto_rows(src: SourceTables) -> DataFrame:
    """Products with a category (inner join: uncategorised products drop out)."""
    p, c = src.produto.alias("p"), src.categoria.alias("c")
    return p.join(c, F.col("c.id") == F.col("p.id_categoria"), "inner").select(
        F.col("p.id").alias("id_produto"),
        F.col("p.nome").alias("nome"),
        F.col("c.descricao").alias("categoria"),
        F.col("p.valor_venda").alias("preco_tabela"),
    )


def dim_produto(src: SourceTables, cfg: PipelineConfig | None = None) -> DataFrame:
    return key_dimension("dim_produto", produto_rows(src), cfg)


def people_with_invoices(people: DataFrame, invoices: DataFrame, role: str) -> DataFrame:
    """People referenced by at least one invoice in column ``role``.

    The reference writes a join followed by DISTINCT; it is a semi-join. The
    invoice side is first reduced to its distinct ids (combined map-side).
    """
    ids = invoices.select(F.col(role).alias("_ref")).where(F.col("_ref").isNotNull()).distinct()
    return people.join(ids, people.id == ids._ref, "left_semi")


def customers_with_sales(src: SourceTables) -> DataFrame:
    """Union of natural and legal persons that bought something (no ids yet)."""
    pf = people_with_invoices(src.pessoa_fisica, src.nota_fiscal, "id_cliente").select(
        F.col("id").alias("id_pessoa"), "nome", F.col("cpf").alias("cpf_cnpj"),
        F.lit(TIPO_FISICA).alias("tipo_cliente")).distinct()
    pj = people_with_invoices(src.pessoa_juridica, src.nota_fiscal, "id_cliente").select(
        F.col("id").alias("id_pessoa"), F.col("razao_social").alias("nome"),
        F.col("cnpj").alias("cpf_cnpj"), F.lit(TIPO_JURIDICA).alias("tipo_cliente")).distinct()
    return pf.unionByName(pj)


def dim_cliente(src: SourceTables, cfg: PipelineConfig | None = None) -> DataFrame:
    return key_dimension("dim_cliente", customers_with_sales(src), cfg)


def vendedor_rows(src: SourceTables) -> DataFrame:
    """Natural persons that appear as seller on an invoice."""
    return people_with_invoices(src.pessoa_fisica, src.nota_fiscal, "id_vendedor").select(
        F.col("id").alias("id_pessoa"), "nome").distinct()


def dim_vendedor(src: SourceTables, cfg: PipelineConfig | None = None) -> DataFrame:
    return key_dimension("dim_vendedor", vendedor_rows(src), cfg)


def address_flatten(src: SourceTables) -> DataFrame:
    """address -> neighbourhood -> city -> state, left outer at every hop."""
    e, b = src.endereco.alias("e"), src.bairro.alias("b")
    c, s = src.cidade.alias("c"), src.estado.alias("s")
    return (
        e.join(b, F.col("b.id") == F.col("e.id_bairro"), "left")
        .join(c, F.col("c.id") == F.col("b.id_cidade"), "left")
        .join(s, F.col("s.id") == F.col("c.id_estado"), "left")
        .select(
            F.col("e.id").alias("id_endereco"), F.col("e.id_pessoa").alias("id_pessoa"),
            F.col("e.rua").alias("rua"), F.col("e.numero").alias("numero"),
            F.col("e.complemento").alias("complemento"), F.col("e.cep").alias("cep"),
            F.col("b.descricao").alias("bairro"), F.col("c.descricao").alias("cidade"),
            F.col("s.descricao").alias("estado"), F.col("s.sigla").alias("sigla_estado"),
        )
    )


def first_address(src: SourceTables) -> DataFrame:
    """One address per person: the one with the lowest address id. That id is found from the ids
    alone, so only about one address of a person is flattened."""
    e, low = src.endereco, F.coalesce("id", F.lit(-(1 << 63)))  # a null id comes first
    lowest = e.groupBy(F.col("id_pessoa").alias("_p")).agg(F.min(low).alias("_low"))
    own = e.join(lowest, F.col("_p").eqNullSafe(F.col("id_pessoa")) & (low == F.col("_low")), "left_semi")
    return first_per_key(address_flatten(replace(src, endereco=own)), "id_pessoa", ["id_endereco"])


def dim_localidade(src: SourceTables, cfg: PipelineConfig | None = None) -> DataFrame:
    return key_dimension("dim_localidade", first_address(src), cfg)


# name -> (rows builder, surrogate key, natural ordering, target schema)
KEYED_DIMENSIONS = {
    "dim_produto": (produto_rows, "sk_produto", ["id_produto"], DIM_PRODUTO),
    "dim_cliente": (customers_with_sales, "sk_cliente", ["tipo_cliente", "id_pessoa"], DIM_CLIENTE),
    "dim_vendedor": (vendedor_rows, "sk_vendedor", ["id_pessoa"], DIM_VENDEDOR),
    "dim_localidade": (first_address, "sk_localidade", ["id_pessoa"], DIM_LOCALIDADE),
}


def key_dimension(name: str, rows: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """Number the rows of a dimension by its natural key (rows of the same by all they have) and fix its schema."""
    _, sk, order_by, schema = KEYED_DIMENSIONS[name]
    buckets = cfg.key_buckets if cfg is not None else None
    return conform(dense_key(rows, sk, order_by, buckets=buckets, ties=_others(rows, order_by)), schema)


def _others(rows: DataFrame, natural: list[str]) -> list[str]:
    return [c for c in rows.columns if c not in natural]


def write_keyed_dimension(name: str, src: SourceTables, cfg: PipelineConfig | None, sink,
                          keys: VersionedTable | None = None):
    """Build dimension ``name`` and hand it to ``sink`` (which writes it).

    ``keys``: its key map, so that entities keep the keys of earlier runs and new ones get
    the next. Without, or before the map's first version (see ``record_keys``), keys are numbered
    from 1. Rows that share a natural key have a key each: the n-th of them, by all that they have, the n-th key that
    was given to it. The rows are read several times, so they are stored for the duration of the write."""
    make, sk, natural, schema = KEYED_DIMENSIONS[name]
    rows = make(src)
    given = keys is not None and keys.current() is not None
    if given:
        rows = occurrences(rows, natural, _others(rows, natural))
    with stored(rows, f"rows-{name}") as rows:
        if not given:
            return sink(key_dimension(name, rows, cfg))
        own = [OCCURRENCE, *natural]
        version = extend_key_map(keys, rows, own, sk, cfg.key_buckets if cfg is not None else None)
        return sink(conform(with_stable_key(keys, version, rows, own, sk), schema))


def record_keys(name: str, dim: DataFrame, keys: VersionedTable) -> None:
    """Make a written dimension the first version of its key map, if there is none yet. It need
    not be there before the fact is built: do it beside other work."""
    _, sk, natural, _ = KEYED_DIMENSIONS[name]
    if keys.current() is None:
        own = [OCCURRENCE, *natural]
        first = occurrences(dim, natural, [sk]).select(*own, sk)
        keys.commit(map_schema(first, own, sk), [keys.write(first)], None)
