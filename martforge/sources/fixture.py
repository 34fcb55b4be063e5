"""Source relations derived from the driver's TPC-H-like tables.

The original job reads a transactional database (invoices, invoice items,
products, categories, natural/legal persons, addresses and the
neighbourhood -> city -> state chain). The test data ships TPC-H-like tables
instead; this module derives the ten source relations from them with plain
DataFrame operators so every fixture row grows with the data.

Mapping (the oracle SQL builds the very same relations):

* nota_fiscal: one header per order; the seller is the order's lowest
  supplier key shifted into the person id space (orders without lines get
  no seller).
* item_nota_fiscal: one item per line; list value and realised value are
  computed in decimal arithmetic.
* produto / categoria: parts; categories numbered by type name; the
  SMALL type is left without a category.
* pessoa_juridica: customers of the AUTOMOBILE, BUILDING and MACHINERY
  segments; pessoa_fisica: the other customers plus every supplier (the
  sellers).
* endereco: a home address per customer in its nation plus one address
  per (customer, supplier nation) it bought from; customers with a negative
  balance have no address; the home address of nation 24 has no
  neighbourhood (a broken location chain).
* bairro / cidade: nations; estado: regions (state code = first two letters).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge.sources.tables import SourceTables

# Fixed values of the fixture mapping.
SELLER_ID_OFFSET = 1_000_000
LEGAL_SEGMENTS = ("AUTOMOBILE", "BUILDING", "MACHINERY")
UNCATEGORISED_TYPE = "SMALL"
BROKEN_CHAIN_NATION = 24
ADDRESS_ID_STRIDE = 100


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _dec(c, p: int, s: int = 2):
    return F.col(c).cast(f"decimal({p},{s})") if isinstance(c, str) else c.cast(f"decimal({p},{s})")


def list_value():
    """Item value before discount and tax, decimal(18,2)."""
    return _dec("l_extendedprice", 18)


def realised_value():
    """Item value after discount and tax, all in decimal arithmetic."""
    one = F.lit(1).cast("decimal(1,0)")
    return (
        _dec("l_extendedprice", 12)
        * _dec(one - _dec("l_discount", 5), 5)
        * _dec(one + _dec("l_tax", 5), 5)
    ).cast("decimal(18,2)")


def fixture_sources(spark: SparkSession, sf_dir: str) -> SourceTables:
    from martforge.operators.keys import dense_key

    t = lambda name: read_driver_table(spark, sf_dir, name)
    orders, lineitem, part = t("orders"), t("lineitem"), t("part")
    customer, supplier, nation, region = t("customer"), t("supplier"), t("nation"), t("region")

    # Seller of an invoice: lowest supplier key among its lines (partial agg).
    seller = lineitem.groupBy("l_orderkey").agg(F.min("l_suppkey").alias("_min_supp"))
    nota_fiscal = orders.join(seller, orders.o_orderkey == seller.l_orderkey, "left").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("data_venda"),
        F.col("o_custkey").alias("id_cliente"),
        (F.lit(SELLER_ID_OFFSET) + F.col("_min_supp")).cast("bigint").alias("id_vendedor"),
    )

    item_nota_fiscal = lineitem.select(
        F.col("l_orderkey").alias("id_nota_fiscal"),
        F.col("l_partkey").alias("id_produto"),
        F.col("l_quantity").cast("int").alias("quantidade"),
        list_value().alias("valor_unitario"),
        realised_value().alias("valor_venda_real"),
    )

    # Category ids numbered by name; the distinct type names form one small
    # range (a text key has no quantiles to split on).
    categoria = dense_key(
        part.select(F.col("p_type").alias("descricao")).distinct(), "id", ["descricao"]
    ).select(F.col("id").cast("int").alias("id"), "descricao")

    produto = part.join(categoria, part.p_type == categoria.descricao, "left").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("nome"),
        _dec("p_retailprice", 18).alias("valor_venda"),
        F.when(F.col("p_type") == UNCATEGORISED_TYPE, F.lit(None).cast("int"))
        .otherwise(F.col("id")).alias("id_categoria"),
    )

    is_legal = F.col("c_mktsegment").isin(*LEGAL_SEGMENTS)
    pessoa_juridica = customer.where(is_legal).select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("razao_social"),
        F.lpad(F.col("c_custkey").cast("string"), 14, "0").alias("cnpj"),
    )
    natural_customers = customer.where(~F.coalesce(is_legal, F.lit(False))).select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("nome"))
    sellers = supplier.select(
        (F.lit(SELLER_ID_OFFSET) + F.col("s_suppkey")).cast("bigint").alias("id"),
        F.col("s_name").alias("nome"))
    pessoa_fisica = natural_customers.unionByName(sellers).select(
        "id", "nome", F.lpad(F.col("id").cast("string"), 11, "0").alias("cpf"))

    located = customer.where(F.col("c_acctbal") >= 0).select(
        F.col("c_custkey").alias("id_pessoa"), "c_nationkey")
    home = located.select(
        (F.col("id_pessoa") * ADDRESS_ID_STRIDE).alias("id"),
        "id_pessoa",
        F.when(F.col("c_nationkey") == BROKEN_CHAIN_NATION, F.lit(None).cast("int"))
        .otherwise(F.col("c_nationkey")).alias("id_bairro"),
    )
    order_nations = (
        lineitem.select("l_orderkey", "l_suppkey")
        .join(supplier.select("s_suppkey", "s_nationkey"),
              F.col("l_suppkey") == F.col("s_suppkey"))
        .select("l_orderkey", "s_nationkey").distinct()
    )
    bought_from = (
        orders.select("o_orderkey", "o_custkey")
        .join(order_nations, F.col("o_orderkey") == F.col("l_orderkey"))
        .select(F.col("o_custkey").alias("id_pessoa"), F.col("s_nationkey").alias("id_bairro"))
        .distinct()
        .join(located.select("id_pessoa"), "id_pessoa", "left_semi")
    )
    extra = bought_from.select(
        (F.col("id_pessoa") * ADDRESS_ID_STRIDE + 1 + F.col("id_bairro")).alias("id"),
        "id_pessoa", F.col("id_bairro").cast("int").alias("id_bairro"))
    endereco = home.unionByName(extra).select(
        F.col("id").cast("bigint").alias("id"),
        F.col("id_pessoa").cast("bigint").alias("id_pessoa"),
        F.concat(F.lit("Rua "), F.col("id_pessoa").cast("string")).alias("rua"),
        (F.col("id") % ADDRESS_ID_STRIDE).cast("string").alias("numero"),
        F.when(F.col("id") % ADDRESS_ID_STRIDE == 0, F.lit(None).cast("string"))
        .otherwise(F.lit("Entrega")).alias("complemento"),
        F.lpad((F.col("id_pessoa") % 100000000).cast("string"), 8, "0").alias("cep"),
        F.col("id_bairro"),
    )

    bairro = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("descricao"),
                           F.col("n_nationkey").alias("id_cidade"))
    cidade = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("descricao"),
                           F.col("n_regionkey").alias("id_estado"))
    estado = region.select(F.col("r_regionkey").alias("id"), F.col("r_name").alias("descricao"),
                           F.substring("r_name", 1, 2).alias("sigla"))

    return SourceTables(
        nota_fiscal=nota_fiscal, item_nota_fiscal=item_nota_fiscal, produto=produto,
        categoria=categoria, pessoa_fisica=pessoa_fisica, pessoa_juridica=pessoa_juridica,
        endereco=endereco, bairro=bairro, cidade=cidade, estado=estado,
    )
