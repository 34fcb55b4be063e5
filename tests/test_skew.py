"""A third of all invoices on one customer: results stay whole and the
shuffle join on the customer key is split by AQE instead of running the hot
key in one task."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from martforge.config import FIXTURE_CONFIG
from martforge.plans import dims as D
from martforge.plans import marts as M
from martforge.plans.fact import fato_venda, lookups, sales_lines
from martforge.sources.calendar import resolve_calendar
from martforge.sources.fixture import fixture_sources


@pytest.fixture()
def skew_conf(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def hot_sources(spark, sf_dir, tmp_path):
    """A third of the invoices on one customer, the items of a third of the invoices on
    one product; sources in several files."""
    src = fixture_sources(spark, sf_dir)
    customer = src.nota_fiscal.agg(F.min("id_cliente")).first()[0]
    product = src.item_nota_fiscal.agg(F.min("id_produto")).first()[0]
    nf = src.nota_fiscal.withColumn(
        "id_cliente", F.when(F.col("id") % 3 == 0, F.lit(customer)).otherwise(F.col("id_cliente")))
    items = src.item_nota_fiscal.withColumn(
        "id_produto", F.when(F.col("id_nota_fiscal") % 3 == 0, F.lit(product)).otherwise(F.col("id_produto")))
    frames = {}
    for name, df in (("nota_fiscal", nf), ("item_nota_fiscal", items), ("produto", src.produto)):
        df.repartition(16).write.parquet(str(tmp_path / name))
        frames[name] = spark.read.parquet(str(tmp_path / name))
    return dataclasses.replace(src, **frames)


def test_hot_customer_and_product_are_split_by_key(spark, sf_dir, skew_conf, tmp_path):
    src = hot_sources(spark, sf_dir, tmp_path)
    cfg = resolve_calendar(src, FIXTURE_CONFIG)

    def keep(name, df):
        df.write.parquet(str(tmp_path / f"kept_{name}"))
        return spark.read.parquet(str(tmp_path / f"kept_{name}"))

    dims = {name: keep(name, df) for name, df in {
        "dim_tempo": D.dim_tempo(spark, cfg), "dim_produto": D.dim_produto(src, cfg),
        "dim_cliente": D.dim_cliente(src, cfg), "dim_vendedor": D.dim_vendedor(src, cfg),
        "dim_localidade": D.dim_localidade(src, cfg)}.items()}
    fact = fato_venda(src, dims, cfg, {n: keep(n, df) for n, df in lookups(src, dims).items()})
    rows = fact.collect()
    assert len(rows) == sales_lines(src).count()
    assert sum(r["sk_cliente"] is None for r in rows) == 0
    final = fact._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    final = final[:final.index("Initial Plan")]
    joins = [x for x in final.splitlines() if "SortMergeJoin" in x or "ShuffledHashJoin" in x]
    for key in ("id_cliente", "id_produto"):
        of_key = [x for x in joins if key in x]
        assert len(of_key) == 1 and "skew=true" in of_key[0], (key, joins)

    vam = M.vendas_ano_mes(fact, dims["dim_tempo"], cfg)
    total = vam.agg(F.sum("qtde_vendida")).first()[0]
    assert total == sales_lines(src).agg(F.sum("quantidade")).first()[0]
