"""Updates against full rebuilds: late, changed and removed rows, new entities, changed lookups."""

import dataclasses
from collections import Counter

import pytest
from pyspark.sql import functions as F

from martforge.config import FIXTURE_CONFIG
from martforge.operators.versions import ConcurrentCommit
from martforge.plans import incremental as I
from martforge.plans.pipeline import run_pipeline
from martforge.sources.fixture import fixture_sources

MONTH = "1998-03"


def content(df, drop=()):
    return Counter(tuple(r) for r in df.drop(*drop).collect())


@pytest.fixture(scope="module")
def src(spark, sf_dir):
    return fixture_sources(spark, sf_dir)


def check_like_a_rebuild(spark, store, src, root):
    """The store's tables have the rows of a run from scratch, keys told by what they stand for."""
    res = run_pipeline(spark, src, FIXTURE_CONFIG, str(root), publish=False)

    def told(read):
        f = read("fato_venda")
        for dim, sk, names in (("dim_produto", "sk_produto", ["id_produto", "preco_tabela"]),
                               ("dim_cliente", "sk_cliente", ["id_pessoa", "tipo_cliente"]),
                               ("dim_vendedor", "sk_vendedor", ["id_pessoa"]),
                               ("dim_localidade", "sk_localidade", ["id_pessoa", "id_endereco", "cidade"])):
            d = read(dim).select(F.col(sk).alias("_sk"), *[F.col(n).alias(f"{dim}_{n}") for n in names])
            f = f.join(d, F.col("_sk").eqNullSafe(F.col(sk)), "left").drop("_sk", sk)
        return content(f)

    assert told(store.read) == told(lambda n: res.table(spark, n))
    for mart in ("vendas_ano_mes", "vendas_localidade"):
        assert content(store.read(mart)) == content(res.table(spark, mart))


def folders(store, name):
    return {p.key: p.folder for p in store.version(name, store.state()).parts}


def test_updates(spark, src, tmp_path):
    store, root = I.Store(spark, f"{tmp_path}/s"), f"{tmp_path}/s"
    late = (F.date_format("data_venda", "yyyy-MM") == MONTH) & (F.col("id") % 3 == 0)
    held = src.nota_fiscal.filter(late).select(F.col("id").alias("_h"))
    items = src.item_nota_fiscal
    some = items.join(F.broadcast(held), F.col("_h") == F.col("id_nota_fiscal"), "left_anti")
    first = I.update(spark, dataclasses.replace(src, item_nota_fiscal=some), FIXTURE_CONFIG, root)
    check_like_a_rebuild(spark, store, dataclasses.replace(src, item_nota_fiscal=some), tmp_path / "r1")
    assert first.state.number == 1

    # late items: their month alone is written again, their days alone are summed again
    was, was_sums = folders(store, "fato_venda"), folders(store, "day_sums")
    second = I.update(spark, src, FIXTURE_CONFIG, root)
    assert second.ranges == {MONTH} and {f"{d:%Y-%m}" for d in second.days} == {MONTH}
    now, now_sums = folders(store, "fato_venda"), folders(store, "day_sums")
    assert {k for k in now if now[k] != was.get(k)} == {MONTH} == {k for k in now_sums if now_sums[k] != was_sums.get(k)}
    check_like_a_rebuild(spark, store, src, tmp_path / "r2")

    # nothing changed: no part is written
    third = I.update(spark, src, FIXTURE_CONFIG, root)
    assert (third.ranges, third.days) == (set(), []) and folders(store, "fato_venda") == now

    # a price, a customer's new invoice with a late date outside the calendar's end, a removed month, a lost address
    product = items.agg(F.min("id_produto")).first()[0]
    gone = src.nota_fiscal.filter(F.date_format("data_venda", "yyyy-MM") != "1999-05")
    fresh = src.nota_fiscal.orderBy("id").limit(1).select(
        (F.col("id") * 0 + 10_000_019).alias("id"), F.lit(None).cast(src.nota_fiscal.schema["data_venda"].dataType).alias("data_venda"),
        "id_cliente", "id_vendedor")
    row = items.limit(1).withColumn("id_nota_fiscal", F.lit(10_000_019).cast(items.schema["id_nota_fiscal"].dataType))
    new = dataclasses.replace(
        src, nota_fiscal=gone.unionByName(fresh), item_nota_fiscal=items.unionByName(row),
        produto=src.produto.withColumn("valor_venda", F.when(F.col("id") == product, F.col("valor_venda") + 1).otherwise(F.col("valor_venda"))))
    fourth = I.update(spark, new, FIXTURE_CONFIG, root)
    check_like_a_rebuild(spark, store, new, tmp_path / "r4")
    assert {"1999-05", I.NONE} <= fourth.ranges and len(fourth.ranges) < len(now)
    assert "1999-05" not in folders(store, "fato_venda")


def test_keys_stay_when_customers_come(spark, src, tmp_path):
    root = f"{tmp_path}/s"
    few = dataclasses.replace(src, nota_fiscal=src.nota_fiscal.filter("id_cliente % 3 <> 0"))
    I.update(spark, few, FIXTURE_CONFIG, root)
    store = I.Store(spark, root)
    old = {(r.tipo_cliente, r.id_pessoa): r.sk_cliente for r in store.read("dim_cliente").collect()}
    I.update(spark, src, FIXTURE_CONFIG, root)
    new = {(r.tipo_cliente, r.id_pessoa): r.sk_cliente for r in store.read("dim_cliente").collect()}
    assert len(new) > len(old) and {k: new[k] for k in old} == old
    assert sorted(new.values()) == list(range(1, len(new) + 1))
    check_like_a_rebuild(spark, store, src, tmp_path / "r")


def test_rows_that_share_an_id_keep_a_key_each(spark, src, tmp_path):
    """A seller and a customer of one id, and a product that comes twice: the second update sees no change in them."""
    people, root = src.pessoa_fisica, f"{tmp_path}/s"
    double = people.filter("id % 2 = 0").withColumn("nome", F.concat(F.lit("Outro "), "nome"))
    both = dataclasses.replace(src, pessoa_fisica=people.unionByName(double), produto=src.produto.unionByName(src.produto.filter("id % 3 = 0")))
    late = (F.date_format("data_venda", "yyyy-MM") == MONTH) & (F.col("id") % 3 == 0)
    held = src.nota_fiscal.filter(late).select(F.col("id").alias("_h"))
    some = src.item_nota_fiscal.join(F.broadcast(held), F.col("_h") == F.col("id_nota_fiscal"), "left_anti")
    I.update(spark, dataclasses.replace(both, item_nota_fiscal=some), FIXTURE_CONFIG, root)
    store, dims = I.Store(spark, root), ("dim_cliente", "dim_vendedor", "dim_produto", "dim_localidade")
    was = {n: content(store.read(n)) for n in dims}
    second = I.update(spark, both, FIXTURE_CONFIG, root)
    assert second.ranges == {MONTH}
    assert {n: content(store.read(n)) for n in dims} == was
    for n, rows in was.items():  # numbered as by row_number over the whole dimension
        assert sorted(r[0] for r in rows.elements()) == list(range(1, rows.total() + 1)), n
    assert any("Outro" in r[2] for r in was["dim_cliente"]) and any("Outro" in r[2] for r in was["dim_vendedor"])
    check_like_a_rebuild(spark, store, both, tmp_path / "r")

    third = dataclasses.replace(both, pessoa_fisica=both.pessoa_fisica.unionByName(double.withColumn("nome", F.lit("Zz"))))
    I.update(spark, third, FIXTURE_CONFIG, root)
    now = content(store.read("dim_cliente"))
    assert now & was["dim_cliente"] == was["dim_cliente"] and min(r[0] for r in now - was["dim_cliente"]) > was["dim_cliente"].total()


def test_update_that_dies_or_meets_another(spark, src, tmp_path, monkeypatch):
    root = f"{tmp_path}/s"
    one = I.update(spark, src, FIXTURE_CONFIG, root)
    store = I.Store(spark, root)
    before = content(store.read("vendas_ano_mes"))
    fewer = dataclasses.replace(src, item_nota_fiscal=src.item_nota_fiscal.filter("quantidade > 5"))
    with monkeypatch.context() as m:
        m.setattr(I.M, "vendas_localidade", lambda *a, **b: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            I.update(spark, fewer, FIXTURE_CONFIG, root)
    assert store.state() == one.state and content(store.read("vendas_ano_mes")) == before
    with open(f"{root}/state/000000000002.json", "w"):
        pass  # another one died while it wrote its state
    assert store.state() == one.state
    again = I.update(spark, fewer, FIXTURE_CONFIG, root)
    assert again.state.number == 3 and content(store.read("vendas_ano_mes")) != before
    with pytest.raises(ConcurrentCommit):
        store.finish(one.state, one.state.calendar, one.state.versions)
