"""Physical-plan properties that matter at scale."""

import pytest

from martforge.config import FIXTURE_CONFIG
from martforge.plans import lake as L
from martforge.plans import marts as M
from martforge.plans import reports as R
from martforge.plans.fact import fato_venda
from martforge.plans.pipeline import run_pipeline
from martforge.sources.fixture import fixture_sources

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def built(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    src = fixture_sources(spark, sf_dir)
    res = run_pipeline(spark, src, FIXTURE_CONFIG, root, publish=False)
    names = ("dim_tempo", "dim_produto", "dim_cliente", "dim_vendedor", "dim_localidade")
    dims = {n: res.table(spark, n) for n in names}
    return src, res, dims


def test_no_python_in_products(spark, built):
    src, res, dims = built
    fact = res.table(spark, "fato_venda")
    vam, vloc = res.table(spark, "vendas_ano_mes"), res.table(spark, "vendas_localidade")
    frames = [fato_venda(src, dims, res.cfg),
              M.build_marts(fact, dims["dim_tempo"], dims["dim_localidade"], res.cfg)[0],
              M.build_marts(fact, dims["dim_tempo"], dims["dim_localidade"], res.cfg)[1],
              R.kpi_cards(vam, 2000), R.top_states(vloc, 2000), R.top_cities(vloc, 2000)]
    for df in frames:
        p = plan(df)
        assert not any(n in p for n in PYTHON_NODES), p


def test_fact_plan_has_no_single_partition_step(spark, built):
    src, res, dims = built
    p = plan(fato_venda(src, dims, res.cfg))
    assert "SinglePartition" not in p


def test_month_filter_reaches_the_fact_scan(spark, built):
    _, res, dims = built
    fact = res.table(spark, "fato_venda")
    ano, mes = L.month_of(res.cfg.ds)
    lo, hi = L.month_sk_range(res.cfg, ano, mes)
    p = plan(L.lake_month(fact, dims["dim_tempo"], dims["dim_localidade"], res.cfg, ano, mes))
    assert f"GreaterThanOrEqual(sk_tempo,{lo})" in p and f"LessThanOrEqual(sk_tempo,{hi})" in p


def test_marts_aggregate_before_the_shuffle(spark, built):
    _, res, dims = built
    fact = res.table(spark, "fato_venda")
    pre = M.month_location_sums(fact, dims["dim_tempo"], res.cfg)
    p = plan(pre)
    assert "partial_sum" in p
    assert "BroadcastHashJoin" in p      # the bounded calendar is broadcast
