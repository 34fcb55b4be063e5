"""End-to-end run: invariants between tables, round trips, idempotent lake,
atomic publish."""

import dataclasses
import os
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from martforge.config import FIXTURE_CONFIG
from martforge.operators.quality import ValidationError
from martforge.plans import fact as FT
from martforge.plans import lake as L
from martforge.plans.fact import sales_lines
from martforge.plans.pipeline import current_run, read_published, run_pipeline
from martforge.schemas import FATO_VENDA
from martforge.sources.fixture import fixture_sources


@pytest.fixture(scope="module")
def run(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("wh"))
    src = fixture_sources(spark, sf_dir)
    return root, src, run_pipeline(spark, src, FIXTURE_CONFIG, root)


def test_counts_and_pointer(spark, run):
    root, src, res = run
    assert current_run(spark, root) == res.run_id
    for name in ("dim_tempo", "dim_produto", "dim_cliente", "dim_vendedor", "dim_localidade",
                 "fato_venda", "vendas_ano_mes", "vendas_localidade"):
        assert read_published(spark, root, name).count() == res.counts[name]


def test_fact_rows_equal_source_lines(spark, run):
    _, src, res = run
    assert res.counts["fato_venda"] == sales_lines(src).count()
    assert not any("duplicated" in w for w in res.warnings)


def test_surrogate_keys_are_one_to_n(spark, run):
    _, _, res = run
    for name, sk in (("dim_produto", "sk_produto"), ("dim_cliente", "sk_cliente"),
                     ("dim_vendedor", "sk_vendedor"), ("dim_localidade", "sk_localidade"),
                     ("dim_tempo", "sk_tempo")):
        keys = sorted(r[0] for r in res.table(spark, name).select(sk).collect())
        assert keys == list(range(1, len(keys) + 1)), name


def test_mart_totals_reconcile_with_the_fact(spark, run):
    _, _, res = run
    fact, cal = res.table(spark, "fato_venda"), res.table(spark, "dim_tempo")
    dated = fact.join(cal, "sk_tempo").agg(F.sum("valor_venda_real").alias("v"),
                                           F.sum("quantidade").alias("q")).first()
    vam = res.table(spark, "vendas_ano_mes").agg(F.sum("valor_total_real").alias("v"),
                                                 F.sum("qtde_vendida").alias("q")).first()
    vloc = res.table(spark, "vendas_localidade").agg(F.sum("valor_total_real").alias("v")).first()
    assert (vam["v"], vam["q"]) == (dated["v"], dated["q"])
    assert vloc["v"] <= vam["v"]


def test_lake_month_rerun_is_idempotent(spark, run, tmp_path):
    root, src, res = run
    ano, mes = L.month_of(FIXTURE_CONFIG.ds)
    before = L.read_lake_month(spark, res.lake_root, ano, mes).count()
    assert before == res.counts["lake_month"] > 0
    again = run_pipeline(spark, src, FIXTURE_CONFIG, root)
    assert L.read_lake_month(spark, res.lake_root, ano, mes).count() == before
    # same data, same surrogate keys (they follow the natural key, not arrival order)
    for name in ("dim_cliente", "dim_localidade", "fato_venda"):
        a, b = res.table(spark, name), again.table(spark, name)
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name
    assert current_run(spark, root) == again.run_id
    # directories are not zero-padded; a small month is one well-sized file
    files = L.read_lake_month(spark, res.lake_root, ano, mes).inputFiles()
    assert files[0].find(f"mes={mes}/") > 0
    assert len(files) == 1


def test_failed_run_keeps_the_previous_publication(spark, run):
    root, src, _ = run
    published = current_run(spark, root)
    no_sales = FIXTURE_CONFIG.with_(calendar_start=date(1980, 1, 1), calendar_end=date(1980, 12, 31))
    with pytest.raises(ValidationError):
        run_pipeline(spark, src, no_sales, root)
    assert current_run(spark, root) == published


def test_empty_month_writes_no_partition(spark, sf_dir, tmp_path):
    cfg = FIXTURE_CONFIG.with_(ds="2005-01-15")
    res = run_pipeline(spark, fixture_sources(spark, sf_dir), cfg, str(tmp_path), publish=False)
    assert res.counts["lake_month"] == 0 and res.lake_location is None


def test_empty_month_with_a_fallback_lake(spark, sf_dir, tmp_path):
    src, cfg = fixture_sources(spark, sf_dir), FIXTURE_CONFIG.with_(ds="2005-01-15")
    for root in ("new", "used"):
        where = str(tmp_path / root)
        if root == "used":
            run_pipeline(spark, src, FIXTURE_CONFIG, where, publish=False)
        res = run_pipeline(spark, src, cfg, where, publish=False, lake_fallback=str(tmp_path / "fb"))
        assert res.counts["lake_month"] == 0 and res.lake_location is None
        assert L.read_lake_month(spark, res.lake_root, 2005, 1).count() == 0
    assert L.read_lake_month(spark, str(tmp_path / "never"), 2005, 1).columns == L.LAKE_ROW.names


def test_a_failed_month_leaves_the_old_one(spark, run, tmp_path):
    _, _, res = run
    ano, mes = L.month_of(FIXTURE_CONFIG.ds)
    rows = L.read_lake_month(spark, res.lake_root, ano, mes)
    lake = str(tmp_path / "lake")
    wrote = L.write_lake(rows, lake)
    # The last of several tasks fails after the others have written their files.
    broken = rows.repartition(4).withColumn(
        "cidade", F.when(F.spark_partition_id() == 3, F.raise_error(F.lit("lost"))).otherwise(F.col("cidade")))
    with pytest.raises(Exception, match="lost"):
        L.write_lake(broken, lake)
    kept = L.read_lake_month(spark, lake, ano, mes)
    assert kept.count() == wrote and kept.exceptAll(rows).count() == 0


def test_a_month_is_switched_by_its_commit(spark, run, tmp_path, monkeypatch):
    """A writer dies after its last file and before its commit; a reader that holds the old month keeps it."""
    _, _, res = run
    ano, mes = L.month_of(FIXTURE_CONFIG.ds)
    rows, lake = L.read_lake_month(spark, res.lake_root, ano, mes), str(tmp_path / "lake")
    other = rows.withColumn("mes", F.lit(mes % 12 + 1))
    assert L.write_lake(rows.unionByName(other), lake) == 2 * res.counts["lake_month"]
    held = L.read_lake_month(spark, lake, ano, mes)
    with monkeypatch.context() as m:
        m.setattr(L.VersionedTable, "change", lambda *a: (_ for _ in ()).throw(OSError("died")))
        with pytest.raises(OSError, match="died"):
            L.write_lake(rows.limit(3), lake)
    assert L.read_lake_month(spark, lake, ano, mes).count() == res.counts["lake_month"]
    assert L.write_lake(rows.limit(3), lake) == 3
    assert L.read_lake_month(spark, lake, ano, mes).count() == 3
    assert held.count() == res.counts["lake_month"]
    assert L.lake_months(spark, lake) == {(ano, mes): 3, (ano, mes % 12 + 1): res.counts["lake_month"]}
    # Two folders hold current months; the one of the dead writer goes.
    assert len(L.VersionedTable(spark, lake).vacuum(keep=1, min_age_s=0)) == 1
    assert L.read_lake_month(spark, lake, ano, mes % 12 + 1).exceptAll(other).count() == 0


def test_plain_month_folders_are_taken_over(spark, run, tmp_path):
    _, _, res = run
    ano, mes = L.month_of(FIXTURE_CONFIG.ds)
    rows, lake = L.read_lake_month(spark, res.lake_root, ano, mes), str(tmp_path / "lake")
    old = rows.unionByName(rows.withColumn("mes", F.lit(mes % 12 + 1)))
    old.write.partitionBy("ano", "mes").parquet(lake)
    n = res.counts["lake_month"]
    assert L.read_lake_month(spark, lake, ano, mes).exceptAll(rows).count() == 0
    assert L.lake_months(spark, lake) == {(ano, mes): n, (ano, mes % 12 + 1): n}
    assert L.write_lake(rows.limit(5), lake) == 5
    assert L.lake_months(spark, lake) == {(ano, mes): 5, (ano, mes % 12 + 1): n}
    assert [L.read_lake_month(spark, lake, ano, m).count() for m in (mes, mes % 12 + 1, 99)] == [5, n, 0]


def test_an_emptied_month_counts_this_attempt_only(spark, run, tmp_path):
    _, _, res = run
    ano, mes = L.month_of(FIXTURE_CONFIG.ds)
    rows = L.read_lake_month(spark, res.lake_root, ano, mes)
    lake = str(tmp_path / "lake")
    assert L.write_lake_with_fallback(rows, lake, str(tmp_path / "fb")).rows == res.counts["lake_month"]
    again = L.write_lake_with_fallback(rows.limit(0), lake, str(tmp_path / "fb"))
    assert (again.rows, again.location, again.reason) == (0, lake, None)


def test_the_reason_of_a_fallback_is_kept(spark, sf_dir, tmp_path, monkeypatch):
    write = L.write_lake

    def failing(rows, root, **kw):
        if root.endswith("/lake"):
            raise OSError("no space on the lake")
        return write(rows, root, **kw)

    monkeypatch.setattr(L, "write_lake", failing)
    res = run_pipeline(spark, fixture_sources(spark, sf_dir), FIXTURE_CONFIG, str(tmp_path), publish=False,
                       lake_fallback=str(tmp_path / "fb"))
    assert res.lake_location == str(tmp_path / "fb") and res.counts["lake_month"] > 0
    assert any("no space on the lake" in w for w in res.warnings)


def test_a_publish_in_progress_does_not_hide_the_last_one(spark, run):
    root, _, _ = run
    published = current_run(spark, root)
    spark.sql("SELECT 'x' AS run_id").write.text(f"{root}/_PUBLISHED/zzz")
    os.remove(f"{root}/_PUBLISHED/zzz/_SUCCESS")     # as a publish that died leaves it
    assert current_run(spark, root) == published


def test_metrics_count_what_the_fact_holds(spark, run):
    _, _, res = run
    fact = res.table(spark, "fato_venda")
    assert res.metrics["nulos_sk_localidade"] == fact.where("sk_localidade IS NULL").count()
    assert res.metrics["sem_calendario"] == fact.where("sk_tempo IS NULL").count()
    assert res.metrics["pct_desconto_fora"] == fact.where("pct_desconto IS NULL AND valor_unitario <> 0").count()


def test_rejected_lines_of_awkward_rows(spark):
    """Nulls everywhere, a price of zero, a fault of each kind, several at once, a repeated line, none at all."""
    cols = FATO_VENDA.names
    line = dict(sk_tempo=1, sk_produto=1, sk_cliente=1, sk_vendedor=1, sk_localidade=1, id_nota=1, quantidade=1,
                valor_unitario=Decimal("2.00"), valor_venda_real=Decimal("2.00"), desconto=Decimal("1.00"),
                pct_desconto=Decimal("50.00"))
    huge = dict(valor_unitario=Decimal("0.01"), desconto=Decimal("-5.00"), pct_desconto=None)
    rows = [line, line | dict(valor_unitario=Decimal("0.00"), pct_desconto=None), line | dict(sk_vendedor=None),
            line | dict(sk_tempo=None), line | huge, line | huge, line | huge | dict(sk_cliente=None, sk_localidade=None),
            dict.fromkeys(cols)]
    fact = spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], FATO_VENDA)
    got = sorted((r["motivos"], r["pct_calculado"]) for r in FT.rejected_lines(fact).collect() if r["id_nota"])
    far = Decimal("-50000.00")
    assert got == [("nulos_sk_cliente,nulos_sk_localidade,pct_desconto_fora", far), ("pct_desconto_fora", far),
                   ("pct_desconto_fora", far), ("sem_calendario", Decimal("50.00"))]
    empty = [r for r in FT.rejected_lines(fact).collect() if r["id_nota"] is None]
    assert [r["motivos"] for r in empty] == ["nulos_sk_cliente,nulos_sk_localidade,sem_calendario"]
    assert FT.rejected_lines(fact.limit(0)).count() == 0


def test_rejects_filter_reaches_the_scan(spark, run):
    _, _, res = run
    plan = FT.rejected_lines(res.table(spark, "fato_venda"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "IsNull(sk_tempo)" in pushed and "IsNull(pct_desconto)" in pushed and "Exchange" not in plan


def test_strict_percentages_fail_the_run(spark, sf_dir, tmp_path):
    src = fixture_sources(spark, sf_dir)
    cheap = dataclasses.replace(src, item_nota_fiscal=src.item_nota_fiscal.withColumn(
        "valor_unitario", F.lit("0.01").cast("decimal(18,2)")))
    lenient = run_pipeline(spark, cheap, FIXTURE_CONFIG, str(tmp_path / "a"), publish=False)
    assert lenient.metrics["pct_desconto_fora"] > 0
    faulty = lenient.table(spark, "rejeitos")
    assert faulty.count() == lenient.metrics["rejeitos"]
    for name in FT.fact_metrics():
        assert faulty.where(F.array_contains(F.split("motivos", ","), name)).count() == lenient.metrics[name], name
    lost = faulty.where(F.array_contains(F.split("motivos", ","), "pct_desconto_fora"))
    assert lost.where("pct_desconto IS NULL AND abs(pct_calculado) > 999.99").count() == lost.count()
    assert any(w.startswith("pct_desconto_fora") for w in lenient.warnings)
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE|CAST_OVERFLOW"):
        run_pipeline(spark, cheap, FIXTURE_CONFIG.with_(strict_pct=True), str(tmp_path / "b"), publish=False)


def test_month_filter_skips_most_files(spark, sf_dir, tmp_path, monkeypatch):
    import glob

    import pyarrow.parquet as pq

    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.shuffle.partitions": "32",
             "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k"}
    monkeypatch.setattr(FT, "INVOICES_PER_FILE", 64)
    old = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        res = run_pipeline(spark, fixture_sources(spark, sf_dir), FIXTURE_CONFIG, str(tmp_path), publish=False)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lo, hi = L.month_sk_range(res.cfg, *L.month_of(FIXTURE_CONFIG.ds))
    spans = []
    for f in glob.glob(f"{res.run_root}/warehouse/fato_venda/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = meta.schema.names.index("sk_tempo")
        spans += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    assert len(spans) >= 4
    assert sum(s.min <= hi and s.max >= lo for s in spans) <= len(spans) / 2


def test_a_hot_day_is_dealt_over_several_files(spark, monkeypatch):
    """A third of the invoices on one day, some without a calendar day: slots follow the days and share the rows."""
    monkeypatch.setattr(FT, "INVOICES_PER_FILE", 100)
    cfg = FIXTURE_CONFIG.with_(calendar_start=date(2020, 1, 1), calendar_end=date(2020, 3, 31))
    day = F.when(F.col("id") < 300, F.lit(45)).when(F.col("id") < 330, F.lit(-400)).otherwise(F.col("id") % 91).cast("int")
    nf = spark.range(900).select("id", F.date_add(F.lit(cfg.calendar_start), day).cast("timestamp").alias("data_venda"))
    slots, n = FT.day_slots(nf, cfg)
    assert n == min(9, int(spark.conf.get("spark.sql.shuffle.partitions"))) and slots[0][0] == 0
    assert all(0 <= first and first + k <= n and k >= 1 for _, first, k in slots)
    fact = nf.select(F.when(day >= 0, day + 1).alias("sk_tempo"), F.col("id").alias("id_nota"))
    dealt = FT.by_day(fact, slots, n).withColumn("p", F.spark_partition_id())
    per = {r["p"]: r for r in dealt.groupBy("p").agg(F.count("*").alias("n"), F.min("sk_tempo").alias("lo"), F.max("sk_tempo").alias("hi")).collect()}
    assert sum(r["n"] for r in per.values()) == 900 and max(r["n"] for r in per.values()) <= 2 * 900 // n
    spans = [(per[p]["lo"], per[p]["hi"]) for p in sorted(per) if per[p]["lo"] is not None]
    assert all(a[1] <= b[1] and a[0] <= b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert FT.by_day(fact.limit(0), *FT.day_slots(nf.limit(0), cfg)).count() == 0
