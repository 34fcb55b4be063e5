"""Steps that must not grow faster than the tables: what is read, run and kept in memory."""

from dataclasses import replace
from datetime import date

from pyspark.sql import functions as F

from martforge import queries as Q
from martforge import session
from martforge.config import FIXTURE_CONFIG
from martforge.operators.keys import first_per_key
from martforge.operators.versions import VersionedTable
from martforge.plans import dims as D
from martforge.plans import incremental as I
from martforge.sources.fixture import fixture_sources
from tests.test_hazards import _src as sources


def test_sources_alone_start_no_run(spark, sf_dir, monkeypatch):
    def never(*a, **k):
        raise AssertionError("a run was started")

    Q.reset_registry()
    monkeypatch.setattr(Q, "run_pipeline", never)
    assert Q.q_customers_with_sales(spark, sf_dir).count() > 0
    assert Q.q_stable_keys_two_runs(spark, sf_dir).count() == Q.q_customers_with_sales(spark, sf_dir).count()
    assert Q.q_day_sums(spark, sf_dir).count() > 0
    Q.reset_registry()


def test_first_address_flattens_one_address_of_a_person(spark):
    rows = [(3, 1, "c"), (2, 1, "b"), (2, 1, "a"), (None, 2, "z"), (1, 2, "y"), (9, None, "p"), (8, None, "q"), (5, 3, None)]
    addresses = spark.createDataFrame(rows, "id long, id_pessoa long, rua string").selectExpr(
        "id", "id_pessoa", "rua", "'1' AS numero", "CAST(NULL AS string) AS complemento", "'0' AS cep", "CAST(NULL AS int) AS id_bairro")
    src = sources(spark, endereco=addresses)
    got = D.first_address(src)
    whole = first_per_key(D.address_flatten(src), "id_pessoa", ["id_endereco"])
    key = lambda r: (str(r.id_pessoa), str(r.id_endereco))
    assert sorted(got.collect(), key=key) == sorted(whole.collect(), key=key)
    assert {(r.id_pessoa, r.id_endereco, r.rua) for r in got.collect()} == {(1, 2, "a"), (2, None, "z"), (None, 8, "q"), (3, 5, None)}
    assert "left_semi" in got._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftsemi", "left_semi")


def test_tables_are_broadcast_by_their_rows(spark, tmp_path):
    import __spark_entry__

    __spark_entry__._prepare(spark)
    path = str(tmp_path / "ids")
    spark.range(0, 1_000_000).write.parquet(path)  # about 4 MB of files, 8 MB of values, 16 MB and more as rows
    other = spark.read.parquet(path).select((F.col("id") + 1).alias("id"))
    plan = spark.read.parquet(path).join(other, "id")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" not in plan


def test_days_of_ranges(spark):
    cfg = FIXTURE_CONFIG.with_(calendar_start=date(1996, 1, 10), calendar_end=date(1997, 2, 20))
    days = spark.range(-1, 500).select(F.when(F.col("id") >= 0, F.date_add(F.lit("1995-12-20").cast("date"), F.col("id").cast("int"))).alias("d"))
    for ranges in ({"1996-01"}, {"1996-01", "1996-02", "1996-12", "1997-02"}, {I.NONE}, {"1996-12", "1997-01", I.NONE}):
        want = days.filter(I.range_of(F.col("d"), cfg).isin(sorted(ranges)))
        assert sorted(map(str, days.filter(I.in_ranges(F.col("d"), ranges, cfg)).collect())) == sorted(map(str, want.collect()))


def test_items_of_a_changed_month_are_filtered_before_they_are_shuffled(spark, tmp_path, monkeypatch):
    from martforge import session

    monkeypatch.setattr(session, "KEY_FILTER_BYTES", 1)
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold")}
    rows = spark.range(2000)
    rows.selectExpr("id", "timestamp'1996-01-01' + make_interval(0, 0, 0, id % 700) AS data_venda", "id AS id_cliente",
                    "id AS id_vendedor").write.parquet(f"{tmp_path}/nf")
    rows.selectExpr("id AS id_nota_fiscal", "id AS id_produto", "1 AS quantidade").write.parquet(f"{tmp_path}/items")
    src = sources(spark, nota_fiscal=spark.read.parquet(f"{tmp_path}/nf"), item_nota_fiscal=spark.read.parquet(f"{tmp_path}/items"))
    cfg = FIXTURE_CONFIG.with_(calendar_start=date(1996, 1, 1), calendar_end=date(1997, 12, 31))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = I.restricted(src, {"1996-03"}, cfg).item_nota_fiscal
        with session.key_filters(spark):
            plan = items._jdf.queryExecution().optimizedPlan().toString()
            assert {r.id_nota_fiscal % 700 for r in items.collect()} == set(range(60, 91))
        assert "might_contain" in plan
        assert spark.conf.get("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold") == before[
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before["spark.sql.autoBroadcastJoinThreshold"])


def test_discounts_are_computed_after_the_fact_is_shuffled(spark, sf_dir, tmp_path, monkeypatch):
    plans, write = [], VersionedTable.write_ranges

    def kept(table, df, column, **k):
        if "desconto" in df.columns:
            plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(table, df, column, **k)

    monkeypatch.setattr(VersionedTable, "write_ranges", kept)
    I.update(spark, fixture_sources(spark, sf_dir), FIXTURE_CONFIG, str(tmp_path))
    (plan,) = plans
    above, below = plan.split("RebalancePartitions", 1)
    assert "AS desconto" in above and "AS pct_desconto" in above and "desconto" not in below


def test_fact_of_many_months_is_computed_in_groups(spark, sf_dir, tmp_path, monkeypatch):
    """Each group's items alone are shuffled, and neither they nor shuffle files stay; rows are those of the whole."""
    src, root = fixture_sources(spark, sf_dir), f"{tmp_path}/s"
    twice = src.nota_fiscal.filter("id % 50 = 0").withColumn("data_venda", F.col("data_venda") + F.expr("INTERVAL 700 DAYS"))
    bare = src.nota_fiscal.filter("id % 70 = 0").withColumn("data_venda", F.lit(None).cast(src.nota_fiscal.schema["data_venda"].dataType))
    src = replace(src, nota_fiscal=src.nota_fiscal.unionByName(twice).unionByName(bare))
    cfg = FIXTURE_CONFIG.with_(calendar_start=date(1995, 6, 1), calendar_end=date(2000, 12, 31))
    I.update(spark, src, cfg, f"{tmp_path}/whole")
    writes, folders, write, new_folder = [], [], VersionedTable.write_ranges, I.scratch_dir

    def kept(table, df, column, **k):
        if "desconto" in df.columns:
            (folder,) = folders
            assert spark.conf.get(session.CLEANUP) == "true"
            writes.append({e.name for e in session.folder_entries(spark, folder) if "=" in e.name})
        return write(table, df, column, **k)

    def scratch(spark, label):
        path = new_folder(spark, label)
        folders.extend([path] if label == "update-items" else [])
        return path

    monkeypatch.setattr(I, "GROUP_ITEMS", 1000)
    monkeypatch.setattr(I, "scratch_dir", scratch)
    monkeypatch.setattr(VersionedTable, "write_ranges", kept)
    before = spark.conf.get(session.CLEANUP)
    made = I.update(spark, src, cfg, root)
    assert len(writes) == 6 and I.NONE in made.ranges and "2000-12" in made.ranges
    assert any(int(n.split("=")[1]).bit_count() == 2 for n in writes[0]) and all(a > b for a, b in zip(writes, writes[1:], strict=False))
    assert not session.path_exists(spark, folders[0]) and spark.conf.get(session.CLEANUP) == before
    for name in ("fato_venda", "day_sums", "vendas_ano_mes", "vendas_localidade"):
        was, now = (sorted(map(str, I.Store(spark, r).read(name).collect())) for r in (f"{tmp_path}/whole", root))
        assert was and was == now, name
