"""One test per hazard of the original job's semantics (nulls, ties, zero
divisors, colliding ids, dates off the calendar, homonymous cities, bands,
overflow, money formatting)."""

from datetime import date
from decimal import Decimal as Dm

import pytest
from pyspark.sql import functions as F

from martforge.functions import format as FM
from martforge.functions import measures as MS
from martforge.operators import quality as Q
from martforge.operators.sinks import nan_to_null
from martforge.plans import dims as D
from martforge.plans import fact as FT
from martforge.plans import marts as M
from martforge.plans import reports as R
from martforge.sources.tables import SourceTables
from tests import frames as X


def _one(df, col):
    return [r[col] for r in df.collect()]


def test_null_location_keys_leave_the_location_mart(spark):
    cal = D.dim_tempo(spark, X.CFG)
    loc = X.localidade(spark, [(1, "AA", "Estado A", "C1"), (2, None, None, None),
                               (3, "AA", "Estado A", None)])
    fact = X.fact_rows(spark, [(10, 1, 1, "10.00", "9.00"), (10, 2, 2, "5.00", "5.00"),
                               (10, 3, 3, "1.00", "1.00"), (10, None, 4, "2.00", "2.00")])
    vl = M.vendas_localidade(fact, cal, loc, X.CFG).collect()
    assert [(r["cidade"], r["qtde_vendida"]) for r in vl] == [("C1", 1)]
    va = M.vendas_ano_mes(fact, cal, X.CFG).collect()
    assert va[0]["qtde_vendida"] == 10          # the monthly mart keeps every sale


def test_all_null_group_sums_to_zero(spark):
    cal = D.dim_tempo(spark, X.CFG)
    fact = X.fact_rows(spark, [(40, None, 1, None, None), (41, None, 2, None, None)])
    row = M.vendas_ano_mes(fact, cal, X.CFG).collect()[0]
    assert row["valor_total_real"] == Dm("0.00") and row["valor_total_esperado"] == Dm("0.00")


def test_dates_off_calendar_get_no_key_and_leave_the_marts(spark):
    cal = D.dim_tempo(spark, X.CFG)
    nf = spark.createDataFrame(
        [(1, "2019-12-31 10:00:00", 7, None), (2, "2020-01-01 00:00:00", 7, None),
         (3, "2021-01-01 00:00:00", 7, None)],
        "id long, data_venda string, id_cliente long, id_vendedor long",
    ).withColumn("data_venda", F.to_timestamp("data_venda"))
    empty = spark.createDataFrame([], "id long, sk long")
    dims = {"dim_tempo": cal,
            "dim_cliente": spark.createDataFrame([], "sk_cliente long, id_pessoa long"),
            "dim_localidade": spark.createDataFrame([], "sk_localidade long, id_pessoa long"),
            "dim_vendedor": spark.createDataFrame([], "sk_vendedor long, id_pessoa long")}
    src = _src(spark, nota_fiscal=nf)
    hdr = {r["id_nota"]: r["sk_tempo"] for r in FT.resolved_headers(
        src, dims["dim_tempo"], FT.person_lookup(dims["dim_cliente"], dims["dim_localidade"]),
        dims["dim_vendedor"]).collect()}
    assert hdr == {1: None, 2: 1, 3: None}
    del empty


def test_best_month_tie_picks_the_earliest_month(spark):
    v = X.vam(spark, [(2020, 3, 1, "50.00", "1.00"), (2020, 7, 1, "50.00", "1.00"),
                      (2020, 1, 1, "10.00", "1.00")])
    row = R.best_month(v).collect()[0]
    assert (row["mes"], row["nome_mes"]) == (3, "Mar")
    k = R.kpi_cards(v).collect()[0]
    assert k["melhor_mes"] == "Mar" and k["melhor_fmt"] == "R$ 50.00"


def test_zero_and_null_divisors(spark):
    df = spark.createDataFrame([(Dm("5.00"), Dm("0.00"), 0), (Dm("0.00"), Dm("0.00"), 0),
                                (None, None, None)], "r decimal(18,2), e decimal(18,2), q long")
    got = df.select(MS.attainment_pct(F.col("r"), F.col("e")).alias("a"),
                    MS.guarded_pct(F.col("r"), F.col("e")).alias("g"),
                    MS.avg_ticket(F.col("r"), F.col("q")).alias("t")).collect()
    assert [r["a"] for r in got] == [None, None, None]
    assert [r["g"] for r in got] == [0.0, 0.0, 0.0]
    assert [r["t"] for r in got] == [0.0, 0.0, 0.0]


def test_same_id_in_both_customer_types_fans_out_and_is_reported(spark):
    nf = spark.createDataFrame([(1, None, 5, None)],
                               "id long, data_venda timestamp, id_cliente long, id_vendedor long")
    pf = spark.createDataFrame([(5, "Ana", "00000000005")], "id long, nome string, cpf string")
    pj = spark.createDataFrame([(5, "Ana Ltda", "00000000000005")],
                               "id long, razao_social string, cnpj string")
    src = _src(spark, nota_fiscal=nf, pessoa_fisica=pf, pessoa_juridica=pj)
    dc = D.dim_cliente(src)
    assert sorted(_one(dc, "tipo_cliente")) == ["Pessoa Fisica", "Pessoa Juridica"]
    assert sorted(_one(dc, "sk_cliente")) == [1, 2]
    dup = Q.duplicate_keys({"dim_cliente": (dc, ["id_pessoa"])}).collect()[0]
    assert dup["chaves_duplicadas"] == 1


def test_homonymous_cities_merge_in_the_city_ranking(spark):
    v = X.vloc(spark, [(2020, "AA", "A", "Lima", "10.00", "10.00"),
                       (2020, "BB", "B", "Lima", "5.00", "10.00"),
                       (2020, "BB", "B", "Rio", "12.00", "10.00")])
    cities = {r["cidade"]: r["valor_total_real"] for r in R.top_cities(v).collect()}
    assert cities == {"Lima": Dm("15.00"), "Rio": Dm("12.00")}
    states = {r["sigla_estado"]: r["valor_total_real"] for r in R.top_states(v).collect()}
    assert states == {"AA": Dm("10.00"), "BB": Dm("17.00")}


def test_top_k_ties_keep_key_order_and_one_row_intensity(spark):
    v = X.vloc(spark, [(2020, s, s, s, "10.00", "10.00") for s in ("CC", "AA", "BB")])
    top2 = R.top_states(v, k=2).collect()
    assert sorted(r["sigla_estado"] for r in top2) == ["AA", "BB"]
    one = R.top_states(v, k=1).collect()
    assert [(r["sigla_estado"], r["intensidade"], r["posicao"]) for r in one] == [("AA", "0.45", 0)]
    three = R.top_states(v, k=3).collect()
    assert sorted(r["intensidade"] for r in three) == ["0.45", "0.73", "1.00"]
    ten = X.vloc(spark, [(2020, f"S{i}", "e", "c", f"{i}.00", "1.00") for i in range(1, 11)])
    got = sorted(R.top_states(ten, k=10).collect(), key=lambda r: r["posicao"])
    assert [r["intensidade"] for r in got] == ["0.45", "0.51", "0.57", "0.63", "0.69", "0.76",
                                               "0.82", "0.88", "0.94", "1.00"]


@pytest.mark.parametrize("pct,band", [(84.9, "red"), (85.0, "yellow"), (99.9, "yellow"),
                                      (100.0, "green"), (None, None)])
def test_attainment_bands(spark, pct, band):
    df = spark.createDataFrame([(pct,)], "p double")
    assert df.select(FM.attainment_band(F.col("p")).alias("b")).first()["b"] == band


def test_discount_pct_overflow_is_null_or_raises(spark):
    df = spark.createDataFrame([(Dm("21.00"), Dm("1.00"))], "v decimal(18,2), u decimal(18,2)")
    d = MS.discount(F.col("v"), F.col("u"))
    assert df.select(MS.discount_pct(d, F.col("u")).alias("p")).first()["p"] is None
    with pytest.raises(Exception):
        df.select(MS.discount_pct(d, F.col("u"), strict=True).alias("p")).collect()


@pytest.mark.parametrize("value,text", [
    (999.99, "R$ 999.99"), (999.999, "R$ 1,000.00"), (1000.0, "R$ 1.0K"),
    (999999.0, "R$ 1000.0K"), (1000000.0, "R$ 1.00M"), (1234567890.0, "R$ 1234.57M"),
    (-1500.0, "R$ -1.5K"), (-5.5, "R$ -5.50"), (1250.0, "R$ 1.2K"), (0.0, "R$ 0.00"),
])
def test_money_bands(spark, value, text):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(FM.fmt_money(F.col("v")).alias("t")).first()["t"] == text


def test_integer_and_percent_text(spark):
    df = spark.createDataFrame([(1234567.9, 2.5, 97.25)], "q double, a double, b double")
    r = df.select(FM.fmt_int_dot(F.col("q")).alias("q"), FM.fmt_pct(F.col("a"), 0).alias("a"),
                  FM.fmt_pct(F.col("b"), 1).alias("b")).first()
    assert (r["q"], r["a"], r["b"]) == ("1.234.567", "2%", "97.2%")


def test_month_label_outside_range_is_null(spark):
    df = spark.createDataFrame([(0,), (1,), (12,), (13,)], "m int")
    assert _one(df.select(FM.month_label(F.col("m")).alias("n")), "n") == [None, "Jan", "Dez", None]


def test_default_year_of_an_empty_mart_has_no_row(spark):
    empty = X.vam(spark, [])
    assert R.default_year(empty).collect() == []
    v = X.vam(spark, [(2019, 1, 1, "1.00", "1.00"), (2021, 1, 1, "1.00", "1.00")])
    assert R.default_year(v).first()["ano"] == 2021


def test_kpi_labels(spark):
    v = X.vam(spark, [(2020, 1, 1000, "1500000.00", "1000000.00"),
                      (2020, 2, 234, "10.00", "600000.00")])
    k = R.kpi_cards(v).first()
    assert k["receita_fmt"] == "R$ 1.50M"
    assert k["desvio_fmt"] == "▼ R$ 100.0K vs meta"      # 99.99 rounds to 100.0
    assert k["qtde_fmt"] == "1.234"
    assert k["meta_label"] == "abaixo da meta" and k["pct_fmt"] == "93.8%"


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert _one(nan_to_null(df), "x") == [None, 2.0]


def test_add_column_if_absent(spark):
    df = spark.createDataFrame([(1,)], "a int")
    out = M.add_column_if_absent(df, "data_atualizacao", "date", F.lit(date(2021, 1, 1)))
    assert out.first()["data_atualizacao"] == date(2021, 1, 1)
    again = M.add_column_if_absent(out, "data_atualizacao", "date")
    assert again.columns == ["a", "data_atualizacao"]


def test_validation_report_statuses(spark):
    counts = Q.counts_frame(spark, {"dim_cliente": 0, "vendas_localidade": 0, "fato_venda": 3})
    rep = {r["tabela"]: r["status"] for r in Q.validation_report(counts).collect()}
    assert rep == {"dim_cliente": "FAIL", "vendas_localidade": "WARN", "fato_venda": "OK"}
    with pytest.raises(Q.ValidationError):
        Q.assert_valid(Q.validation_report(counts))


def _src(spark, **over):
    empty = {
        "nota_fiscal": "id long, data_venda timestamp, id_cliente long, id_vendedor long",
        "item_nota_fiscal": "id_nota_fiscal long, id_produto long, quantidade int, "
                            "valor_unitario decimal(18,2), valor_venda_real decimal(18,2)",
        "produto": "id long, nome string, valor_venda decimal(18,2), id_categoria int",
        "categoria": "id int, descricao string",
        "pessoa_fisica": "id long, nome string, cpf string",
        "pessoa_juridica": "id long, razao_social string, cnpj string",
        "endereco": "id long, id_pessoa long, rua string, numero string, complemento string, "
                    "cep string, id_bairro int",
        "bairro": "id int, descricao string, id_cidade int",
        "cidade": "id int, descricao string, id_estado int",
        "estado": "id int, descricao string, sigla string",
    }
    return SourceTables(**{k: over.get(k, spark.createDataFrame([], v)) for k, v in empty.items()})


def test_create_if_absent(spark, tmp_uri):
    from martforge.operators.sinks import create_if_absent
    from martforge.operators.versions import read_table
    from martforge.schemas import VENDAS_ANO_MES

    path = f"{tmp_uri}/mart"
    assert create_if_absent(spark, path, VENDAS_ANO_MES) is True
    assert create_if_absent(spark, path, VENDAS_ANO_MES) is False
    df = read_table(spark, path)
    assert df.count() == 0 and df.columns == VENDAS_ANO_MES.fieldNames()


def test_full_refresh_keeps_the_table_schema(spark, tmp_uri):
    from martforge.operators.sinks import full_refresh, replace_table
    from martforge.operators.versions import read_table
    from martforge.schemas import DIM_VENDEDOR

    path = f"{tmp_uri}/dim"
    replace_table(spark.createDataFrame([(1, 10, "a")], "sk_vendedor int, id_pessoa int, nome string"),
                  path, DIM_VENDEDOR)
    newer = spark.createDataFrame([(2, "b", 7)], "id_pessoa long, nome string, extra int")
    assert full_refresh(newer, path) == 1
    back = read_table(spark, path)
    assert back.schema == read_table(spark, path).schema
    assert back.columns == ["sk_vendedor", "id_pessoa", "nome"]
    assert [tuple(r) for r in back.collect()] == [(None, 2, "b")]


def test_append_skips_empty_input(spark, tmp_uri):
    from martforge.operators.sinks import append_table
    from martforge.operators.versions import is_versioned

    path = f"{tmp_uri}/empty"
    assert append_table(spark.createDataFrame([], "a int"), path) == 0
    assert not is_versioned(spark, path)


def test_null_customer_never_matches_a_null_address_owner(spark):
    """SQL join semantics: an address without owner is not attached to sales
    without customer (a pandas merge would match NULL to NULL)."""
    nf = spark.createDataFrame([(1, None, None, None)],
                               "id long, data_venda timestamp, id_cliente long, id_vendedor long")
    loc = spark.createDataFrame([(1, None)], "sk_localidade long, id_pessoa long")
    empty = lambda sk: spark.createDataFrame([], f"{sk} long, id_pessoa long")
    hdr = FT.resolved_headers(_src(spark, nota_fiscal=nf), D.dim_tempo(spark, X.CFG),
                              FT.person_lookup(empty("sk_cliente"), loc), empty("sk_vendedor")).collect()
    assert [(r["id_nota"], r["sk_localidade"]) for r in hdr] == [(1, None)]


def test_ratios_round_half_up_and_money_stays_exact(spark):
    # 1.25 / 1 * 100 = 125.0 exactly; 0.125 -> 12.5 -> one decimal half-up = 12.5
    df = spark.createDataFrame([(Dm("97.25"), Dm("100.00")), (Dm("0.125"), Dm("1.000"))],
                               "r decimal(18,3), e decimal(18,3)")
    got = [r["p"] for r in df.select(MS.attainment_pct(F.col("r"), F.col("e"), 0).alias("p")).collect()]
    assert got == [97.0, 13.0]          # 97.25 -> 97, 12.5 -> 13 (half-up, not half-even)
    d = spark.createDataFrame([(Dm("10.005"), Dm("0.001"))], "a decimal(18,3), b decimal(18,3)")
    assert d.select(MS.discount(F.col("a"), F.col("b")).alias("x")).first()["x"] == Dm("10.00")
