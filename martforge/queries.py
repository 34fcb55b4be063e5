"""Registry of every operator/data product as (Spark plan, oracle SQL).

Each Spark entry is ``fn(spark, sf_dir) -> DataFrame`` and reads the driver
tables through the fixture sources, so its work grows with the data. The
matching SQL (DuckDB dialect) rebuilds everything from the same driver
tables. Keys without SQL are write/read round trips whose SQL is the SELECT
of the rows written.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from dataclasses import replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martforge import oracle_sql as O
from martforge.config import FIXTURE_CONFIG, PipelineConfig
from martforge.functions import format as FM
from martforge.functions.measures import (attainment_pct, avg_ticket, discount, discount_pct,
                                          pct_overflowed)
from martforge.operators import quality as Q
from martforge.operators import sinks as K
from martforge.operators.keys import dense_key
from martforge.operators.keymap import extend_key_map, with_stable_key
from martforge.operators.versions import VersionedTable, read_table
from martforge.plans import dims as D
from martforge.plans import fact as FT
from martforge.plans import incremental as I
from martforge.plans import lake as L
from martforge.plans import marts as M
from martforge.plans import reports as R
from martforge.plans.pipeline import RunResult, run_pipeline, stage_sources
from martforge.schemas import DIM_LOCALIDADE, DIM_PRODUTO, DIM_VENDEDOR, PCT_ATTAINMENT
from martforge.session import input_state, scratch_dir, written
from martforge.sources.fixture import (fixture_sources, list_value, read_driver_table,
                                       realised_value)
from martforge.sources.tables import SourceTables

# Fixed parameters of the registered queries.
H10_CALENDAR = dict(calendar_start=date(1996, 1, 1), calendar_end=date(2000, 12, 31))
SELECTED_YEARS = (1996, 1997)
EMPTY_MONTH = (2005, 1)
#: The first of two updates lacks the items of a fifth of this month's invoices; the first key map has the customers until a day.
LATE_MONTH = "1998-03"
FIRST_KEYS_BEFORE = "1997-01-01"
SECOND_MONTH = (1998, 7)


class Warehouse:
    """The sources of a folder of tables and the tables made of them, each on first use.

    The sources read more than once are written first; what needs sources alone starts no run. The run is the benchmarked one
    (``run_pipeline``, unpublished), made from these sources into a folder under the session's shared checkpoint
    directory; a registered product is a table that it wrote, or a plan over such tables.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: PipelineConfig = FIXTURE_CONFIG):
        self.spark, self._sf_dir, self._cfg = spark, sf_dir, cfg
        self._src: SourceTables | None = None
        self._addressed: SourceTables | None = None
        self._run: RunResult | None = None
        self._store: I.Store | None = None
        self._lock = threading.RLock()

    @property
    def run(self) -> RunResult:
        with self._lock:
            if self._run is None:
                self._run = run_pipeline(self.spark, self.with_addresses, self._cfg, scratch_dir(self.spark, "registry"),
                                         stage=False, publish=False)
            return self._run

    @property
    def src(self) -> SourceTables:
        with self._lock:
            if self._src is None:
                self._src = stage_sources(fixture_sources(self.spark, self._sf_dir), scratch_dir(self.spark, "registry-sources"),
                                          ("nota_fiscal", "produto"))
            return self._src

    @property
    def with_addresses(self) -> SourceTables:
        """The sources with the addresses, the costliest one, written too."""
        with self._lock:
            if self._addressed is None:
                self._addressed = stage_sources(self.src, scratch_dir(self.spark, "registry-sources"), ("endereco",))
            return self._addressed

    @property
    def cfg(self) -> PipelineConfig:
        return self.run.cfg

    @property
    def dims(self) -> dict[str, DataFrame]:
        return {n: self.run.table(self.spark, n) for n in ("dim_tempo", *D.KEYED_DIMENSIONS)}

    @property
    def fact(self) -> DataFrame:
        return self.run.table(self.spark, "fato_venda")

    @property
    def vam(self) -> DataFrame:
        return self.run.table(self.spark, "vendas_ano_mes")

    @property
    def vloc(self) -> DataFrame:
        return self.run.table(self.spark, "vendas_localidade")

    @property
    def updated(self) -> I.Store:
        """Tables after two updates: one without the late items, one with them."""
        with self._lock:
            if self._store is None:
                src = self.with_addresses
                root = scratch_dir(self.spark, "registry-updates")
                late = src.nota_fiscal.filter((F.date_format("data_venda", "yyyy-MM") == LATE_MONTH) & (F.col("id") % 5 == 0))
                # Only items of every fifth invoice can be late: the others need no join.
                items, fifth = src.item_nota_fiscal, F.coalesce(F.col("id_nota_fiscal") % 5 == 0, F.lit(False))
                items = items.filter(~fifth).unionByName(items.filter(fifth).join(
                    late.select(F.col("id").alias("_late")), F.col("_late") == F.col("id_nota_fiscal"), "left_anti"))
                I.update(self.spark, replace(src, item_nota_fiscal=items), self._cfg, root, stage=False)
                second = I.update(self.spark, src, self._cfg, root, stage=False)
                if second.ranges - {LATE_MONTH}:
                    raise RuntimeError(f"the late items are of {LATE_MONTH}, but {sorted(second.ranges)} were computed again")
                self._store = I.Store(self.spark, root)
            return self._store

    def month(self) -> tuple[int, int]:
        return L.month_of(self._cfg.ds)

    def lake_month(self, ano: int | None = None, mes: int | None = None) -> DataFrame:
        y, m = (ano, mes) if ano is not None else self.month()
        d = self.dims
        return L.lake_month(self.fact, d["dim_tempo"], d["dim_localidade"], self.cfg, y, m)


_BUILT: dict[tuple, Warehouse] = {}
_BUILT_LOCK = threading.Lock()


def reset_registry() -> None:
    """Forget the tables built for earlier queries."""
    with _BUILT_LOCK:
        _BUILT.clear()


def _wh(spark: SparkSession, sf_dir: str, **cfg) -> Warehouse:
    """One warehouse per (session, state of the input files, parameters), reused by
    every registered query of that session while the input stays as it is."""
    key = (spark.conf.get("spark.app.id", None) or id(spark), input_state(spark, sf_dir),
           tuple(sorted(cfg.items())))
    with _BUILT_LOCK:
        return _BUILT.setdefault(key, Warehouse(spark, sf_dir, FIXTURE_CONFIG.with_(**cfg)))


# ---------------------------------------------------------------- SQL helpers

def _money_sql(x: str) -> str:
    v = f"CAST({x} AS DOUBLE)"
    return (f"CASE WHEN abs({v}) >= 1000000 THEN 'R$ ' || printf('%.2f', {v} / 1000000) || 'M' "
            f"WHEN abs({v}) >= 1000 THEN 'R$ ' || printf('%.1f', {v} / 1000) || 'K' "
            f"ELSE 'R$ ' || printf('%,.2f', {v}) END")


def _ratio_sql(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0) * 100)"


def _month_sql(m: str) -> str:
    return f"(['Jan','Fev','Mar','Abr','Mai','Jun','Jul','Ago','Set','Out','Nov','Dez'])[{m}]"


def _band_sql(p: str) -> str:
    return (f"(CASE WHEN {p} >= 100 THEN 'green' WHEN {p} >= 85 THEN 'yellow' "
            f"WHEN {p} IS NOT NULL THEN 'red' END)")


def _sign_sql(x: str) -> str:
    return f"(CASE WHEN {x} >= 0 THEN 'green' WHEN {x} IS NOT NULL THEN 'red' END)"


def _pct_text_sql(x: str, digits: int) -> str:
    return f"(printf('%.{digits}f', CAST({x} AS DOUBLE)) || '%')"


def _int_dot_sql(q: str) -> str:
    return f"replace(format('{{:,}}', CAST({q} AS BIGINT)), ',', '.')"


LAKE_SQL = """SELECT dt.data, f.quantidade, f.valor_unitario, f.valor_venda_real, dl.sigla_estado,
       dl.cidade, CAST(dt.ano AS INTEGER) AS ano, CAST(dt.mes AS INTEGER) AS mes
FROM fato_venda f JOIN dim_tempo dt ON dt.sk_tempo = f.sk_tempo
LEFT JOIN dim_localidade dl ON dl.sk_localidade = f.sk_localidade
WHERE dt.ano = {ano} AND dt.mes = {mes}"""


def _lake_sql(ano: int, mes: int) -> str:
    return LAKE_SQL.format(ano=ano, mes=mes)


FIX_MONTH = L.month_of(FIXTURE_CONFIG.ds)


# ------------------------------------------------------------- Spark queries

def q_scan_source(spark, sf):
    _wh(spark, sf).src.register(spark)
    return spark.sql("SELECT id, data_venda, id_cliente, id_vendedor FROM nota_fiscal")


def q_calendar_days(spark, sf):
    return _wh(spark, sf).dims["dim_tempo"].select("data")


def q_dim_tempo(spark, sf):
    return _wh(spark, sf).dims["dim_tempo"]


def q_dim_produto(spark, sf):
    return _wh(spark, sf).dims["dim_produto"]


def q_dim_cliente(spark, sf):
    return _wh(spark, sf).dims["dim_cliente"]


def q_dim_vendedor(spark, sf):
    return _wh(spark, sf).dims["dim_vendedor"]


def q_dim_localidade(spark, sf):
    return _wh(spark, sf).dims["dim_localidade"]


def q_customers_with_sales(spark, sf):
    return D.customers_with_sales(_wh(spark, sf).src)


def q_address_flatten(spark, sf):
    return D.address_flatten(_wh(spark, sf).src)


def q_first_address(spark, sf):
    return D.first_address(_wh(spark, sf).with_addresses)


def q_surrogate_key(spark, sf):
    nf = _wh(spark, sf).src.nota_fiscal.select("id", "id_cliente")
    return dense_key(nf, "sk_nota", ["id"])


def q_sales_lines(spark, sf):
    return FT.sales_lines(_wh(spark, sf).src)


def q_fact_discount(spark, sf):
    s = FT.sales_lines(_wh(spark, sf).src)
    return s.select("id_nota", "id_produto", "valor_venda", "valor_unitario",
                    discount(F.col("valor_venda"), F.col("valor_unitario")).alias("desconto"))


def q_fact_discount_pct(spark, sf):
    s = FT.sales_lines(_wh(spark, sf).src)
    d = discount(F.col("valor_venda"), F.col("valor_unitario"))
    return s.select("id_nota", "id_produto", "valor_unitario", d.alias("desconto"),
                    discount_pct(d, F.col("valor_unitario")).alias("pct_desconto"))


def q_fato_venda(spark, sf):
    return _wh(spark, sf).fact


def q_fact_sk_lookup(spark, sf):
    return _wh(spark, sf, **H10_CALENDAR).fact


def q_calendar_misses(spark, sf):
    f = _wh(spark, sf, **H10_CALENDAR).fact
    return f.agg(F.count_if(F.col("sk_tempo").isNull()).cast("bigint").alias("sem_calendario"),
                 F.count(F.lit(1)).cast("bigint").alias("linhas"))


def q_fact_null_keys(spark, sf):
    return FT.fact_null_keys(_wh(spark, sf).fact).select(
        F.col("nulos_sk_cliente").cast("bigint").alias("nulos_sk_cliente"),
        F.col("nulos_sk_localidade").cast("bigint").alias("nulos_sk_localidade"))


def q_fact_star_inner(spark, sf):
    w = _wh(spark, sf)
    return M.fact_star_inner(w.fact, w.dims["dim_tempo"], w.cfg)


def q_vendas_ano_mes(spark, sf):
    return _wh(spark, sf).vam


def q_vendas_localidade(spark, sf):
    return _wh(spark, sf).vloc


def q_mart_selected_years(spark, sf):
    return _wh(spark, sf, aggregation_years=SELECTED_YEARS).vam


def q_mart_add_column(spark, sf):
    w = _wh(spark, sf)
    old = M.vendas_localidade(w.fact, w.dims["dim_tempo"], w.dims["dim_localidade"], w.cfg,
                              stamp=False)
    return M.add_column_if_absent(old, "data_atualizacao", "date", M.run_stamp(w.cfg))


def q_lake_month(spark, sf):
    return _wh(spark, sf).lake_month()


def q_lake_month_write(spark, sf):
    w = _wh(spark, sf)
    root = scratch_dir(spark, "lake")
    L.write_lake(w.lake_month(), root)
    return L.read_lake_month(spark, root, *w.month())


def q_lake_month_scan(spark, sf):
    w = _wh(spark, sf)
    root = scratch_dir(spark, "lake")
    L.write_lake(w.lake_month(), root)
    L.write_lake(w.lake_month(*SECOND_MONTH), root)
    L.write_lake(w.lake_month(), root)          # same day again: replaces, never duplicates
    return L.read_lake_month(spark, root, *w.month())


def q_lake_write_fallback(spark, sf):
    w = _wh(spark, sf)
    # The primary lake is unreachable (a URI scheme no file system serves), so
    # the month lands in the fallback location.
    primary = "unreachable-lake://primary/vendas"
    fallback = scratch_dir(spark, "lake-fallback")
    wrote = L.write_lake_with_fallback(w.lake_month(), primary, fallback)
    rows = L.read_lake_month(spark, wrote.location, *w.month())
    return rows.withColumn("destino", F.lit("fallback" if wrote.location == fallback and wrote.reason else "primary"))


def q_rejected_lines(spark, sf):
    """The faulty lines that a run with a short calendar wrote beside its fact."""
    return _wh(spark, sf, **H10_CALENDAR).run.table(spark, "rejeitos")


def q_rejected_prices(spark, sf):
    """Faulty lines of the fact with every fourth invoice repriced at a thousandth."""
    w = _wh(spark, sf)
    unit = F.when(F.col("id_nota") % 4 == 0, (F.col("valor_unitario") / 1000).cast("decimal(18,2)")) \
        .otherwise(F.col("valor_unitario"))
    lines = w.fact.withColumns({"valor_unitario": unit, "_lista": F.col("valor_unitario") + F.col("desconto")})
    lines = lines.withColumn("desconto", discount(F.col("_lista"), F.col("valor_unitario")))
    lines = lines.withColumn("pct_desconto", discount_pct(F.col("desconto"), F.col("valor_unitario")))
    return FT.rejected_lines(lines)


def q_pct_overflow_counts(spark, sf):
    """What a run counts when percentages do not fit: every fourth invoice repriced
    at a thousandth, and the targets of the cities up to J at a five-thousandth."""
    w = _wh(spark, sf)
    unit = F.when(F.col("id_nota") % 4 == 0, (F.col("valor_unitario") / 1000).cast("decimal(18,2)")) \
        .otherwise(F.col("valor_unitario"))
    lines = w.fact.select("sk_cliente", "sk_localidade", "sk_tempo", unit.alias("valor_unitario"),
                          (F.col("valor_unitario") + F.col("desconto")).alias("lista"))
    off = discount(F.col("lista"), F.col("valor_unitario"))
    lines = lines.select("*", off.alias("desconto"), discount_pct(off, F.col("valor_unitario")).alias("pct_desconto"))
    target = F.when(F.col("cidade") < "J", (F.col("valor_total_esperado") / 5000).cast("decimal(18,2)")) \
        .otherwise(F.col("valor_total_esperado"))
    places = w.vloc.select("valor_total_real", target.alias("valor_total_esperado"))
    places = places.withColumn("pct_atingimento", attainment_pct(
        F.col("valor_total_real"), F.col("valor_total_esperado")).try_cast(PCT_ATTAINMENT))
    a = lines.agg(FT.fact_metrics()["pct_desconto_fora"].cast("bigint").alias("pct_desconto_fora"))
    b = places.agg(M.location_metrics()["pct_atingimento_fora"].cast("bigint").alias("pct_atingimento_fora"))
    return a.join(b, F.lit(True))


def q_surrogate_key_text(spark, sf):
    c = read_driver_table(spark, sf, "customer").select("c_name", "c_custkey")
    return dense_key(c, "sk_nome", ["c_name"])


def q_stable_keys_two_runs(spark, sf):
    """Customer keys after two runs: those of customers before FIRST_KEYS_BEFORE first, then the others'."""
    src, (_, sk, natural, _) = _wh(spark, sf).src, D.KEYED_DIMENSIONS["dim_cliente"]
    keys = VersionedTable(spark, scratch_dir(spark, "keys"))
    early = replace(src, nota_fiscal=src.nota_fiscal.filter(F.to_date("data_venda") < F.lit(FIRST_KEYS_BEFORE).cast("date")))
    extend_key_map(keys, written(D.customers_with_sales(early), "customers"), natural, sk)
    rows = written(D.customers_with_sales(src), "customers")
    return with_stable_key(keys, extend_key_map(keys, rows, natural, sk), rows, natural, sk).select(sk, *natural)


def q_fact_after_updates(spark, sf):
    return _wh(spark, sf).updated.read("fato_venda")


def q_ano_mes_after_updates(spark, sf):
    return _wh(spark, sf).updated.read("vendas_ano_mes")


def q_localidade_after_updates(spark, sf):
    return _wh(spark, sf).updated.read("vendas_localidade")


def q_day_sums(spark, sf):
    return _wh(spark, sf).updated.read("day_sums").select(
        "sk_tempo", "sk_localidade", F.col("_q").alias("quantidade"), F.col("_r").cast("decimal(18,2)").alias("valor_venda_real"),
        F.col("_e").cast("decimal(18,2)").alias("valor_unitario"))


def q_report_empty_year(spark, sf):
    w = _wh(spark, sf)
    frames = {}
    for label, ano in (("vazio", EMPTY_MONTH[0]), ("com_vendas", FIX_MONTH[0])):
        frames |= {f"top_states_{label}": R.top_states(w.vloc, ano), f"top_cities_{label}": R.top_cities(w.vloc, ano),
                   f"monthly_series_{label}": R.monthly_series(w.vam, ano), f"kpi_cards_{label}": R.kpi_cards(w.vam, ano)}
    return Q.table_counts(frames)


def q_sink_create_if_absent(spark, sf):
    path = scratch_dir(spark, "create")
    first = K.create_if_absent(spark, path, DIM_VENDEDOR)
    K.append_table(_wh(spark, sf).dims["dim_vendedor"], path, DIM_VENDEDOR)
    again = K.create_if_absent(spark, path, DIM_VENDEDOR)
    return read_table(spark, path).select("*", F.lit(first).alias("criada"), F.lit(again).alias("recriada"))


def q_sink_append(spark, sf):
    path = scratch_dir(spark, "append")
    dim = _wh(spark, sf).dims["dim_vendedor"]
    K.append_table(dim, path, DIM_VENDEDOR)
    K.append_table(dim, path, DIM_VENDEDOR)
    K.append_table(dim.limit(0), path, DIM_VENDEDOR)   # empty input: no-op
    return read_table(spark, path)


def q_sink_full_refresh(spark, sf):
    path = scratch_dir(spark, "refresh")
    dim = _wh(spark, sf).dims["dim_produto"]
    K.replace_table(dim, path, DIM_PRODUTO)
    K.full_refresh(dim, path)
    return read_table(spark, path)


def q_sink_replace(spark, sf):
    path = scratch_dir(spark, "replace")
    dim = _wh(spark, sf).dims["dim_localidade"]
    old = dim.select("sk_localidade", "id_pessoa", F.lit("v1").alias("versao_antiga"))
    K.replace_table(old, path, old.schema)
    K.replace_table(dim, path, DIM_LOCALIDADE)
    return read_table(spark, path)


def q_nan_to_null(spark, sf):
    c = read_driver_table(spark, sf, "customer")
    return K.nan_to_null(c.select("c_custkey", F.sqrt("c_acctbal").alias("raiz_saldo")))


def q_table_counts(spark, sf):
    w = _wh(spark, sf)
    dims = {n: w.dims[n] for n in ("dim_tempo", "dim_produto", "dim_cliente", "dim_vendedor",
                                   "dim_localidade")}
    return Q.table_counts({**dims, "fato_venda": w.fact, "lake_month": w.lake_month(),
                           "vendas_ano_mes": w.vam, "vendas_localidade": w.vloc})


def q_validation_report(spark, sf):
    return Q.validation_report(q_table_counts(spark, sf))


def q_dim_key_uniqueness(spark, sf):
    d = _wh(spark, sf).dims
    return Q.duplicate_keys({
        "dim_produto": (d["dim_produto"], ["id_produto"]),
        "dim_cliente": (d["dim_cliente"], ["id_pessoa"]),
        "dim_vendedor": (d["dim_vendedor"], ["id_pessoa"]),
        "dim_localidade": (d["dim_localidade"], ["id_pessoa"]),
    })


def q_guard_empty_month(spark, sf):
    w = _wh(spark, sf)
    a = Q.guard_empty_month(w.lake_month(), *w.month())
    b = Q.guard_empty_month(w.lake_month(*EMPTY_MONTH), *EMPTY_MONTH)
    return a.unionByName(b)


def q_monthly_series(spark, sf):
    return R.monthly_series(_wh(spark, sf).vam, all_years=True)


def q_monthly_by_year(spark, sf):
    return R.monthly_series(_wh(spark, sf).vam, ano=FIX_MONTH[0])


def q_years_available(spark, sf):
    return R.years_available(_wh(spark, sf).vam)


def q_default_year(spark, sf):
    return R.default_year(_wh(spark, sf).vam)


def q_best_month(spark, sf):
    return R.best_month(_wh(spark, sf).vam)


def q_kpi_cards(spark, sf):
    return R.kpi_cards(_wh(spark, sf).vam)


def q_top_states(spark, sf):
    return R.top_states(_wh(spark, sf).vloc, k=FIXTURE_CONFIG.top_states)


def q_top_states_k3(spark, sf):
    return R.top_states(_wh(spark, sf).vloc, k=3)


def q_state_rank_intensity(spark, sf):
    return R.state_rank_intensity(_wh(spark, sf).vloc, k=FIXTURE_CONFIG.top_states)


def q_top_cities(spark, sf):
    return R.top_cities(_wh(spark, sf).vloc, k=FIXTURE_CONFIG.top_cities)


def q_avg_ticket(spark, sf):
    g = _wh(spark, sf).vam.groupBy("ano").agg(
        F.sum("valor_total_real").alias("r"), F.sum("qtde_vendida").alias("q"))
    return g.select("ano", avg_ticket(F.col("r"), F.col("q")).alias("ticket_medio"))


def q_month_label(spark, sf):
    return _wh(spark, sf).vam.select("ano", "mes", FM.month_label(F.col("mes")).alias("nome_mes"))


def q_fmt_money(spark, sf):
    w = _wh(spark, sf)
    key = (F.col("ano") * 100 + F.col("mes")).cast("bigint")
    a = w.vam.select(F.lit("receita").alias("origem"), key.alias("chave"),
                     F.col("valor_total_real").alias("valor"))
    b = w.vam.select(F.lit("desvio").alias("origem"), key.alias("chave"),
                     (F.col("valor_total_real") - F.col("valor_total_esperado"))
                     .cast("decimal(18,2)").alias("valor"))
    c = w.dims["dim_produto"].select(F.lit("preco").alias("origem"), F.col("id_produto").alias("chave"),
                                     F.col("preco_tabela").alias("valor"))
    return a.unionByName(b).unionByName(c).withColumn("texto", FM.fmt_money(F.col("valor")))


def q_fmt_int_dot(spark, sf):
    return _wh(spark, sf).vam.select("ano", "mes", "qtde_vendida",
                                     FM.fmt_int_dot(F.col("qtde_vendida")).alias("qtde_fmt"))


def q_fmt_pct(spark, sf):
    m = R.monthly_series(_wh(spark, sf).vam, all_years=True)
    return m.select("ano", "mes", "pct_ating", FM.fmt_pct(F.col("pct_ating"), 1).alias("pct_1"),
                    FM.fmt_pct(F.col("pct_ating"), 0).alias("pct_0"))


def q_deviation_sign(spark, sf):
    m = R.monthly_series(_wh(spark, sf).vam, all_years=True)
    return m.select("ano", "mes", "desvio", FM.deviation_sign(F.col("desvio")).alias("status_desvio"),
                    FM.direction_label(F.col("desvio")).alias("direcao"))


def _shipping_groups(spark, sf) -> DataFrame:
    li = read_driver_table(spark, sf, "lineitem")
    part = read_driver_table(spark, sf, "part").select("p_partkey", "p_type")
    sup = read_driver_table(spark, sf, "supplier").select("s_suppkey", "s_nationkey")
    rows = (li.join(part, F.col("l_partkey") == F.col("p_partkey"))
            .join(sup, F.col("l_suppkey") == F.col("s_suppkey"))
            .select(F.year("l_shipdate").alias("ano_envio"), F.col("p_type").alias("tipo"),
                    F.col("s_nationkey").alias("nacao"), realised_value().alias("real"),
                    list_value().alias("esperado")))
    return rows.groupBy("ano_envio", "tipo", "nacao").agg(
        F.sum("real").cast("decimal(18,2)").alias("valor_total_real"),
        F.sum("esperado").cast("decimal(18,2)").alias("valor_total_esperado"))


def q_attainment_pct(spark, sf):
    g = _shipping_groups(spark, sf)
    return g.withColumn("pct", attainment_pct(F.col("valor_total_real"),
                                              F.col("valor_total_esperado"), 1))


def q_attainment_band(spark, sf):
    g = q_attainment_pct(spark, sf)
    return g.select("ano_envio", "tipo", "nacao", "pct", FM.attainment_band(F.col("pct")).alias("faixa"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "scan_source": q_scan_source,
    "calendar_days": q_calendar_days,
    "dim_tempo": q_dim_tempo,
    "dim_produto": q_dim_produto,
    "customers_with_sales": q_customers_with_sales,
    "dim_cliente": q_dim_cliente,
    "dim_vendedor": q_dim_vendedor,
    "address_flatten": q_address_flatten,
    "first_address": q_first_address,
    "dim_localidade": q_dim_localidade,
    "surrogate_key": q_surrogate_key,
    "surrogate_key_text": q_surrogate_key_text,
    "sales_lines": q_sales_lines,
    "fact_discount": q_fact_discount,
    "fact_discount_pct": q_fact_discount_pct,
    "fato_venda": q_fato_venda,
    "fact_sk_lookup": q_fact_sk_lookup,
    "calendar_misses": q_calendar_misses,
    "fact_null_keys": q_fact_null_keys,
    "pct_overflow_counts": q_pct_overflow_counts,
    "rejected_lines": q_rejected_lines,
    "rejected_prices": q_rejected_prices,
    "fact_star_inner": q_fact_star_inner,
    "vendas_ano_mes": q_vendas_ano_mes,
    "vendas_localidade": q_vendas_localidade,
    "mart_selected_years": q_mart_selected_years,
    "mart_add_column": q_mart_add_column,
    "lake_month": q_lake_month,
    "lake_month_write": q_lake_month_write,
    "lake_month_scan": q_lake_month_scan,
    "lake_write_fallback": q_lake_write_fallback,
    "sink_create_if_absent": q_sink_create_if_absent,
    "sink_append": q_sink_append,
    "sink_full_refresh": q_sink_full_refresh,
    "sink_replace": q_sink_replace,
    "stable_keys_two_runs": q_stable_keys_two_runs,
    "fact_after_updates": q_fact_after_updates,
    "ano_mes_after_updates": q_ano_mes_after_updates,
    "localidade_after_updates": q_localidade_after_updates,
    "day_sums": q_day_sums,
    "nan_to_null": q_nan_to_null,
    "table_counts": q_table_counts,
    "validation_report": q_validation_report,
    "dim_key_uniqueness": q_dim_key_uniqueness,
    "guard_empty_month": q_guard_empty_month,
    "monthly_series": q_monthly_series,
    "monthly_by_year": q_monthly_by_year,
    "years_available": q_years_available,
    "default_year": q_default_year,
    "best_month": q_best_month,
    "kpi_cards": q_kpi_cards,
    "top_states": q_top_states,
    "top_states_k3": q_top_states_k3,
    "state_rank_intensity": q_state_rank_intensity,
    "top_cities": q_top_cities,
    "report_empty_year": q_report_empty_year,
    "avg_ticket": q_avg_ticket,
    "month_label": q_month_label,
    "fmt_money": q_fmt_money,
    "fmt_int_dot": q_fmt_int_dot,
    "fmt_pct": q_fmt_pct,
    "deviation_sign": q_deviation_sign,
    "attainment_pct": q_attainment_pct,
    "attainment_band": q_attainment_band,
}


# ---------------------------------------------------------------- oracle SQL

def _top_sql(key: str, k: int, final: str) -> str:
    return f"""
, sel AS (SELECT * FROM vendas_localidade WHERE ano = (SELECT max(ano) FROM vendas_localidade))
, grp AS (SELECT {key}, CAST(coalesce(sum(valor_total_real), 0) AS DECIMAL(18,2)) AS valor_total_real,
                 CAST(coalesce(sum(valor_total_esperado), 0) AS DECIMAL(18,2)) AS valor_total_esperado
          FROM sel WHERE {key} IS NOT NULL GROUP BY {key})
, top AS (SELECT * FROM grp ORDER BY valor_total_real DESC NULLS LAST, {key} ASC LIMIT {k})
{final}"""


def _top_states_sql(k: int, cols: str | None = None) -> str:
    pct = f"round({_ratio_sql('valor_total_real', 'valor_total_esperado')}, 1)"
    final = f"""
, ranked AS (
  SELECT sigla_estado, valor_total_real, valor_total_esperado, {pct} AS pct,
         CAST(row_number() OVER (ORDER BY valor_total_real ASC NULLS FIRST, sigla_estado DESC) - 1
              AS INTEGER) AS posicao,
         count(*) OVER () AS n
  FROM top)
SELECT {cols or 'sigla_estado, valor_total_real, valor_total_esperado, pct, posicao, rotulo, intensidade'}
FROM (SELECT *, printf('%.2f', CAST(0.45 AS DOUBLE) + (CAST(0.55 AS DOUBLE) * CAST(posicao AS DOUBLE))
                       / CAST(greatest(n - 1, 1) AS DOUBLE)) AS intensidade,
             '  ' || {_money_sql('valor_total_real')} || '  ' || printf('%.0f', pct) || '%' AS rotulo
      FROM ranked) t"""
    return _ctes() + _top_sql("sigla_estado", k, final)


def _ctes(cfg: PipelineConfig = FIXTURE_CONFIG) -> str:
    return "WITH " + ",\n".join(O.sources_sql() + O.dims_sql(cfg) + O.fact_sql() + O.marts_sql(cfg))


def _rejected_sql(lines: str) -> str:
    """Lines with a null key or with a percentage above 999.99."""
    return f"""
, ln AS ({lines})
, pc AS (SELECT *, CAST(round(CAST(desconto AS DOUBLE) / CAST(NULLIF(valor_unitario, 0) AS DOUBLE) * 100, 2)
                        AS DECIMAL(38,2)) AS pct_calculado FROM ln)
, why AS (SELECT *, concat_ws(',', CASE WHEN sk_cliente IS NULL THEN 'nulos_sk_cliente' END,
                 CASE WHEN sk_localidade IS NULL THEN 'nulos_sk_localidade' END,
                 CASE WHEN sk_tempo IS NULL THEN 'sem_calendario' END,
                 CASE WHEN abs(pct_calculado) > 999.99 THEN 'pct_desconto_fora' END) AS motivos FROM pc)
SELECT sk_tempo, sk_produto, sk_cliente, sk_vendedor, sk_localidade, id_nota, quantidade, valor_unitario,
       valor_venda_real, desconto,
       CASE WHEN abs(pct_calculado) <= 999.99 THEN CAST(pct_calculado AS DECIMAL(5,2)) END AS pct_desconto,
       pct_calculado, motivos
FROM why WHERE motivos <> ''"""


def _monthly_cols() -> str:
    pct = f"round({_ratio_sql('valor_total_real', 'valor_total_esperado')}, 1)"
    dev = "CAST(valor_total_real - valor_total_esperado AS DECIMAL(18,2))"
    return (f"id, ano, mes, qtde_vendida, valor_total_real, valor_total_esperado, {dev} AS desvio, "
            f"{pct} AS pct_ating, {_month_sql('mes')} AS nome_mes, {_band_sql(pct)} AS status_ating, "
            f"{_sign_sql(dev)} AS status_desvio")


def _kpi_sql() -> str:
    pct = f"coalesce({_ratio_sql('receita_real', 'meta_esperada')}, 0)"
    ticket = ("coalesce(CAST(receita_real AS DOUBLE) / NULLIF(CAST(qtde_total AS DOUBLE), 0), 0)")
    dev = "CAST(receita_real - meta_esperada AS DECIMAL(18,2))"
    arrow = f"(CASE WHEN {dev} >= 0 THEN '▲' ELSE '▼' END)"
    return _ctes() + f"""
, sel AS (SELECT * FROM vendas_ano_mes WHERE ano = (SELECT max(ano) FROM vendas_ano_mes))
, best AS (SELECT ano, mes AS melhor_mes_num, valor_total_real AS melhor_valor FROM (
     SELECT *, row_number() OVER (PARTITION BY ano ORDER BY valor_total_real DESC, mes ASC) AS rn
     FROM sel) t WHERE rn = 1)
, g AS (SELECT ano, CAST(coalesce(sum(valor_total_real), 0) AS DECIMAL(18,2)) AS receita_real,
               CAST(coalesce(sum(valor_total_esperado), 0) AS DECIMAL(18,2)) AS meta_esperada,
               CAST(coalesce(sum(qtde_vendida), 0) AS BIGINT) AS qtde_total
        FROM sel GROUP BY ano)
, k AS (SELECT g.*, b.melhor_mes_num, b.melhor_valor, {dev} AS desvio_total, {pct} AS pct_geral,
               {ticket} AS ticket_medio
        FROM g JOIN best b ON b.ano = g.ano)
SELECT ano, receita_real, meta_esperada, qtde_total, desvio_total, pct_geral, ticket_medio,
       {_month_sql('melhor_mes_num')} AS melhor_mes, melhor_valor,
       {_money_sql('receita_real')} AS receita_fmt,
       {arrow} || ' ' || {_money_sql('abs(desvio_total)')} || ' vs meta' AS desvio_fmt,
       {_sign_sql('desvio_total')} AS desvio_cor,
       {_money_sql('meta_esperada')} AS meta_fmt,
       {_int_dot_sql('qtde_total')} AS qtde_fmt,
       'ticket médio ' || {_money_sql('ticket_medio')} AS ticket_fmt,
       {_pct_text_sql('pct_geral', 1)} AS pct_fmt,
       CASE WHEN pct_geral >= 100 THEN 'acima da meta' ELSE 'abaixo da meta' END AS meta_label,
       {_money_sql('melhor_valor')} AS melhor_fmt
FROM k"""


def _shipping_sql(final: str) -> str:
    return f"""WITH grp AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS ano_envio, p.p_type AS tipo, s.s_nationkey AS nacao,
         CAST(sum(CAST(CAST(l.l_extendedprice AS DECIMAL(12,2))
                  * CAST(1 - CAST(l.l_discount AS DECIMAL(5,2)) AS DECIMAL(5,2))
                  * CAST(1 + CAST(l.l_tax AS DECIMAL(5,2)) AS DECIMAL(5,2)) AS DECIMAL(18,2)))
              AS DECIMAL(18,2)) AS valor_total_real,
         CAST(sum(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS valor_total_esperado
  FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey
  JOIN supplier s ON s.s_suppkey = l.l_suppkey
  GROUP BY 1, 2, 3),
att AS (SELECT *, round({_ratio_sql('valor_total_real', 'valor_total_esperado')}, 1) AS pct FROM grp)
{final}"""


def oracle() -> dict[str, str]:
    fm, sm = FIX_MONTH, SECOND_MONTH
    h10 = FIXTURE_CONFIG.with_(**H10_CALENDAR)
    yrs = FIXTURE_CONFIG.with_(aggregation_years=SELECTED_YEARS)
    base = _ctes()
    money_rows = """
SELECT 'receita' AS origem, CAST(ano * 100 + mes AS BIGINT) AS chave, valor_total_real AS valor
FROM vendas_ano_mes
UNION ALL
SELECT 'desvio', CAST(ano * 100 + mes AS BIGINT),
       CAST(valor_total_real - valor_total_esperado AS DECIMAL(18,2)) FROM vendas_ano_mes
UNION ALL
SELECT 'preco', id_produto, preco_tabela FROM dim_produto"""
    counts = """
SELECT 'dim_tempo' AS tabela, CAST(count(*) AS BIGINT) AS linhas FROM dim_tempo
UNION ALL SELECT 'dim_produto', count(*) FROM dim_produto
UNION ALL SELECT 'dim_cliente', count(*) FROM dim_cliente
UNION ALL SELECT 'dim_vendedor', count(*) FROM dim_vendedor
UNION ALL SELECT 'dim_localidade', count(*) FROM dim_localidade
UNION ALL SELECT 'fato_venda', count(*) FROM fato_venda
UNION ALL SELECT 'lake_month', count(*) FROM (""" + _lake_sql(*fm) + """) lm
UNION ALL SELECT 'vendas_ano_mes', count(*) FROM vendas_ano_mes
UNION ALL SELECT 'vendas_localidade', count(*) FROM vendas_localidade"""
    sql = {
        "scan_source": base + "\nSELECT id, data_venda, id_cliente, id_vendedor FROM nota_fiscal",
        "calendar_days": base + "\nSELECT data FROM dim_tempo",
        "dim_tempo": base + "\nSELECT * FROM dim_tempo",
        "dim_produto": base + "\nSELECT * FROM dim_produto",
        "customers_with_sales": base + "\nSELECT * FROM cliente_rows",
        "dim_cliente": base + "\nSELECT * FROM dim_cliente",
        "dim_vendedor": base + "\nSELECT * FROM dim_vendedor",
        "address_flatten": base + "\nSELECT * FROM addr",
        "first_address": base + "\nSELECT * FROM first_addr",
        "dim_localidade": base + "\nSELECT * FROM dim_localidade",
        "surrogate_key": base + "\nSELECT CAST(row_number() OVER (ORDER BY id) AS BIGINT) AS sk_nota, id, "
                                "id_cliente FROM nota_fiscal",
        "surrogate_key_text": "SELECT CAST(row_number() OVER (ORDER BY c_name) AS BIGINT) AS sk_nome, c_name, "
                              "c_custkey FROM customer",
        "rejected_lines": _ctes(h10) + _rejected_sql("SELECT * FROM fato_venda"),
        "rejected_prices": base + """
, rp AS (SELECT *, CASE WHEN id_nota % 4 = 0
                THEN CAST(CAST(valor_unitario AS DECIMAL(28,8)) / 1000 AS DECIMAL(18,2)) ELSE valor_unitario END AS u
         FROM fato_venda)""" + _rejected_sql("""
  SELECT * EXCLUDE (valor_unitario, desconto, u), u AS valor_unitario,
         CAST(valor_unitario + desconto - u AS DECIMAL(18,2)) AS desconto FROM rp"""),
        "pct_overflow_counts": base + """
, l AS (SELECT valor_unitario + desconto AS lista, CASE WHEN id_nota % 4 = 0
               THEN CAST(CAST(valor_unitario AS DECIMAL(28,8)) / 1000 AS DECIMAL(18,2)) ELSE valor_unitario END AS u
        FROM fato_venda)
, p AS (SELECT abs(round(CAST(lista - u AS DOUBLE) / CAST(u AS DOUBLE) * 100, 2)) AS pct FROM l WHERE u <> 0)
, c AS (SELECT valor_total_real AS r, CASE WHEN cidade < 'J'
               THEN CAST(CAST(valor_total_esperado AS DECIMAL(28,8)) / 5000 AS DECIMAL(18,2))
               ELSE valor_total_esperado END AS e FROM vendas_localidade)
SELECT (SELECT count(*) FROM p WHERE pct > 999.99) AS pct_desconto_fora,
       (SELECT count(*) FROM c WHERE e <> 0 AND abs(round(CAST(r AS DOUBLE) / CAST(e AS DOUBLE) * 100, 1)) > 99999.9)
         AS pct_atingimento_fora""",
        "report_empty_year": base + "\n" + "\nUNION ALL ".join(
            f"SELECT '{name}_{label}' AS tabela, CAST(count(*) AS BIGINT) AS linhas FROM ({body.format(ano=ano)}) t"
            for label, ano in (("vazio", 2005), ("com_vendas", 1998))
            for name, body in (
                ("top_states", "SELECT DISTINCT sigla_estado FROM vendas_localidade WHERE ano = {ano} LIMIT 10"),
                ("top_cities", "SELECT DISTINCT cidade FROM vendas_localidade WHERE ano = {ano} LIMIT 20"),
                ("monthly_series", "SELECT mes FROM vendas_ano_mes WHERE ano = {ano}"),
                ("kpi_cards", "SELECT DISTINCT ano FROM vendas_ano_mes WHERE ano = {ano}"))),
        "sink_create_if_absent": base + "\nSELECT *, TRUE AS criada, FALSE AS recriada FROM dim_vendedor",
        "sales_lines": base + "\nSELECT * FROM sales_lines",
        "fact_discount": base + "\nSELECT id_nota, id_produto, valor_venda, valor_unitario, "
                                "CAST(valor_venda - valor_unitario AS DECIMAL(18,2)) AS desconto FROM sales_lines",
        "fact_discount_pct": base + """
SELECT id_nota, id_produto, valor_unitario, d AS desconto,
       TRY_CAST(round(CAST(d AS DOUBLE) / NULLIF(CAST(valor_unitario AS DOUBLE), 0) * 100, 2)
                AS DECIMAL(5,2)) AS pct_desconto
FROM (SELECT *, CAST(valor_venda - valor_unitario AS DECIMAL(18,2)) AS d FROM sales_lines) t""",
        "fato_venda": base + "\nSELECT * FROM fato_venda",
        "fact_sk_lookup": _ctes(h10) + "\nSELECT * FROM fato_venda",
        "calendar_misses": _ctes(h10) + "\nSELECT CAST(count(*) FILTER (WHERE sk_tempo IS NULL) AS BIGINT) "
                                        "AS sem_calendario, CAST(count(*) AS BIGINT) AS linhas FROM fato_venda",
        "fact_null_keys": base + "\nSELECT CAST(count(*) FILTER (WHERE sk_cliente IS NULL) AS BIGINT) AS "
                                 "nulos_sk_cliente, CAST(count(*) FILTER (WHERE sk_localidade IS NULL) AS "
                                 "BIGINT) AS nulos_sk_localidade FROM fato_venda",
        "fact_star_inner": base + "\nSELECT * FROM star",
        "vendas_ano_mes": base + "\nSELECT * FROM vendas_ano_mes",
        "vendas_localidade": base + "\nSELECT * FROM vendas_localidade",
        "mart_selected_years": _ctes(yrs) + "\nSELECT * FROM vendas_ano_mes",
        "mart_add_column": base + "\nSELECT * FROM vendas_localidade",
        "lake_month": base + "\n" + _lake_sql(*fm),
        "lake_month_write": base + "\n" + _lake_sql(*fm),
        "lake_month_scan": base + "\n" + _lake_sql(*fm),
        "lake_write_fallback": base + "\nSELECT *, 'fallback' AS destino FROM (" + _lake_sql(*fm) + ") t",
        "sink_append": base + "\nSELECT * FROM dim_vendedor UNION ALL SELECT * FROM dim_vendedor",
        "sink_full_refresh": base + "\nSELECT * FROM dim_produto",
        "sink_replace": base + "\nSELECT * FROM dim_localidade",
        "stable_keys_two_runs": base + f"""
, marked AS (
  SELECT c.tipo_cliente, c.id_pessoa, c.id_pessoa IN (
    SELECT id_cliente FROM nota_fiscal WHERE CAST(data_venda AS DATE) < DATE '{FIRST_KEYS_BEFORE}') AS early
  FROM dim_cliente c)
SELECT CAST(row_number() OVER (ORDER BY CASE WHEN early THEN 0 ELSE 1 END, tipo_cliente, id_pessoa) AS BIGINT) AS sk_cliente,
       tipo_cliente, id_pessoa FROM marked""",
        "fact_after_updates": base + "\nSELECT * FROM fato_venda",
        "ano_mes_after_updates": base + "\nSELECT * FROM vendas_ano_mes",
        "localidade_after_updates": base + "\nSELECT * FROM vendas_localidade",
        "day_sums": base + """
SELECT sk_tempo, sk_localidade, CAST(sum(quantidade) AS BIGINT) AS quantidade,
       CAST(sum(valor_venda_real) AS DECIMAL(18,2)) AS valor_venda_real,
       CAST(sum(valor_unitario) AS DECIMAL(18,2)) AS valor_unitario
FROM fato_venda WHERE sk_tempo IS NOT NULL GROUP BY sk_tempo, sk_localidade""",
        "nan_to_null": "SELECT c_custkey, CASE WHEN isnan(sqrt(c_acctbal)) THEN NULL "
                       "ELSE sqrt(c_acctbal) END AS raiz_saldo FROM customer",
        "table_counts": base + counts,
        "validation_report": base + f"""
, c AS ({counts})
SELECT tabela, coalesce(linhas, 0) AS linhas,
       CASE WHEN tabela IN ('dim_cliente', 'dim_localidade', 'vendas_ano_mes') AND coalesce(linhas, 0) = 0 THEN 'FAIL'
            WHEN tabela = 'vendas_localidade' AND coalesce(linhas, 0) = 0 THEN 'WARN' ELSE 'OK' END AS status
FROM c""",
        "dim_key_uniqueness": base + """
SELECT 'dim_produto' AS tabela, CAST(count(*) AS BIGINT) AS chaves_duplicadas
FROM (SELECT id_produto FROM dim_produto GROUP BY 1 HAVING count(*) > 1) a
UNION ALL SELECT 'dim_cliente', count(*) FROM (SELECT id_pessoa FROM dim_cliente GROUP BY 1 HAVING count(*) > 1) b
UNION ALL SELECT 'dim_vendedor', count(*) FROM (SELECT id_pessoa FROM dim_vendedor GROUP BY 1 HAVING count(*) > 1) c
UNION ALL SELECT 'dim_localidade', count(*) FROM (SELECT id_pessoa FROM dim_localidade GROUP BY 1 HAVING count(*) > 1) d""",
        "guard_empty_month": base + f"""
SELECT {fm[0]} AS ano, {fm[1]} AS mes, CAST(count(*) AS BIGINT) AS linhas,
       CASE WHEN count(*) = 0 THEN 'ignorar' ELSE 'gravar' END AS acao FROM ({_lake_sql(*fm)}) a
UNION ALL
SELECT {EMPTY_MONTH[0]}, {EMPTY_MONTH[1]}, CAST(count(*) AS BIGINT),
       CASE WHEN count(*) = 0 THEN 'ignorar' ELSE 'gravar' END FROM ({_lake_sql(*EMPTY_MONTH)}) b""",
        "monthly_series": base + f"\nSELECT {_monthly_cols()} FROM vendas_ano_mes",
        "monthly_by_year": base + f"\nSELECT {_monthly_cols()} FROM vendas_ano_mes WHERE ano = {fm[0]}",
        "years_available": base + "\nSELECT DISTINCT ano FROM vendas_ano_mes WHERE ano IS NOT NULL",
        "default_year": base + "\nSELECT max(ano) AS ano FROM vendas_ano_mes HAVING count(ano) > 0",
        "best_month": base + f"""
SELECT ano, mes, {_month_sql('mes')} AS nome_mes, valor_total_real FROM (
  SELECT *, row_number() OVER (PARTITION BY ano ORDER BY valor_total_real DESC, mes ASC) AS rn
  FROM vendas_ano_mes) t WHERE rn = 1""",
        "kpi_cards": _kpi_sql(),
        "top_states": _top_states_sql(10),
        "top_states_k3": _top_states_sql(3),
        "state_rank_intensity": _top_states_sql(10,
                                                "sigla_estado, posicao, intensidade"),
        "top_cities": base + _top_sql("cidade", 20, """
SELECT cidade, valor_total_real, valor_total_esperado,
       CAST(sum(valor_total_esperado) OVER () AS DOUBLE) / count(*) OVER () AS media_meta FROM top"""),
        "avg_ticket": base + """
SELECT ano, coalesce(CAST(sum(valor_total_real) AS DOUBLE) / NULLIF(CAST(sum(qtde_vendida) AS DOUBLE), 0), 0)
       AS ticket_medio FROM vendas_ano_mes GROUP BY ano""",
        "month_label": base + f"\nSELECT ano, mes, {_month_sql('mes')} AS nome_mes FROM vendas_ano_mes",
        "fmt_money": base + f"\nSELECT origem, chave, valor, {_money_sql('valor')} AS texto FROM ({money_rows}) t",
        "fmt_int_dot": base + f"\nSELECT ano, mes, qtde_vendida, {_int_dot_sql('qtde_vendida')} AS qtde_fmt "
                              "FROM vendas_ano_mes",
        "fmt_pct": base + f"""
SELECT ano, mes, pct_ating, {_pct_text_sql('pct_ating', 1)} AS pct_1, {_pct_text_sql('pct_ating', 0)} AS pct_0
FROM (SELECT ano, mes, round({_ratio_sql('valor_total_real', 'valor_total_esperado')}, 1) AS pct_ating
      FROM vendas_ano_mes) t""",
        "deviation_sign": base + f"""
SELECT ano, mes, desvio, {_sign_sql('desvio')} AS status_desvio,
       (CASE WHEN desvio >= 0 THEN '▲' ELSE '▼' END) || ' '
         || {_money_sql('abs(desvio)')} || ' vs meta' AS direcao
FROM (SELECT ano, mes, CAST(valor_total_real - valor_total_esperado AS DECIMAL(18,2)) AS desvio
      FROM vendas_ano_mes) t""",
        "attainment_pct": _shipping_sql("SELECT * FROM att"),
        "attainment_band": _shipping_sql(f"SELECT ano_envio, tipo, nacao, pct, {_band_sql('pct')} AS faixa FROM att"),
    }
    return sql
