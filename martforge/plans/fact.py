"""fato_venda: one row per invoice item with every surrogate key resolved.

Plan shape (chosen for a fact in the 10^12-row range):

* Keys that depend only on the invoice header (calendar, customer, location,
  seller) are resolved on the header table, which is several times smaller
  than the item table.
* One lookup and one join per key: customer and location keys share a lookup
  by person, price and product key share a lookup by product. Two chained joins
  on one key would keep its partitioning between them, and AQE then splits
  neither; with one, each join is followed by another shuffle and a hot
  customer or product is split.
* The resolved headers meet the items in a single equi-join on the invoice id.
* The calendar is bounded by its date range and is always broadcast; all
  other lookups are left to Spark's size estimate and AQE, which broadcast
  them when small and fall back to a shuffle join (with skew splitting)
  otherwise.

Semantics kept from the original job: invoices without items and items
without a product disappear (inner joins); every dimension lookup is a left
join, so a sale outside the calendar keeps a NULL sk_tempo, a customer
without an address keeps a NULL sk_localidade, and a person id present in
both customer types fans the sale out (reported by the quality checks).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martforge.config import PipelineConfig
from martforge.functions.measures import discount, discount_pct, pct_overflowed, ratio_pct
from martforge.schemas import FATO_VENDA, REJEITOS, conform
from martforge.sources.tables import SourceTables


def sales_lines(src: SourceTables) -> DataFrame:
    """Invoice header x item x product (inner), dates truncated to days."""
    nf, it, p = src.nota_fiscal.alias("nf"), src.item_nota_fiscal.alias("inf"), src.produto.alias("p")
    return (
        it.join(nf, F.col("inf.id_nota_fiscal") == F.col("nf.id"), "inner")
        .join(p, F.col("p.id") == F.col("inf.id_produto"), "inner")
        .select(
            F.to_date(F.col("nf.data_venda")).alias("data_venda"),
            F.col("nf.id_cliente").alias("id_cliente"),
            F.col("nf.id_vendedor").alias("id_vendedor"),
            F.col("inf.id_produto").alias("id_produto"),
            F.col("nf.id").alias("id_nota"),
            F.col("inf.quantidade").alias("quantidade"),
            F.col("inf.valor_unitario").alias("valor_unitario"),
            F.col("inf.valor_venda_real").alias("valor_venda_real"),
            F.col("p.valor_venda").alias("valor_venda"),
        )
    )


def person_lookup(dim_cliente: DataFrame, dim_localidade: DataFrame) -> DataFrame:
    """id_pessoa, sk_cliente, sk_localidade: all that the customer id resolves."""
    cli = dim_cliente.where("id_pessoa IS NOT NULL").select("id_pessoa", "sk_cliente")
    loc = dim_localidade.where("id_pessoa IS NOT NULL").select("id_pessoa", "sk_localidade")
    return cli.join(loc, "id_pessoa", "full_outer")


def product_lookup(produto: DataFrame, dim_produto: DataFrame) -> DataFrame:
    """id_produto, valor_venda, sk_produto: all that the product id resolves."""
    keys = dim_produto.select(F.col("id_produto").alias("_pd"), "sk_produto")
    return (produto.select(F.col("id").alias("id_produto"), "valor_venda")
            .join(keys, F.col("_pd") == F.col("id_produto"), "left")
            .select("id_produto", "valor_venda", "sk_produto"))


def lookups(src: SourceTables, dims: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The lookups of the fact. A run writes each first, so that the joins of the fact
    start from plain scans."""
    return {
        "person": person_lookup(dims["dim_cliente"], dims["dim_localidade"]),
        "product": product_lookup(src.produto, dims["dim_produto"]),
    }


def resolved_headers(src: SourceTables, dim_tempo: DataFrame, person: DataFrame,
                     dim_vendedor: DataFrame) -> DataFrame:
    """Invoice headers with calendar, customer, location and seller keys: one join
    per key, so a hot customer or seller is split by AQE."""
    nf = src.nota_fiscal.select(
        F.col("id").alias("id_nota"), F.to_date("data_venda").alias("data_venda"),
        "id_cliente", "id_vendedor")
    cal = F.broadcast(dim_tempo.select("sk_tempo", F.col("data").alias("_data")))
    people = person.select(F.col("id_pessoa").alias("_pc"), "sk_cliente", "sk_localidade")
    sellers = dim_vendedor.select(F.col("id_pessoa").alias("_pv"), "sk_vendedor")
    return (
        nf.join(cal, F.col("_data") == F.col("data_venda"), "left")
        .join(people, F.col("_pc") == F.col("id_cliente"), "left")
        .join(sellers, F.col("_pv") == F.col("id_vendedor"), "left")
        .select("id_nota", "sk_tempo", "sk_cliente", "sk_localidade", "sk_vendedor")
    )


def fato_venda(src: SourceTables, dims: dict[str, DataFrame], cfg: PipelineConfig | None = None,
               found: dict[str, DataFrame] | None = None,
               spread: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``found``: the written lookups of a run; built in place without them. ``spread`` deals the rows over
    tasks before what follows from their values is computed, so a shuffle does not carry that."""
    strict = bool(cfg and cfg.strict_pct)
    found = found or lookups(src, dims)
    hdr = resolved_headers(src, dims["dim_tempo"], found["person"], dims["dim_vendedor"])
    products = found["product"].withColumnRenamed("id_produto", "_prod")
    rows = (
        src.item_nota_fiscal
        .join(products, F.col("_prod") == F.col("id_produto"), "inner")
        .join(hdr, F.col("id_nota") == F.col("id_nota_fiscal"), "inner")
    )
    if spread:
        rows = spread(rows.select(
            "sk_tempo", "sk_produto", "sk_cliente", "sk_vendedor", "sk_localidade", "id_nota",
            "quantidade", "valor_unitario", "valor_venda_real", "valor_venda"))
    desc = discount(F.col("valor_venda"), F.col("valor_unitario"))
    out = rows.select(
        "sk_tempo", "sk_produto", "sk_cliente", "sk_vendedor", "sk_localidade", "id_nota",
        "quantidade", "valor_unitario", "valor_venda_real",
        desc.alias("desconto"),
        discount_pct(desc, F.col("valor_unitario"), strict=strict).alias("pct_desconto"),
    )
    return conform(out, FATO_VENDA)


#: Invoices of a written file at least, where shuffle partitions are many.
INVOICES_PER_FILE = 8192


def day_slots(invoices: DataFrame, cfg: PipelineConfig) -> tuple[list[tuple[int, int, int]], int]:
    """Which of n neighbouring file slots each calendar day takes, by its number of invoices: rows
    (sk_tempo, first slot, slots), 0 for sales outside the calendar; and n. A row for each day at most."""
    day = F.to_date("data_venda")
    inside = day.between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    sk = F.when(inside, F.datediff(day, F.lit(cfg.calendar_start)) + 1).otherwise(0)
    counts = invoices.groupBy(sk.alias("sk")).count().orderBy("sk").collect()
    total = sum(r["count"] for r in counts)
    most = int(invoices.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    n, before, slots = max(1, min(most, -(-total // INVOICES_PER_FILE))), 0, []
    for r in counts:
        first, last = before * n // total, (before + r["count"] - 1) * n // total
        slots.append((r["sk"], first, last - first + 1))
        before += r["count"]
    return slots, n


def by_day(fact: DataFrame, slots: list[tuple[int, int, int]], n: int) -> DataFrame:
    """The fact dealt over n tasks in ranges of its calendar key, so that (sorted by sk_tempo) a written
    file covers few days and the month filter skips the others; a hot day is dealt over
    several by its invoices. The ranges come from the headers, so nothing of the fact is sampled."""
    at = F.broadcast(fact.sparkSession.createDataFrame(slots or [(0, 0, 1)], "_day int, _first int, _slots int"))
    own = F.coalesce(F.col("_first") + F.pmod(F.xxhash64("id_nota"), F.col("_slots")), F.lit(0)).cast("int")
    return (fact.join(at, F.col("_day") == F.coalesce(F.col("sk_tempo"), F.lit(0)), "left")
            .repartitionById(n, own).select(*fact.columns))


def _times(cond: Column) -> Column:
    return F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0))


def _faults() -> dict[str, Column]:
    """What may be wrong with a line of the fact: no key, a day outside the calendar, a
    discount that does not fit pct_desconto."""
    return {
        "nulos_sk_cliente": F.col("sk_cliente").isNull(),
        "nulos_sk_localidade": F.col("sk_localidade").isNull(),
        "sem_calendario": F.col("sk_tempo").isNull(),
        "pct_desconto_fora": pct_overflowed(F.col("pct_desconto"), F.col("desconto"), F.col("valor_unitario")),
    }


def fact_metrics() -> dict[str, Column]:
    """Counts of the faults, for observation while the fact is written."""
    return {name: _times(fault) for name, fault in _faults().items()}


def rejected_lines(fact: DataFrame) -> DataFrame:
    """The lines of a written fact that have a fault, each once: ``motivos`` names its faults (in the
    order of ``fact_metrics``, comma-joined) and ``pct_calculado`` has the percentage that was
    computed, also where it did not fit (null where there is none: a price of zero or null).
    The lines stay in the fact. The filter is on nulls alone, so it reaches the
    scan and row groups without a null in these columns are not read."""
    named = F.concat_ws(",", *[F.when(fault, F.lit(name)) for name, fault in _faults().items()])
    maybe = (F.col("sk_cliente").isNull() | F.col("sk_localidade").isNull() | F.col("sk_tempo").isNull()
             | F.col("pct_desconto").isNull())
    pct = F.round(ratio_pct(F.col("desconto"), F.col("valor_unitario")), 2)
    rows = fact.where(maybe).select("*", pct.try_cast(REJEITOS["pct_calculado"].dataType).alias("pct_calculado"),
                                    named.alias("motivos"))
    return conform(rows.where("motivos <> ''"), REJEITOS)


def fact_null_keys(fact: DataFrame) -> DataFrame:
    """Null counts of the customer and location keys (one row)."""
    return fact.agg(
        F.count_if(F.col("sk_cliente").isNull()).alias("nulos_sk_cliente"),
        F.count_if(F.col("sk_localidade").isNull()).alias("nulos_sk_localidade"),
    )
