"""Fact and marts kept up to date: only what changed is computed again.

Layout under ``root`` (a shared-storage URI)::

    root/keys/<dim>       key maps: an entity keeps its surrogate key from update to update
    root/tables/<table>   versioned tables: dims, fact, day sums, marts, checksums
    root/state/<n>.json   an update: the version of every table that belongs together

One update:

1. Dimensions are written with stable keys (new entities get the next keys).
2. Every invoice day gets a checksum of its headers and items; every person, seller and product gets
   one of what the fact looks up by it. Against those of the last update they tell
   the changed days: days whose own checksum differs, and days with an invoice of a changed person, seller or product.
3. The fact is a part for each calendar month (and one for sales outside the calendar). Months
   with a changed day are computed from the invoices of these months alone and replace their
   parts; the files of other months stay as they are. Many months are computed in a few groups, one after the
   other, from items written by group; shuffle files of a group are gone when the next begins.
4. Sums by day and location are kept as a table, a part for each month. Changed days are summed
   anew, the other days of a touched month are copied. Both marts come from these sums;
   the fact is not scanned.
5. One small file names the new version of every table. Readers see the last update whole until then,
   and an update that dies leaves nothing but parts that no one reads: the next one starts
   from the last state and finds the same changes.

Costs of an update without changes: one pass over the sources for the checksums (items are added up by
invoice before they meet the headers) and the dimensions. A changed calendar renumbers
every day, so all months are computed again.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from contextlib import nullcontext
from dataclasses import dataclass, field, replace
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.config import PipelineConfig
from martforge.operators.sinks import nan_to_null
from martforge.operators.versions import ConcurrentCommit, Part, Version, VersionedTable
from martforge.plans import dims as D
from martforge.plans import fact as FT
from martforge.plans import marts as M
from martforge.plans.pipeline import parallel, stage_sources
from martforge.schemas import FATO_VENDA, MONEY, TABLES, conform
from martforge.session import (create_text, delete_path, folder_entries, key_filters, read_text, released,
                               scratch_dir, stored)
from martforge.sources.calendar import resolve_calendar
from martforge.sources.tables import SourceTables

NONE = "none"  # the range of sales outside the calendar
RANGE = "faixa"
DAY_SUMS = T.StructType([
    T.StructField("sk_tempo", T.IntegerType()), T.StructField("sk_localidade", T.LongType()),
    T.StructField("_q", T.LongType()), T.StructField("_r", T.DecimalType(28, 2)), T.StructField("_e", T.DecimalType(28, 2))])
SUM = T.DecimalType(38, 0)
#: Items of a group of ranges, of which there are some up to GROUPS.
GROUP_ITEMS = 1 << 21
GROUPS = 8


def range_of(day: Column, cfg: PipelineConfig) -> Column:
    """The month of a day of the calendar, as yyyy-MM; NONE for all others."""
    inside = day.between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    return F.when(inside, F.date_format(day, "yyyy-MM")).otherwise(F.lit(NONE))


def in_ranges(day: Column, ranges: set[str], cfg: PipelineConfig) -> Column:
    """Whether the range of a day (``range_of``) is one of ``ranges``, as comparisons of the day: a scan skips by
    them, and Spark sees that they choose rows (``key_filters``)."""
    spans: list[list[date]] = []
    for first in sorted(date.fromisoformat(f"{r}-01") for r in ranges - {NONE}):
        after = (first + timedelta(days=31)).replace(day=1)
        if spans and spans[-1][1] == first:
            spans[-1][1] = after
        else:
            spans.append([first, after])
    inside = day.between(F.lit(cfg.calendar_start), F.lit(cfg.calendar_end))
    chosen = [inside & (day >= F.lit(a)) & (day < F.lit(b)) for a, b in spans]
    chosen += [~F.coalesce(inside, F.lit(False))] if NONE in ranges else []
    return reduce(or_, chosen, F.lit(False))


def range_of_key(sk_tempo: Column, cfg: PipelineConfig) -> Column:
    return F.coalesce(F.date_format(F.date_add(F.lit(cfg.calendar_start), sk_tempo - 1), "yyyy-MM"), F.lit(NONE))


def checksum(df: DataFrame, *columns: str) -> Column:
    """A hash of a row's columns (all by default); which are null counts, the precision of a decimal doesn't."""
    names = columns or df.columns
    values = [F.col(c).cast(MONEY) if isinstance(df.schema[c].dataType, T.DecimalType) else F.col(c) for c in names]
    return F.xxhash64(*values, *[F.col(c).isNull() for c in names]).cast("decimal(20,0)")


def day_checksums(src: SourceTables) -> DataFrame:
    """data, notas, itens, soma: how many headers and items each invoice day has, and the sum of their hashes."""
    items = (src.item_nota_fiscal.withColumn("_h", checksum(src.item_nota_fiscal))
             .groupBy(F.col("id_nota_fiscal").alias("id")).agg(F.count(F.lit(1)).alias("_n"), F.sum("_h").alias("_s")))
    nf = src.nota_fiscal.withColumn("data", F.to_date("data_venda"))
    nf = nf.select("id", "data", checksum(nf, "id", "data", "id_cliente", "id_vendedor").alias("_h"))
    return (nf.join(items, "id", "left").groupBy("data")
            .agg(F.count(F.lit(1)).alias("notas"), F.coalesce(F.sum("_n"), F.lit(0)).alias("itens"),
                 (F.sum("_h") + F.coalesce(F.sum("_s"), F.lit(0))).cast(SUM).alias("soma")))


def lookup_checksums(found: dict[str, DataFrame], dim_vendedor: DataFrame) -> DataFrame:
    """tipo, id, soma: for each person, product and seller, a checksum of what the fact takes from it."""
    def of(kind: str, df: DataFrame, key: str) -> DataFrame:
        return (df.withColumn("_h", checksum(df)).groupBy(F.col(key).cast("bigint").alias("id"))
                .agg(F.sum("_h").cast(SUM).alias("soma")).select(F.lit(kind).alias("tipo"), "id", "soma"))

    sellers = dim_vendedor.select("id_pessoa", "sk_vendedor")
    return (of("pessoa", found["person"], "id_pessoa").unionByName(of("produto", found["product"], "id_produto"))
            .unionByName(of("vendedor", sellers, "id_pessoa")))


def differing(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """The keys whose row is new, gone or other. Keys may be null."""
    values = [c for c in new.columns if c not in keys]
    pack = lambda df, name: df.select(*keys, F.struct(*values).alias(name))
    o, n = pack(old, "_old").alias("o"), pack(new, "_new").alias("n")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(f"o.{k}").eqNullSafe(F.col(f"n.{k}"))
    gone = o.join(n, same, "left_anti").select(*keys)
    other = n.join(o, same, "left").filter(~F.col("_new").eqNullSafe(F.col("_old"))).select(*[F.col(f"n.{k}") for k in keys])
    return gone.unionByName(other)


def days_of(src: SourceTables, changed: DataFrame) -> DataFrame:
    """The days (data) with an invoice that a changed person, seller or product is on."""
    ids = lambda kind: changed.filter(F.col("tipo") == kind).select(F.col("id").alias("_c"))
    nf = src.nota_fiscal.select("id", F.to_date("data_venda").alias("data"), "id_cliente", "id_vendedor")
    items = src.item_nota_fiscal.select("id_nota_fiscal", "id_produto")
    on_items = items.join(ids("produto"), F.col("_c") == F.col("id_produto"), "left_semi").select(F.col("id_nota_fiscal").alias("_c"))
    return (nf.join(ids("pessoa"), F.col("_c") == F.col("id_cliente"), "left_semi").select("data")
            .unionByName(nf.join(ids("vendedor"), F.col("_c") == F.col("id_vendedor"), "left_semi").select("data"))
            .unionByName(nf.join(on_items, F.col("_c") == F.col("id"), "left_semi").select("data")).distinct())


def restricted(src: SourceTables, ranges: set[str], cfg: PipelineConfig) -> SourceTables:
    """The sources with the invoices and items of some ranges alone."""
    nf = src.nota_fiscal.filter(in_ranges(F.to_date("data_venda"), ranges, cfg))
    items = src.item_nota_fiscal.join(nf.select(F.col("id").alias("_n")), F.col("_n") == F.col("id_nota_fiscal"), "left_semi")
    return SourceTables(**{n: {"nota_fiscal": nf, "item_nota_fiscal": items}.get(n, getattr(src, n)) for n in src.names()})


def range_groups(days: DataFrame, ranges: set[str], cfg: PipelineConfig) -> list[set[str]]:
    """``ranges`` in groups of neighbours with about as many items each, by the checksums of the days. The driver
    gets a row for each range."""
    counted = days.groupBy(range_of(F.col("data"), cfg).alias(RANGE)).agg(F.sum("itens").alias("itens")).collect()
    items = {r[RANGE]: r["itens"] for r in counted if r[RANGE] in ranges}
    total, before = sum(items.values()), 0
    n = max(1, min(GROUPS, total // GROUP_ITEMS))
    groups: list[set[str]] = [set() for _ in range(n)]
    for r in sorted(ranges):
        groups[before * n // total if before < total else n - 1 if total else 0].add(r)
        before += items.get(r, 0)
    return [g for g in groups if g]


def grouped(src: SourceTables, groups: list[set[str]], cfg: PipelineConfig) -> Iterator[SourceTables]:
    """The sources with the invoices and items of one group of ranges, and then of the next. Items are written first, in a folder
    for each set of groups (as bits) that invoices of their id are in, which is deleted after the last of its groups."""
    spark, items = src.nota_fiscal.sparkSession, src.item_nota_fiscal
    path, day = scratch_dir(spark, "update-items"), F.to_date("data_venda")
    bits = [F.when(in_ranges(day, g, cfg), F.lit(1 << i)).otherwise(F.lit(0)) for i, g in enumerate(groups)]
    sets = (src.nota_fiscal.select(F.col("id").alias("_n"), reduce(Column.bitwiseOR, bits).alias("_b"))
            .groupBy("_n").agg(F.bit_or("_b").alias("grupos")).filter("grupos <> 0"))
    (items.join(sets, F.col("_n") == F.col("id_nota_fiscal")).drop("_n")
     .write.partitionBy("grupos").parquet(path))
    folders = {int(e.name.split("=")[1]): f"{path}/{e.name}" for e in folder_entries(spark, path) if e.name.startswith("grupos=")}
    for i, g in enumerate(groups):
        own = [f for b, f in folders.items() if b >> i & 1]
        rows = spark.read.schema(items.schema).parquet(*own) if own else spark.createDataFrame([], items.schema)
        yield replace(src, nota_fiscal=src.nota_fiscal.filter(in_ranges(day, g, cfg)), item_nota_fiscal=rows)
        for b, f in folders.items():
            if b.bit_length() == i + 1:
                delete_path(spark, f)
    delete_path(spark, path)


def day_sums(fact: DataFrame) -> DataFrame:
    """Mergeable sums of the fact by day and location (sales of the calendar)."""
    rows = fact.filter(F.col("sk_tempo").isNotNull()).groupBy("sk_tempo", "sk_localidade").agg(
        F.sum("quantidade").alias("_q"), F.sum("valor_venda_real").alias("_r"), F.sum("valor_unitario").alias("_e"))
    return conform(rows, DAY_SUMS)


def month_location_sums(sums: DataFrame, dim_tempo: DataFrame, cfg: PipelineConfig | None = None) -> DataFrame:
    """What the marts start from, out of the day sums instead of the fact."""
    return (sums.join(M.calendar_months(dim_tempo, cfg), "sk_tempo").groupBy("ano", "mes", "sk_localidade")
            .agg(*[F.sum(c).alias(c) for c in ("_q", "_r", "_e")]))


@dataclass(frozen=True)
class State:
    """An update: its number, the calendar, and the version of each table."""

    number: int
    calendar: tuple[str, str]
    versions: dict[str, int]


@dataclass
class Update:
    state: State
    days: list[date | None] = field(default_factory=list)   # changed days of the calendar
    ranges: set[str] = field(default_factory=set)            # fact parts that were computed again
    counts: dict[str, int] = field(default_factory=dict)


class Store:
    """The tables under a root, as the last update (or ``number``) left them."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/tables/{name}")

    def keys(self, dim: str) -> VersionedTable:
        return VersionedTable(self.spark, f"{self.root}/keys/{dim}")

    def numbers(self) -> list[int]:
        names = [e.name for e in folder_entries(self.spark, f"{self.root}/state")]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def state(self) -> State | None:
        for n in reversed(self.numbers()):
            try:
                made = json.loads(read_text(self.spark, self._state_file(n)))
            except json.JSONDecodeError:  # its writer died
                continue
            return State(n, tuple(made["calendar"]), made["versions"])
        return None

    def version(self, name: str, state: State | None) -> Version | None:
        return self.table(name).at(state.versions[name]) if state and name in state.versions else None

    def read(self, name: str) -> DataFrame:
        version = self.version(name, self.state())
        if version is None:
            raise FileNotFoundError(f"no update under {self.root} has {name}")
        return self.table(name).read(version)

    def put(self, name: str, schema: T.StructType, parts: list[Part]) -> Version:
        """A new version of a table; none of the readers knows it before the state names it."""
        return self.table(name).change(schema, lambda _: parts)

    def finish(self, before: State | None, calendar: tuple[str, str], versions: dict[str, int]) -> State:
        numbers = self.numbers()
        last = self.state()
        number = (numbers or [0])[-1] + 1
        text = json.dumps({"calendar": calendar, "versions": versions})
        if (last and last.number) != (before and before.number) or not create_text(self.spark, self._state_file(number), text):
            raise ConcurrentCommit(f"{self.root}: another update finished meanwhile")
        return State(number, calendar, versions)

    def _state_file(self, number: int) -> str:
        return f"{self.root}/state/{number:012d}.json"


def update(spark: SparkSession, src: SourceTables, cfg: PipelineConfig, root: str, *, stage: bool = True) -> Update:
    """Bring the tables under ``root`` up to date with the sources. ``stage``: write the sources that are
    read more than once first; not needed for sources that are plain tables already."""
    with released(spark):
        return _updated(spark, src, cfg, root, stage)


def _updated(spark: SparkSession, src: SourceTables, cfg: PipelineConfig, root: str, stage: bool) -> Update:
    store = Store(spark, root)
    before = store.state()
    if stage:
        src = stage_sources(src, scratch_dir(spark, "update-sources"))
    cfg = resolve_calendar(src, cfg)
    calendar = (str(cfg.calendar_start), str(cfg.calendar_end))
    made: dict[str, Version] = {}

    def full(name: str, df: DataFrame, schema: T.StructType | None = None) -> DataFrame:
        schema = schema or TABLES[name]
        part = store.table(name).write(nan_to_null(conform(df, schema)))
        made[name] = store.put(name, schema, [part])
        return store.table(name).read(made[name])

    tasks = {n: lambda n=n: D.write_keyed_dimension(n, src, cfg, lambda df: full(n, df), store.keys(n)) for n in D.KEYED_DIMENSIONS}
    dims = parallel({"dim_tempo": lambda: full("dim_tempo", D.dim_tempo(spark, cfg)), **tasks})
    done = parallel({
        "person": lambda: full("lookup_person", df := FT.person_lookup(dims["dim_cliente"], dims["dim_localidade"]), df.schema),
        "product": lambda: full("lookup_product", df := FT.product_lookup(src.produto, dims["dim_produto"]), df.schema),
        "days": lambda: full("day_checksums", df := day_checksums(src), df.schema),
    })
    days, found = done.pop("days"), done
    lookups = full("lookup_checksums", df := lookup_checksums(found, dims["dim_vendedor"]), df.schema)
    changed, ranges = changed_days(store, before, calendar, src, days, lookups, cfg)

    groups = range_groups(days, ranges, cfg)
    if len(groups) > 1:
        parts, filters = grouped(src, groups, cfg), nullcontext  # of items that are those of the group already
    else:
        parts, filters = iter([restricted(src, g, cfg) if before else src for g in groups]), lambda: key_filters(spark)
    fact = replace_ranges(store, before, calendar, made, ranges, parts,
                          lambda part, spread: FT.fato_venda(part, dims, cfg, found, spread), cfg, filters)
    sums = replace_day_sums(store, before, calendar, made, changed, ranges - {NONE}, fact, cfg)
    with stored(month_location_sums(sums, dims["dim_tempo"], cfg), "update-months") as pre:
        parallel({
            **{f"keys_{n}": lambda n=n: D.record_keys(n, dims[n], store.keys(n)) for n in D.KEYED_DIMENSIONS},
            "vendas_ano_mes": lambda: full("vendas_ano_mes", M.vendas_ano_mes(None, dims["dim_tempo"], cfg, pre=pre)),
            "vendas_localidade": lambda: full("vendas_localidade", M.vendas_localidade(
                None, dims["dim_tempo"], dims["dim_localidade"], cfg, pre=pre)),
        })
    state = store.finish(before, calendar, {n: v.number for n, v in made.items()})
    return Update(state, sorted(changed), ranges, {n: v.rows for n, v in made.items()})


def changed_days(store: Store, before: State | None, calendar: tuple[str, str], src: SourceTables, days: DataFrame,
                 lookups: DataFrame, cfg: PipelineConfig) -> tuple[set[date], set[str]]:
    """The days of the calendar to sum anew, and the ranges to compute again. The driver gets no more days than
    the calendar has."""
    if before is None or before.calendar != calendar:
        changed = days.select("data")
    else:
        old = {n: store.table(n).read(store.version(n, before)) for n in ("day_checksums", "lookup_checksums")}
        changed = differing(old["day_checksums"], days, ["data"])
        moved = differing(old["lookup_checksums"], lookups, ["tipo", "id"]).persist()
        try:
            if not moved.isEmpty():
                changed = changed.unionByName(days_of(src, moved))
            return _listed(changed, cfg)
        finally:
            moved.unpersist()
    return _listed(changed, cfg)


def _listed(changed: DataFrame, cfg: PipelineConfig) -> tuple[set[date], set[str]]:
    key = range_of(F.col("data"), cfg)
    rows = changed.select(F.when(key != NONE, F.col("data")).alias("data"), key.alias(RANGE)).distinct().collect()
    return {r["data"] for r in rows if r["data"] is not None}, {r[RANGE] for r in rows}


def _kept(store: Store, name: str, before: State | None, calendar: tuple[str, str], ranges: set[str]) -> list[Part]:
    """The parts of the last update that go on as they are."""
    old = store.version(name, before) if before and before.calendar == calendar else None
    return [p for p in old.parts if p.key not in ranges] if old else []


def replace_ranges(store: Store, before: State | None, calendar: tuple[str, str], made: dict[str, Version], ranges: set[str],
                   parts: Iterator[SourceTables], rows, cfg: PipelineConfig, filters=nullcontext) -> DataFrame:
    """The fact with some ranges computed again from ``parts``, each with all invoices of some of them. ``rows`` makes
    them of a part, given how to deal them over tasks; ``filters`` holds while they are written."""
    kept, table = _kept(store, "fato_venda", before, calendar, ranges), store.table("fato_venda")
    new = []
    for part in parts:
        # Rebalanced by month: AQE merges small months' tasks and splits a large month over several files.
        first_day = F.trunc(F.date_add(F.lit(cfg.calendar_start), F.col("sk_tempo") - 1), "month")
        made_by_month = rows(part, lambda df, first_day=first_day: df.withColumn("_mes", first_day).hint("rebalance", "_mes").drop("_mes"))
        keyed = nan_to_null(made_by_month).withColumn(RANGE, range_of_key(F.col("sk_tempo"), cfg))
        with filters():
            new += table.write_ranges(keyed, RANGE, sort_by=["sk_tempo", "sk_produto"])
    made["fato_venda"] = store.put("fato_venda", FATO_VENDA, [*kept, *new])
    return table.read(made["fato_venda"], ranges)


def replace_day_sums(store: Store, before: State | None, calendar: tuple[str, str], made: dict[str, Version],
                     changed: set[date], ranges: set[str], touched: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """The day sums with the changed days summed anew from ``touched``, the fact of the touched ranges."""
    kept, table = _kept(store, "day_sums", before, calendar, ranges), store.table("day_sums")
    new = []
    if changed:
        keys = sorted((d - cfg.calendar_start).days + 1 for d in changed)
        sums = day_sums(touched.filter(F.col("sk_tempo").isin(keys)))
        old = store.version("day_sums", before) if before and before.calendar == calendar else None
        if old:
            sums = sums.unionByName(table.read(old, ranges).filter(~F.col("sk_tempo").isin(keys)))
        keyed = sums.withColumn(RANGE, range_of_key(F.col("sk_tempo"), cfg)).hint("rebalance", RANGE)
        new = table.write_ranges(keyed, RANGE, sort_by=["sk_tempo", "sk_localidade"])
    made["day_sums"] = store.put("day_sums", DAY_SUMS, [*kept, *new])
    return table.read(made["day_sums"])
