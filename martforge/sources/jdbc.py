"""Relational (JDBC) source reader.

The original job runs each SELECT on the source database and fetches the
whole result over one cursor. Here every relation is a JDBC DataFrame; big
tables are read in parallel slices of a numeric column so no single task or
the driver holds a whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martforge.sources.tables import SourceTables

# Fixed relation names of the source database (schema.table).
SOURCE_RELATIONS = {
    "nota_fiscal": "vendas.nota_fiscal",
    "item_nota_fiscal": "vendas.item_nota_fiscal",
    "produto": "vendas.produto",
    "categoria": "vendas.categoria",
    "pessoa_fisica": "geral.pessoa_fisica",
    "pessoa_juridica": "geral.pessoa_juridica",
    "endereco": "geral.endereco",
    "bairro": "geral.bairro",
    "cidade": "geral.cidade",
    "estado": "geral.estado",
}

# Relations that grow with sales volume and are read in parallel slices.
PARTITIONED = {
    "nota_fiscal": "id",
    "item_nota_fiscal": "id_nota_fiscal",
    "endereco": "id",
    "produto": "id",
    "pessoa_fisica": "id",
    "pessoa_juridica": "id",
}


def quantile_query(column: str, source: str, n: int) -> str:
    """SELECT of the lowest key of each of ``n`` equally filled buckets of ``column`` (n rows at
    most reach the driver). All rows count: a sample of keys would weigh a hot key by chance."""
    return (f"SELECT MIN(k) AS lo FROM (SELECT {column} AS k, NTILE({n}) OVER (ORDER BY {column}) AS b "
            f"FROM {source} WHERE {column} IS NOT NULL) t GROUP BY b")


def quantile_predicates(column: str, lows: list) -> list[str]:
    """Conditions that split all rows, null keys in the first, at the buckets' lowest keys."""
    cuts = sorted(set(lows))[1:]
    if not cuts:
        return []
    inner = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_jdbc(spark: SparkSession, url: str, *, dbtable: str | None = None,
              query: str | None = None, properties: dict | None = None,
              partition_column: str | None = None, num_partitions: int | None = None,
              fetchsize: int = 10000, by_quantiles: bool = False) -> DataFrame:
    """Read a table or SELECT through JDBC.

    With ``partition_column`` the bounds are looked up first (a one-row
    min/max query) and the read is split into ``num_partitions`` ranges of equal width.
    With ``by_quantiles`` the ranges hold equally many rows instead, whatever gaps the keys have
    (numeric keys; the database sorts the key once).
    """
    if (dbtable is None) == (query is None):
        raise ValueError("give exactly one of dbtable or query")
    opts = {"url": url, "fetchsize": str(fetchsize), **(properties or {})}
    if query is not None and partition_column is None:
        return spark.read.format("jdbc").options(**opts).option("query", query).load()
    source = dbtable if dbtable is not None else f"({query}) AS q"
    if partition_column is None:
        return spark.read.format("jdbc").options(**opts).option("dbtable", source).load()
    n = max(1, num_partitions or spark.sparkContext.defaultParallelism)
    if by_quantiles:
        lows = (spark.read.format("jdbc").options(**opts)
                .option("query", quantile_query(partition_column, source, n)).load().collect())
        cuts = quantile_predicates(partition_column, [r["lo"] for r in lows])
        if not cuts:
            return spark.read.format("jdbc").options(**opts).option("dbtable", source).load()
        return spark.read.jdbc(url, source, predicates=cuts, properties={k: v for k, v in opts.items() if k != "url"})
    bounds = (
        spark.read.format("jdbc").options(**opts)
        .option("query", f"SELECT MIN({partition_column}) AS lo, MAX({partition_column}) AS hi FROM {source}")
        .load().first()
    )
    lo, hi = bounds["lo"], bounds["hi"]
    if lo is None:
        return spark.read.format("jdbc").options(**opts).option("dbtable", source).load()
    return (
        spark.read.format("jdbc").options(**opts)
        .option("dbtable", source)
        .option("partitionColumn", partition_column)
        .option("lowerBound", str(lo)).option("upperBound", str(int(hi) + 1))
        .option("numPartitions", str(n))
        .load()
    )


def jdbc_sources(spark: SparkSession, url: str, properties: dict | None = None,
                 num_partitions: int | None = None,
                 relations: dict[str, str] | None = None, by_quantiles: bool = False) -> SourceTables:
    rel = {**SOURCE_RELATIONS, **(relations or {})}
    frames = {}
    for name, table in rel.items():
        frames[name] = read_jdbc(
            spark, url, dbtable=table, properties=properties,
            partition_column=PARTITIONED.get(name), num_partitions=num_partitions,
            by_quantiles=by_quantiles,
        )
    return SourceTables(**frames)
