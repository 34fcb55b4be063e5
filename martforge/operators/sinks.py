"""Table sinks (Parquet): append, full refresh, schema replacement.

Executors write their partitions directly; nothing is gathered on the
driver. Every sink first projects onto the table's fixed schema so files of
one table never disagree on types. Tables are versioned (``operators/versions.py``): a
sink writes beside what is there and switches by one small file, so a reader never finds a
table empty or half written, and a writer that dies leaves the rows that were there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.versions import ConcurrentCommit, VersionedTable, is_versioned
from martforge.schemas import conform


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN in float/double columns becomes NULL (other types are untouched)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            cols.append(F.when(F.isnan(F.col(f.name)), F.lit(None).cast(f.dataType))
                        .otherwise(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def write_folder(df: DataFrame, path: str, schema: T.StructType, *, sort_by: list[str] | None = None,
                 metrics: dict | None = None, seen: dict | None = None) -> int:
    """Write a plain folder that no one reads yet, such as a table of a run that is still unpublished.

    ``metrics``: further aggregates (name -> Column) observed while writing, put into ``seen``."""
    obs = Observation()
    out = nan_to_null(conform(df, schema)).observe(
        obs, F.count(F.lit(1)).alias("rows"), *[c.alias(k) for k, c in (metrics or {}).items()])
    if sort_by:
        out = out.sortWithinPartitions(*sort_by)
    out.write.mode("overwrite").parquet(path)
    found = obs.get
    if metrics:
        seen.update({k: int(found.get(k) or 0) for k in metrics})
    return int(found["rows"])


def _schema_of(table: VersionedTable, df: DataFrame, schema: T.StructType | None) -> T.StructType:
    now = table.current() if schema is None else None
    return schema or (now.schema if now else df.schema)


def append_table(df: DataFrame, path: str, schema: T.StructType | None = None) -> int:
    """Append rows; an empty input makes no new version."""
    table = VersionedTable(df.sparkSession, path)
    schema = _schema_of(table, df, schema)
    part = table.write(nan_to_null(conform(df, schema)))
    if part.rows:
        table.change(schema, lambda now: [*(now.parts if now else ()), part])
    else:
        table.discard(part)
    return part.rows


def full_refresh(df: DataFrame, path: str, schema: T.StructType | None = None) -> int:
    """Replace the rows, keeping the table's current schema when it exists."""
    table = VersionedTable(df.sparkSession, path)
    return replace_table(df, path, _schema_of(table, df, schema))


def replace_table(df: DataFrame, path: str, schema: T.StructType, sort_by: list[str] | None = None) -> int:
    """Drop-and-create: data and schema both become the new ones."""
    table = VersionedTable(df.sparkSession, path)
    part = table.write(nan_to_null(conform(df, schema)), sort_by=sort_by)
    table.change(schema, lambda now: [part])
    return part.rows


def create_if_absent(spark, path: str, schema: T.StructType) -> bool:
    """Create an empty table with ``schema`` when ``path`` holds none.
    Returns True when it was created."""
    if is_versioned(spark, path):
        return False
    try:
        VersionedTable(spark, path).commit(schema, [], None)
    except ConcurrentCommit:  # created meanwhile
        return False
    return True


def jdbc_write(df: DataFrame, url: str, table: str, *, mode: str = "append",
               properties: dict | None = None, batchsize: int = 2000,
               truncate: bool = True, num_partitions: int | None = None) -> None:
    """Write to a relational table (the dashboard database).

    Each task inserts its own partition in batches of ``batchsize`` rows, so
    the driver never holds the data. ``mode="overwrite"`` with ``truncate``
    keeps the table's DDL (a full refresh); ``mode="append"`` adds rows.
    ``num_partitions`` caps concurrent connections to the database (by a shuffle,
    so that the work before it keeps its own parallelism).
    """
    out = nan_to_null(df)
    if num_partitions:
        out = out.repartition(num_partitions)
    w = (out.write.format("jdbc").mode(mode)
         .option("url", url).option("dbtable", table)
         .option("batchsize", str(batchsize))
         .option("truncate", "true" if truncate else "false"))
    for k, v in (properties or {}).items():
        w = w.option(k, v)
    w.save()
