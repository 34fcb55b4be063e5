"""Surrogate keys that stay the same from run to run.

A key map is a versioned table of (natural key columns, surrogate key), one for each
dimension. Natural keys that are not in it are found by an anti-join and numbered in
the order of the natural key, on from the highest key so far; their rows become
a part of their own. Keys are never given again: an entity that leaves the source and comes
back has its old key. The map is committed before the keys are used, and only if no
other run extended it meanwhile, so no key is given twice.

Against an empty map the keys are exactly those of ``dense_key``. All rows of a natural key share
its key; where each is to have one of its own, the natural key gets a column more (``occurrences``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martforge.operators.keys import dense_key
from martforge.operators.versions import Version, VersionedTable

#: Tells rows of one natural key apart; null for the first of them, as for all rows of a map without the column.
OCCURRENCE = "_ocorrencia"


def occurrences(rows: DataFrame, natural: list[str], order_by: list[str]) -> DataFrame:
    """``rows`` with OCCURRENCE: null for the first row of a natural key, 2, 3 and so on for the next, in ``order_by``."""
    same = Window.partitionBy(*natural).orderBy(*[F.col(c).asc_nulls_first() for c in order_by or natural])
    return rows.withColumn(OCCURRENCE, F.nullif(F.row_number().over(same), F.lit(1)))


def _same(left: str, right: str, columns: list[str]) -> Column:
    """Equality of the natural key, nulls included."""
    both = [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    cond = both[0]
    for c in both[1:]:
        cond = cond & c
    return cond


def map_schema(rows: DataFrame, natural: list[str], sk: str) -> T.StructType:
    return T.StructType([*[T.StructField(c, rows.schema[c].dataType, True) for c in natural],
                         T.StructField(sk, T.LongType(), True)])


def _given(table: VersionedTable, version: Version, rows: DataFrame, natural: list[str]) -> DataFrame:
    """A version of the map, with nulls in the columns of the natural key that it was written without."""
    given = table.read(version)
    return given.withColumns({c: F.lit(None).cast(rows.schema[c].dataType) for c in natural if c not in given.columns})


def extend_key_map(table: VersionedTable, rows: DataFrame, natural: list[str], sk: str,
                   buckets: int | None = None) -> Version:
    """Give a key to every natural key of ``rows`` that has none, and commit. ``rows`` is read
    twice or more: pass rows that are cheap to read again."""
    now = table.current()
    found = rows.select(*natural).distinct()
    highest = 0
    if now is not None and now.rows:
        old = _given(table, now, rows, natural)
        highest = old.agg(F.max(sk)).first()[0] or 0
        found = found.alias("n").join(old.alias("o"), _same("n", "o", natural), "left_anti")
    keyed = dense_key(found, sk, natural, buckets=buckets).select(*natural, (F.col(sk) + highest).alias(sk))
    schema = map_schema(rows, natural, sk)
    part = table.write(keyed)
    if not part.rows:
        table.discard(part)
        return now or table.commit(schema, [], now)
    return table.commit(schema, [*(now.parts if now else ()), part], now)


def with_stable_key(table: VersionedTable, version: Version, rows: DataFrame, natural: list[str], sk: str) -> DataFrame:
    """``rows`` with their keys of a version of the map, as the first column."""
    keyed = rows.alias("r").join(_given(table, version, rows, natural).alias("k"), _same("r", "k", natural), "inner")
    return keyed.select(F.col(f"k.{sk}").alias(sk), "r.*")
