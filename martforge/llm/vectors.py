"""Columns of vectors as exact integers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled entries up to here are whole numbers in a double and in a long.
EXACT = float(1 << 52)


def usable(vector: Column, scale: int) -> Column:
    """Whether a vector is there and every entry is a number that has an exact scaled form."""
    inside = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < EXACT, F.lit(False)))
    return F.coalesce(vector.isNotNull() & inside, F.lit(False))


def scaled(vector: Column, scale: int, offset: int = 0) -> Column:
    """floor(scale * entry) + offset of each entry, as long."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))


def of_common_length(rows: DataFrame, vector: str) -> tuple[DataFrame, int]:
    """The rows whose vector has the most frequent length (ties: the longer), and that length."""
    sizes = rows.groupBy(F.size(vector).alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).first()
    size = top["size"] if top else 0
    return rows.filter(F.size(vector) == size), size
