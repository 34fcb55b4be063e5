"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from martforge.session import scratch_dir

#: White space of every contract: space and U+0009 to U+000D.
SPACES = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1024, size: int = 32 << 20) -> None:
    """Bound the rows and bytes that go to a Python worker at once: texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def staged(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, so a
    lost executor never recomputes (or renumbers) what was decided."""
    path = scratch_dir(spark, f"llm-{label}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def lowest(df: DataFrame, key: Column, n: int) -> DataFrame:
    """A sample of ``n`` rows: those with the lowest ``key``, a long that is a hash. The bound is
    found from the keys alone, and only keys below ``low_bits`` are sorted, so no task gathers
    more than the sample and a 65,536th of the keys, whatever the number of tasks."""
    keys = df.select(key.alias("k"))
    bits = low_bits(keys, "k", n)
    if bits is None:
        return df.limit(0)
    low = keys.filter(F.shiftright("k", 48) <= bits).orderBy("k").limit(n).agg(F.max("k")).first()[0]
    return df.filter(key <= F.lit(low)).limit(n)


def low_bits(df: DataFrame, key: str, n: int) -> int | None:
    """The first 16 bits up to which ``n`` rows or more have their ``key``, or all rows if they are
    fewer; None without rows. 65,536 counts at most reach the driver."""
    total, bound = 0, None
    for r in df.groupBy(F.shiftright(F.col(key), 48).alias("b")).count().orderBy("b").collect():
        bound, total = r["b"], total + r["count"]
        if total >= n:
            break
    return bound


def low_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """A sample of ``n`` rows: those with the lowest ``key``, a long that is a hash.

    The rows are counted by the first 16 bits of the key (65,536 counts at most), which bounds the
    keys that can be among the lowest; only rows below the bound are sorted, and these are the
    sample and a 65,536th of the rows."""
    bound = low_bits(df, key, n)
    return df.limit(0) if bound is None else df.filter(F.shiftright(F.col(key), 48) <= bound).orderBy(key).limit(n)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``.

    A lambda variable is bound to the value, so the optimizer cannot inline the
    expression at every use (inside an array lambda that would be quadratic).
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The white-space separated words of a text; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACES, -1), "")


def utf8_crc32(text: Column) -> Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))


def rank_cells(rows: int, per_cell: int = 250_000) -> int:
    """How many cells a group is dealt over, so that a group of all rows keeps
    ``per_cell`` rows in each."""
    return max(64, -(-rows // per_cell))


def with_salted_rank(df: DataFrame, keys: list[str], salt: Column, order: list[Column], cells: int) -> DataFrame:
    """Add ``_rank``: 0, 1, 2, ... within ``keys`` (never null), without a task
    that holds a whole group.

    The rows of a group are dealt over ``cells`` cells by ``salt``. Ranks count
    on from the rows of the earlier cells, whose number is summed per cell first.
    """
    df = df.withColumn("_cell", F.pmod(salt, F.lit(cells)).cast("int"))
    counts = df.groupBy(*keys, "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = Window.partitionBy(*keys, "_cell").orderBy(*order)
    ranked = df.withColumn("_rank", F.row_number().over(inner).cast("long") - 1)
    return (ranked.join(offsets, [*keys, "_cell"])
            .withColumn("_rank", F.col("_rank") + F.col("_offset")).drop("_offset", "_cell"))
