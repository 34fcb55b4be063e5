"""Surrogate keys and first-row-per-key.

``dense_key`` numbers rows 1..N in the order of their natural key, exactly as
``row_number() OVER (ORDER BY key)`` would, without funnelling the table
through the single task an unpartitioned window runs in:

1. The last ordering column is cut into quantile ranges (boundaries come from
   ``approxQuantile``, for text from a sample of keys compared as text; only
   those few values reach the driver). Any leading
   ordering columns are kept as-is in front of the range number, so the pair
   (leading columns, range) sorts like the full key.
2. Rows are counted per range (one small aggregate), a running sum over that
   small table gives each range its starting offset.
3. Each row gets offset + its row_number inside its range; ranges are
   numbered in parallel, one window partition each.

The boundaries only steer balance; correctness does not depend on them, so
an approximate quantile is enough. Natural keys must be unique for the
numbering to be deterministic.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
            T.DoubleType, T.DecimalType)
#: Quantile boundaries found; more ranges than that cut each span evenly.
TREE = 512
#: Bytes of a text key that cut the span between two boundaries (a double holds them exactly).
TEXT_BYTES = 6
#: Text keys sampled for each boundary.
TEXT_SAMPLE = 32


def default_buckets(df: DataFrame) -> int:
    return max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))


def _text_as_number(x: Column, shared: Column) -> Column:
    """A number that never falls as the text rises, among texts that share their first
    ``shared`` bytes: the bytes after these."""
    part = F.substring(F.encode(x, "UTF-8"), shared + 1, F.lit(TEXT_BYTES))
    return F.conv(F.rpad(F.hex(part), 2 * TEXT_BYTES, "0"), 16, 10).cast("double")


def _text_number(text: str, shared: int) -> float:
    """``_text_as_number`` of a boundary."""
    return float(int.from_bytes(text.encode()[shared:shared + TEXT_BYTES].ljust(TEXT_BYTES, b"\0"), "big"))


def text_bounds(df: DataFrame, c: str, cuts: int) -> list[str]:
    """Quantiles of a text column in its own order: of the different texts whose hash
    lies below a bound, about ``TEXT_SAMPLE`` for each boundary."""
    want, rows = TEXT_SAMPLE * cuts, df.agg(F.count(c)).first()[0]
    sample = df.select(c).filter(F.col(c).isNotNull())
    if rows > want:
        sample = sample.filter(F.xxhash64(c) < F.lit(-(1 << 63) + (1 << 64) * want // rows))
    found = sorted((r[0] for r in sample.distinct().collect()), key=str.encode)
    return [found[i] for i in sorted({i * (len(found) - 1) // cuts for i in range(cuts + 1)})] if found else []


def _as_number(df: DataFrame, c: str) -> Column | None:
    dt = df.schema[c].dataType
    if isinstance(dt, _NUMERIC):
        return F.col(c).cast("double")
    if isinstance(dt, T.DateType):
        return F.unix_date(F.col(c)).cast("double")
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(c).cast("timestamp")).cast("double")
    return None


def range_index(x: Column, bounds: list[float] | list[str], within: int = 1) -> Column:
    """Number of boundaries <= x, as a balanced CASE tree (log2(n) compares). With
    ``within`` over 1 the span between two boundaries counts as that many ranges,
    cut evenly (texts: by the bytes after those that both boundaries share)."""

    def build(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(x < F.lit(bounds[mid]), build(lo, mid)).otherwise(build(mid + 1, hi))

    tree = build(0, len(bounds))
    if within > 1 and len(bounds) > 1:
        # Ranges 1 to len(bounds) - 1 lie between two boundaries; the outer ones stay whole.
        if isinstance(bounds[0], str):
            spans = list(zip(bounds, bounds[1:], strict=False))
            common = [len(os.path.commonprefix([a.encode(), b.encode()])) for a, b in spans]
            ends = [[_text_number(span[i], n) for span, n in zip(spans, common, strict=True)] for i in (0, 1)]
            low, high = (F.get(F.array(*map(F.lit, e)), tree - 1) for e in ends)
            number = _text_as_number(x, F.get(F.array(*map(F.lit, common)), tree - 1))
        else:
            edges = F.array(*[F.lit(b) for b in bounds])
            low, high, number = F.get(edges, tree - 1), F.get(edges, tree), x
        share = F.when(high > low, F.floor((number - low) / (high - low) * within)).otherwise(0)
        inner = (tree > 0) & (tree < len(bounds))
        part = F.when(inner, F.least(F.lit(within - 1), F.greatest(F.lit(0), share))).otherwise(F.lit(0))
        tree = (tree * within + part).cast("int")
    return F.when(x.isNull(), F.lit(-1)).otherwise(tree)


def dense_key(df: DataFrame, name: str, order_by: list[str], *,
              buckets: int | None = None, first: bool = True, ties: list[str] | None = None) -> DataFrame:
    """Add column ``name`` = 1..N following ``order_by`` (ascending, nulls first), rows that
    are equal in these in the order of ``ties``.

    ``first`` puts the new key as the first column (surrogate-key layout).
    """
    cols = list(order_by)
    last, prefix = cols[-1], cols[:-1]
    text = isinstance(df.schema[last].dataType, T.StringType)
    num = F.col(last) if text else _as_number(df, last)
    bounds: list[float] | list[str] = []
    within = 1
    if num is not None:
        n = buckets or default_buckets(df)
        if n > 1:
            cuts = min(n, TREE)
            if text:
                bounds = text_bounds(df, last, cuts)
            else:
                probs = [i / cuts for i in range(cuts + 1)]
                q = df.select(num.alias("_k")).approxQuantile("_k", probs, 1.0 / (4 * cuts))
                bounds = sorted({b for b in q if b is not None})
            within = -(-n // cuts)
    rng = range_index(num, bounds, within) if num is not None else F.lit(0)
    keyed = df.withColumn("_rng", rng)
    groups = prefix + ["_rng"]

    sizes = keyed.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(*[F.col(c).asc_nulls_first() for c in groups]).rowsBetween(
        Window.unboundedPreceding, -1)
    offsets = sizes.select(*groups, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # Without leading columns the offset table has a row per range at most.
    if not prefix:
        offsets = F.broadcast(offsets)

    k, o = keyed.alias("_k"), offsets.alias("_o")
    cond = [F.col(f"_k.{c}").eqNullSafe(F.col(f"_o.{c}")) for c in groups]
    joined = k.join(o, cond, "inner").select("_k.*", "_o._off")
    within = Window.partitionBy(*groups).orderBy(*[F.col(c).asc_nulls_first() for c in [*cols, *(ties or [])]])
    out = joined.withColumn(name, (F.col("_off") + F.row_number().over(within)).cast("bigint"))
    out = out.drop("_rng", "_off")
    if first:
        out = out.select(name, *[c for c in df.columns if c != name])
    return out


def first_per_key(df: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Keep one row per ``key``: the one with the smallest ``order_by`` values.

    A grouped ``min`` over a struct whose leading fields are the ordering
    columns; it is combined map-side, so a key holding a large share of the
    rows never lands whole in one task. Rows with a NULL key form one group.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    packed = F.struct(*[F.col(c) for c in order_by + rest]).alias("_first")
    return (
        df.groupBy(key).agg(F.min(packed).alias("_first"))
        .select(key, *[F.col(f"_first.{c}").alias(c) for c in order_by + rest])
        .select(*df.columns)
    )
