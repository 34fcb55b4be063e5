"""Daily calendar source (inclusive date range)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def calendar_days(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day from ``start`` to ``end`` inclusive, column ``data``.

    Generated with ``spark.range`` so the rows are produced in parallel; the
    day offset doubles as the 0-based position of the date in the calendar.
    """
    n_days = (end - start).days + 1
    if n_days <= 0:
        return spark.range(0).select(F.lit(None).cast("date").alias("data"))
    return spark.range(n_days).select(
        F.date_add(F.lit(start), F.col("id").cast("int")).alias("data")
    )


def resolve_calendar(src, cfg):
    """Fill a missing calendar bound from the invoice dates (one-row aggregate)."""
    from datetime import date as _date

    if cfg.calendar_start is not None and cfg.calendar_end is not None:
        return cfg
    d = F.to_date(F.col("data_venda"))
    row = src.nota_fiscal.agg(F.min(d).alias("lo"), F.max(d).alias("hi")).first()
    lo = cfg.calendar_start or (_date(row["lo"].year, 1, 1) if row["lo"] else _date(2015, 1, 1))
    hi = cfg.calendar_end or (_date(row["hi"].year, 12, 31) if row["hi"] else lo)
    return cfg.with_(calendar_start=lo, calendar_end=hi)
