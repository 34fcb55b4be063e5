"""Compare a Spark result with a DuckDB statement, order-insensitively."""

from __future__ import annotations

import datetime as _dt
import decimal
import os

import duckdb

DRIVER_TABLES = ("region nation customer supplier part orders lineitem events documents "
                 "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    """Exact comparison: doubles by their exact value, decimals by value
    (Decimal('1.50') == Decimal('1.5')); NaN is not NULL."""
    if v is None:
        return None
    if isinstance(v, float):
        return repr(v)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, _dt.datetime):
        return v.isoformat()
    if isinstance(v, _dt.date):
        return v.isoformat()
    return v


def _key(row):
    return tuple((x is None, "" if x is None else str(type(x).__name__), "" if x is None else x) for x in row)


def compare(spark_df, sql: str, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    scols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    out = {"spark_rows": len(srows), "oracle_rows": len(drows),
           "spark_cols": sorted(scols), "oracle_cols": sorted(dcols)}
    if sorted(scols) != sorted(dcols):
        out["match"] = False
        out["why"] = "columns"
        return out
    order = sorted(scols)
    si = [scols.index(c) for c in order]
    di = [dcols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in si) for r in srows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in di) for r in drows), key=_key)
    out["match"] = s == d
    if not out["match"]:
        ds = [x for x in s if x not in set(d)][:3] if len(s) < 200000 else []
        dd = [x for x in d if x not in set(s)][:3] if len(d) < 200000 else []
        out["why"] = {"cols": order, "only_spark": ds, "only_oracle": dd}
    return out


def duck_type(t) -> str:
    """Spark type -> DuckDB type name."""
    from pyspark.sql import types as T

    simple = {T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.ShortType: "SMALLINT",
              T.DoubleType: "DOUBLE", T.StringType: "VARCHAR", T.DateType: "DATE",
              T.BooleanType: "BOOLEAN", T.TimestampNTZType: "TIMESTAMP",
              T.TimestampType: "TIMESTAMP"}
    for cls, name in simple.items():
        if isinstance(t, cls):
            return name
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    return str(t)


def type_diff(spark_df, sql: str, con) -> dict:
    s = {f.name: duck_type(f.dataType) for f in spark_df.schema.fields}
    d = {r[0]: r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    return {k: (s.get(k), d.get(k)) for k in set(s) | set(d) if s.get(k) != d.get(k)}
