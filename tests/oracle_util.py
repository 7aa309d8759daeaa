"""Run a registered query in Spark and its SQL twin in DuckDB; compare results.

The comparison mirrors the driver: column names (sorted), row count and an
order-insensitive hash of the values.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import math

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sql: str, sf_dir: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    pdf = con.sql(sql).df()
    # newer DuckDB gives integers with NULLs as Int64; Spark's toPandas gives them as float64
    nullable = [c for c in pdf.columns if isinstance(pdf[c].dtype, pd.api.extensions.ExtensionDtype) and pdf[c].dtype.kind in "iu" and pdf[c].isna().any()]
    return pdf.astype({c: "float64" for c in nullable})


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (pd.Timestamp, _dt.datetime, _dt.date)):
        return str(pd.Timestamp(v))
    if v is pd.NaT:
        return None
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def rows_of(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return out


def value_hash(rows: list[tuple]) -> str:
    h = [hashlib.md5(repr(r).encode()).hexdigest() for r in rows]
    return hashlib.md5("".join(sorted(h)).encode()).hexdigest()


def compare(spark_pdf: pd.DataFrame, duck_pdf: pd.DataFrame) -> dict:
    res = {"cols_match": sorted(spark_pdf.columns) == sorted(duck_pdf.columns),
           "rows_spark": len(spark_pdf), "rows_duck": len(duck_pdf)}
    if not res["cols_match"]:
        res["cols_spark"] = sorted(spark_pdf.columns)
        res["cols_duck"] = sorted(duck_pdf.columns)
        res["ok"] = False
        return res
    kinds = {c: (spark_pdf[c].dtype.kind, duck_pdf[c].dtype.kind) for c in spark_pdf.columns}
    res["dtype_diff"] = {c: k for c, k in kinds.items()
                         if k[0] != k[1] and not (k[0] in "iu" and k[1] in "iu")}
    a, b = rows_of(spark_pdf), rows_of(duck_pdf)
    res["hash_match"] = value_hash(a) == value_hash(b)
    res["ok"] = res["hash_match"] and len(a) == len(b)
    if not res["ok"]:
        sa, sb = set(a), set(b)
        res["only_spark"] = sorted(sa - sb, key=repr)[:3]
        res["only_duck"] = sorted(sb - sa, key=repr)[:3]
    return res
