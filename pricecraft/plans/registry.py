"""Registry of named queries: a Spark builder and (optionally) a DuckDB oracle.

``register`` stores the Spark function and its SQL twin.  Both sides are
rounded by the same per-column spec, so engine-specific float noise cannot
change the value hash.  Every query starts from the listings view built from
the given tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.listings import LISTINGS_SQL, listings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF_YEAR = 2004       # reference year for ages (ages 3..9 on the driver tables)
VALID_PCT = 20          # hold-out share for the repeatable split


def _round(df: DataFrame, spec: dict[str, int]) -> DataFrame:
    if not spec:
        return df
    # "+ 0.0" turns -0.0 into 0.0
    return df.withColumns({c: F.round(F.col(c), d) + 0.0 for c, d in spec.items()})


def _round_sql(sql: str, spec: dict[str, int], ctes: str = "") -> str:
    head = "WITH " + LISTINGS_SQL.strip()
    if ctes.strip():
        head += ",\n" + ctes.strip().rstrip(",")
    if spec:
        repl = ", ".join(f'round("{c}", {d}) + 0.0 AS "{c}"' for c, d in spec.items())
        return f"{head}\nSELECT * REPLACE ({repl}) FROM (\n{sql.strip()}\n) _q"
    return f"{head}\n{sql.strip()}"


def register(name: str, sql: str | None = None, rounds: dict[str, int] | None = None,
             ctes: str = ""):
    """Decorator: ``fn(spark, sf_dir) -> DataFrame`` plus its oracle SQL."""
    spec = dict(rounds or {})

    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _round(fn(spark, sf_dir), spec)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = _round_sql(sql, spec, ctes)
        return fn

    return deco


def L(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All listings (train and test sides, price present)."""
    return listings(spark, sf_dir)


def TRAIN(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).where(F.col("source") == "train")


def TEST(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listings(spark, sf_dir).where(F.col("source") == "test").drop("price")


def R(cols, d: int = 6) -> dict[str, int]:
    """Rounding spec: the same digits for several columns."""
    return {c: d for c in cols}
