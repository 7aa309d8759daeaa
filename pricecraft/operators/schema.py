"""Projection, schema and set helpers (metadata work stays on the driver;
row work stays in Spark)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def head_n(df: DataFrame, n: int, order_by: Sequence[str] | str) -> DataFrame:
    """First ``n`` rows in a stated order (Spark has no row index)."""
    order_by = [order_by] if isinstance(order_by, str) else list(order_by)
    return df.orderBy(*order_by).limit(n)


def table_shape(df: DataFrame, name: str = "table") -> DataFrame:
    """rows x columns as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Columns found only in ``a`` (side 'a') or only in ``b`` (side 'b')."""
    ca, cb = set(a.columns), set(b.columns)
    rows = [(c, "a") for c in sorted(ca - cb)] + [(c, "b") for c in sorted(cb - ca)]
    return spark.createDataFrame(rows, "column string, side string")


def type_name(dt: T.DataType) -> str:
    return dt.simpleString()


def dtype_counts(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Number of columns per data type."""
    rows = [(f.name, type_name(f.dataType)) for f in df.schema.fields]
    return (spark.createDataFrame(rows, "column string, type string")
            .groupBy("type").agg(F.count(F.lit(1)).alias("n_columns")))


def select_by_type(df: DataFrame, kind: str) -> list[str]:
    """Column names by kind: 'numeric', 'string' (object) or 'boolean'."""
    out = []
    for f in df.schema.fields:
        dt = f.dataType
        if kind == "numeric" and isinstance(dt, NUMERIC_TYPES):
            out.append(f.name)
        elif kind == "string" and isinstance(dt, T.StringType):
            out.append(f.name)
        elif kind == "boolean" and isinstance(dt, T.BooleanType):
            out.append(f.name)
    return out


def select_features(df: DataFrame, exclude: Iterable[str]) -> DataFrame:
    ex = set(exclude)
    return df.select(*[c for c in df.columns if c not in ex])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Drop columns; absent names are ignored."""
    return df.drop(*list(cols))


def constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: whether it holds at most one distinct value, NULL counting as one.

    One pass of min/max/null-count (partial aggregation, no distinct
    expansion): constant iff all NULL, or no NULL and min = max.
    """
    cols = list(cols or df.columns)
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.min(x).alias(f"{c}__mn"), F.max(x).alias(f"{c}__mx"),
                 F.count_if(x.isNull()).alias(f"{c}__nn")]
    one = df.agg(F.count(F.lit(1)).alias("__n"), *aggs)
    structs = []
    for c in cols:
        mn, mx, nn = F.col(f"`{c}__mn`"), F.col(f"`{c}__mx`"), F.col(f"`{c}__nn`")
        is_const = (nn == F.col("__n")) | ((nn == 0) & (mn == mx)) | (F.col("__n") == 0)
        structs.append(F.struct(F.lit(c).alias("column"), F.coalesce(is_const, F.lit(False)).alias("is_constant")))
    return one.select(F.explode(F.array(*structs)).alias("s")).select("s.*")


def drop_constant_columns(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Drop columns with <= 1 distinct value (NULL counts as a value).

    Runs one aggregation job to decide which names to drop.
    """
    const = [r["column"] for r in constant_columns(df, cols).where("is_constant").collect()]
    return df.drop(*const)


def cast_double(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast columns to double; text that is not a number becomes NULL."""
    cols = set(cols or df.columns)
    return df.select(*[F.col(c).try_cast("double").alias(c) if c in cols else F.col(c)
                       for c in df.columns])


def tag_source(df: DataFrame, name: str, col: str = "source") -> DataFrame:
    return df.withColumn(col, F.lit(name))


def filter_source(df: DataFrame, name: str, col: str = "source") -> DataFrame:
    return df.where(F.col(col) == name)


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stack two tables; a column missing on one side becomes NULL there."""
    return a.unionByName(b, allowMissingColumns=True)
