"""Readers and writers: delimited text with a declared schema, training logs,
submissions, importance tables, feature tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import nan_to_null

# Declared schema of the raw listing files (space separated, header row).
RAW_FIELDS = (
    [("SaleID", T.LongType()), ("name", T.LongType()), ("regDate", T.IntegerType()),
     ("model", T.DoubleType()), ("brand", T.IntegerType()), ("bodyType", T.DoubleType()),
     ("fuelType", T.DoubleType()), ("gearbox", T.DoubleType()), ("power", T.IntegerType()),
     ("kilometer", T.DoubleType()), ("notRepairedDamage", T.StringType()),
     ("regionCode", T.IntegerType()), ("seller", T.IntegerType()), ("offerType", T.IntegerType()),
     ("creatDate", T.IntegerType()), ("price", T.DoubleType())]
    + [(f"v_{i}", T.DoubleType()) for i in range(15)])


def raw_schema(with_price: bool = True) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS
                         if with_price or n != "price"])


def read_delimited(spark: SparkSession, path: str, schema: T.StructType | None = None,
                   sep: str = " ", header: bool = True) -> DataFrame:
    """Header + separator text files with a declared schema (no inference pass).

    With a header the columns are found by name, in whatever order the file
    has them; a declared column that the header lacks is an error, further
    ones are left out.  Text that is no value of the declared type gives
    NULL, and so do empty fields and NaN.
    """
    r = spark.read.option("sep", sep).option("header", header).option("nullValue", "")
    if schema is None:
        return r.csv(path)
    if not header:
        raw = r.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])).csv(path)
    else:
        raw = r.csv(path)
        missing = [f.name for f in schema.fields if f.name not in raw.columns]
        if missing:
            raise ValueError(f"{path}: the header lacks {missing}")
    return raw.select(*(_typed(f).alias(f.name) for f in schema.fields))


def _typed(f: T.StructField) -> Column:
    c = F.col(f"`{f.name}`")
    if isinstance(f.dataType, T.StringType):
        return c
    x = c.try_cast(f.dataType)
    return nan_to_null(x) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else x


LOG_SCHEMAS = {
    "error": T.StructType([T.StructField("iter", T.IntegerType()), T.StructField("RMSE", T.DoubleType())]),
    "time": T.StructType([T.StructField("iter", T.IntegerType()), T.StructField("Passed", T.DoubleType()),
                          T.StructField("Remaining", T.DoubleType())]),
}


def read_training_log(spark: SparkSession, path: str, kind: str = "error") -> DataFrame:
    """Tab-separated per-iteration log with a header row."""
    return read_delimited(spark, path, LOG_SCHEMAS[kind], sep="\t")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_submission(df: DataFrame, path: str, key: str = "SaleID", price: str = "price") -> None:
    """(id, price) CSV with a header."""
    write_csv(df.select(F.col(key), F.col(price)), path)


def write_importance(imp: DataFrame, path: str) -> None:
    write_csv(imp.orderBy(F.desc("importance"), F.asc("feature")), path, single_file=True)


def write_feature_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(partition_by)
    w.parquet(path)
