"""Exclusive prefix sums and dense codes within groups, safe under key skew.

``SUM(m) OVER (PARTITION BY k ORDER BY o ROWS UNBOUNDED PRECEDING AND 1 PRECEDING)``
sends every row of a key to one task.  Here a key is cut into segments by a
column that never falls along the order and depends on the row alone, such as
the high bits of a hash order.  Segment totals are partial aggregates, a window over them (keys x segments rows) gives
each segment's offset, and the running sum inside a segment is a window
partitioned by key and segment.  Everything is JVM-side, and no step relies on
two reads of a shuffle being cut alike.  Orders of values are cut into range
partitions instead, which are written before they are counted (``range_ranks``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..session import shared_path

# Segments of a hash order (a power of two).
SEGMENTS = 1024


def hash_segment(order: Column, bits: int = 32, segments: int = SEGMENTS) -> Column:
    """The high bits of a ``bits``-bit non-negative number: rises with it."""
    return F.shiftright(order, bits - (segments - 1).bit_length()).cast("int")


def prefix_sums(df: DataFrame, keys: Sequence[str], orders: Sequence[str], measures: Sequence[str], segment: Column) -> DataFrame:
    """Add ``<m>_before`` = sum of ``m`` over earlier rows of the same key.

    ``segment`` must not fall along ``orders``, which must be unique within a
    key (ties need a tie-breaker column); keys must not be NULL.
    """
    keys, measures, cols = list(keys), list(measures), df.columns
    d = df.withColumn("_px_seg", segment)
    totals = d.groupBy(*keys, "_px_seg").agg(*(F.sum(m).alias(f"_px_{m}") for m in measures))
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_px_seg").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_px_seg", *(F.coalesce(F.sum(f"_px_{m}").over(earlier), F.lit(0)).alias(f"_px_off_{m}") for m in measures))
    inside = Window.partitionBy(*keys, "_px_seg").orderBy(*orders).rowsBetween(Window.unboundedPreceding, -1)
    j = d.join(offsets, [*keys, "_px_seg"])
    return j.select(*cols, *((F.coalesce(F.sum(m).over(inside), F.lit(0)) + F.col(f"_px_off_{m}")).alias(f"{m}_before") for m in measures))


def range_ranks(df: DataFrame, keys: Sequence[str], orders: Sequence[str], out: str) -> DataFrame:
    """Add ``out``: the 0-based place of each row of its key in the order of
    ``orders`` (unique within a key; keys must not be NULL).

    Rows are range-partitioned by key and order into as many parts as the
    session has shuffle partitions and written so to the shared folder, which
    runs when the function is called: the parts must not be cut anew.  A row's
    place is its place inside its part, by a window over that part, and the rows
    of its key in the parts before, from one count per key and part.
    """
    keys, orders, spark = list(keys), list(orders), df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = shared_path(spark, "ranks", "t")
    df.repartitionByRange(n, *keys, *orders).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    cut = spark.read.schema(StructType([*df.schema.fields, StructField("_part", IntegerType())])).parquet(path)
    counts = cut.groupBy(*keys, "_part").agg(F.count(F.lit(1)).alias("_n"))
    earlier = (Window.partitionBy(*keys) if keys else Window.partitionBy()).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))       # keys x parts rows
    inside = Window.partitionBy(*keys, "_part").orderBy(*orders)
    ranked = cut.withColumn("_at", F.row_number().over(inside) - 1)
    return ranked.join(before, [*keys, "_part"]).select(*df.columns, (F.col("_at") + F.col("_before")).cast("int").alias(out))


def dense_codes(df: DataFrame, value_col: str, keys: Sequence[str] = (), code_col: str = "code") -> DataFrame:
    """Distinct non-NULL values of ``value_col`` (per key) with 0-based sorted
    codes: ``dense_rank() - 1`` over distinct values, in bounded tasks."""
    keys = list(keys)
    d = df.select(*keys, value_col).where(F.col(value_col).isNotNull()).distinct()
    return range_ranks(d, keys, [value_col], code_col).select(*keys, value_col, code_col)
