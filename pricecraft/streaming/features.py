"""Feature engineering on a stream.

The row-level feature functions are plain Column expressions, so they apply
to a streaming DataFrame unchanged; fitted statistics (brand means, tiers,
target encodings) are static DataFrames joined to the stream (stream-static
join: no streaming state, the static side is small and broadcast after a
size check).  ``run_available_now`` drains everything present in the source
folder with the ``availableNow`` trigger and returns the sink as a batch
DataFrame; the checkpoint lives in the shared folder, so a restarted or
moved driver resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import checked_broadcast
from ..plans import features as FE
from ..session import shared_path


def stream_features(stream: DataFrame, brand_stats: DataFrame, as_of_year: int) -> DataFrame:
    """Cleaning, time features, brand join and flags on a (streaming) DataFrame."""
    d = FE.time_features(FE.clean(stream), as_of_year)
    d = d.join(checked_broadcast(brand_stats), "brand", "left")
    return FE.flag_features(FE.condition_features(d))


def run_available_now(spark: SparkSession, source_dir: str, schema, transform, name: str = "stream") -> DataFrame:
    """Read ``source_dir`` as a Parquet stream, apply ``transform``, write a
    Parquet sink with the availableNow trigger, and return the sink."""
    base = shared_path(spark, "streams", name)
    stream = spark.readStream.schema(schema).parquet(source_dir)
    out = transform(stream)
    q = (out.writeStream.format("parquet").option("path", f"{base}/sink")
            .option("checkpointLocation", f"{base}/checkpoint")
            .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")


def stage_files(df: DataFrame, name: str) -> str:
    """Write ``df`` as Parquet files (the stream's input) in the shared folder,
    as many as it has partitions."""
    spark = df.sparkSession
    path = shared_path(spark, "stream-input", name)
    df.write.parquet(path)
    return path


__all__ = ["stream_features", "run_available_now", "stage_files", "F"]
