"""Exact-size samples, range-partitioned ranks, the binned density and one-scan correlations."""

import hashlib

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricecraft.operators import evaluate as EVO
from pricecraft.operators import profile as P
from pricecraft.operators.prefix import range_ranks


@pytest.mark.parametrize("n", [0, 1, 7, 500, 2999, 3000, 9999])
def test_samples_have_exactly_n_rows_and_are_the_first_by_hash(spark, n, monkeypatch):
    monkeypatch.setattr(EVO, "CUT_ROWS", 3)
    monkeypatch.setattr(EVO, "_CUT_BITS", 4)
    df = spark.range(3000).select(F.col("id").cast("string").alias("k")).unionByName(spark.createDataFrame([(None,)], "k string")).repartition(5)
    got = {r.k for r in EVO.random_sample_n(df, "k", n).collect()}
    want = sorted((hashlib.md5(str(i).encode()).hexdigest(), str(i)) for i in range(3000))[:n]
    assert got == {k for _, k in want}


def test_holdout_of_exact_size(spark):
    df = spark.range(1237).select(F.col("id").cast("string").alias("k"))
    got = EVO.holdout_split_exact(df, "k", 0.2).groupBy("split").count().collect()
    assert {r.split: r["count"] for r in got} == {"valid": 247, "train": 990}
    assert EVO.holdout_split_exact(df.limit(0), "k").count() == 0


def test_ranks_by_range_partitions(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"k": np.where(rng.random(5000) < 0.6, "hot", rng.choice(list("abc"), 5000)), "v": rng.permutation(5000)})
    out = range_ranks(spark.createDataFrame(pdf).repartition(3), ["k"], ["v"], "r").toPandas()
    assert (out.r == out.groupby("k").v.rank().astype(int) - 1).all() and len(out) == 5000
    # parts follow the shuffle partitions, and none holds all rows of the hot key
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        d = spark.createDataFrame(pdf).repartitionByRange(16, "k", "v").groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(d) > 8 and max(r["count"] for r in d) < 1500
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_density_is_near_the_exact_kernel_sum(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(0, 1, 700), rng.normal(8, 0.3, 300), [30.0]])
    got = P.density_grid(spark.createDataFrame(pd.DataFrame({"v": v})), "v").toPandas().sort_values("i")
    h = v.std(ddof=1) * len(v) ** -0.2
    x = v.min() - np.ptp(v) / 2 + np.arange(1000) * 2 * np.ptp(v) / 999
    exact = np.exp(-0.5 * ((x[:, None] - v) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))
    assert len(got) == 1000 and np.allclose(got.x, x)
    bound = 1 / (8 * P.DENSITY_BINS ** 2 * h * np.sqrt(2 * np.pi))
    assert np.abs(got.density - exact).max() <= bound * 1.01 + 1e-14


def test_correlations_with_a_target(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"y": rng.normal(1e6, 1, 800), "flat": 0.1, "none": np.nan})
    pdf["a"] = pdf.y * 2 + rng.normal(0, 2, 800)
    pdf["b"] = rng.normal(size=800)
    pdf.loc[::3, "b"] = np.nan
    pdf.loc[::5, "y"] = np.nan
    df = spark.createDataFrame(pdf).repartition(6).withColumn("none", F.lit(None).cast("double"))
    got = {r.column: r["corr"] for r in P.correlation_with_target(df, ["a", "b", "flat", "none"], "y").collect()}
    assert got["a"] == pytest.approx(pdf.a.corr(pdf.y), rel=1e-9) and got["b"] == pytest.approx(pdf.b.corr(pdf.y), abs=1e-9)
    assert got["flat"] is None and got["none"] is None
