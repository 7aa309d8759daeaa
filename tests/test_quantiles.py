"""Quantiles by repeated narrowing: exactness at every width, bounded tasks, few scans."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricecraft.operators import quantiles as Q
from pricecraft.operators.profile import describe

PROBS = [0, 0.003, 0.05, 0.25, 0.5, 0.77, 0.95, 1]


def values(seed, n=4000):
    rng = np.random.default_rng(seed)
    return rng.permutation(np.concatenate([rng.normal(size=n), np.repeat(0.25, n // 3), rng.exponential(1e9, n), -rng.integers(0, 9, n).astype(float),
                                           [0.0, -0.0, 5e-324, -5e-324, 1e300, -1e300]]))


@pytest.mark.parametrize("sub_ranges,limit", [(Q.SUB_RANGES, Q.EXACT_ROWS), (2, 1), (16, 8), (1 << 10, 1)])
def test_columns_are_exact_at_every_width(spark, sub_ranges, limit):
    pdf = pd.DataFrame({"a": values(1), "b": np.round(values(2), 1), "c": np.full(len(values(1)), 7.0)})
    pdf.loc[::7, "a"] = np.nan
    got = {(r.column, r.p): r.q for r in Q.quantile_columns(spark.createDataFrame(pdf).repartition(4), list("abc"), PROBS, sub_ranges=sub_ranges, limit=limit).collect()}
    assert len(got) == 3 * len(PROBS)
    for c in "abc":
        assert [got[c, p] for p in PROBS] == pytest.approx(pdf[c].dropna().quantile(PROBS).tolist(), rel=1e-12, abs=1e-300)


@pytest.mark.parametrize("sub_ranges,limit", [(Q.SUB_RANGES, Q.EXACT_ROWS), (4, 2), (64, 1)])
def test_groups_are_exact_at_every_width(spark, sub_ranges, limit):
    rng = np.random.default_rng(3)
    v = values(4, 700)
    pdf = pd.DataFrame({"k": np.where(rng.random(len(v)) < 0.4, "hot", rng.choice(list("xyz"), len(v))), "j": rng.integers(0, 2, len(v)), "v": v})
    df = spark.createDataFrame(pdf).repartition(3).unionByName(spark.createDataFrame([(None, 1, 5.0), ("x", 0, None), ("lone", 1, 3.0)], "k string, j long, v double"))
    pdf = pd.concat([pdf, pd.DataFrame({"k": ["lone"], "j": [1], "v": [3.0]})])
    got = {(r.k, r.j, r.p): r.q for r in Q.exact_quantiles(df, "v", PROBS, ["k", "j"], sub_ranges=sub_ranges, limit=limit).collect()}
    want = pdf.groupby(["k", "j"]).v.quantile(PROBS)
    assert len(got) == len(want)
    for key, x in want.items():
        assert got[key] == pytest.approx(x, rel=1e-12, abs=1e-300)


def test_infinities_and_empty_columns(spark):
    v = [math.inf, math.inf, -math.inf, 1.0, 2.0, 1e308]
    df = spark.createDataFrame([(x, None, "g") for x in v], "v double, w double, k string")
    want = sorted(v)
    for got in (Q.exact_quantiles(df, "v", [0, 0.2, 0.4, 0.6, 0.8, 1], sub_ranges=2, limit=1),
                Q.exact_quantiles(df, "v", [0, 0.2, 0.4, 0.6, 0.8, 1], ["k"], sub_ranges=2, limit=1)):
        assert [r.q for r in got.orderBy("p").collect()] == want
    assert Q.exact_quantiles(df, "w", [0.5]).collect() == [] and Q.exact_quantiles(df, "w", [0.5], ["k"]).collect() == []
    assert Q.quantile_columns(df.limit(0), ["v", "w"], [0.5]).collect() == []


def test_tasks_that_order_sub_ranges_are_bounded(spark):
    n = 60_000
    df = spark.range(n).select((F.xxhash64("id") / 1e15).alias("v"))
    bracket = (-1e4, 1e4)
    for sub_ranges, limit in ((64, 16), (1 << 10, 512)):
        shift = Q._shift(*bracket, n, sub_ranges, limit)
        counts = Q.count_sub_ranges(df, ["v"], [[(*bracket, shift)]]).collect()
        assert len(counts) <= sub_ranges and sum(r.c for r in counts) == n
        few = df.where("v BETWEEN 0 AND 0.1")
        rows = few.count()
        assert 0 < rows <= limit or limit == 16
        assert len(Q.count_sub_ranges(few, ["v"], [[(0.0, 0.1, Q._shift(0.0, 0.1, rows, sub_ranges, limit))]]).collect()) <= max(sub_ranges, limit)


def test_two_scans_for_ordinary_columns(spark):
    df = spark.range(300_000).select((F.xxhash64("id", F.lit(1)) / 1e16).alias("a"), (F.pmod(F.xxhash64("id"), F.lit(9999)) / 100).alias("b"),
                                     F.exp(F.xxhash64("id", F.lit(2)) / 2e18).alias("c"), F.lit(20_040_315).alias("d"))
    found = Q.ColumnQuantiles(df, list("abcd"), [0.05, 0.25, 0.5, 0.75, 0.95])
    assert found.scans <= 2 and len(found.values) == 20


def test_changed_input_is_noticed(spark):
    df = spark.range(50_000).select(F.rand().alias("v"))          # other values on every scan
    with pytest.raises(Exception, match="other rows"):
        Q.exact_quantiles(df.withColumn("v", F.col("v") + F.monotonically_increasing_id() * 0 + F.shuffle(F.array(F.lit(0.0), F.lit(1.0), F.lit(7.0)))[0]
                                        + F.unix_micros(F.current_timestamp()) % 1000 / 7), "v", [0.3, 0.5, 0.9], sub_ranges=64, limit=1).collect()


def test_describe_is_pandas_describe(spark):
    pdf = pd.DataFrame({"a": values(5), "b": 1e9 + values(6) % 1, "c": np.arange(len(values(5)), dtype=float)})
    pdf["a"] = pdf["a"].clip(-1e6, 1e6)
    pdf.loc[::5, "b"] = np.nan
    df = spark.createDataFrame(pdf).repartition(5).withColumn("none", F.lit(None).cast("double"))
    got = {r.column: r for r in describe(df, ["a", "b", "c", "none"], digits=None).collect()}
    for c in "abc":
        w = pdf[c].describe()
        assert tuple(got[c])[1:] == pytest.approx(tuple(w[x] for x in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")), rel=1e-9)
    assert got["none"]["count"] == 0 and got["none"]["mean"] is None and got["none"]["q50"] is None
