"""Operators on hand-made tables: quantiles, prefix sums, moments, encoders,
constant columns, histories, metrics, splits."""

import hashlib
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricecraft.operators import encode as E
from pricecraft.operators import evaluate as EV
from pricecraft.operators import groupstats as G
from pricecraft.operators import profile as P
from pricecraft.operators import schema as SC
from pricecraft.operators.outliers import fences, iqr_filter, outlier_flag_and_clip, qcut_tier
from pricecraft.operators.prefix import dense_codes, prefix_sums
from pricecraft.operators.quantiles import exact_quantiles


@pytest.fixture(params=["true", "false"])
def path(spark, request):
    """Run a test with and without reuse of equal exchanges: no result may rest on it."""
    spark.conf.set("spark.sql.exchange.reuse", request.param)
    yield request.param
    spark.conf.unset("spark.sql.exchange.reuse")


@pytest.mark.parametrize("seed", [0, 1, 2])
def test_exact_quantiles_match_pandas_under_skew(spark, seed, path):
    rng = np.random.default_rng(seed)
    n = 3000
    k = np.where(rng.random(n) < 0.5, "hot", rng.choice(["a", "b", "c"], n))
    v = np.round(rng.normal(0, 10, n), 1)
    pdf = pd.DataFrame({"k": k, "v": v})
    pdf.loc[::97, "v"] = np.nan
    df = spark.createDataFrame(pdf).repartition(3)
    probs = [0, 0.05, 0.25, 0.5, 0.75, 0.95, 1]
    got = exact_quantiles(df, "v", probs, ["k"]).toPandas()
    ref = pdf.groupby("k")["v"].quantile(probs).reset_index()
    ref.columns = ["k", "p", "q"]
    m = got.merge(ref, on=["k", "p"])
    assert len(m) == len(ref) == len(got)
    assert np.allclose(m.q_x, m.q_y, rtol=0, atol=1e-9)


def test_quantiles_single_value_and_empty_group(spark, path):
    df = spark.createDataFrame([("a", 5.0), ("b", None)], "k string, v double")
    got = exact_quantiles(df, "v", [0.25, 0.5], ["k"]).orderBy("p").collect()
    assert [(r.k, r.q) for r in got] == [("a", 5.0), ("a", 5.0)]


@pytest.mark.parametrize("accuracy", [10, 50, 10_000])
def test_quantiles_are_exact_at_any_bracket_width(spark, path, accuracy):
    rng = np.random.default_rng(9)
    v = np.concatenate([rng.normal(size=1500), np.repeat(0.25, 700), rng.exponential(size=800)])
    df = spark.createDataFrame(pd.DataFrame({"v": rng.permutation(v)})).repartition(5)
    probs = [0, 0.01, 0.1, 0.5, 0.77, 0.999, 1]
    got = {r.p: r.q for r in exact_quantiles(df, "v", probs, accuracy=accuracy).collect()}
    assert np.allclose([got[p] for p in probs], np.quantile(v, probs), rtol=0, atol=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7, 10, 101])
def test_quantiles_of_few_values(spark, n):
    v = [float(x * x) for x in range(n)]
    probs = [0, 0.05, 0.25, 0.5, 0.75, 0.95, 1]
    got = {r.p: r.q for r in exact_quantiles(spark.createDataFrame([(x,) for x in v], "v double"), "v", probs).collect()}
    assert np.allclose([got[p] for p in probs], np.quantile(v, probs))


def test_prefix_sums_match_window(spark, path):
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"k": rng.choice(["x", "y"], 500, p=[0.9, 0.1]), "o": rng.permutation(500),
                        "m": rng.integers(0, 10, 500)})
    out = prefix_sums(spark.createDataFrame(pdf), ["k"], ["o"], ["m"], F.floor(F.col("o") / 37)).toPandas()
    ref = pdf.sort_values(["k", "o"]).assign(b=lambda d: d.groupby("k").m.cumsum() - d.m)
    m = out.merge(ref, on=["k", "o"])
    assert len(m) == 500 and (m.m_before == m.b).all()


def test_dense_codes_of_many_values(spark, path):
    values = [f"v{i % 700:04d}" for i in range(2100)]
    got = {r.v: r.code for r in dense_codes(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()}
    assert got == {v: i for i, v in enumerate(sorted(set(values)))}


def test_ordered_target_stats_without_exchange_reuse(spark, path):
    rows = [(f"key{i}", "hot" if i % 3 else "cold", float(i % 17)) for i in range(600)]
    df = spark.createDataFrame(rows, "key string, c string, y double")
    got = {r.key: r.c_ots for r in E.ordered_target_stats(df, "c", "y", "key").collect()}
    order = lambda k: (int(hashlib.md5(k.encode()).hexdigest()[:8], 16), k)
    mean, run = sum(r[2] for r in rows) / len(rows), {}
    for k, c, y in sorted(rows, key=lambda r: order(r[0])):
        s, n = run.get(c, (0.0, 0))
        assert math.isclose(got[k], (s + mean) / (n + 1), rel_tol=1e-12)
        run[c] = (s + y, n + 1)
    assert len(got) == 600


def test_dense_codes_sorted(spark, path):
    df = spark.createDataFrame([(v,) for v in ["b", "a", None, "c", "a"]], "v string")
    got = {r.v: r.code for r in dense_codes(df, "v").collect()}
    assert got == {"a": 0, "b": 1, "c": 2}


def test_bias_corrected_moments(spark):
    df = spark.createDataFrame([(x,) for x in [1.0, 2.0, 4.0, 9.0]], "x double")
    r = P.target_summary(df, "x").collect()[0]
    assert math.isclose(r.skew, 1.3309, abs_tol=1e-4)
    assert math.isclose(r.kurtosis, 1.5, abs_tol=1e-9)
    assert r.median == 3.0


def test_group_stats_null_key_single_row(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("a", 4.0), ("s", 7.0)], "k string, y double")
    st = {r.k: r for r in G.group_stats(df, "k", "y", "k").collect()}
    assert set(st) == {"a", "s"}
    assert st["s"]["k_price_std"] is None and st["s"]["k_count"] == 1


def test_target_encoding_unseen_and_null(spark):
    train = spark.createDataFrame([(None, 1.0), ("a", 2.0), ("a", 4.0), ("b", 9.0)], "k string, y double")
    test = spark.createDataFrame([("a",), ("b",), ("zz",), (None,)], "k string")
    out = {r.k: r.k_encoded for r in E.target_encode(train, test, ["k"], "y").collect()}
    assert out["a"] == 3.0 and out["b"] == 9.0
    assert out["zz"] == 4.0 and out[None] == 4.0    # global mean of all training rows


def test_tied_group_means_go_to_lower_tier(spark, path):
    st = spark.createDataFrame([(f"b{i}", float(v)) for i, v in enumerate([1, 2, 2, 2, 3, 4, 5, 6, 7])],
                               "brand string, m double")
    got = {r.brand: r.tier for r in qcut_tier(st, "m", "tier").collect()}
    assert got["b1"] == got["b2"] == got["b3"] == "budget"   # edge 2.0 equals the value
    assert got["b8"] == "luxury"


def test_constant_columns_null_counts_as_value(spark):
    df = spark.createDataFrame([(1, None, 5, 1.0), (1, None, None, 2.0)], "a int, b int, c int, y double")
    assert SC.drop_constant_columns(df).columns == ["c", "y"]


def test_freq_encode_null_label(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    out = {r.c: r.c_freq for r in E.freq_encode(df, ["c"]).collect()}
    assert out == {"a": 0.5, "未知": 0.25, "b": 0.25}


def test_category_codes_shared_unseen(spark, path):
    tr = spark.createDataFrame([("b",), ("a",)], "c string")
    te = spark.createDataFrame([("a",), ("z",), (None,)], "c string")
    got = {r.c: r.c_code for r in E.category_codes_shared(tr, te, "c").collect()}
    assert got == {"a": 0, "z": -1, None: -1}


def test_ordered_target_stats_of_many_orders_and_combinations(spark):
    rows = [(f"k{i}", None if i % 7 == 0 else "ab"[i % 2], ["bc", "c", None][i % 3], None if i % 5 == 0 else float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "key string, a string, b string, y double")
    got = {r.key: (r.a_ots, r.a_b_ots) for r in E.ordered_target_stats_many(df, ["a", ["a", "b"]], "y", "key", ("s", "t"), prior=F.lit(2.0)).collect()}

    def brute(me, of):
        encs = []
        for s in "st":
            order = lambda r: (hashlib.md5(f"{s}:{r[0]}".encode()).hexdigest()[:8], r[0])
            before = [r[3] for r in rows if of(r) == of(me) and order(r) < order(me) and r[3] is not None]
            encs.append((sum(before) + 2.0) / (len(before) + 1))
        return sum(encs) / 2
    for r in rows:
        assert got[r[0]] == pytest.approx((brute(r, lambda x: x[1]), brute(r, lambda x: x[1:3])))
    assert E.ordered_target_stats_many(df.limit(0), ["a"], "y", "key").count() == 0


def test_ordered_target_stats_many_moves_a_row_once_an_order(spark):
    """Before, a row travelled once per category and order, and all of that once more by its key."""
    n, salts, cols = 4000, ("s", "t"), ["a", "b", ["a", "b"]]
    df = spark.range(n, numPartitions=4).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 3).cast("string").alias("a"),
                                                (F.col("id") % 2).cast("string").alias("b"), F.col("id").cast("double").alias("y"))
    out = E.ordered_target_stats_many(df, cols, "y", "key", salts, prior=F.lit(2.0))
    assert "hashpartitioning(_key" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.count() == n
    # rows of one key give one row, those without a key give none
    odd = df.where("id < 50").unionByName(df.where("id < 5")).unionByName(df.where("id < 3").withColumn("key", F.lit(None).cast("string")))
    got = {r.key: r.a_ots for r in E.ordered_target_stats_many(odd, ["a"], "y", "key", salts, prior=F.lit(2.0)).collect()}
    assert len(got) == 50 and None not in got and all(v is not None for v in got.values())


def test_ordered_target_stats_uses_only_earlier_rows(spark):
    pdf = pd.DataFrame({"key": [f"k{i}" for i in range(40)], "c": ["x"] * 30 + ["y"] * 10,
                        "y": np.arange(40, dtype=float)})
    out = E.ordered_target_stats(spark.createDataFrame(pdf), "c", "y", "key", prior=F.lit(0.0)).toPandas()
    import hashlib
    pdf["h"] = [int(hashlib.md5(k.encode()).hexdigest()[:8], 16) for k in pdf.key]
    pdf = pdf.sort_values(["c", "h", "key"])
    pdf["ref"] = (pdf.groupby("c").y.cumsum() - pdf.y) / (pdf.groupby("c").cumcount() + 1.0)
    m = out.merge(pdf, on="key")
    assert np.allclose(m.c_ots, m.ref)


def test_standard_scale_pop_std_and_zero_std(spark):
    tr = spark.createDataFrame([(1.0, 3.0), (3.0, 3.0)], "a double, b double")
    out = E.standard_scale(tr, tr, ["a", "b"]).collect()
    assert [r.a for r in out] == [-1.0, 1.0] and [r.b for r in out] == [0.0, 0.0]


def test_impute_median_uses_train(spark, path):
    tr = spark.createDataFrame([(1.0,), (2.0,), (10.0,), (None,)], "x double")
    te = spark.createDataFrame([(None,), (5.0,)], "x double")
    assert [r.x for r in E.impute_median(tr, te, ["x"]).collect()] == [2.0, 5.0]


def test_winsorized_values_inside_fences(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame(pd.DataFrame({"x": np.r_[rng.normal(0, 1, 500), [50.0, -60.0]]}))
    f = fences(df, ["x"]).collect()[0]
    out = outlier_flag_and_clip(df, ["x"]).toPandas()
    assert out.x.min() >= f.x_lo - 1e-12 and out.x.max() <= f.x_hi + 1e-12
    assert out.x_outlier.sum() == 2
    kept = iqr_filter(df, ["x"]).count()
    assert kept < 502


def test_split_disjoint_and_covering(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    a, b = EV.split_frames(df, "k", 20)
    na, nb = a.count(), b.count()
    assert na + nb == 5000 and a.join(b, "k").count() == 0
    assert 800 < nb < 1200


def test_early_stop_plateau_and_tie(spark):
    rows = [("v", i, r) for i, r in enumerate([5.0, 4.0, 3.0, 3.0, 3.5, 3.6, 3.7, 3.8, 3.0, 3.9], start=1)]
    h = spark.createDataFrame(rows, "set string, iteration int, rmse double")
    r = EV.early_stop_point(h, 3).collect()[0]
    assert r.best_iteration == 3 and r.best_value == 3.0
    assert r.stop_iteration == 6      # last improvement at 3, patience 3


def test_metrics_weights_blend(spark):
    rows = [(k, m, y, p) for k, y in enumerate([1.0, 2.0, 3.0, 4.0])
            for m, p in [("m1", y + 1), ("m2", y * 1.1)]]
    preds = spark.createDataFrame(rows, "key long, model string, y double, p double")
    met = {r.model: r for r in EV.regression_metrics(preds, "y", "p", ["model"]).collect()}
    assert met["m1"].mae == 1.0 and met["m1"].rmse == 1.0
    y = np.array([1, 2, 3, 4.0])
    assert math.isclose(met["m2"].r2, 1 - ((0.1 * y) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    w = EV.ensemble_r2_weights(EV.regression_metrics(preds, "y", "p", ["model"])).toPandas()
    assert math.isclose(w.weight.sum(), 1.0)
    blend = EV.ensemble_blend(preds, w.pipe(spark.createDataFrame), "key", "model", "p").count()
    assert blend == 4


def test_clip_negative_predictions(spark):
    df = spark.createDataFrame([(-5.0,), (7.9,)], "prediction double")
    assert [r.price for r in EV.clip_predictions(df).collect()] == [0, 7]


def test_cumulative_importance(spark):
    imp = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.15), ("d", 0.05)], "feature string, importance double")
    kept = [r.feature for r in EV.cumulative_importance_select(imp, 0.85).orderBy("rank").collect()]
    assert kept == ["a", "b", "c"]   # two shares <= 0.85, plus one


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 1.0, 2.0, 3.0, 4.0]], "x double")
    got = {r.bin: r["count"] for r in P.histogram(df, "x", 4).collect()}
    assert got == {0: 1, 1: 1, 2: 1, 3: 2}


def test_correlation_constant_is_null(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 2.0), (1.0, 3.0)], "a double, y double")
    assert P.correlation_with_target(df, ["a"], "y").collect()[0].corr is None


def test_listings_are_written_by_side_without_a_sort(spark, tmp_path):
    from pricecraft.sources import listings as LS
    df = LS.build_listings(spark, "/root/testdata/sf0.001")
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    LS._write_by_source(df, str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t")).select(df.columns)
    assert spark.conf.get(key) == before and back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
