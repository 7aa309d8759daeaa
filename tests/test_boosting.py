"""The boosting loop: exact leaves, categories, missing values, patience, staged metrics."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pricecraft.operators import boosting as B
from pricecraft.operators.evaluate import regression_metrics

ALL = dict(subsample=1.0, feature_share=1.0)


def toy(spark, n=3000, seed=0):
    rng = np.random.default_rng(seed)
    pdf = pd.DataFrame({"x1": rng.uniform(0, 10, n), "x2": rng.uniform(0, 5, n), "c": rng.choice([f"v{i}" for i in range(30)], n), "key": np.arange(n)})
    pdf["y"] = 3 * pdf.x1 + np.where(pdf.x2 > 2.5, 20.0, 0.0) + rng.normal(0, 1, n)
    return pdf


@pytest.mark.parametrize("loss,l2", [("squared", 0.0), ("absolute", 0.0), ("squared", 3.0)])
def test_it_learns(spark, loss, l2):
    df = spark.createDataFrame(toy(spark)).repartition(4)
    model = B.fit_boosted(df.where("key % 5 != 0"), "y", ["x1", "x2"], ["c"], rounds=12, depth=4, step=0.3, loss=loss, l2=l2)
    m = regression_metrics(B.score_boosted(model, df.where("key % 5 = 0"), ["y"]), "y", "prediction").first()
    assert m.r2 > 0.9
    share = {r.feature: r.importance for r in model.feature_importance(spark).collect()}
    assert abs(sum(share.values()) - 1) < 1e-9 and share["c"] < 0.1


def test_a_category_set_is_found_at_depth_one(spark):
    """The target depends on values that no order of the names puts together."""
    rng = np.random.default_rng(1)
    c = rng.choice(list("abcdefghij"), 4000)
    y = np.where(np.isin(c, list("adgj")), 10.0, 0.0)
    df = spark.createDataFrame(pd.DataFrame({"c": c, "y": y, "key": np.arange(4000)}))
    model = B.fit_boosted(df, "y", [], ["c"], rounds=1, depth=1, step=1.0, **ALL)
    assert B.score_boosted(model, df, ["y"]).where("abs(prediction - y) > 1e-9").count() == 0


def test_missing_and_unseen_values_have_bins_of_their_own(spark):
    pdf = pd.DataFrame({"c": ["a", "b", None] * 400, "x": [1.0, 2.0, np.nan] * 400, "key": np.arange(1200)})
    pdf["y"] = [0.0, 5.0, 50.0] * 400
    df = spark.createDataFrame(pdf).withColumn("x", F.nanvl("x", F.lit(None).cast("double")))
    for numeric, nominal in ((["x"], []), ([], ["c"])):
        model = B.fit_boosted(df, "y", numeric, nominal, rounds=1, depth=3, step=1.0, **ALL)
        assert B.score_boosted(model, df, ["y"]).where("abs(prediction - y) > 1e-9").count() == 0
        odd = spark.createDataFrame([("zzz", 9e9), (None, None), ("a", float("nan"))], "c string, x double")
        assert all(np.isfinite(r.prediction) for r in B.score_boosted(model, odd).collect())


def brute_tree(x, g, depth):
    """Prediction of a tree by trying every cut of every column."""
    best = None
    for j in range(x.shape[1]):
        for cut in np.unique(x[:, j])[:-1]:
            m = x[:, j] <= cut
            gain = g[m].sum() ** 2 / m.sum() + g[~m].sum() ** 2 / (~m).sum() - g.sum() ** 2 / len(g)
            if best is None or gain > best[0] + 1e-9:
                best = gain, m
    if depth == 0 or best is None or best[0] <= 1e-9:
        return np.full(len(g), g.mean())
    out = np.empty(len(g))
    for m in (best[1], ~best[1]):
        out[m] = brute_tree(x[m], g[m], depth - 1)
    return out


def test_rounds_are_those_of_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 9, (400, 3)).astype(float)
    y = x[:, 0] * 2 + (x[:, 1] > 4) * 7 + rng.normal(size=400)
    pdf = pd.DataFrame(x, columns=list("abc")).assign(y=y, key=np.arange(400))
    model = B.fit_boosted(spark.createDataFrame(pdf).repartition(3), "y", list("abc"), rounds=4, depth=3, step=0.5, write_every=2, **ALL)
    f = np.full(400, y.mean())
    for _ in range(4):
        f += 0.5 * brute_tree(x, y - f, 3)
    got = B.score_boosted(model, spark.createDataFrame(pdf), ["key"]).toPandas().sort_values("key").prediction
    assert np.allclose(got, f, atol=1e-9)


def test_median_leaves(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"c": rng.choice(list("abcdef"), 999), "key": np.arange(999)})
    pdf["y"] = rng.exponential(10, 999) * (1 + pdf.c.map(ord) % 5)
    df = spark.createDataFrame(pdf)
    model = B.fit_boosted(df, "y", [], ["c"], rounds=1, depth=12, step=1.0, loss="absolute", **ALL)
    want = pdf.groupby("c").y.median()
    assert all(r.prediction == pytest.approx(want[r.c], rel=1e-12) for r in B.score_boosted(model, df, ["c"]).distinct().collect())


def test_patience_stops_training_and_staged_metrics_are_the_history(spark):
    pdf = toy(spark, 1200, 5)
    pdf["y"] = np.random.default_rng(6).normal(size=1200)          # nothing to learn
    df = spark.createDataFrame(pdf)
    tr, va = df.where("key % 3 != 0"), df.where("key % 3 = 0")
    fit = lambda **kw: B.fit_boosted(tr, "y", ["x1", "x2"], ["c"], valid=va, depth=4, step=0.5, write_every=3, **kw)
    full, cut = fit(rounds=8), fit(rounds=400, patience=2)
    assert cut.rounds_run < 12 and len(cut.trees) == cut.rounds_run - 2
    valid = [h for h in cut.history if h[0] == "valid"]
    best = min(valid, key=lambda h: h[3])
    assert best[1] == len(cut.trees) if cut.trees else True
    both = tr.withColumn("s", F.lit("train")).unionByName(va.withColumn("s", F.lit("valid")))
    got = {(r.set, r.iteration): (r.mae, r.rmse, r.r2) for r in B.staged_metrics(full, both, "y", "s").collect()}
    assert len(got) == len(full.history) == 16
    for s, k, *m in full.history:
        assert got[s, k] == pytest.approx(m, rel=1e-9, abs=1e-9)
    s = B.score_boosted(full, va, ["y"])
    last = regression_metrics(s, "y", "prediction").first()
    assert got["valid", 8] == pytest.approx((last.mae, last.rmse, last.r2), rel=1e-9)


def test_rows_drawn_and_model_do_not_depend_on_partitioning(spark):
    df = spark.createDataFrame(toy(spark, 1500, 7))
    a, b = (B.fit_boosted(df.repartition(n), "y", ["x1", "x2"], ["c"], rounds=3, depth=3, binning=B.Binning({"x1": [2.0, 5.0, 8.0], "x2": [1.0, 2.5]}, {"c": ["v1", "v2"]}))
            for n in (1, 6))
    assert [t.feature for t in a.trees] == [t.feature for t in b.trees]
    assert np.allclose(np.concatenate([t.value for t in a.trees]), np.concatenate([t.value for t in b.trees]))
    h = np.arange(100_000, dtype=np.int64)
    assert abs(B.in_bag(h, 1, 2, 0.8).mean() - 0.8) < 0.01 and (B.in_bag(h, 1, 2, 0.8) != B.in_bag(h, 1, 3, 0.8)).any()


def test_saving_scoring_many_and_selection(spark, tmp_path):
    df = spark.createDataFrame(toy(spark, 1500, 8)).withColumn("ly", F.log1p(F.abs("y")))
    a = B.fit_boosted(df, "y", ["x1", "x2"], ["c"], rounds=4, depth=3, step=0.5)
    b = B.fit_boosted(df, "ly", ["x2"], rounds=2, depth=2, step=0.5)
    B.save_boosted(spark, a, f"{tmp_path}/m")
    loaded = B.load_boosted(spark, f"{tmp_path}/m")
    both = B.score_many({"a": (loaded, "identity"), "b": (b, "log1p")}, df, ["key"]).toPandas().sort_values("key").predictions
    pa_, pb = (B.score_boosted(m, df, ["key"]).toPandas().sort_values("key").prediction.to_numpy() for m in (a, b))
    assert np.allclose([x[0] for x in both], pa_) and np.allclose([x[1] for x in both], np.expm1(pb))
    quick, kept, final = B.select_and_refit(df, "y", ["x1", "x2"], ["c"], 0.85, dict(rounds=4, depth=3, step=0.5, **ALL), rounds=3, depth=3, step=0.5)
    share = sorted(((r.importance, r.feature) for r in quick.feature_importance(spark).collect()), reverse=True)
    assert kept == final.binning.features and {f for _, f in share[:len(kept)]} == set(kept) and len(kept) < 3


def test_empty_and_constant_tables(spark):
    df = spark.createDataFrame([(1.0, "a", 3.0, i) for i in range(20)] + [(None, None, None, 99)], "x double, c string, y double, key long")
    model = B.fit_boosted(df, "y", ["x"], ["c"], rounds=2, **ALL)
    assert [r.prediction for r in B.score_boosted(model, df).distinct().collect()] == [3.0]
    none = B.fit_boosted(df.limit(0), "y", ["x"], ["c"], rounds=2)
    assert none.base == 0.0 and B.score_boosted(none, df).count() == 21


def test_one_feature_takes_a_job_a_round(spark):
    """A whole tree on one feature follows from the root's sums; before, each of its levels was a job."""
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"c": rng.choice([f"v{i}" for i in range(20)], 2000), "key": np.arange(2000)})
    pdf["y"] = pdf.c.str[1:].astype(float) ** 2 + rng.normal(size=2000)
    df = spark.createDataFrame(pdf)
    sc = spark.sparkContext

    def jobs(rounds):
        sc.setJobGroup(f"boost-{rounds}", "")
        model = B.fit_boosted(df, "y", [], ["c"], rounds=rounds, depth=40, step=0.5, **ALL)
        sc.setLocalProperty("spark.jobGroup.id", None)
        return len(sc.statusTracker().getJobIdsForGroup(f"boost-{rounds}")), model
    few, _ = jobs(1)
    more, model = jobs(4)
    assert more - few == 3
    mean, total = pdf.groupby("c").y.mean(), pdf.y.mean()
    for r in B.score_boosted(model, df, ["c"]).distinct().collect():
        assert r.prediction == pytest.approx(mean[r.c] - 0.5 ** 4 * (mean[r.c] - total), rel=1e-9)


def test_sums_of_the_driver_and_of_the_shuffle_agree(spark, monkeypatch):
    df = spark.createDataFrame(toy(spark, 1500, 9)).repartition(3)
    fit = lambda: B.fit_boosted(df, "y", ["x1", "x2"], ["c"], rounds=2, depth=3, valid=df.where("key % 7 = 0"))
    a = fit()
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    b = fit()
    assert [t.feature for t in a.trees] == [t.feature for t in b.trees] and [t.value for t in a.trees] == [t.value for t in b.trees]
    assert a.history == b.history


@pytest.mark.parametrize("values", [7, 400])
def test_medians_from_narrowed_brackets(spark, monkeypatch, values):
    """Exact medians, also where few values travel and half of a leaf's rows are equal."""
    rng = np.random.default_rng(5)
    pdf = pd.DataFrame({"c": rng.choice(list("abcde"), 4001), "key": np.arange(4001)})
    pdf["y"] = np.where(pdf.c == "a", rng.integers(0, 2, 4001), np.where(pdf.c == "b", 3.0, rng.normal(0, 1e4, 4001)))
    df = spark.createDataFrame(pdf).repartition(3).cache()
    monkeypatch.setattr(B, "MEDIAN_VALUES", values)
    asked = []
    real = B._Loop._residuals
    monkeypatch.setattr(B._Loop, "_residuals", lambda self, *a: asked.append(real(self, *a)) or asked[-1])
    model = B.fit_boosted(df, "y", [], ["c"], rounds=1, depth=6, step=1.0, loss="absolute", **ALL)
    got = {r.c: r.prediction for r in B.score_boosted(model, df, ["c"]).distinct().collect()}
    want = pdf.groupby("c").y.median().to_dict()
    assert got == pytest.approx(want, abs=1e-9) and len(asked) > 1
    df.unpersist()


def test_gains_of_single_features_need_one_store(spark, monkeypatch):
    df = spark.createDataFrame(toy(spark)).repartition(3)
    alone = {}
    for c, own in (("x1", (["x1"], [])), ("c", ([], ["c"]))):
        alone[c] = sum(g for t in B.fit_boosted(df, "y", *own, rounds=1, depth=5, step=1.0, **ALL).trees for g in t.gain)
    stores = []
    real = B._Loop._write
    monkeypatch.setattr(B._Loop, "_write", lambda self, rows: stores.append(1) or real(self, rows))
    assert B.gains_alone(df, "y", ["x1"], ["c"], depth=5) == pytest.approx(alone, rel=1e-9)
    assert len(stores) == 1
    monkeypatch.setattr(B, "DRIVER_BYTES", 0)
    assert B.gains_alone(df, "y", ["x1"], ["c"], depth=5) == pytest.approx(alone, rel=1e-9)


def test_a_tree_is_put_into_the_scores_once(spark, monkeypatch):
    """Levels read scores as they stand; nothing stays with the executors."""
    df = spark.createDataFrame(toy(spark)).repartition(3)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    put = []
    real = B._Loop.put
    monkeypatch.setattr(B._Loop, "put", lambda self, tree, number, final: put.append(number) or real(self, tree, number, final))
    fits = [B.fit_boosted(df, "y", ["x1", "x2"], ["c"], rounds=5, depth=3, step=0.5, write_every=n) for n in (1, 2, 9)]
    assert put == [1, 2, 3, 4, 5] * 3
    for m in fits[1:]:
        for t, u in zip(m.trees, fits[0].trees, strict=True):
            assert t.feature == u.feature and t.value == pytest.approx(u.value, rel=1e-9, abs=1e-9)
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_rows_of_one_task_are_dealt_over_all(spark, monkeypatch):
    """Before, rows that came in one task stayed in one task for all passes."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 50)
    df = spark.createDataFrame(toy(spark, 2000, 12)).coalesce(1)
    sizes = []
    real = B._Loop.put

    def put(self, *a, **kw):
        sizes.append(self.blocks.map(lambda b: len(b[0])).glom().map(sum).collect())
        real(self, *a, **kw)
    monkeypatch.setattr(B._Loop, "put", put)
    B.fit_boosted(df, "y", ["x1", "x2"], ["c"], rounds=1, depth=2)
    assert sum(sizes[0]) == 2000 and max(sizes[0]) < 1000


def test_a_pass_has_no_more_tasks_than_cores_until_they_are_full(spark, monkeypatch):
    """Many small files of blocks, each a split of its own, are still few tasks."""
    rng = np.random.default_rng(11)
    df = spark.createDataFrame(pd.DataFrame({"x": rng.uniform(size=4000), "key": np.arange(4000)}).assign(y=rng.normal(size=4000))).repartition(60)
    cost, cores = "spark.sql.files.openCostInBytes", spark.sparkContext.defaultParallelism
    spark.conf.set(cost, str(128 << 20))
    try:
        args = df, "y", ["x"], [], "key", None, 0.1, "squared", 8, None, 1, 1.0, 1, 0.0, 5
        loop = B._prepare(*args)
        assert loop.tasks == loop.blocks.getNumPartitions() <= cores
        assert sum(len(b[0]) for b in loop.blocks.collect()) == 4000
        loop.close()
        monkeypatch.setattr(B, "TASK_BYTES", 512)                   # full tasks: more of them
        loop = B._prepare(*args)
        assert loop.tasks > cores
        loop.close()
    finally:
        spark.conf.unset(cost)


def test_leaves_of_some_rows_are_those_of_all():
    rng = np.random.default_rng(12)
    for width in (1, 3):
        x, tree = rng.integers(0, 9, (width, 500)).astype(np.uint8), B.Tree()
        for node in (0, 1, 2):
            tree.split(node, node % width, rng.random(9) < 0.5, 1.0, (0.0, 0.0))
        rows = np.flatnonzero(rng.random(500) < 0.6)
        assert (B.leaves(tree.frozen(), x, rows) == B.leaves(tree.frozen(), x)[rows]).all()


def test_bins_are_stored_once_and_a_round_keeps_scores_alone(spark, monkeypatch):
    """Before, every round kept bins, hashes and labels anew, and every ``write_every`` rounds wrote them."""
    df = spark.createDataFrame(toy(spark)).repartition(3)
    stores, kept, files = [], [], set()
    write, put = B._Loop._write, B._Loop.put
    monkeypatch.setattr(B._Loop, "_write", lambda self, rows: stores.append(1) or write(self, rows))

    def spy(self, *a, **kw):
        put(self, *a, **kw)
        kept.append(sum(s.nbytes for s in self.kept[-1].collect()))
        files.update(f for f in (s.getCheckpointFile() for s in self.safe) if f)
    monkeypatch.setattr(B._Loop, "put", spy)
    B.fit_boosted(df, "y", ["x1", "x2"], ["c"], rounds=4, depth=3, write_every=1)
    assert stores == [1] and kept == [8 * 3000] * 4
    fs = spark._jvm.org.apache.hadoop.fs
    assert len(files) == 3 and not any(fs.Path(f).getFileSystem(spark._jsc.hadoopConfiguration()).exists(fs.Path(f)) for f in files)


@pytest.mark.parametrize("loss", ["squared", "absolute"])
def test_a_child_is_its_parent_less_the_other(spark, monkeypatch, loss):
    """The trees are those of counting both children, in any partitioning."""
    pdf = toy(spark, 2000, 13).assign(x3=lambda d: -d.x1, x4=lambda d: d.x2 * 2)             # equal gains: the first feature wins
    fit = lambda n: B.fit_boosted(spark.createDataFrame(pdf).repartition(n), "y", ["x1", "x2", "x3", "x4"], ["c"], rounds=3, depth=4, loss=loss,
                                  binning=B.Binning({c: sorted(np.quantile(pdf[c], [0.2, 0.4, 0.6, 0.8])) for c in ("x1", "x2", "x3", "x4")}, {"c": ["v1", "v2"]}))
    derived = []
    larger = B._Loop._larger
    monkeypatch.setattr(B._Loop, "_larger", lambda self, *a: derived.append(larger(self, *a)) or derived[-1])
    a, b = fit(1), fit(5)
    assert any(derived)
    monkeypatch.setattr(B._Loop, "_larger", lambda self, *a: {})
    c = fit(3)
    assert [t.feature for t in a.trees] == [t.feature for t in b.trees] == [t.feature for t in c.trees]
    assert a.base != b.base or [t.value for t in a.trees] == [t.value for t in b.trees]
