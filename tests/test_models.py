"""Model queries.  The driver's price is independent of every feature (all
|r| < 0.01), so on those tables the check is rows-only; learning itself is
checked on a small hand-made table whose label depends on the features."""

import inspect
from types import SimpleNamespace
from unittest.mock import MagicMock

import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from pricecraft.operators import boosting
from pricecraft.operators import models as M
from pricecraft.operators.evaluate import regression_metrics
from pricecraft.plans import q_models


def _toy(spark, n=2000, seed=0):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.uniform(0, 10, n), rng.uniform(0, 5, n)
    y = 3 * x1 + np.where(x2 > 2.5, 20.0, 0.0) + rng.normal(0, 1, n)
    return spark.createDataFrame(pd.DataFrame({"x1": x1, "x2": x2, "y": y, "k": np.arange(n)}))


def test_tree_and_gbt_learn(spark):
    df = _toy(spark)
    tr, va = df.where("k % 5 != 0"), df.where("k % 5 = 0")
    for model in (M.fit_tree(tr, ["x1", "x2"], "y", max_depth=8),
                  M.fit_gbt(tr, ["x1", "x2"], "y", max_iter=20, max_depth=4, step=0.3),
                  M.fit_gbt(tr, ["x1", "x2"], "y", max_iter=20, max_depth=4, step=0.3, loss="absolute")):
        m = regression_metrics(M.score(model, va, keep=["y"]), "y", "prediction").collect()[0]
        assert m.r2 > 0.9, m


def test_importance_and_history(spark):
    df = _toy(spark)
    tr, va = df.where("k % 5 != 0"), df.where("k % 5 = 0")
    model = M.fit_gbt(tr, ["x1", "x2"], "y", max_iter=10, max_depth=3, step=0.3)
    imp = M.feature_importance(spark, model).toPandas()
    assert abs(imp.importance.sum() - 1) < 1e-9 and imp.set_index("feature").importance["x1"] > 0.3
    h = M.eval_history(spark, model, tr, va, "y").toPandas()
    v = h[h.set == "valid"].sort_values("iteration").rmse.to_numpy()
    assert len(v) == 10 and v[-1] < v[0]


def test_registered_model_queries_rows(spark):
    q = E.queries()
    tree = {r.split: r for r in q["fit_tree"](spark, SF_SMALL).collect()}
    assert set(tree) == {"train", "valid"} and tree["train"].rmse < tree["valid"].rmse
    pdf = q["feature_importance"](spark, SF_SMALL).toPandas()
    assert len(pdf) == 25 and abs(pdf.importance.sum() - 1.0) < 1e-9


class _Asked(Exception):
    pass


@pytest.mark.parametrize("name,rounds,patience", [("fit_gbt", 200, None), ("score", 200, None), ("feature_importance", 200, None), ("eval_history", 200, None),
                                                  ("model_facts", 200, None), ("fit_gbt_early_stop", 500, 20), ("fit_gbt_mae", 3000, 100)])
def test_registered_fits_run_the_rounds_of_the_source(monkeypatch, name, rounds, patience):
    """Before, the fits without patience ran 60 of the 200 rounds, and the absolute loss waited 20 rounds instead of 100."""
    real = inspect.signature(boosting.fit_boosted)

    def asked(*a, **kw):
        b = real.bind(*a, **kw)
        b.apply_defaults()
        raise _Asked(b.arguments["rounds"], b.arguments["patience"])
    monkeypatch.setattr(boosting, "fit_boosted", asked)
    monkeypatch.setattr(q_models, "_frames", lambda spark, sf: (MagicMock(), MagicMock(), MagicMock()))
    monkeypatch.setattr(q_models, "_once", lambda spark, sf, name, make: make())
    monkeypatch.setattr(q_models.F, "log1p", lambda c: c)
    with pytest.raises(_Asked) as e:
        getattr(q_models, f"q_{name}")(None, "")
    assert e.value.args == (rounds, patience)


def test_a_tree_is_fitted_in_a_task_a_core(spark, monkeypatch):
    """Every task sends statistics of every node; before, there were as many tasks as file splits."""
    seen, cores = [], spark.sparkContext.defaultParallelism
    monkeypatch.setattr(M, "Pipeline", lambda stages: SimpleNamespace(fit=lambda rows: seen.append((rows.rdd.getNumPartitions(), rows.count()))))
    M.fit_tree(_toy(spark).repartition(5 * cores), ["x1", "x2"], "y")
    assert seen == [(cores, 2000)]
