"""Ridge parity with a closed form, interval/attribution invariants, trees, registry."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelcast.ml import registry as reg
from panelcast.ml.boosting import Setting
from panelcast.ml.linear import ALPHAS, fit_ridge, with_val_std
from panelcast.ml.training import train_and_evaluate
from panelcast.ml.trees import fit_bounds, fit_gbt_early_stopping
from panelcast.operators import features as feat
from panelcast.operators.evaluation import z_value
from panelcast.operators.splits import SplitConfig, split_rows

from .conftest import ENTITIES

CFG = SplitConfig("2016Q4", "2018Q4")


@pytest.fixture(scope="module")
def matrix(sample_panel):
    return feat.build_features(sample_panel, ENTITIES).persist()


def numpy_ridge(X, y, alphas, k=5):
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1
    Z = (X - mu) / sd

    def fit(Z, y, a):
        zm, ym = Z.mean(0), y.mean()
        Zc = Z - zm
        w = np.linalg.solve(Zc.T @ Zc + a * np.eye(Z.shape[1]), Zc.T @ (y - ym))
        return w, ym - zm @ w

    n = len(y)
    sizes = [n // k + (1 if i < n % k else 0) for i in range(k)]
    b = np.cumsum([0] + sizes)
    scores = {}
    for a in alphas:
        r2 = []
        for i in range(k):
            te = np.arange(b[i], b[i + 1])
            tr = np.setdiff1d(np.arange(n), te)
            w, b0 = fit(Z[tr], y[tr], a)
            p = b0 + Z[te] @ w
            r2.append(1 - ((y[te] - p) ** 2).sum() / ((y[te] - y[te].mean()) ** 2).sum())
        scores[a] = np.mean(r2)
    best = max(alphas, key=lambda a: (scores[a], -list(alphas).index(a)))
    w, b0 = fit(Z, y, best)
    return best, w, b0


def test_ridge_matches_closed_form(matrix):
    cols = feat.feature_columns(ENTITIES)
    train = split_rows(matrix, "train", CFG)
    model = fit_ridge(train, cols)
    pdf = train.select("entity", "period", *cols, "target").toPandas().sort_values(["entity", "period"])
    best, w, b0 = numpy_ridge(pdf[cols].to_numpy(float), pdf["target"].to_numpy(float), ALPHAS)
    assert model.alpha == best
    # drivers of the synthetic panel are collinear in time (ill-conditioned
    # Gram matrix): compare coefficients loosely and predictions tightly
    assert np.allclose(model.coef, w, rtol=1e-3, atol=1e-6)
    X = pdf[cols].to_numpy(float)
    mu, sd = X.mean(0), X.std(0)
    sd[sd == 0] = 1
    ours = np.array([r.p for r in train.orderBy("entity", "period").select(model.prediction().alias("p")).collect()])
    ref = b0 + ((X - mu) / sd) @ w
    # cpi_lag1 and unemp_lag1 are exactly collinear here (condition ~1e10)
    assert np.max(np.abs(ours - ref)) < 1e-4, np.max(np.abs(ours - ref))


def test_ridge_interval_and_attribution(matrix):
    cols = feat.feature_columns(ENTITIES)
    model = with_val_std(fit_ridge(split_rows(matrix, "train", CFG), cols), split_rows(matrix, "val", CFG))
    p, lo, hi = model.interval(z_value(0.9))
    contrib, base = model.attribution()
    total = F.aggregate(F.map_values(contrib), F.lit(0.0), lambda a, v: a + v)
    rows = matrix.select(p.alias("p"), lo.alias("lo"), hi.alias("hi"), (total + base).alias("s")).collect()
    assert all(r.lo <= r.p <= r.hi for r in rows)
    assert all(r.s == pytest.approx(r.p, abs=1e-9) for r in rows)
    imp = model.importance()
    assert imp[0][1] == max(abs(c) for c in model.coef)


def test_gbt_early_stopping_and_registry(spark, matrix, tmp_path):
    cols = feat.feature_columns(ENTITIES)
    train, val = split_rows(matrix, "train", CFG), split_rows(matrix, "val", CFG)
    tree = fit_gbt_early_stopping(train, val, cols, setting=Setting(rounds=8, depth=3, step=0.3, patience=3))
    assert 1 <= tree.forest.n_trees <= 8
    imp = tree.importance()
    assert sum(v for _, v in imp) == pytest.approx(1.0)

    root = str(tmp_path / "registry")
    ridge = fit_ridge(train, cols)
    reg.save(spark, root, ridge, "1", {"test": {"rmse": 2.0}}, 0.9)
    reg.save(spark, root, tree, "1", {"test": {"rmse": 1.0}}, 0.8)
    best = reg.best_model(spark, root).first()
    assert best.name == tree.name
    loaded, meta = reg.load(spark, root, "ridge", "1")
    assert loaded.coef == ridge.coef and reg.feature_set_matches(meta, cols)
    t2, _ = reg.load(spark, root, tree.name, "1")
    a = tree.transform(val, "p").select("p").collect()
    b = t2.transform(val, "p").select("p").collect()
    assert a == b
    with pytest.raises(FileNotFoundError):
        reg.load(spark, root, "missing", "9")


def test_training_job(matrix):
    cols = feat.feature_columns(ENTITIES)
    space = {"rounds": (3, 5), "depth": (2, 3), "step": (0.1, 0.3), "row_share": (0.8, 1.0),
             "feature_share": (0.8, 1.0), "least_rows": (1, 2)}
    res = train_and_evaluate(matrix, CFG, cols, n_trials=2, level_space=space, leaf_space={**space, "leaves": (3, 5)},
                             patience=2)
    assert set(res.models) == {"ridge", "gbt", "gbt_es"}
    assert sum(res.weights.values()) == pytest.approx(1.0)
    models = {r.model for r in res.metrics.select("model").distinct().collect()}
    assert models == {"ridge", "gbt", "gbt_es", "ensemble"}
    with pytest.raises(ValueError):
        train_and_evaluate(matrix, CFG, cols, models=["svm"])


def test_walk_forward_cv_pluggable(matrix):
    from panelcast.ml.cv import forecaster, walk_forward_cv

    cols = feat.feature_columns(ENTITIES)
    res = walk_forward_cv(matrix, cols, "ridge", n_splits=3, min_train=16, val=4).collect()
    assert [r.fold for r in sorted(res)] == [0, 1, 2]
    assert all(r.n_samples == 8 * 4 for r in res)  # 8 entities x 4 validation quarters
    with pytest.raises(ValueError):
        forecaster("svm", cols)


def test_registry_keeps_quantile_interval_models(spark, matrix, tmp_path):
    cols = feat.feature_columns(ENTITIES)
    train, val = split_rows(matrix, "train", CFG), split_rows(matrix, "val", CFG)
    tree = fit_gbt_early_stopping(train, val, cols, setting=Setting(rounds=4, depth=2, step=0.3, patience=2))
    fit_bounds(train, [tree])
    root = str(tmp_path / "reg")
    reg.save(spark, root, tree, "2")
    loaded, _ = reg.load(spark, root, tree.name, "2")
    a = tree.with_interval(val).select("pred", "lo", "hi").collect()
    b = loaded.with_interval(val).select("pred", "lo", "hi").collect()
    assert a == b


def test_blend_is_saved_and_scores_alike_after_loading(spark, sample_panel, tmp_path):
    import numpy as np
    from pyspark.sql import functions as F

    from panelcast.ml import registry as reg
    from panelcast.ml.blend import BlendModel
    from panelcast.ml.linear import RidgeModel
    from panelcast.ml.scoring import explain
    from panelcast.ml.trees import fit_gbt_early_stopping

    rng = np.random.default_rng(0)
    rows = [(i, float(a), float(b), float(2 * a - b)) for i, (a, b) in enumerate(rng.normal(size=(120, 2)))]
    data = spark.createDataFrame(rows, "key int, a double, b double, target double").cache()
    tree = fit_gbt_early_stopping(data, data, ["a", "b"], setting=Setting(rounds=5, depth=2, step=0.3))
    ridge = RidgeModel(["a", "b"], [0.0, 0.0], [1.0, 1.0], [1.9, -1.1], 0.05, 1.0, val_residual_std=0.2)
    blend = BlendModel.fit([tree, ridge], data)
    assert abs(sum(blend.weights) - 1) < 1e-9 and blend.weights[1] > blend.weights[0]
    assert abs(sum(v for _, v in blend.importance()) - 1) < 1e-9
    root = str(tmp_path / "models")
    reg.save(spark, root, blend, "3", {"test": {"rmse": 0.1}})
    loaded, meta = reg.load_best(spark, root, ["a", "b"])
    assert meta["kind"] == "blend" and loaded.weights == blend.weights
    for model in (blend, loaded):
        out = model.with_interval(data).select("key", "pred", "lo", "hi").orderBy("key").collect()
        first = out if model is blend else first
        assert out == first and all(r["lo"] <= r["hi"] for r in out)
    ex = explain(data, loaded, ["key"])
    assert ex.count() == 120 and ex.agg(F.max("gap")).first()[0] <= 1e-6


def test_dry_run_scores_a_row(spark):
    import pytest

    from panelcast.ml import registry as reg
    from panelcast.ml.linear import RidgeModel

    reg.dry_run(spark, RidgeModel(["a"], [0.0], [1.0], [1.0], 0.0, 1.0))
    with pytest.raises(Exception):  # noqa: B017 - a scale of 0 divides by zero
        reg.dry_run(spark, RidgeModel(["a"], [0.0], [0.0], [1.0], 0.0, 1.0))


def test_fold_offsets_match_plain_numbering(spark):
    from panelcast.ml.linear import contiguous_folds

    rows = [(f"e{(i * 37) % 23:02d}", i) for i in range(211)]
    frame = spark.createDataFrame(rows, "entity string, period int")
    found = {(r["entity"], r["period"]): r["fold"] for r in contiguous_folds(frame, 5).collect()}
    order = sorted(rows)
    bounds = [43, 85, 127, 169, 211]
    assert found == {k: next(f for f, b in enumerate(bounds) if i < b) for i, k in enumerate(order)}


def test_registered_training_has_the_whole_budget(spark, monkeypatch, tmp_path):
    from panelcast.ml import cv
    from panelcast.ml import trees as tr
    from panelcast.plans import catalog

    class Called(Exception):
        pass

    def caught(*args, **kw):
        raise Called({k: v for k, v in kw.items() if v is not None})

    monkeypatch.setattr(catalog, "ml_inputs", lambda spark, sf_dir: (None, []))
    monkeypatch.setattr(catalog, "_input_mark", lambda spark, sf_dir: "mark")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(catalog, "train_and_evaluate", caught)
    monkeypatch.setattr(cv, "walk_forward_cv", caught)
    cuts = {"n_trials", "level_space", "leaf_space", "patience", "settings"}
    for query in (catalog.q_training_metrics, catalog.q_gbt_importance, catalog.q_gbt_walk_forward):
        with pytest.raises(Called) as e:
            query(spark, "nowhere")
        assert not cuts & set(e.value.args[0])
    level, leaf = tr.level_settings(), tr.leaf_settings()
    assert len(level) == len(leaf) == 50
    assert all(100 <= s.rounds <= 800 and 3 <= s.depth <= 7 and s.leaves is None and s.patience is None for s in level)
    assert all(100 <= s.rounds <= 1000 and 3 <= s.depth <= 8 and 15 <= s.leaves <= 127 and 5 <= s.least_rows <= 50
               and s.patience == 50 for s in leaf)
    assert max(s.rounds for s in level) > 700 and max(s.rounds for s in leaf) > 900
