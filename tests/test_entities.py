"""Many entities: indexes and effects without a column per entity; moments in the JVM; folds from one read; stored panels."""

from __future__ import annotations

import numpy as np
import pytest

from panelcast.ml import registry as reg
from panelcast.ml.effects import fit_effect_ridge
from panelcast.ml.linear import ALPHAS, fit_ridge, fit_ridge_folds
from panelcast.ml.moments import gram_by_group
from panelcast.operators import features as feat
from panelcast.operators.offsets import entity_index
from panelcast.operators.splits import SplitConfig, distinct_periods_list, plan_folds, split_rows
from panelcast.session import stored
from panelcast.sources.ingest import store_panel

from .conftest import ENTITIES


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_numbers_entities_in_order(spark):
    names = [f"e{(i * 37) % 601:04d}" for i in range(1500)] + [None]
    found = entity_index(spark.createDataFrame([(n,) for n in names], "entity string").repartition(5)).collect()
    assert {r["entity"]: r["idx"] for r in found} == {n: i for i, n in enumerate(sorted({x for x in names if x}))}
    assert entity_index(spark.createDataFrame([], "entity string")).count() == 0


def test_sparse_code_of_many_entities(spark):
    rows = [(f"e{i:04d}",) for i in range(600)] + [(None,)]
    out = {r["entity"]: r["entity_vec"] for r in feat.add_sparse_entity(spark.createDataFrame(rows, "entity string")).collect()}
    assert out["e0599"].size == 600 and out["e0599"].indices.tolist() == [599] and out[None].indices.tolist() == []


def dense_ridge(x, onehot, y, alpha):
    z = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
    both = np.hstack([z, onehot / onehot.std(0)])
    centred = both - both.mean(0)
    w = np.linalg.solve(centred.T @ centred + alpha * np.eye(both.shape[1]), centred.T @ (y - y.mean()))
    return lambda q, o: y.mean() + (np.hstack([(q - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1), o / onehot.std(0)])
                                    - both.mean(0)) @ w


@pytest.fixture(scope="module")
def effects_data(spark):
    rng = np.random.default_rng(4)
    entity = rng.integers(0, 12, 300)
    x = rng.normal(size=(300, 3))
    y = x @ np.array([2.0, -1.0, 0.5]) + 3 * np.sin(entity) + 0.2 * rng.normal(size=300)
    rows = [(f"e{e:02d}", *map(float, r), float(t), int(i >= 220)) for i, (e, r, t) in enumerate(zip(entity, x, y, strict=True))]
    return entity, x, y, spark.createDataFrame(rows, "entity string, a double, b double, c double, target double, part int")


@pytest.mark.parametrize("alpha", [0.1, 10.0, 1000.0])
def test_effects_equal_the_dense_ridge(effects_data, alpha):
    entity, x, y, rows = effects_data
    model = fit_effect_ridge(rows.where("part = 0"), rows.where("part = 1"), ["a", "b", "c"], alphas=[alpha])
    onehot = (entity[:, None] == np.arange(12)).astype(float)
    want = dense_ridge(x[:220], onehot[:220], y[:220], alpha)(x, onehot)
    got = {(r["entity"], r["a"]): r["pred"] for r in model.transform(rows).collect()}
    assert [got[(f"e{e:02d}", float(v))] for e, v in zip(entity, x[:, 0], strict=True)] == pytest.approx(want.tolist(), abs=1e-8)


def test_alpha_is_the_best_on_validation_rows(effects_data, spark, tmp_path):
    entity, x, y, rows = effects_data
    model = fit_effect_ridge(rows.where("part = 0"), rows.where("part = 1"), ["a", "b", "c"])
    onehot = (entity[:, None] == np.arange(12)).astype(float)
    errors = {}
    for a in ALPHAS:
        p = dense_ridge(x[:220], onehot[:220], y[:220], a)(x, onehot)
        errors[str(a)] = float(np.sqrt(np.mean((y[220:] - p[220:]) ** 2)))
    assert model.val_rmse == pytest.approx(errors, rel=1e-7) and str(model.alpha) == min(errors, key=errors.get)
    reg.save(spark, str(tmp_path), model, "1")
    loaded, _ = reg.load(spark, str(tmp_path), "ridge_effects", "1")
    new = spark.createDataFrame([("e01", 0.5, 0.1, 0.2), ("never seen", 0.5, 0.1, 0.2), (None, 0.5, 0.1, 0.2)],
                                "entity string, a double, b double, c double")
    for m in (model, loaded):
        out = m.attributions(m.with_interval(new)).collect()
        assert len(out) == 3
        for r in out:
            assert sum(r["shap_values"].values()) + r["base_value"] == pytest.approx(r["pred"])
            assert r["lo"] <= r["pred"] <= r["hi"]
        assert sum(r["shap_values"]["entity"] == 0.0 for r in out) == 2
    assert dict(model.importance())["entity"] > 1.0


def test_moments_equal_numpy_and_stay_in_the_jvm(spark, effects_data):
    _, x, y, rows = effects_data
    grams = gram_by_group(rows, ["a", "b", "c"], "target", "part")
    v = np.column_stack([np.ones(300), x, y])
    assert np.allclose(grams[0], v[:220].T @ v[:220]) and np.allclose(grams[1], v[220:].T @ v[220:])


def test_folds_from_one_read_equal_fits_of_their_own(spark, sample_panel):
    matrix = stored(feat.build_features(sample_panel, ENTITIES), "matrix")
    cols = feat.feature_columns(ENTITIES)
    folds = plan_folds(distinct_periods_list(matrix), 4, 12, 4)
    together = fit_ridge_folds(matrix, cols, folds)
    for fold, model in zip(folds, together, strict=True):
        train = split_rows(matrix, "train", SplitConfig(fold.train_end, fold.val_end))
        alone = fit_ridge(train, cols)
        assert model.alpha == alone.alpha and model.mean == pytest.approx(alone.mean, rel=1e-9, abs=1e-12)
        a, b = (np.array([r[0] for r in train.orderBy("entity", "period").select(m.prediction()).collect()])
                for m in (model, alone))
        assert np.max(np.abs(a - b)) < 1e-5


def test_windows_over_a_stored_panel_need_no_exchange(spark, sample_panel, tmp_path):
    table = store_panel(sample_panel, "stored_panel_test", str(tmp_path / "panel"), buckets=4)
    bucketed = feat.build_features(table, ENTITIES)
    assert "Exchange" not in plan_of(bucketed) and "Exchange" in plan_of(feat.build_features(sample_panel, ENTITIES))
    key = ["entity", "period"]
    a = [tuple(r) for r in bucketed.orderBy(*key).collect()]
    assert a == [tuple(r) for r in feat.build_features(sample_panel, ENTITIES).orderBy(*key).select(*bucketed.columns).collect()]
    spark.sql("DROP TABLE stored_panel_test")
