"""Lock-step boosting, forests as arrays, attributions as a table, the model protocol, published artefacts."""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable
from dataclasses import dataclass, replace

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from panelcast.ml import artifacts, boosting, cv, trees, treeshap
from panelcast.ml import registry as reg
from panelcast.ml.boosting import Setting, grow
from panelcast.ml.forest import Forest, scores
from panelcast.ml.model import KINDS, FittedModel, model_kind

COLS = [f"f{j}" for j in range(6)]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(320, 6))
    x[:, 3] = np.round(x[:, 3])
    y = 2 * x[:, 0] - x[:, 1] * x[:, 2] + 0.3 * rng.normal(size=320)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    schema = ", ".join(f"{c} double" for c in COLS) + ", target double, stage int"
    values = [(*map(float, r), float(t), int(i >= 240)) for i, (r, t) in enumerate(zip(*data, strict=True))]
    return spark.createDataFrame(values, schema).repartition(3).cache()


def same_forest(a: Forest, b: Forest) -> bool:
    return all(np.array_equal(getattr(a, c), getattr(b, c))
               for c in ("starts", "feature", "threshold", "left", "value", "cover", "gain"))


SOME = [Setting(rounds=6, step=0.3, depth=3, row_share=0.7, feature_share=0.6, least_rows=2, l1=0.1, l2=0.5, seed=1),
        Setting(rounds=5, step=0.2, depth=4, leaves=6, least_rows=5, patience=3, seed=2),
        Setting(rounds=4, step=0.5, depth=2, quantile=0.9, least_rows=5, seed=3)]


@pytest.fixture(scope="module")
def grown(rows):
    return grow(rows, COLS, SOME)


def test_one_tree_equals_spark_ml_on_binned_rows(rows):
    tree = grow(rows, COLS, [Setting(rounds=1, step=1.0, depth=4, least_rows=3)])[0].forest
    cuts = boosting.bin_cuts(rows.where("stage = 0"), COLS)
    binned = rows.select("target", "stage", *[F.col(c).alias(f"raw_{c}") for c in COLS], *[
        sum((F.col(c) > v).cast("int") for v in cut).cast("double").alias(c) for c, cut in zip(COLS, cuts, strict=True)])
    vec = VectorAssembler(inputCols=COLS, outputCol="v").transform(binned)
    spark_tree = DecisionTreeRegressor(featuresCol="v", labelCol="target", maxDepth=4, minInstancesPerNode=3,
                                       maxBins=64).fit(vec.where("stage = 0"))
    both = spark_tree.transform(vec).select("prediction", *[F.col(f"raw_{c}").alias(c) for c in COLS])
    worst = scores(both, {"own": tree}).agg(F.max(F.abs(F.col("own") - F.col("prediction")))).first()[0]
    assert worst < 1e-9


def test_same_trees_alone_again_and_in_blocks(rows, grown, monkeypatch):
    again = grow(rows.repartition(5), COLS, SOME[:1])
    assert same_forest(again[0].forest, grown[0].forest) and again[0].val_rmse == grown[0].val_rmse
    monkeypatch.setattr(boosting, "BLOCK_ROWS", 120)  # three blocks: an aggregation per level
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 2)
    in_blocks = grow(rows, COLS, SOME)
    for a, b in zip(in_blocks, grown, strict=True):
        assert same_forest(a.forest, b.forest) and a.val_rmse == b.val_rmse


def test_rounds_between_passes_do_not_matter(rows, grown, monkeypatch):
    monkeypatch.setattr(boosting, "CHECKPOINT_ROUNDS", 1)
    assert all(same_forest(a.forest, b.forest) for a, b in zip(grow(rows, COLS, SOME), grown, strict=True))


def test_stopping_round_by_brute_force(rows, data):
    x, y = data
    s = Setting(rounds=60, step=0.5, depth=3, patience=4)
    found = grow(rows, COLS, [s])[0]
    full = grow(rows, COLS, [replace(s, patience=None)])[0]
    errors = []
    for k in range(61):
        ends = np.append(full.forest.starts, len(full.forest.left))[k]
        cut = Forest(COLS, full.forest.init, full.forest.starts[:k], *(getattr(full.forest, c)[:ends] for c in (
            "feature", "threshold", "left", "value", "cover", "gain")))
        errors.append(math.sqrt(np.mean((y[240:] - cut.predict(x[240:])) ** 2)))
    best = 0
    for k, e in enumerate(errors):
        if e < errors[best]:
            best = k
        elif k - best >= 4:
            break
    assert found.best_round == best == found.forest.n_trees and len(found.val_rmse) == best + 5
    assert found.val_rmse == pytest.approx(errors[: len(found.val_rmse)], rel=1e-6)
    assert full.forest.n_trees == 60 and full.val_rmse == pytest.approx(errors, rel=1e-6)


def test_leaf_first_growth_by_plain_search(rows, data):
    x, y = data
    cuts = boosting.bin_cuts(rows.where("stage = 0"), COLS)
    s = Setting(rounds=1, step=1.0, depth=6, leaves=5, least_rows=8)
    forest = grow(rows, COLS, [s])[0].forest
    train = x[:240]
    r = y[:240] - y[:240].mean()

    def best_split(idx):
        found = (1e-12, 0, 0.0)
        for f, cut in enumerate(cuts):
            for v in cut:
                left = idx[train[idx, f] <= v]
                right = idx[train[idx, f] > v]
                if min(len(left), len(right)) >= 8:
                    gain = r[left].sum() ** 2 / len(left) + r[right].sum() ** 2 / len(right) - r[idx].sum() ** 2 / len(idx)
                    if gain > found[0] + 1e-9:
                        found = (gain, f, v)
        return found

    leaves = [(best_split(np.arange(240)), np.arange(240))]
    while len(leaves) < 5:
        k = max(range(len(leaves)), key=lambda i: leaves[i][0][0])
        (_, f, v), idx = leaves.pop(k)
        for part in (idx[train[idx, f] <= v], idx[train[idx, f] > v]):
            leaves.append((best_split(part), part))
    want = np.empty(240)
    for _, idx in leaves:
        want[idx] = y[idx].mean()
    assert np.allclose(forest.predict(train), want, atol=1e-6) and (forest.left < 0).sum() == 5


def test_quantile_leaves_are_exact_quantiles(rows, data):
    x, y = data
    forest = grow(rows, COLS, [Setting(rounds=1, step=1.0, depth=3, quantile=0.9, least_rows=20)])[0].forest
    node = np.zeros(240, np.int64)
    for _ in range(forest.depth()):
        to = forest.left[node]
        right = x[np.arange(240), np.maximum(forest.feature[node], 0)] > forest.threshold[node]
        node = np.where(to >= 0, to + right, node)
    for leaf in np.unique(node):
        rest = np.sort(y[:240][node == leaf] - forest.init)
        assert forest.value[leaf] == pytest.approx(rest[math.ceil(0.9 * len(rest) - 1e-9) - 1])


def test_merged_summaries_stay_near_the_quantile():
    rng = np.random.default_rng(1)
    parts = [rng.normal(size=4000) for _ in range(9)]
    merged = None
    for p in parts:
        summary = boosting._squeeze(p, np.ones(len(p)), boosting.SUMMARY)
        merged = summary if merged is None else boosting._merged(merged, summary)
    every = np.sort(np.concatenate(parts))
    for q in (0.05, 0.5, 0.95):
        place = np.searchsorted(every, boosting.summary_quantile(merged, q)) / len(every)
        assert abs(place - q) < 0.005


def test_bounds_take_all_tuned_settings(rows, monkeypatch):
    tuned = replace(SOME[0], leaves=7)
    model = trees.tree_model("m", COLS, grow(rows, COLS, [tuned])[0], tuned)
    asked = []
    monkeypatch.setattr(trees, "fit_quantiles", lambda train, cols, settings, target: asked.extend(settings) or [None, None])
    trees.fit_bounds(rows.where("stage = 0"), [model])
    assert [s.quantile for s in asked] == pytest.approx([0.05, 0.95])
    assert all(replace(s, quantile=None) == tuned for s in asked)


def test_search_takes_the_least_error_and_repeats(rows):
    space = {"rounds": (3, 6), "depth": (2, 3), "step": (0.1, 0.5), "l2": (1e-3, 1.0)}
    train, val = rows.where("stage = 0"), rows.where("stage = 1")
    a = trees.search_gbt(train, val, COLS, n_trials=4, space=space)
    b = trees.search_gbt(train, val, COLS, n_trials=4, space=space)
    each = grow(rows, COLS, trees.level_settings(4, space=space))
    assert a.val_rmse == min(g.val_rmse[-1] for g in each) and a.params == b.params and same_forest(a.forest, b.forest)


def test_no_training_rows(rows):
    with pytest.raises(ValueError, match="no training rows"):
        grow(rows.where("stage = 1"), COLS, [Setting(rounds=1)])


# -- forests ------------------------------------------------------------------


def test_plan_does_not_grow_with_trees(rows, grown):
    big = grow(rows, COLS, [Setting(rounds=60, depth=3)])[0].forest

    def plan(forest):
        df = scores(rows, {"a": forest, "b": forest})
        return df._jdf.queryExecution().optimizedPlan().toString().count("\n")

    assert plan(big) == plan(grown[0].forest)


def test_forest_table_round_trip(spark, rows, grown):
    for g in (grown[0], grow(rows, COLS, [Setting(rounds=1, least_rows=500)])[0]):
        forest = g.forest
        assert same_forest(Forest.from_table(forest.table(spark), COLS, forest.init), forest)


def test_missing_features_go_right_and_null_rows_score(spark, grown):
    empty = spark.createDataFrame([(None,) * 6], ", ".join(f"{c} double" for c in COLS))
    forest = grown[0].forest
    value = scores(empty, {"p": forest}).first()["p"]
    assert value == pytest.approx(forest.predict(np.full((1, 6), np.inf))[0])


# -- attributions -------------------------------------------------------------


def _expected(forest: Forest, x: np.ndarray, known: set, node: int) -> float:
    child = forest.left[node]
    if child < 0:
        return float(forest.value[node])
    f = int(forest.feature[node])
    if f in known:
        return _expected(forest, x, known, int(child + (x[f] > forest.threshold[node])))
    parts = [_expected(forest, x, known, int(child + k)) * forest.cover[child + k] for k in (0, 1)]
    return sum(parts) / forest.cover[node]


def test_attributions_equal_brute_force_shapley(rows, data, grown):
    x, _ = data
    for forest in (grown[0].forest, grown[1].forest, grown[2].forest):
        few = rows.limit(6)
        for r in treeshap.attributions(scores(few, {"pred": forest}), forest).collect():
            point = np.array([r[c] for c in COLS])
            want = np.zeros(6)
            for i in range(6):
                others = [k for k in range(6) if k != i]
                for size in range(6):
                    weight = math.factorial(size) * math.factorial(5 - size) / math.factorial(6)
                    for known in itertools.combinations(others, size):
                        for root in forest.starts.tolist():
                            want[i] += weight * (_expected(forest, point, {*known, i}, root)
                                                 - _expected(forest, point, set(known), root))
            assert [r["shap_values"][c] for c in COLS] == pytest.approx(want.tolist(), abs=1e-9)
            assert sum(r["shap_values"].values()) + r["base_value"] == pytest.approx(r["pred"], abs=1e-9)


def test_attributions_keep_repeated_rows_and_need_no_python(rows, grown):
    twice = rows.limit(5).unionAll(rows.limit(5))
    out = treeshap.attributions(twice, grown[0].forest)
    assert out.count() == 10
    assert "Python" not in out._jdf.queryExecution().toString() and "Pandas" not in out._jdf.queryExecution().toString()


def test_forest_without_splits(rows):
    forest = grow(rows, COLS, [Setting(rounds=2, least_rows=500)])[0].forest
    r = treeshap.attributions(scores(rows.limit(1), {"p": forest}), forest).first()
    assert r["base_value"] == pytest.approx(r["p"]) and set(r["shap_values"].values()) == {0.0}
    assert sum(v for _, v in forest.importance()) == 0.0


# -- a class of the user's own ------------------------------------------------


@model_kind("test-mean")
@dataclass
class MeanModel(FittedModel):
    name: str
    feature_cols: list[str]
    mean: float

    def transform(self, df, out="pred"):
        return df.withColumn(out, F.lit(self.mean))

    def with_interval(self, df, pred="pred", lo="lo", hi="hi", confidence=0.90):
        return df.withColumns({pred: F.lit(self.mean), lo: F.lit(self.mean - 1), hi: F.lit(self.mean + 1)})

    def importance(self):
        return [(c, 0.0) for c in self.feature_cols]

    def attributions(self, df, values="shap_values", base="base_value"):
        keys = F.array(*[F.lit(c) for c in self.feature_cols])
        zeros = F.array(*[F.lit(0.0)] * len(self.feature_cols))
        return df.withColumns({values: F.map_from_arrays(keys, zeros), base: F.lit(self.mean)})

    def parts(self, spark):
        return {"mean": self.mean}, {}

    @classmethod
    def from_parts(cls, name, feature_cols, info, table: Callable, members):
        return cls(name, feature_cols, info["mean"])


class MeanForecaster:
    def __init__(self, cols, target="target"):
        self.cols, self.target = list(cols), target

    def fit(self, train, val):
        return MeanModel("mean", self.cols, train.agg(F.avg(self.target)).first()[0])


def test_own_class_goes_through_everything(spark, rows, tmp_path, monkeypatch):
    from panelcast.ml.scoring import explain
    from panelcast.ml.training import train_and_evaluate
    from panelcast.operators.splits import SplitConfig

    monkeypatch.setitem(cv.FORECASTERS, "mean", None)
    cv.register_forecaster("mean", MeanForecaster)
    panel = rows.withColumns({"entity": F.lit("a"), "period": (F.monotonically_increasing_id() % 20 + 8000).cast("int")})
    folds = cv.walk_forward_cv(panel, COLS, "mean", n_splits=2, min_train=8, val=4).collect()
    assert len(folds) == 2 and all(r["mae"] > 0 for r in folds)
    done = train_and_evaluate(panel, SplitConfig(8010, 8015), COLS, ["ridge", "mean"], registry_root=str(tmp_path))
    assert {r["model"] for r in done.metrics.select("model").distinct().collect()} == {"ridge", "mean"}
    loaded, _ = reg.load(spark, str(tmp_path), "mean", "1")
    assert loaded == done.models["mean"]
    assert explain(rows.limit(2), loaded, ["target"]).agg(F.max("gap")).first()[0] == 0.0
    monkeypatch.delitem(KINDS, "test-mean")
    with pytest.raises(ValueError, match="no class is known"):
        reg.load(spark, str(tmp_path), "mean", "1")


def test_boosted_folds_grow_together(spark, rows):
    panel = rows.withColumns({"entity": F.lit("a"), "period": (F.monotonically_increasing_id() % 20 + 8000).cast("int")})
    panel = panel.cache()
    panel.count()
    settings = [Setting(rounds=4, depth=2, patience=2)]
    got = cv.walk_forward_cv(panel, COLS, "gbt_es", n_splits=2, min_train=8, val=4, settings=settings).collect()
    assert len(got) == 2 and all(r["model"] == "gbt_es" for r in got)
    with pytest.raises(ValueError, match="is taken"):
        model_kind("boosted")(MeanModel)


# -- artefacts ----------------------------------------------------------------


def test_two_trainers_at_once_publish_one_whole_run(tmp_path):
    import threading

    both = threading.Barrier(2, timeout=30)
    made = []

    def make(folder):
        both.wait()  # both find nothing published
        with open(f"{folder}/model", "w") as f:
            f.write(folder)
        made.append(folder)

    found = []
    threads = [threading.Thread(target=lambda: found.append(artifacts.artefact(str(tmp_path), "k", make))) for _ in range(2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(made) == 2 and made[0] != made[1]
    now = artifacts.published(str(tmp_path), "k")
    assert now in made and open(f"{now}/model").read() == now
    assert artifacts.artefact(str(tmp_path), "k", lambda folder: pytest.fail("made again")) == now


def test_failed_run_is_not_published(tmp_path):
    def fails(folder):
        open(f"{folder}/half", "w").close()
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        artifacts.artefact(str(tmp_path), "k", fails)
    assert artifacts.published(str(tmp_path), "k") is None


def test_key_follows_inputs_parameters_and_code(monkeypatch):
    key = artifacts.artefact_key("in", {"a": 1})
    assert key == artifacts.artefact_key("in", {"a": 1})
    assert len({key, artifacts.artefact_key("in2", {"a": 1}), artifacts.artefact_key("in", {"a": 2})}) == 3
    monkeypatch.setattr(artifacts, "code_version", lambda: "other")
    assert artifacts.artefact_key("in", {"a": 1}) != key
