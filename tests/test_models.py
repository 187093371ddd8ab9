import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.operators import models as M

FEATURES = ["x1", "x2"]


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(0, 1, (400, 2))
    y = 2 * x[:, 0] - x[:, 1] + 3 + rng.normal(0, 0.01, 400)
    rows = [("A", i, float(a), float(b), float(v), float(v > 3)) for i, ((a, b), v) in enumerate(zip(x, y))]
    rows.append(("A", 400, None, 1.0, 0.0, 0.0))
    return spark.createDataFrame(rows, "ticker string, date int, x1 double, x2 double, label double, up double").cache()


def test_linear_coefficients_and_null_features_are_skipped(frame):
    model = M.pipeline("linear", "regression", FEATURES).fit(frame)
    assert list(model.stages[-1].coefficients) == pytest.approx([2, -1], abs=0.01)
    assert M.score(model, frame).count() == 400
    assert [r["feature"] for r in M.importance(model, FEATURES).collect()] == ["x1", "x2"]


def test_saved_model_scores_the_same(spark, frame, tmp_path):
    model = M.pipeline("random_forest", "classification", FEATURES, label="up", numTrees=5, maxDepth=3).fit(frame)
    M.save_model(model, str(tmp_path / "m"), FEATURES, "up", kind="random_forest")
    loaded, meta = M.load_model(str(tmp_path / "m"))
    assert meta == {"features": FEATURES, "label": "up", "kind": "random_forest"}
    a = M.score(model, frame, True).orderBy("date").select("score").collect()
    assert a == M.score(loaded, frame, True).orderBy("date").select("score").collect()


def test_stacking_ridge_equals_the_normal_equations(spark, frame):
    train, test = frame.where("date < 300"), frame.where("date BETWEEN 300 AND 399")
    out = M.stack(train, test, {"a": M.pipeline("linear", "regression", FEATURES), "b": M.pipeline("linear", "regression", ["x1"])})
    rows = out.collect()
    assert len(rows) == 100
    assert np.mean([(r["label"] - r["prediction"]) ** 2 for r in rows]) < 0.05


def test_comparison_has_a_row_per_model(frame):
    table = M.compare(frame.where("date < 300"), frame.where("date >= 300"), {
        "good": M.pipeline("linear", "regression", FEATURES), "poor": M.pipeline("linear", "regression", ["x2"])})
    got = {r["model"]: r for r in table.collect()}
    assert got["good"]["rmse"] < got["poor"]["rmse"] and got["good"]["fit_seconds"] > 0


def test_principal_components_are_uncorrelated(frame):
    out = M.principal_components(frame.select("ticker", "date", *FEATURES), FEATURES, 10)
    assert [c for c in out.columns if c.startswith("PCA")] == ["PCA_1", "PCA_2"]
    assert out.select(F.corr("PCA_1", "PCA_2")).first()[0] == pytest.approx(0, abs=1e-9)
