import numpy as np
import pandas as pd
import pytest

from tenure.operators import cox, features, logistic
from tenure.plans.model_store import ModelStore


def _models():
    scaler = features.Scaler(["a", "b"], [1.0, 2.0], [0.5, 3.0])
    lr = logistic.LogisticModel(scaler, [0.3, -0.7], 0.11, 42)
    base = pd.DataFrame({"time": [1.0, 5.0], "baseline_hazard": [0.1, 0.2], "baseline_cumulative_hazard": [0.1, 0.3]})
    with_base = cox.CoxModel(["b", "a"], np.array([0.2, -0.4]), np.array([[1.0, 0.25], [0.25, 2.0]]), np.array([0.1, 0.2]), -3.5, 7, 99, base, converged=False)
    varying = cox.CoxModel(["a"], np.array([0.9]), np.array([[4.0]]), np.array([0.0]), -1.0, 2, 10)
    return scaler, lr, with_base, varying


def test_reloaded_models_score_as_the_fitted_ones(spark, tmp_path):
    scaler, lr, standard, varying = _models()
    store = ModelStore(spark, f"{tmp_path}/models")
    assert store.versions("logistic") == []
    with pytest.raises(ValueError):
        store.load("logistic")
    assert store.save("logistic", lr, scaler, ["c"]) == 1
    assert store.save("cox_standard", standard, features.Scaler(["b", "a"], [2.0, 1.0], [3.0, 0.5]), []) == 1
    assert store.save("cox_time_varying", varying, features.Scaler(["a"], [0.0], [1.0]), ["b", "open"]) == 1
    df = spark.createDataFrame([("x", 1.5, 2.0), ("y", None, -4.0), ("z", 0.0, 0.0)], "id string, a double, b double")

    back = store.load("logistic")
    assert back.model == lr and back.dropped == ["c"] and back.kept == ["a", "b"]
    want = logistic.predict_logistic(df, lr).select("id", "probability", "predicted_label").collect()
    assert back.score(df, keep=["id"]).collect() == want

    back = store.load("cox_standard")
    assert back.model.features == standard.features and back.model.converged is False and back.model.iterations == 7 and back.model.n_rows == 99
    assert np.array_equal(back.model.variance, standard.variance) and np.array_equal(back.model.norm_mean, standard.norm_mean)
    assert back.model.baseline.equals(standard.baseline)
    assert back.model.summary_rows() == standard.summary_rows()
    scaled = features.standardize(df, back.scaler, keep=["id"])
    want = cox.survival_at(cox.partial_hazard(scaled, standard), standard, [3, 9]).collect()
    assert cox.survival_at(cox.partial_hazard(scaled, back.model), back.model, [3, 9]).collect() == want
    assert store.load("cox_time_varying").dropped == ["b", "open"] and store.load("cox_time_varying").model.baseline is None


def test_versions_are_kept_apart(spark, tmp_path):
    scaler, lr, *_ = _models()
    store = ModelStore(spark, f"{tmp_path}/models")
    later = logistic.LogisticModel(scaler, [9.0, 9.0], 1.0, 43)
    assert (store.save("logistic", lr, scaler, []), store.save("logistic", later, scaler, [])) == (1, 2)
    assert store.load("logistic").model == later and store.load("logistic", 1).model == lr
    with pytest.raises(ValueError):
        store.load("logistic", 3)
    # a run that failed before its file was committed is no version
    store._fs.mkdirs(store._path(f"{tmp_path}/models/kind=logistic/version=3"))
    assert store.versions("logistic") == [1, 2] and store.load("logistic").version == 2
    assert store.save("logistic", lr, scaler, []) == 4
    assert {(r.kind, r.version) for r in store.table().select("kind", "version").distinct().collect()} == {("logistic", 1), ("logistic", 2), ("logistic", 4)}
