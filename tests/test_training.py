"""Negative controls and guarded training on the survey's synthetic rows."""

from datetime import datetime, timedelta

import numpy as np
import pytest

from tickloom.operators import training as T
from tickloom.operators import validation as V

FEATURES = ["f1", "f2", "f3"]
START = datetime(2026, 7, 17, 9, 15)
SCHEMA = "row_id long, f1 double, f2 double, f3 double, label double, prediction_time timestamp, evaluation_time timestamp"


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(42)
    x = rng.normal(size=(500, 3))
    y = (x[:, 0] * 0.15 + rng.normal(size=500) * 0.85 > 0).astype(float)
    at = [START + timedelta(minutes=i) for i in range(500)]
    data = [(i, *map(float, x[i]), float(y[i]), at[i], at[i] + timedelta(minutes=30)) for i in range(500)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.fixture(scope="module")
def controls(rows):
    return T.negative_controls(rows, FEATURES, trees=2, depth=2)


def test_every_control_is_there(controls):
    by = {}
    for r in controls.collect():
        by.setdefault(r["control"], []).append(r)
    assert set(by) == set(T.CONTROLS)
    assert sorted(r["seed"] for r in by["label_shuffle"]) == [7, 19, 42, 73, 101]
    assert by["reversed_time"][0]["rejected"] is True
    assert all(r["accuracy"] is not None for k, v in by.items() if k != "reversed_time" for r in v)


CASES = [
    ("as_is", "accuracy", 0.1), ("label_shuffle", "mcc", 0.4), ("noise_features", "balanced_accuracy", 0.7), ("duplicate_rows", "fold_sd", 0.0),
    ("missing_values", "accuracy", float("nan")), ("reversed_time", "rejected", False),
]


def metrics(spark, **change):
    names = ["as_is", *["label_shuffle"] * 5, "noise_features", "duplicate_rows", "missing_values", "reversed_time"]
    good = {"accuracy": 0.55, "balanced_accuracy": 0.5, "mcc": 0.01, "fold_sd": 0.04, "null_accuracy": 0.52, "rejected": None}
    found = [{"control": n, "seed": i, **good, **({"rejected": True} if n == "reversed_time" else {}), **change.get(n, {})} for i, n in enumerate(names)]
    kinds = "control string, seed int, accuracy double, balanced_accuracy double, mcc double, fold_sd double, null_accuracy double, rejected boolean"
    return spark.createDataFrame(found, kinds)


@pytest.mark.parametrize("control,column,value", CASES)
def test_each_control_is_judged(spark, control, column, value):
    assert T.controls_failed(metrics(spark, **{control: {column: value}})) == [control]
    assert T.controls_failed(metrics(spark).filter(f"control <> '{control}'"))
    assert T.controls_passed(metrics(spark))


def test_time_order(spark, rows):
    V.assert_time_order(rows, "row_id")
    with pytest.raises(V.LeakageError, match="monotonic"):
        V.purged_kfold(rows.selectExpr("499 - row_id AS row_id", "prediction_time", "evaluation_time"), order="row_id")


def test_guarded_train_needs_controls(spark, rows):
    split = V.chrono_split(rows, keys=("prediction_time", "row_id")).selectExpr("*", "concat('d-', role) AS dataset_id")
    with pytest.raises(V.LeakageError, match="required"):
        T.guarded_train(split, FEATURES)
    bad = metrics(spark, label_shuffle={"mcc": 0.4})
    with pytest.raises(V.LeakageError, match="label_shuffle"):
        T.guarded_train(split, FEATURES, controls=bad)
    found = T.guarded_train(split, FEATURES, folds=2, trees=3, depth=2, patience=1, controls=metrics(spark))[1].first()
    assert found["negative_control_passed"] is True and 1 <= found["trees"] <= 3 and found["max_depth"] == 2
    assert found["train_rows"] < 400
    assert (found["dataset_ids"], found["dataset_roles"], found["early_stopping_dataset"]) == (["d-early_stopping", "d-train"], ["early_stopping", "train"], ["d-early_stopping"])
    assert {f for f in T.MANIFEST if found[f] is None} == {"feature_version", "label_version", "embargo", "study_id", "git_commit"} and found["guardian_status"] == "passed"
    assert (found["splitter"], found["purge"], found["best_iteration"]) == ("purged_kfold(2)", "1800s", found["trees"]) and len(found["data_hash"]) > 5
    with pytest.raises(ValueError, match="colour"):
        T.training_manifest(split, FEATURES, colour="red")


def test_a_study_must_not_see_the_vault(spark, rows):
    split = rows.selectExpr("*", "CASE WHEN row_id < 400 THEN 'train' WHEN row_id < 480 THEN 'early_stopping' ELSE 'final_vault' END AS role").selectExpr("*", "concat('d-', role) AS dataset_id")
    with pytest.raises(V.LeakageError, match="study s1"):
        T.guarded_train(split, FEATURES, controls=metrics(spark), study_id="s1")
    with pytest.raises(V.LeakageError, match="training must not hold d-final_vault"):
        T.guarded_train(split, FEATURES, controls=metrics(spark))


def test_roles_name_some_datasets_and_count_all(spark):
    df = spark.range(30).selectExpr("concat('d', lpad(id, 2, '0')) AS dataset_id", "CASE WHEN id < 20 THEN 'final_vault' WHEN id = 20 THEN NULL ELSE 'train' END AS role")
    with pytest.raises(V.LeakageError, match="d00, d01, d02 and 18 more"):
        V.assert_roles(df, "training", named=3)


def test_medians_over_seeds(spark):
    df = spark.createDataFrame([("a", s, x, x / 2, -x) for s, x in enumerate([0.1, 0.9, 0.4])] + [("b", 0, 0.2, 0.2, 0.2)], "k string, seed int, accuracy double, balanced_accuracy double, mcc double")
    got = {r["k"]: tuple(r)[1:] for r in V.median_metrics(df, ("k",)).collect()}
    assert got == {"a": (3, 0.4, 0.2, -0.4), "b": (1, 0.2, 0.2, 0.2)}


def test_query_gives_controls_and_surveyed_sizes(spark, monkeypatch):
    import inspect

    from tickloom.plans import learn

    seen = {}
    monkeypatch.setattr(learn, "rows", lambda spark, sf_dir: spark.sql("SELECT 1L AS row_id, 1L AS security_id, current_timestamp() AS event_time"))
    monkeypatch.setattr(learn.T, "negative_controls", lambda df, features: "controls")
    monkeypatch.setattr(learn.T, "guarded_train", lambda df, features, **given: (None, seen.update(given)))
    learn.guarded_train(spark, "")
    assert seen == {"controls": "controls"}
    monkeypatch.undo()
    given = {k: p.default for k, p in inspect.signature(T.guarded_train).parameters.items()}
    assert [given[k] for k in ("folds", "purge_s", "trees", "depth", "patience", "require_controls")] == [5, 1800, 200, 6, 20, True]
