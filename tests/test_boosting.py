"""Models that are trained together against MLlib's, each trained by itself."""

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickloom.operators import boosting
from tickloom.operators import training as T

FEATURES = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    data = []
    for model in range(3):
        for i in range(900):
            a, b, c = rng.normal(), float(rng.integers(0, 5)), rng.normal() if rng.random() > 0.3 else T.MISSING
            label = float(a * (model + 1) + b * 0.5 + rng.normal() > 1)
            data.append((model, i, "test" if i % 5 == model else "train", label, a, b, c))
    return spark.createDataFrame(data, "model int, row_id long, role string, label double, a double, b double, c double")


def test_guesses_are_those_of_mllib(spark, rows, monkeypatch):
    monkeypatch.setattr(boosting, "LEAST_ROWS", 500)
    got = sorted(tuple(r) for r in boosting.boosted_guesses(rows, FEATURES, 8, 3).groupBy("model", "prediction", "label").count().collect())
    want = []
    for model in range(3):
        own = rows.filter(F.col("model") == model)
        fitted = T._fit(own.filter("role = 'train'"), FEATURES, "label", 42, 8, 3)
        guessed = T._predict(fitted, own.filter("role = 'test'"), FEATURES)
        want += [(model, *r) for r in guessed.groupBy("prediction", "label").count().collect()]
    assert got == sorted(want) and len(got) == 12


def test_bins_of_large_models_follow_quantiles_of_all_rows(spark, rows, monkeypatch):
    sizes = {0: 720, 1: 720, 2: 720}
    train = rows.filter("role = 'train'")
    exact = boosting._edges(train, sizes, FEATURES)
    monkeypatch.setattr(boosting, "EXACT", 100)
    near = boosting._edges(train, sizes, FEATURES)
    for model in sizes:
        for feature, (e, n) in enumerate(zip(exact[model], near[model])):
            assert abs(len(e) - len(n)) <= 2, (model, feature)
        assert np.allclose(exact[model][1], near[model][1]) and np.abs(exact[model][0] - np.interp(np.linspace(0, 1, len(exact[model][0])), np.linspace(0, 1, len(near[model][0])), near[model][0])).max() < 0.3


def test_jobs_do_not_grow_with_models(spark, rows):
    """A job for each level of a tree serves all models; by themselves each had some for each tree."""
    tracker, group = spark.sparkContext.statusTracker(), "boosted"
    spark.sparkContext.setJobGroup(group, group)
    boosting.boosted_guesses(rows, FEATURES, 4, 3).collect()
    spark.sparkContext.setJobGroup("", "")
    assert len(tracker.getJobIdsForGroup(group)) < 4 * 3 + 16


def test_bins_hold_a_bounded_number_of_values(spark, monkeypatch):
    """Of many values a part tells EXACT for each PART_ROWS, and cuts stay within half a step of rank of those of all rows."""
    monkeypatch.setattr(boosting, "EXACT", 200)
    values = np.random.default_rng(3).lognormal(size=20_000)
    batches = [pa.record_batch([pa.array([0] * 1000, pa.int32()), pa.array(v)], ["model", "a"]) for v in values.reshape(20, 1000)]
    told = list(boosting._counts(["a"], 5000)(batches))
    counts = [np.frombuffer(t.column("counts")[0].as_py(), np.int64) for t in told]
    assert [(len(c), c.sum()) for c in counts] == [(200, 5000)] * 4
    df = spark.createDataFrame(pd.DataFrame({"model": 0, "a": values})).selectExpr("CAST(model AS int) AS model", "a")
    found, want = boosting._edges(df, {0: 20_000}, ["a"])[0][0], boosting.bin_edges(values)
    rank = lambda edges: np.searchsorted(np.sort(values), edges) / len(values)
    assert len(found) == len(want) == 31 and np.abs(rank(found) - rank(want)).max() < 1 / 200


def test_blocks_lie_on_disk_between_passes(spark, rows, monkeypatch):
    """Neither an executor's memory nor a plan holds the rows of all rounds: some lie on disk, and a written one begins anew."""
    monkeypatch.setattr(boosting, "WRITTEN", 2)
    kept, written, saved = [], boosting.written, []
    monkeypatch.setattr(boosting, "written", lambda df, name: (saved.append(name), written(df, name))[1])
    grow = boosting.Tree.grow

    def seen(*given):
        kept.extend((x.getStorageLevel().useMemory(), x.getStorageLevel().useDisk()) for x in spark.sparkContext._jsc.getPersistentRDDs().values())
        grow(*given)

    monkeypatch.setattr(boosting.Tree, "grow", seen)
    boosting.boosted_guesses(rows, FEATURES, 6, 2)
    assert set(kept) == {(False, True)} and saved == ["binned", "raised", "raised"]
    assert not list(spark.sparkContext._jsc.getPersistentRDDs().values())


@pytest.mark.parametrize("trees,patience", [(8, 2), (5, 20)])
def test_early_stop_is_that_of_mllib(spark, rows, monkeypatch, trees, patience):
    """Rounds, guesses and losses are those of MLlib's model, looked at round by round; a missing value may be null or stand below all."""
    monkeypatch.setattr(boosting, "LEAST_ROWS", 200)
    train, held = rows.filter("model = 1 AND role = 'train'"), rows.filter("model = 1 AND role = 'test'")
    model, found = boosting.stopped_early(train, held, FEATURES, trees, 5, 0.9, patience)
    losses = T._fit(train, FEATURES, "label", 42, trees, 5, 0.9).evaluateEachIteration(T._vectors(held, FEATURES))
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    assert found == best + 1 == len(model.trees) < trees
    want = T._predict(T._fit(train, FEATURES, "label", 42, best + 1, 5, 0.9), held, FEATURES).select("row_id", "prediction").collect()
    empty = held.withColumns({c: F.when(F.col(c) != T.MISSING, F.col(c)) for c in FEATURES})
    for given in (held, empty):
        assert sorted(map(tuple, model.transform(given).select("row_id", "prediction").collect())) == sorted(map(tuple, want))
