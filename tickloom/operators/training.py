"""Guarded training of boosted trees, and controls that must fail to learn."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone
from functools import reduce
from multiprocessing.pool import ThreadPool
from statistics import median

from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.audit import content_checksum
from tickloom.operators.boosting import boosted_guesses, stopped_early
from tickloom.operators.order import global_position
from tickloom.operators.validation import (
    LeakageError,
    assert_roles,
    classification_metrics,
    event_intervals,
    purged_kfold,
    temporal_leakage,
)
from tickloom.session import written

#: The controls that must all hold.
CONTROLS = ("as_is", "label_shuffle", "noise_features", "duplicate_rows", "missing_values", "reversed_time")
#: Fields of a training manifest that do not come from the rows.
MANIFEST = {
    "model_id": "string", "model_type": "string", "version": "string", "feature_version": "string", "label_version": "string", "splitter": "string", "purge": "string", "embargo": "string",
    "study_id": "string", "best_iteration": "int", "guardian_status": "string", "git_commit": "string", "train_timestamp": "string", "negative_control_passed": "boolean",
    "seed": "int", "trees": "int", "max_depth": "int",
}
#: Stands for a missing value in trees.
MISSING = -1e300
#: Controls whose folds are made at the same time.
AT_ONCE = 4


def _present(df: DataFrame, features: list[str], prefix: str = "") -> DataFrame:
    return df.withColumns({f"{prefix}{c}": F.when(F.col(c).isNull() | F.isnan(c), MISSING).otherwise(F.col(c)) for c in features})


def _vectors(df: DataFrame, features: list[str]) -> DataFrame:
    """_features: the vector of features; a missing value lies below every other, so that one split tells it apart."""
    ready = _present(df, features, "_")
    return VectorAssembler(inputCols=[f"_{c}" for c in features], outputCol="_features").transform(ready)


def _fit(train: DataFrame, features: list[str], label: str, seed: int, trees: int, depth: int, step: float = 0.1):
    """MLlib's model, which ours are held against."""
    learner = GBTClassifier(featuresCol="_features", labelCol=label, maxIter=trees, maxDepth=depth, stepSize=step, seed=seed)
    return learner.fit(_vectors(train, features))


def _predict(model, df: DataFrame, features: list[str]) -> DataFrame:
    return model.transform(_vectors(df, features))


def negative_controls(
    df: DataFrame, features: list[str], folds: int = 5, seeds: tuple[int, ...] = (7, 19, 42, 73, 101), trees: int = 50, depth: int = 3, purge_s: int = 1800
) -> DataFrame:
    """Controls over purged folds: labels shuffled (for each seed), features of noise, a tenth of the rows repeated after the
    end, half of the values missing, time reversed, and the data as it is.

    df: row_id, prediction_time, evaluation_time, label, features. Returns control, seed, accuracy, balanced_accuracy, mcc,
    fold_sd (deviation of the folds' accuracies), null_accuracy (that of the most frequent label) and rejected (by the
    guard of time; reversed_time alone, which trains nothing). Labels are shuffled by joining positions in time with
    positions in a seeded random order. The models of all controls and folds are trained together (boosting.boosted_guesses).
    """
    placed = global_position(df.select("row_id", "prediction_time", "evaluation_time", "label", *features), ["prediction_time", "row_id"])
    df = written(placed.withColumn("row_id", F.col("position")).drop("position"), "controls")
    rows = df.drop("n_rows")

    def shuffled(seed: int) -> DataFrame:
        other = global_position(df.select("label", F.xxhash64("row_id", F.lit(seed)).alias("key"), "row_id"), ["key", "row_id"])
        return rows.drop("label").join(other.select(F.col("position").alias("row_id"), "label"), "row_id")

    def repeated() -> DataFrame:
        last = F.broadcast(rows.agg(F.max("prediction_time").alias("_last")))  # one row
        more = df.filter("row_id < n_rows / 10").join(last)
        span = F.col("evaluation_time") - F.col("prediction_time")
        at = F.col("_last") + F.make_dt_interval(mins=(F.col("row_id") + 1).cast("int"))
        more = more.withColumn("evaluation_time", at + span).withColumn("prediction_time", at).withColumn("row_id", F.col("n_rows") + F.col("row_id"))
        return rows.unionByName(more.select(*rows.columns))

    def rejected() -> bool:
        times = df.select((F.col("n_rows") - 1 - F.col("row_id")).alias("row_id"), "prediction_time", "evaluation_time")
        try:
            purged_kfold(times, folds, purge_s, order="row_id")
        except LeakageError:
            return True
        return False

    missing = {c: F.when(F.rand(seeds[0] * 1000 + i) >= 0.5, F.col(c)) for i, c in enumerate(features)}
    noise = {c: F.randn(seeds[0] * 100 + i) for i, c in enumerate(features)}
    cases = [("as_is", 0, rows), *[("label_shuffle", s, shuffled(s)) for s in seeds]]
    cases += [("noise_features", seeds[0], rows.withColumns(noise)), ("duplicate_rows", 0, repeated()), ("missing_values", seeds[0], rows.withColumns(missing))]

    def folded(case: tuple[str, int, DataFrame]) -> tuple[str, int, DataFrame]:
        return (*case[:2], written(purged_kfold(written(case[2], case[0]), folds, purge_s).filter("role <> 'purged'"), f"{case[0]}-folds"))

    with ThreadPool(AT_ONCE) as pool:
        ready = pool.map(inheritable_thread_target(df.sparkSession)(folded), cases)
    each = [data.select(F.lit(i).alias("case"), "fold", "row_id", "role", "label", *features) for i, (_, _, data) in enumerate(ready)]
    every = _present(reduce(DataFrame.unionByName, each), features).withColumn("model", F.col("case") * folds + F.col("fold"))
    named = [F.element_at(F.array(*[F.lit(case[i]) for case in cases]), (F.floor(F.col("model") / folds) + 1).cast("int")).alias(c) for i, c in enumerate(("control", "seed"))]
    found = boosted_guesses(every, features, trees, depth).select(*named, (F.col("model") % folds).alias("fold"), "prediction", "label")
    guesses = written(found, "guesses")
    case = ("control", "seed")
    spread = classification_metrics(guesses, (*case, "fold")).groupBy(*case).agg(F.stddev_pop("accuracy").alias("fold_sd"))
    ones = (F.col("tp") + F.col("fn")) / (F.col("tp") + F.col("fn") + F.col("tn") + F.col("fp"))
    metrics = classification_metrics(guesses, case).withColumn("null_accuracy", F.greatest(ones, 1 - ones)).join(spread, [*case])
    metrics = metrics.select(*case, "accuracy", "balanced_accuracy", "mcc", "fold_sd", "null_accuracy", F.lit(None).cast("boolean").alias("rejected"))
    time = df.sparkSession.createDataFrame([("reversed_time", 0, rejected())], "control string, seed int, rejected boolean")
    return written(metrics.unionByName(time, allowMissingColumns=True), "control-metrics")


def controls_failed(metrics: DataFrame) -> list[str]:
    """Names of the controls that failed or are missing.

    Median correlation of shuffled labels within 0.1 of none and no single one below -0.3; noise near one half; reversed
    time rejected; repeated rows don't level the folds' accuracies (to under 0.01, or under a quarter of the spread as it
    is, which on large data is small by itself); scores in spite of missing values; as it is, at most 0.05 below the null
    model.
    """
    by = {}
    for r in metrics.collect():  # a row for each control and seed
        by.setdefault(r["control"], []).append(r)
    sound = lambda x: x is not None and x == x

    def holds(name: str) -> bool:
        own = by[name]
        if name == "reversed_time":
            return all(r["rejected"] is True for r in own)
        if not all(sound(r[c]) for r in own for c in ("accuracy", "balanced_accuracy", "mcc", "fold_sd", "null_accuracy")):
            return False
        if name == "label_shuffle":
            return abs(median(r["mcc"] for r in own)) <= 0.1 and min(r["mcc"] for r in own) >= -0.3
        if name == "noise_features":
            return all(abs(r["balanced_accuracy"] - 0.5) <= 0.1 for r in own)
        if name == "duplicate_rows":
            return all("as_is" in by and r["fold_sd"] >= min(0.01, by["as_is"][0]["fold_sd"] / 4) for r in own)
        if name == "as_is":
            return all(r["accuracy"] >= r["null_accuracy"] - 0.05 for r in own)
        return True

    return [name for name in CONTROLS if name not in by or not holds(name)]


def controls_passed(metrics: DataFrame) -> bool:
    """Whether every control is there and held."""
    return not controls_failed(metrics)


def training_manifest(df: DataFrame, features: list[str], **settings) -> DataFrame:
    """One row that says what a model was trained on and how: the datasets of df (dataset_id, role) with their roles, the
    early_stopping ones, the number and checksum of the train rows' labels and features, and what settings hold of the
    other fields (MANIFEST); a field that is not given is null, and one that is none raises."""
    unknown = settings.keys() - MANIFEST.keys()
    if unknown:
        raise ValueError(f"no fields of a manifest: {', '.join(sorted(unknown))}")
    ids = df.groupBy("dataset_id", "role").agg(F.count("*").alias("n")).agg(
        F.array_sort(F.collect_set("dataset_id")).alias("dataset_ids"), F.array_sort(F.collect_set("role")).alias("dataset_roles"),
        F.array_sort(F.collect_set(F.when(F.col("role") == "early_stopping", F.col("dataset_id")))).alias("early_stopping_dataset"),
    )  # fmt: skip  # a row for each dataset and role
    train = df.filter("role = 'train'").select("label", *features)
    content = train.agg(F.count("*").alias("train_rows"), content_checksum(train).alias("data_hash"))
    given = {c: F.lit(settings.get(c)).cast(kind).alias(c) for c, kind in MANIFEST.items()}
    return ids.join(F.broadcast(content)).select("*", F.lit(",".join(features)).alias("features"), *given.values())


def guarded_train(
    df: DataFrame, features: list[str], folds: int = 5, purge_s: int = 1800, trees: int = 200, depth: int = 6, seed: int = 42,
    controls: DataFrame | None = None, patience: int = 20, require_controls: bool = True, study_id: str | None = None, **settings,
):
    """Train boosted trees if every guard holds; else raise LeakageError. Returns the model and a manifest (one row).

    df: row_id, dataset_id, role, prediction_time, evaluation_time, label, features. Guards: roles of the training and the
    evaluation rows, proper event intervals, no train row of a purged fold that meets its test interval, no train row that
    meets an early_stopping one after those that do were purged, and passed negative controls (negative_controls of the
    same rows), unless require_controls is switched off. A tuning study (study_id) must not see final_vault data, which is
    looked for on its own. settings: further fields of the manifest (training_manifest). Trees stop early on the early_stopping rows, after patience rounds
    without a better one.
    """
    if study_id is not None and not df.filter("role = 'final_vault'").isEmpty():
        raise LeakageError(f"study {study_id} must not see final_vault data")
    assert_roles(df, "training")
    assert_roles(df.filter("role <> 'train'"), "eval_set")
    if controls is None and require_controls:
        raise LeakageError("negative controls are required")
    failed = [] if controls is None else controls_failed(controls)
    if failed and require_controls:
        raise LeakageError(f"negative controls failed: {', '.join(failed)}")
    passed = None if controls is None else not failed
    df = written(event_intervals(df), "training-rows")
    train, held = df.filter("role = 'train'"), df.filter("role = 'early_stopping'")
    folded = written(purged_kfold(train.select("row_id", "prediction_time", "evaluation_time"), folds, purge_s), "training-folds")
    for fold in range(folds):
        rows = folded.filter(F.col("fold") == fold)
        if not temporal_leakage(rows.filter("role = 'train'"), rows.filter("role = 'test'")).isEmpty():
            raise LeakageError(f"fold {fold} leaks")
    leaks = temporal_leakage(train.select("row_id", "prediction_time", "evaluation_time"), held.select("row_id", "prediction_time", "evaluation_time"))
    purged = written(train.join(leaks.select("row_id"), "row_id", "left_anti"), "purged-train")
    model, rounds = stopped_early(_present(purged, features), _present(held, features), features, trees, depth, 0.05, patience)
    metrics = classification_metrics(model.transform(held).select("prediction", "label"))
    settings |= {
        "model_id": settings.get("model_id") or f"gbt-{uuid.uuid4().hex[:8]}", "model_type": "gbt", "version": f"spark-{df.sparkSession.version}", "splitter": f"purged_kfold({folds})",
        "purge": f"{purge_s}s", "study_id": study_id, "best_iteration": rounds, "guardian_status": "passed" if require_controls else "controls not required",
        "train_timestamp": datetime.now(timezone.utc).isoformat(), "negative_control_passed": passed, "seed": seed, "trees": rounds, "max_depth": depth,
    }
    seen = purged.select("dataset_id", "role", "label", *features).unionByName(held.select("dataset_id", "role", "label", *features))
    manifest = training_manifest(seen, features, **settings).join(F.broadcast(metrics.select("accuracy", "balanced_accuracy", "mcc")))  # one row each
    return model, written(manifest, "training-manifest")
