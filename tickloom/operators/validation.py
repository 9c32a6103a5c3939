"""Dataset roles, time-ordered splits, and guards against leakage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.order import global_position
from tickloom.session import written

ROLES = ("train", "early_stopping", "calibration", "outer_test", "final_vault")
#: Roles that a purpose must not see.
FORBIDDEN = {"training": ("outer_test", "final_vault"), "eval_set": ("outer_test", "final_vault", "calibration")}


class LeakageError(ValueError):
    """A guard found data that its purpose must not see."""


def assert_roles(df: DataFrame, purpose: str, named: int = 1000) -> None:
    """Raise LeakageError, naming dataset ids, if df (dataset_id, role) holds a role that purpose forbids, an unknown role,
    or, as an eval_set, no early_stopping data. At most so many ids reach the driver and are named; all are counted."""
    known = [r for r in ROLES if r not in FORBIDDEN[purpose]]
    bad = df.filter(~F.coalesce(F.col("role").isin(*known), F.lit(False))).select("dataset_id").distinct()
    first = bad.orderBy("dataset_id").limit(named).collect()
    if first:
        more = bad.count() - len(first)
        raise LeakageError(f"{purpose} must not hold {', '.join(str(r[0]) for r in first)}" + f" and {more} more" * (more > 0))
    if purpose == "eval_set" and df.filter("role = 'early_stopping'").isEmpty():
        raise LeakageError("an eval_set needs early_stopping data")


def event_intervals(df: DataFrame) -> DataFrame:
    """prediction_time and evaluation_time as timestamps (UTC); a null or an end before its start raises."""
    out = df.withColumns({c: F.col(c).cast("timestamp") for c in ("prediction_time", "evaluation_time")})
    bad = out.agg(F.count_if(F.coalesce(F.col("evaluation_time") < F.col("prediction_time"), F.lit(True))).alias("n")).first()["n"]
    if bad:
        raise LeakageError(f"{bad} rows have no proper event interval")
    return out


def forward_label(features: DataFrame, keep_last: bool = False) -> DataFrame:
    """label: whether the next bar's return is positive; a last bar has none and goes, or is labelled 0 with keep_last."""
    after = F.lead("returns").over(Window.partitionBy("security_id").orderBy("event_time"))
    df = features.withColumn("label", F.when(after > 0, 1).when(after.isNotNull(), 0))
    return df.fillna({"label": 0}) if keep_last else df.filter("label IS NOT NULL")


def chrono_split(df: DataFrame, share: float = 0.8, keys: tuple[str, ...] = ("event_time", "security_id")) -> DataFrame:
    """role: train for the first share of rows in time, early_stopping for the rest."""
    placed = global_position(df, list(keys))
    first = F.floor(F.lit(share) * F.col("n_rows"))
    return placed.withColumn("role", F.when(F.col("position") < first, "train").otherwise("early_stopping")).drop("position", "n_rows")


def busiest_security(df: DataFrame) -> DataFrame:
    """The security with most rows, the least id of several."""
    return df.groupBy("security_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "security_id").limit(1)


def _overlaps(start: Column, end: Column, low: Column, high: Column) -> Column:
    return (start <= high) & (end >= low)


def assert_time_order(df: DataFrame, order: str) -> None:
    """Raise LeakageError if prediction_time falls anywhere along the column order, whose values differ from row to row."""
    rows = df.select(order, "prediction_time")
    given = global_position(rows, [order]).select(order, F.col("position").alias("given"))
    moved = global_position(rows, ["prediction_time", order]).join(given, order).filter("position <> given")
    if not moved.isEmpty():
        raise LeakageError(f"prediction_time is not monotonic in {order}")


def purged_kfold(
    df: DataFrame, k: int = 5, purge_s: int = 0, embargo_s: int = 0, keys: tuple[str, ...] = ("prediction_time", "row_id"), order: str | None = None
) -> DataFrame:
    """(fold, role) of each row for k contiguous folds in time, the first n mod k of them one row longer.

    In fold f its rows are test; other rows are train unless their interval meets the test interval widened by purge_s on
    both sides, or they start within embargo_s after it. There are k fold bounds, so they are broadcast. order: a column along
    which time must not fall.
    """
    if order:
        assert_time_order(df, order)
    placed = global_position(event_intervals(df), list(keys))
    size, more = F.floor(F.col("n_rows") / k), F.col("n_rows") % k
    cut = more * (size + 1)
    own = F.when(F.col("position") < cut, F.floor(F.col("position") / (size + 1))).otherwise(more + F.floor((F.col("position") - cut) / F.greatest(size, F.lit(1))))
    placed = placed.withColumn("own_fold", own.cast("int")).drop("position", "n_rows")
    bounds = placed.groupBy(F.col("own_fold").alias("fold")).agg(F.min("prediction_time").alias("low"), F.max("evaluation_time").alias("high"))
    every = placed.join(F.broadcast(bounds))
    wide = lambda c, s: c + F.make_dt_interval(secs=F.lit(s))
    near = _overlaps(F.col("prediction_time"), F.col("evaluation_time"), wide(F.col("low"), -purge_s), wide(F.col("high"), purge_s))
    after = (F.col("prediction_time") > F.col("high")) & (F.col("prediction_time") <= wide(F.col("high"), embargo_s))
    role = F.when(F.col("own_fold") == F.col("fold"), "test").when(near | after, "purged").otherwise("train")
    return every.withColumn("role", role).drop("low", "high", "own_fold")


def temporal_leakage(train: DataFrame, test: DataFrame) -> DataFrame:
    """Train rows whose event interval meets that of a test row.

    A train row leaks if some test row that starts at or before its end ends at or after its start, so what counts is the
    latest end among the test rows that start by then. Ends of train rows and starts of test rows are put in one order of
    time, cut into ranges of equal size (a busy moment can be cut too); each range finds its latest end, those few are
    carried from range to range, and a window inside a range does the rest. Nothing is compared pair by pair.
    """
    n = int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ends = event_intervals(train).select(F.col("evaluation_time").alias("_moment"), F.lit(1).alias("_kind"), F.col("prediction_time").alias("_low"), F.struct(*train.columns).alias("_row"))
    starts = event_intervals(test).select(F.col("prediction_time").alias("_moment"), F.lit(0).alias("_kind"), F.col("evaluation_time").alias("_reach"))
    # the number tells rows of one moment apart, so that no range must take all of them
    sweep = starts.unionByName(ends, allowMissingColumns=True).withColumn("_nth", F.monotonically_increasing_id())
    sweep = written(written(sweep, "leak-rows").repartitionByRange(n, "_moment", "_kind", "_nth").withColumn("_range", F.spark_partition_id()), "leak-ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = sweep.groupBy("_range").agg(F.max("_reach").alias("_most")).select("_range", F.max("_most").over(before).alias("_carried"))  # one row for each range
    upto = Window.partitionBy("_range").orderBy("_moment", "_kind", "_nth").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = sweep.join(F.broadcast(carried), "_range").withColumn("_latest", F.greatest("_carried", F.max("_reach").over(upto)))
    return swept.filter("_kind = 1 AND _latest >= _low").select("_row.*")


def lineage_integrity(predictions: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Predictions whose universe snapshot does not exist."""
    return predictions.join(snapshots.select("universe_snapshot_id"), "universe_snapshot_id", "left_anti")


def classification_metrics(df: DataFrame, by: tuple[str, ...] = (), prediction: str = "prediction", label: str = "label") -> DataFrame:
    """Accuracy, balanced accuracy and Matthews correlation (0 where undefined) of each group."""
    p, y = F.col(prediction) == 1, F.col(label) == 1
    c = df.groupBy(*by).agg(
        F.count_if(p & y).alias("tp"), F.count_if(~p & ~y).alias("tn"), F.count_if(p & ~y).alias("fp"), F.count_if(~p & y).alias("fn")
    )
    tp, tn, fp, fn = (F.col(x).cast("double") for x in ("tp", "tn", "fp", "fn"))
    share = lambda a, b: F.when(a + b > 0, a / (a + b)).otherwise(F.lit(0.0))
    root = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    return c.withColumns(
        {
            "accuracy": (tp + tn) / (tp + tn + fp + fn),
            "balanced_accuracy": (share(tp, fn) + share(tn, fp)) / 2,
            "mcc": F.when(root > 0, (tp * tn - fp * fn) / root).otherwise(F.lit(0.0)),
        }
    )


def median_metrics(metrics: DataFrame, by: tuple[str, ...] = (), names: tuple[str, ...] = ("accuracy", "balanced_accuracy", "mcc")) -> DataFrame:
    """The median of each metric over the rows (seeds) of a group."""
    return metrics.groupBy(*by).agg(F.count("*").alias("seeds"), *[F.percentile(n, F.lit(0.5)).alias(n) for n in names])
