"""Series of rolling contracts, gaps of minutes, labels over horizons, and combinatorial splits."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.order import global_position
from tickloom.operators.validation import event_intervals


def rolling_segments(df: DataFrame, slot: str = "slot", strike: str = "strike", time_col: str = "event_time", value: str = "close") -> DataFrame:
    """Add rolling_segment_id (from 0, one more at each change of strike in a slot), segment_boundary, and returns of value
    that start anew in each segment."""
    order = Window.partitionBy(slot).orderBy(time_col)
    changed = ~F.col(strike).eqNullSafe(F.lag(strike).over(order)) & (F.row_number().over(order) > 1)
    df = df.withColumn("segment_boundary", changed).withColumn("rolling_segment_id", F.sum(F.col("segment_boundary").cast("int")).over(order))
    before = F.lag(value).over(Window.partitionBy(slot, "rolling_segment_id").orderBy(time_col))
    return df.withColumn("returns", F.when(before != 0, (F.col(value) - before) / before))


def segment_features(df: DataFrame, slot: str = "slot", strike: str = "strike", time_col: str = "event_time") -> DataFrame:
    """rolling_segments with oi_change (to the bar before) and vwap (of the segment so far), which start anew in each segment
    too. df: slot, strike, time_col, high, low, close, volume, oi_close."""
    found = rolling_segments(df, slot, strike, time_col)
    order = Window.partitionBy(slot, "rolling_segment_id").orderBy(time_col)
    so_far, before = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), F.lag("oi_close").over(order)
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    volume = F.sum("volume").over(so_far)
    return found.withColumns(
        {
            "oi_change": F.when(before != 0, (F.col("oi_close") - before) / before),
            "vwap": F.when(volume == 0, F.lit(0.0)).otherwise(F.sum(typical * F.col("volume")).over(so_far) / volume),
        }
    )


def silver_flags(ticks: DataFrame, as_of, window_s: int = 300) -> DataFrame:
    """Mark repeats of (security_id, event_time, price, volume), late ticks, and those without a proper price or time."""
    again = Window.partitionBy("security_id", "event_time", "price", "volume").orderBy("seq")
    late = F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds("event_time") > window_s
    return ticks.withColumns(
        {
            "is_duplicate": F.row_number().over(again) > 1,
            "is_late": F.coalesce(late, F.lit(False)),
            "is_invalid": F.col("event_time").isNull() | F.coalesce(F.col("price") <= 0, F.lit(True)) | F.coalesce(F.col("volume") < 0, F.lit(False)),
        }
    )


def missing_minutes(bars: DataFrame, interval_s: int = 60) -> DataFrame:
    """For each security and day: bars there are, bars there should be between the first and the last, and the share that is
    missing. Nothing is filled in."""
    seconds = F.unix_seconds("event_time")
    days = bars.groupBy("security_id", F.col("event_time").cast("date").alias("day")).agg(
        F.count_distinct("event_time").alias("present"), ((F.max(seconds) - F.min(seconds)) / interval_s + 1).cast("long").alias("expected")
    )
    return days.withColumn("missing_rate", 1 - F.col("present") / F.col("expected"))


def oi_jumps(bars: DataFrame, most: float = 0.5) -> DataFrame:
    """Bars whose open interest differs from the last known one by more than that share of it."""
    order = Window.partitionBy("security_id").orderBy("event_time").rowsBetween(Window.unboundedPreceding, -1)
    before = F.last("oi_close", ignorenulls=True).over(order)
    return bars.withColumn("oi_before", before).filter(F.abs(F.col("oi_close") - F.col("oi_before")) > most * F.col("oi_before"))


def horizon_labels(bars: DataFrame, minutes: list[int], tolerance_s: int = 86_400) -> DataFrame:
    """label_<m>: whether the first close at or after m minutes later is higher; null if there is none within tolerance_s more."""
    order = Window.partitionBy("security_id").orderBy(F.unix_seconds("event_time"))
    later = lambda m: F.first("close").over(order.rangeBetween(60 * m, 60 * m + tolerance_s))
    return bars.withColumns({f"label_{m}": (later(m) > F.col("close")).cast("int") for m in minutes})


def path_numbers(groups: int, tests: int) -> list[tuple[int, int, int]]:
    """(split, group, path): the splits that test a group are dealt one to each path, so that a path tests every group once.

    With 8 groups and 2 tests there are 28 splits and 28 * 2 / 8 = 7 paths.
    """
    seen, found = [0] * groups, []
    for split, chosen in enumerate(combinations(range(groups), tests)):
        for g in chosen:
            found.append((split, g, seen[g]))
            seen[g] += 1
    return found


def combinatorial_folds(df: DataFrame, groups: int = 8, tests: int = 2, purge_s: int = 1800, embargo_s: int = 300, keys: tuple[str, ...] = ("prediction_time", "row_id")) -> DataFrame:
    """(split, role, path) of each row for all ways to choose test groups among contiguous groups in time.

    A row outside the test groups is purged if its interval meets one of theirs, widened by purge_s, or if it starts within
    embargo_s after one. A test row has the path (path_numbers) that its group and split belong to: the test rows of a path are
    all rows, once. The bounds of groups and the splits are a few rows, set by groups and tests.
    """
    placed = global_position(event_intervals(df), list(keys))
    placed = placed.withColumn("own", F.least(F.floor(F.col("position") * groups / F.col("n_rows")), F.lit(groups - 1)).cast("int")).drop("position", "n_rows")
    bounds = placed.groupBy("own").agg(F.min("prediction_time").alias("low"), F.max("evaluation_time").alias("high"))
    ways = df.sparkSession.createDataFrame(path_numbers(groups, tests), "split int, own int, path int").join(F.broadcast(bounds), "own", "left")
    ways = ways.groupBy("split").agg(F.collect_list(F.struct("own", "path", "low", "high")).alias("tests"))
    every = placed.join(F.broadcast(ways))
    wide = lambda c, s: c + F.make_dt_interval(secs=F.lit(s))
    start, end = F.col("prediction_time"), F.col("evaluation_time")
    near = F.exists("tests", lambda t: (start <= wide(t["high"], purge_s)) & (end >= wide(t["low"], -purge_s)) | (start > t["high"]) & (start <= wide(t["high"], embargo_s)))
    path = F.get(F.filter("tests", lambda t: t["own"] == F.col("own")), F.lit(0))["path"]
    every = every.withColumn("path", path)
    role = F.when(F.col("path").isNotNull(), "test").when(F.coalesce(near, F.lit(False)), "purged").otherwise("train")
    return every.withColumn("role", role).drop("own", "tests")


def path_gains(folds: DataFrame, by: str = "security_id", value: str = "value") -> DataFrame:
    """Test rows of combinatorial_folds with what a split's train rows of the same security teach, put together by path.

    learned: the sum of their values, chance: the share of them that are above 0 (null without any); gain: the row's value
    held long or short by the sign of learned. Each row is in each path once. Train rows are summed in each task first, and
    what is joined has one row for each split and security.
    """
    taught = folds.filter("role = 'train'").groupBy("split", by).agg(F.sum(value).alias("learned"), F.avg((F.col(value) > 0).cast("double")).alias("chance"))
    test = folds.filter("role = 'test'").join(taught, ["split", by], "left")
    return test.withColumn("gain", F.signum(F.coalesce(F.col("learned").cast("double"), F.lit(0.0))) * F.col(value))


def path_performance(gains: DataFrame, candidate: str = "candidate") -> DataFrame:
    """n, total and ratio (mean to standard deviation, null if that is 0) of each candidate's gains along each path."""
    per = gains.groupBy(candidate, "path").agg(F.count("*").alias("n"), F.sum("gain").alias("total"), F.avg("gain").alias("m"), F.stddev_samp("gain").alias("sd"))
    return per.withColumn("ratio", F.when(F.col("sd") > 0, F.col("m") / F.col("sd"))).drop("m", "sd")


def calibration_error(gains: DataFrame, candidate: str = "candidate", value: str = "value", bins: int = 10) -> DataFrame:
    """For each candidate the mean distance of the chance from the share that came true, over equal bins of the chance."""
    some = gains.filter("chance IS NOT NULL").withColumn("bin", F.least(F.floor(F.col("chance") * bins), F.lit(bins - 1)))
    per = some.groupBy(candidate, "bin").agg(F.count("*").alias("n"), F.sum("chance").alias("said"), F.count_if(F.col(value) > 0).alias("came"))
    return per.groupBy(candidate).agg((F.sum(F.abs(F.col("said") - F.col("came"))) / F.sum("n")).alias("calibration_error"))


def model_input_iv(df: DataFrame, max_age_s: int = 60, max_spread: float = 0.05) -> DataFrame:
    """iv and iv_source: the local volatility if its search converged, else the provider's if it is fresh and its spread
    tight, else null. df: local_iv, converged, provider_iv, age_s, spread."""
    local = F.coalesce(F.col("converged") & (F.col("local_iv") > 0), F.lit(False))
    provider = (F.col("provider_iv") > 0) & (F.col("age_s") <= max_age_s) & (F.col("spread") <= max_spread)
    provider = F.coalesce(provider, F.lit(False))
    return df.withColumns(
        {
            "iv": F.when(local, F.col("local_iv")).when(provider, F.col("provider_iv")),
            "iv_source": F.when(local, "local").when(provider, "provider").otherwise("none"),
        }
    )
