"""Technical features of bars, in one pass over windows of a security.

Wilder's smoothing a_t = r a_(t-1) + x_t / p is a linear recurrence. Rows of a key are cut into blocks; inside a block it is a
running sum of x r^-i, and the ends of the blocks before carry over, each decayed by its distance. A block is so long that a
value fades by e^60 or more along it, so the ends of the last 12 blocks are all that a double can hold. All columns are
smoothed together by windows over the key: no loop in Python, no join, and the key's one shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.scalars import ratio

#: A block has so many periods: a value fades by e to this power along it. Ends of so many blocks are carried over.
FADE, CARRIED = 60, 12


def _keys(session_col: str | None) -> list[str]:
    return ["security_id", session_col] if session_col else ["security_id"]


def true_range() -> Column:
    before = F.col("close_before")
    spread = F.col("high") - F.col("low")
    return F.when(before.isNull(), spread).otherwise(
        F.greatest(spread, F.abs(F.col("high") - before), F.abs(F.col("low") - before))
    )


def wilder(df: DataFrame, columns: dict[str, tuple[str, int]], period: int, keys: Iterable[str] = ("security_id",)) -> DataFrame:
    """Wilder averages of columns {input: (output, first row)}; df has row number n (from 1) within keys.

    The average starts at row n = first + period - 1 as the mean of the period rows from row first on; before that it is
    null. Inputs are 0 or more; a null counts as 0.
    """
    keys = list(keys)
    keep = (period - 1) / period
    block = FADE * period if period > 1 else 1
    recent = Window.partitionBy(*keys).orderBy("n").rowsBetween(1 - period, 0)
    inside = Window.partitionBy(*keys, "_block").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = Window.partitionBy(*keys).orderBy("_block").rangeBetween(-CARRIED, -1)
    df = df.withColumn("_block", F.floor((F.col("n") - 1) / block)).withColumn("_j", F.pmod(F.col("n") - 1, F.lit(block)))
    names = {}
    for x, (y, first) in columns.items():
        start = first + period - 1
        own = F.when(F.col("n") == start, F.sum(x).over(recent) / period).when(F.col("n") > start, F.col(x) / period)
        names[y] = start
        df = df.withColumn(f"_y_{y}", own)
    for y in names:
        running = F.sum(F.col(f"_y_{y}") * F.pow(F.lit(keep), -F.col("_j"))).over(inside)
        df = df.withColumn(f"_s_{y}", F.coalesce(running * F.pow(F.lit(keep), F.col("_j")), F.lit(0.0)))
    last = F.struct(F.col("_block").alias("block"), *[F.col(f"_s_{y}").alias(y) for y in names])
    df = df.withColumn("_ends", F.collect_list(F.when(F.col("_j") == block - 1, last)).over(ends))

    def carried(y: str) -> Column:
        """The ends of the blocks before, each decayed by the rows since."""
        return F.aggregate(
            "_ends", F.lit(0.0), lambda total, end: total + end[y] * F.pow(F.lit(keep), (F.col("_block") - 1 - end["block"]) * block + F.col("_j") + 1)
        )

    for y, start in names.items():
        df = df.withColumn(y, F.when(F.col("n") >= start, F.col(f"_s_{y}") + carried(y)))
    return df.drop("_block", "_j", "_ends", *[f"_{p}_{y}" for p in "ys" for y in names])


def compute_features(
    bars: DataFrame, expiry: Column | None = None, period: int = 14, rvol_rows: int = 20, session_col: str | None = None
) -> DataFrame:
    """returns, range, true_range, atr, vwap, rsi, rvol, oi_change and minutes_to_expiry of each bar.

    Of bars with one (security_id, event_time) the one of the highest revision counts. Nulls: returns and oi_change on
    the first bar, atr on 13 bars, rsi on 14, rvol on 19 (with the default period and rows); returns and oi_change also where the bar before is 0 or lacks
    a value. session_col restarts everything with each session. All windows and the smoothing share one shuffle on
    security_id.
    """
    keys = _keys(session_col)
    newest = Window.partitionBy(*keys, "event_time").orderBy(F.desc("revision"))
    order = Window.partitionBy(*keys).orderBy("event_time")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    recent = order.rowsBetween(1 - rvol_rows, 0)
    bars = bars.repartition("security_id").withColumn("_nth", F.row_number().over(newest)).filter("_nth = 1").drop("_nth")
    df = (
        bars.withColumn("n", F.row_number().over(order))
        .withColumn("close_before", F.lag("close").over(order))
        .withColumn("oi_before", F.lag("oi_close").over(order))
        .withColumn("true_range", true_range())
    )
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    change = F.col("close") - F.col("close_before")
    mean = F.avg("volume").over(recent)
    df = (
        df.withColumn("returns", F.when(F.col("close_before") != 0, change / F.col("close_before")))
        .withColumn("range", ratio(F.col("high") - F.col("low"), F.col("close"), F.lit(0.0)))
        .withColumn("vwap", ratio(F.sum(typical * F.col("volume")).over(upto), F.sum("volume").over(upto), F.lit(0.0)))
        .withColumn("rvol", F.when(F.col("n") >= rvol_rows, ratio(F.col("volume"), mean, F.lit(0.0))))
        .withColumn("oi_change", F.when(F.col("oi_before") != 0, (F.col("oi_close") - F.col("oi_before")) / F.col("oi_before")))
        .withColumn("gain", F.greatest(change, F.lit(0.0)))
        .withColumn("loss", F.greatest(-change, F.lit(0.0)))
    )
    df = wilder(df, {"true_range": ("atr", 1), "gain": ("avg_gain", 2), "loss": ("avg_loss", 2)}, period, keys)
    rsi = F.when(F.col("avg_loss") == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + F.col("avg_gain") / F.col("avg_loss")))
    df = df.withColumn("rsi", F.when(F.col("avg_loss").isNotNull(), rsi))
    if expiry is None:
        expiry = F.lit(None).cast("timestamp")
    seconds = (F.unix_micros(expiry.cast("timestamp")) - F.unix_micros(F.col("event_time").cast("timestamp"))) / 1e6
    df = df.withColumn("minutes_to_expiry", seconds / 60)
    return df.select(
        *keys, "event_time", "returns", "range", "true_range", "atr", "vwap", "rsi", "rvol", "oi_change", "minutes_to_expiry"
    )


def feature_available_time(event_time: Column, bar_s: int = 60, delay_s: int = 1) -> Column:
    """When a feature of the bar that starts at event_time is known."""
    return event_time + F.make_dt_interval(secs=F.lit(bar_s + delay_s))


def causal_filter(features: DataFrame, decision: Column, bar_s: int = 60, delay_s: int = 1) -> DataFrame:
    """Features that are known at the time of a decision."""
    return features.filter(feature_available_time(F.col("event_time"), bar_s, delay_s) <= decision)


def feature_parity(a: DataFrame, b: DataFrame, columns: list[str], atol: float = 1e-10, rtol: float = 1e-8) -> DataFrame:
    """For each column: rows in both, rows in one alone, values that differ, nulls on one side alone, and securities whose first
    valid row is not the same one. Counts are made for each security first."""
    keys = ["security_id", "event_time"]
    left = a.select(*keys, *[F.col(c).alias(f"a_{c}") for c in columns], F.lit(1).alias("in_a"))
    right = b.select(*keys, *[F.col(c).alias(f"b_{c}") for c in columns], F.lit(1).alias("in_b"))
    both = left.join(right, keys, "full")
    paired = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    counts, totals = [F.count_if(paired).alias("rows"), F.count_if(~paired).alias("unpaired")], []
    for c in columns:
        x, y = F.col(f"a_{c}"), F.col(f"b_{c}")
        first = lambda v: F.min(F.when(v.isNotNull(), F.col("event_time")))
        counts += [
            F.count_if(paired & (F.abs(x - y) > atol + rtol * F.abs(y))).alias(f"differ_{c}"),
            F.count_if(paired & (x.isNull() != y.isNull())).alias(f"nulls_{c}"),
            (~first(x).eqNullSafe(first(y))).cast("long").alias(f"first_{c}"),
        ]
        total = lambda name: F.coalesce(F.sum(name), F.lit(0))
        totals.append(
            F.struct(
                F.lit(c).alias("feature"), total("rows").alias("rows"), total("unpaired").alias("unpaired"), total(f"differ_{c}").alias("differ"),
                total(f"nulls_{c}").alias("null_differ"), total(f"first_{c}").alias("first_differ"),
            ).alias(c)
        )
    return both.groupBy("security_id").agg(*counts).agg(*totals).select(F.inline(F.array(*columns)))
