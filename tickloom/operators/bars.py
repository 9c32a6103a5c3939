"""Time bars from ticks, late partial bars, and checks of bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.functions.scalars import bucket_start


def bar_aggregates(time_col: str = "event_time") -> list[Column]:
    """What a bar has of its ticks. A tick without a price adds open interest alone; ties on time are broken by seq."""
    order, trade = F.struct(F.col(time_col).alias("t"), F.col("seq").alias("s")), F.col("price").isNotNull()
    trade_order, oi_order = F.when(trade, order), F.when(F.col("oi").isNotNull(), order)
    return [
        F.min_by("price", trade_order).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        F.max_by("price", trade_order).alias("close"),
        F.sum(F.when(trade, F.col("volume")).otherwise(F.lit(0))).alias("volume"),
        F.sum(F.when(trade & (F.col("trade_sign") != 0), F.col("volume") * F.col("trade_sign"))).alias("volume_delta"),
        F.min_by("oi", oi_order).alias("oi_open"),
        F.max("oi").alias("oi_high"),
        F.min("oi").alias("oi_low"),
        F.max_by("oi", oi_order).alias("oi_close"),
        F.count_if(trade).alias("trade_count"),
    ]


def build_bars(ticks: DataFrame, interval_s: int = 60, time_col: str = "event_time", zero_price_fill: bool = False) -> DataFrame:
    """Bars of (security_id, bucket): prices, volume, signed volume, open interest, trades; revision 0.

    ticks: security_id, time_col, seq, price, volume, trade_sign, oi. Rows without a time are dropped. A tick without a
    price adds open interest alone, unless zero_price_fill makes it a trade at 0. Ties on time are broken by seq. One
    shuffle on (security_id, bucket), after a partial aggregation in each task.
    """
    price = F.coalesce("price", F.lit(0.0)) if zero_price_fill else F.col("price")
    ticks = ticks.filter(F.col(time_col).isNotNull()).withColumn("price", price)
    return (
        ticks.groupBy("security_id", bucket_start(F.col(time_col), interval_s).alias("event_time"))
        .agg(*bar_aggregates(time_col))
        .withColumn("revision", F.lit(0))
        .withColumn("is_corrected", F.lit(False))
        .withColumn("correction_of", F.lit(None).cast("timestamp"))
    )


def roll_up(bars: DataFrame, interval_s: int) -> DataFrame:
    """Longer bars from shorter ones of a length that divides interval_s."""
    oi_time = F.when(F.col("oi_open").isNotNull(), F.col("event_time"))
    price_time = F.when(F.col("open").isNotNull(), F.col("event_time"))
    return bars.groupBy("security_id", bucket_start(F.col("event_time"), interval_s).alias("bucket")).agg(
        F.min_by("open", price_time).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", price_time).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("volume_delta").alias("volume_delta"),
        F.min_by("oi_open", oi_time).alias("oi_open"),
        F.max("oi_high").alias("oi_high"),
        F.min("oi_low").alias("oi_low"),
        F.max_by("oi_close", oi_time).alias("oi_close"),
        F.sum("trade_count").alias("trade_count"),
    ).withColumnRenamed("bucket", "event_time")


def merge_bar_revisions(bars: DataFrame, partials: DataFrame, arrival: str | None = None) -> DataFrame:
    """Fold later partial bars, in the order of arrival, into the closed bars: one row for each key.

    Each partial corrects what is there: the lesser open, the outer high and low, the partial's close, summed volumes and
    counts; open interest keeps its old open, takes the outer high and low, and the partial's close if it has one; the
    revision goes up by one. Without a closed bar the first partial becomes one. These rules are sums, extremes, and the
    first or last in order, so any number of partials folds in one aggregation, which begins in each task. arrival: a
    column of partials whose values differ within a key; without it a second partial of a key raises.
    """
    keys = ["security_id", "event_time"]
    kept = [*keys, "open", "high", "low", "close", "volume", "volume_delta", "oi_open", "oi_high", "oi_low", "oi_close", "trade_count"]
    closed = bars.select(*kept, F.col("revision").alias("_revision"), F.lit(0).alias("_late"), F.lit(None).alias("_arrival"))
    late = partials.select(*kept, F.lit(None).cast("int").alias("_revision"), F.lit(1).alias("_late"), (F.col(arrival) if arrival else F.lit(None)).alias("_arrival"))
    order = F.struct("_late", "_arrival")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)
    folded = closed.unionByName(late).groupBy(*keys).agg(
        F.min("open").alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last("close"), F.sum("volume").alias("volume"), F.sum("volume_delta").alias("volume_delta"),
        F.min_by("oi_open", order).alias("oi_open"), F.max("oi_high").alias("oi_high"), F.min("oi_low").alias("oi_low"), last("oi_close"), F.sum("trade_count").alias("trade_count"),
        F.max("_revision").alias("_revision"), F.count("*").alias("_pieces"), F.sum("_late").alias("_lates"),
    )
    if not arrival:
        twice = F.raise_error(F.lit("several partials of a bar need a column that tells in which order they came"))
        folded = folded.withColumn("_pieces", F.when(F.col("_lates") > 1, twice.cast("long")).otherwise(F.col("_pieces")))
    corrected = F.col("_pieces") > 1
    return folded.select(
        *kept,
        (F.coalesce("_revision", F.lit(0)) + F.col("_pieces") - 1).cast("int").alias("revision"),
        corrected.alias("is_corrected"),
        F.when(corrected, F.col("event_time")).alias("correction_of"),
    )


def revision_stats(bars: DataFrame, ticks: DataFrame, as_of: Column, window_s: int = 300) -> DataFrame:
    """One row: bars, corrected bars, revisions, and ticks rejected as late."""
    late = ticks.agg(F.count_if(~_in_time(F.col("event_time"), as_of, window_s, 60)).alias("late_rejected"))
    sums = bars.agg(
        F.count("*").alias("bars"), F.count_if("is_corrected").alias("corrected"), F.sum("revision").cast("long").alias("revisions")
    )
    return sums.join(F.broadcast(late))  # one row each


def _in_time(time: Column, as_of: Column, window_s: int, interval_s: int) -> Column:
    return F.coalesce(F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(bucket_start(time, interval_s)) <= window_s, F.lit(False))


def drop_late(ticks: DataFrame, as_of: Column, window_s: int = 300, interval_s: int = 60) -> DataFrame:
    """Ticks whose bucket started at most window_s before as_of; future ticks pass, ticks without a time do not."""
    return ticks.filter(_in_time(F.col("event_time"), as_of, window_s, interval_s))


def bars_between(bars: DataFrame, security_id: int, start: Column, end: Column) -> DataFrame:
    """Bars of one security in an inclusive range of bar times."""
    return bars.filter((F.col("security_id") == security_id) & F.col("event_time").between(start, end))


def bar_at(bars: DataFrame, asked: DataFrame) -> DataFrame:
    """For each (security_id, at) the newest bar that had begun then; rows without one are left out.

    Bars and questions are ordered together in one window of a security, so nothing is compared pair by pair.
    """
    values = F.struct(*bars.columns)
    both = bars.select("security_id", F.col("event_time").alias("_t"), F.lit(0).alias("_asks"), values.alias("_bar")).unionByName(
        asked.select("security_id", F.col("at").alias("_t"), F.lit(1).alias("_asks")), allowMissingColumns=True
    )
    upto = Window.partitionBy("security_id").orderBy("_t", "_asks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = both.withColumn("_bar", F.last("_bar", ignorenulls=True).over(upto)).filter("_asks = 1 AND _bar IS NOT NULL")
    return found.select(F.col("_t").alias("at"), "_bar.*")


def bar_quality(bars: DataFrame, arrival: str = "arrival") -> DataFrame:
    """For each security: bars, bars not later than the one that arrived before, empty bars, bars whose range does not hold
    open and close. arrival: the column that tells in which order bars came, which differs from row to row."""
    order = Window.partitionBy("security_id").orderBy(arrival)
    flagged = bars.withColumn("before", F.lag("event_time").over(order))
    inside = F.col("open").between(F.col("low"), F.col("high")) & F.col("close").between(F.col("low"), F.col("high"))
    return flagged.groupBy("security_id").agg(
        F.count("*").alias("bars"),
        F.count_if(F.col("event_time") <= F.col("before")).alias("out_of_order"),
        F.count_if(F.col("trade_count") == 0).alias("empty"),
        F.count_if(~inside).alias("outside_range"),
    )
