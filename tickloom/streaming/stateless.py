"""Streams that Spark's own windows, watermarks and deduplication can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from tickloom.operators.bars import bar_aggregates, drop_late
from tickloom.operators.events import OUTCOMES, ready_flags, route_by_status

def stream_bars(ticks: DataFrame, interval: str = "1 minute", lateness: str = "5 minutes") -> DataFrame:
    """Tumbling bars of a stream of ticks; use update mode. Late ticks re-emit their bar until the watermark drops it."""
    bars = ticks.withWatermark("event_time", lateness).groupBy("security_id", F.window("event_time", interval).alias("w")).agg(
        *bar_aggregates(), F.max("event_time").alias("last_tick")
    )
    return bars.select("security_id", F.col("w.start").alias("event_time"), *[c for c in bars.columns if c not in ("security_id", "w")])


def late_events(ticks: DataFrame, as_of: Column, window_s: int = 300, interval_s: int = 60) -> tuple[DataFrame, DataFrame]:
    """Ticks in time, and those too late at as_of (the clock, in a live stream), which another sink takes."""
    kept = drop_late(ticks, as_of, window_s, interval_s)
    seconds = F.unix_seconds("event_time")
    started = seconds - F.pmod(seconds, F.lit(interval_s))
    late = ticks.filter(F.col("event_time").isNull() | (F.unix_seconds(as_of.cast("timestamp")) - started > window_s))
    return kept, late


def counted_late(ticks: DataFrame, as_of: Column, window_s: int = 300, interval_s: int = 60) -> DataFrame:
    """ticks, of which each micro-batch counts as an observed metric (lateness) those in time and those too late at as_of."""
    seconds = F.unix_seconds("event_time")
    kept = F.coalesce(F.unix_seconds(as_of.cast("timestamp")) - (seconds - F.pmod(seconds, F.lit(interval_s))) <= window_s, F.lit(False))
    return ticks.observe("lateness", F.count_if(kept).alias("kept"), F.count_if(~kept).alias("late"))


def observed(query, name: str) -> list[dict]:
    """What the latest micro-batches of a query observed under a name, a dict for each."""
    return [p.observedMetrics[name].asDict() for p in query.recentProgress if name in p.observedMetrics]


def stream_dedup(events: DataFrame, time_col: str = "event_time", horizon: str = "1 hour") -> DataFrame:
    """One row for each event_id that comes again within the horizon; older repeats are left to a check of the history."""
    return events.withWatermark(time_col, horizon).dropDuplicatesWithinWatermark(["event_id"])


def stream_readiness(packets: DataFrame) -> DataFrame:
    """For each contract the flags of its latest packet, first and last time and packets; use update mode."""
    order = F.struct("ts", "seq")
    return ready_flags(packets).groupBy("contract_id").agg(
        F.max_by("quote_ready", order).alias("quote_ready"), F.max_by("full_ready", order).alias("full_ready"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count("*").alias("packet_count"),
    )


def route_batch(kept_path: str, quarantine_path: str):
    """A foreachBatch function that routes events by status; a batch that is run again overwrites its own folder, so each
    event is written once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        kept, failed = route_by_status(batch)
        kept.write.mode("overwrite").parquet(f"{kept_path}/batch={batch_id}")
        failed.write.mode("overwrite").parquet(f"{quarantine_path}/batch={batch_id}")
        batch.unpersist()

    return run


def counted_route(events: DataFrame, time_col: str = "event_time", horizon: str = "1 hour") -> DataFrame:
    """stream_dedup of events, which counts what comes in (received) and what route_batch will keep (persisted) or not
    (quarantined) as observed metrics of each micro-batch."""
    ok = F.coalesce((F.col("decode_status") == "success") & F.col("decoded_payload").isNotNull(), F.lit(False))
    once = stream_dedup(events.observe("came", F.count("*").alias("received")), time_col, horizon)
    return once.observe("went", F.count_if(ok).alias("persisted"), F.count_if(~ok).alias("quarantined"))


def batch_counters(progress) -> dict[str, int]:
    """Counters of one micro-batch of counted_route from its progress; dropped: repeats that the state turned away."""
    seen = {k: v or 0 for row in progress.observedMetrics.values() for k, v in row.asDict().items()}
    dropped = sum(int(s.customMetrics.get("numDroppedDuplicateRows", 0)) for s in progress.stateOperators)
    return {"batch": progress.batchId} | {c: seen.get(c, 0) for c in ("received", "persisted", "quarantined")} | {"queued": 0, "spooled": 0, "dropped": dropped}


class RouteCounters(StreamingQueryListener):
    """Sums of batch_counters over all micro-batches of a running query, for a session's listeners; balanced says whether all
    that was received is accounted for."""

    def __init__(self):
        self.batches, self.sums = 0, dict.fromkeys(("received", *OUTCOMES), 0)

    @property
    def balanced(self) -> bool:
        return self.sums["received"] == sum(self.sums[o] for o in OUTCOMES)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.batches += 1
        for name, n in batch_counters(event.progress).items():
            if name in self.sums:
                self.sums[name] += n

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def late_batch(kept_path: str, late_path: str, as_of: Column, window_s: int = 300, interval_s: int = 60):
    """A foreachBatch function that writes ticks in time to one table and late ones to another; a batch that is run again
    overwrites its own folder."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for rows, path in zip(late_events(batch, as_of, window_s, interval_s), (kept_path, late_path)):
            rows.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        batch.unpersist()

    return run


def _slices(ready: DataFrame, key: Column, at_once: int) -> list[list[str]]:
    """The files of ready, which follow each other in time, put together as long as no key has over at_once rows."""
    file = F.col("_metadata.file_path").alias("_file")
    busiest = ready.select(file, key.alias("_key")).groupBy("_file", "_key").count().groupBy("_file").agg(F.max("count").alias("n"))
    slices, held = [], at_once
    for row in sorted(busiest.collect()):  # a row for each file; names follow the ranges
        if held + row["n"] > at_once:
            slices.append([])
            held = 0
        slices[-1].append(row["_file"])
        held += row["n"]
    return slices


def replay(rows: DataFrame, base: str, build, run, key: Column, at_once: int = 1_000_000, time_col: str = "event_time") -> DataFrame:
    """Feed rows to a stream in the order of time, in slices that hold about at_once rows of each of its keys (key) at most, and
    return the stream; rows without a time are left out.

    build makes the stream of the rows' stream, run(stream, checkpoint) runs it over what is there and stops. State goes
    from one run to the next by the checkpoint, so no task holds more of a key than at_once rows (and those of one moment)
    have. A run costs each key it meets some milliseconds, so slices are as few as that allows: more keys don't make more
    slices. Only names of files and a number for each pass through the driver.
    """
    spark, timed = rows.sparkSession, rows.filter(F.col(time_col).isNotNull())
    parts = max(1, -(-timed.count() // at_once))
    timed.repartitionByRange(parts, time_col).write.parquet(f"{base}/slices")
    ready = spark.read.schema(rows.schema).parquet(f"{base}/slices")
    timed.limit(0).write.parquet(f"{base}/in")
    stream = build(spark.readStream.schema(rows.schema).parquet(f"{base}/in"))
    for files in _slices(ready, key, at_once):
        spark.read.schema(rows.schema).parquet(*files).write.mode("append").parquet(f"{base}/in")
        run(stream, f"{base}/checkpoint")
    return stream


def replay_difference(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row: the rows of two replays, and how many of either have no equal in the other, repeats counted."""
    sides = [df.select(*first.columns).withColumns({"_first": F.lit(int(k == 0)), "_second": F.lit(k)}) for k, df in enumerate((first, second))]
    per = sides[0].unionByName(sides[1]).groupBy(*first.columns).agg(F.sum("_first").alias("a"), F.sum("_second").alias("b"))
    alone = lambda x, y: F.coalesce(F.sum(F.greatest(F.col(x) - F.col(y), F.lit(0))), F.lit(0))
    total = lambda x: F.coalesce(F.sum(x), F.lit(0))
    return per.agg(total("a").alias("first_rows"), total("b").alias("second_rows"), alone("a", "b").alias("first_alone"), alone("b", "a").alias("second_alone"))


def run_to_end(stream: DataFrame, checkpoint: str, mode: str = "append", path: str | None = None, each=None):
    """Run a stream over what is there now and stop: the same captured data gives the same result again."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(each).start() if each else writer.format("parquet").start(path)
    query.awaitTermination()
    return query
