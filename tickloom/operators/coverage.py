"""Subscriptions, coverage and continuity of a feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def subscription_delta(desired: DataFrame, active: DataFrame) -> DataFrame:
    """Each security of either set: add, remove or keep."""
    d = desired.select("security_id").distinct().withColumn("d", F.lit(True))
    a = active.select("security_id").distinct().withColumn("a", F.lit(True))
    action = F.when(F.col("a").isNull(), "add").when(F.col("d").isNull(), "remove").otherwise("keep")
    return d.join(a, "security_id", "full").select("security_id", action.alias("action"))


def coverage_flags(**sets: DataFrame) -> DataFrame:
    """Each security of any set, with a flag for each set."""
    names = list(sets)
    tagged = None
    for name, df in sets.items():
        some = df.select("security_id", F.lit(name).alias("of"))
        tagged = some if tagged is None else tagged.unionByName(some)
    return tagged.groupBy("security_id").agg(*[F.bool_or(F.col("of") == n).alias(n) for n in names])


def coverage_report(flags: DataFrame, min_critical: int, min_broad: int) -> DataFrame:
    """One row of counts, differences and a verdict from flags desired, sent, seen, critical."""
    d, s, v, c = (F.col(x) for x in ("desired", "sent", "seen", "critical"))
    counts = flags.agg(
        F.count_if(d).alias("desired"),
        F.count_if(s).alias("sent"),
        F.count_if(v).alias("seen"),
        F.count_if(d & ~s).alias("not_sent"),
        F.count_if(s & ~v).alias("not_seen"),
        F.count_if(v & ~d).alias("unwanted"),
        F.count_if(c & v).alias("critical_seen"),
    )
    critical, broad = F.col("critical_seen") >= min_critical, F.col("seen") >= min_broad
    verdict = F.when(critical & broad, "PASS").when(critical, "CONDITIONAL_FAIL").otherwise("CONTINUITY_FAIL")
    return counts.withColumns({"critical_ready": critical, "broad_ready": broad, "verdict": verdict})


def reconcile_three_way(flags: DataFrame) -> DataFrame:
    """Securities on which desired, active and broker differ, and what to do: subscribe, remove, or only report."""
    d, a, b = (F.col(x) for x in ("desired", "active", "broker"))
    issue = F.when(d & ~b, "missing").when(b & ~d, "extra")
    repair = F.when(d & ~b, "subscribe").when(b & ~d & ~a, "unsubscribe").when(b & ~d, "keep")
    return flags.select("security_id", issue.alias("issue"), repair.alias("repair")).filter(F.col("issue").isNotNull())


def subscription_refcount(log: DataFrame) -> DataFrame:
    """Counts of each (security, consumer) after all add and remove events, never below 0 at any time, and the total of
    the security. A floor at 0 after each event is the running sum less the least it has been below 0."""
    order = Window.partitionBy("security_id", "consumer_id").orderBy("seq")
    step = F.when(F.col("op") == "add", 1).otherwise(-1)
    df = log.withColumn("s", F.sum(step).over(order)).withColumn("low", F.least(F.lit(0), F.min("s").over(order)))
    last = df.groupBy("security_id", "consumer_id").agg(F.max_by(F.col("s") - F.col("low"), "seq").alias("refs"))
    whole = Window.partitionBy("security_id")
    return last.withColumn("total", F.sum("refs").over(whole)).withColumn("needed", F.col("total") > 0)


def packet_gaps(packets: DataFrame, start: Column, end: Column, warn_s: int = 60, stall_s: int = 300) -> DataFrame:
    """For each security: longest gap, warnings (over warn_s up to stall_s), stalls, stalled seconds, first and last
    packet, covered seconds and the share of [start, end] that is not stalled."""
    order = Window.partitionBy("security_id").orderBy("ts", "seq")
    gap = (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(order))) / 1e6
    df = packets.withColumn("gap", gap)
    stalled = F.coalesce(F.sum(F.when(F.col("gap") > stall_s, F.col("gap"))), F.lit(0.0))
    whole = (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6
    out = df.groupBy("security_id").agg(
        F.count("*").alias("packets"),
        F.max("gap").alias("longest_gap"),
        F.count_if((F.col("gap") > warn_s) & (F.col("gap") <= stall_s)).alias("warnings"),
        F.count_if(F.col("gap") > stall_s).alias("stalls"),
        stalled.alias("stalled_s"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    )
    covered = (F.unix_micros("last_ts") - F.unix_micros("first_ts")) / 1e6
    return out.withColumn("covered_s", covered).withColumn("coverage_pct", 100 * (covered - F.col("stalled_s")) / whole)


def feed_gaps(packets: DataFrame, bucket_s: int = 3600) -> DataFrame:
    """Gaps between successive packets of the whole feed, without ordering all packets in one task.

    Gaps inside a bucket of time come from a window over the bucket; between buckets, from one row of first and last
    times for each bucket, which alone are ordered globally.
    """
    bucket = F.floor(F.unix_seconds("ts") / bucket_s)
    df = packets.select("ts").withColumn("bucket", bucket)
    inside = df.withColumn("before", F.lag("ts").over(Window.partitionBy("bucket").orderBy("ts"))).filter("before IS NOT NULL")
    ends = df.groupBy("bucket").agg(F.min("ts").alias("ts"), F.max("ts").alias("last"))
    between = ends.withColumn("before", F.lag("last").over(Window.orderBy("bucket"))).filter("before IS NOT NULL")
    gaps = inside.select("before", "ts").unionByName(between.select("before", "ts"))
    return gaps.withColumn("gap_s", (F.unix_micros("ts") - F.unix_micros("before")) / 1e6)


def continuity_verdict(df: DataFrame, stall_s: int = 300) -> DataFrame:
    """Verdict of runs with packets, dropped, quarantined, longest_gap and failures."""
    high = (F.col("quarantined") > 0.5 * F.col("packets")) & (F.col("packets") > 100)
    verdict = (
        F.when(F.col("dropped") > 0, "DROPPED_EVENTS")
        .when(high, "HIGH_QUARANTINE")
        .when(F.col("longest_gap") > stall_s, "CONTINUITY_FAIL")
        .when(F.col("failures") > 0, "PARTIAL_FAIL")
        .otherwise("PASS")
    )
    return df.withColumn("verdict", verdict)


def failure_streak_health(checks: DataFrame, warn: int = 1, degraded: int = 2, blocked: int = 5) -> DataFrame:
    """For each check the length of the run of failures that ends there, and the health it means."""
    order = Window.partitionBy("security_id").orderBy("ts", "seq")
    df = checks.withColumn("island", F.sum(F.when(F.col("healthy"), 1).otherwise(0)).over(order))
    run = Window.partitionBy("security_id", "island").orderBy("ts", "seq")
    df = df.withColumn("streak", F.sum(F.when(F.col("healthy"), 0).otherwise(1)).over(run))
    health = (
        F.when(F.col("streak") >= blocked, "BLOCKED")
        .when(F.col("streak") >= degraded, "DEGRADED")
        .when(F.col("streak") >= warn, "DEGRADED_WARNING")
        .otherwise("HEALTHY")
    )
    return df.drop("island").withColumn("health", health)


def coverage_gaps(df: DataFrame, date_col: str, max_days: int = 1, keys: tuple[str, ...] = ("source",)) -> DataFrame:
    """Ranges of days without data, for each source: first and last missing day."""
    days = df.select(*keys, F.col(date_col).cast("date").alias("day")).distinct()
    after = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    gaps = days.withColumn("after", after).filter(F.datediff("after", "day") > max_days)
    return gaps.select(*keys, F.date_add("day", 1).alias("gap_start"), F.date_sub("after", 1).alias("gap_end"))


def recovery_latency(events: DataFrame) -> DataFrame:
    """For each disconnect: the first packet of the security after it and the seconds that took."""
    order = Window.partitionBy("security_id").orderBy("ts", "seq").rowsBetween(1, Window.unboundedFollowing)
    packet_ts = F.when(F.col("kind") == "packet", F.col("ts"))
    df = events.withColumn("recovered_at", F.min(packet_ts).over(order)).filter("kind = 'disconnect'")
    latency = (F.unix_micros("recovered_at") - F.unix_micros("ts")) / 1e6
    return df.select("security_id", F.col("ts").alias("lost_at"), "recovered_at", latency.alias("latency_s"))


def run_report(snapshots: DataFrame) -> DataFrame:
    """For each run: greatest, first and last value of the gauge, totals, and the result."""
    order = F.struct("ts", "seq")
    out = snapshots.groupBy("run").agg(
        F.max("gauge").alias("most"),
        F.min_by("gauge", order).alias("first"),
        F.max_by("gauge", order).alias("last"),
        F.sum("errors").alias("errors"),
        F.sum("violations").alias("violations"),
    )
    result = F.when(F.col("errors") > 0, "ERROR").when(F.col("violations") > 0, "INVARIANT_FAILURE").otherwise("PASS")
    return out.withColumn("result", result)


def snapshot_invariants(snapshots: DataFrame) -> DataFrame:
    """Each snapshot with the invariants it breaks."""
    active = F.col("phase").isin("STABLE", "FAILED")
    rules = {
        "no_id": F.col("universe_snapshot_id").isNull(),
        "no_contracts": F.coalesce(F.col("contract_count"), F.lit(0)) <= 0,
        "phase_not_terminal": ~active,
        "generations_differ": active & (F.col("active_generation") != F.col("desired_generation")),
        "duplicates_missed": F.col("injected_duplicates") != F.col("detected_duplicates"),
    }
    broken = F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]), lambda x: x.isNotNull())
    return snapshots.withColumn("broken", broken).withColumn("ok", F.size("broken") == 0)
