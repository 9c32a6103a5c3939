"""Registered queries over packets, readiness, coverage and continuity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import coverage as C
from tickloom.operators import events as E
from tickloom.plans.views import TICKS_SQL, naive, ticks
from tickloom.session import table

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def packets(spark, sf_dir) -> DataFrame:
    """Each event as a packet of a feed; those with volume divisible by 10 failed to decode."""
    t = ticks(spark, sf_dir)
    cents = F.col("volume") % 3
    return t.select(
        "security_id",
        F.concat(F.lit("c"), F.col("security_id").cast("string")).alias("contract_id"),
        F.concat(F.lit("line"), (F.col("security_id") % 4).cast("string")).alias("connection_id"),
        F.col("seq").alias("message_id"),
        cents.alias("packet_offset"),
        "seq",
        F.col("event_time").alias("ts"),
        F.concat_ws(":", "event_type", F.col("volume").cast("string")).alias("payload"),
        F.when(F.col("volume") % 10 == 0, "failed").when(F.col("volume") % 25 == 1, "").otherwise("success").alias("decode_status"),
        F.when(F.col("event_type") != "view", F.col("price")).alias("ltp"),
        F.unix_seconds("event_time").alias("last_trade_time"),
        F.col("volume").alias("last_trade_volume"),
        (F.col("price") - cents).alias("bid"),
        F.col("price").alias("ask"),
        F.array_repeat(F.lit(1), (F.col("volume") % 4).cast("int")).alias("bids"),
        (F.col("volume") % 2).cast("int").alias("generation"),
        F.when(F.col("volume") % 7 != 0, F.lit(2)).alias("response_code"),
        F.when(F.col("volume") % 13 == 0, "bad").alias("error"),
        (F.col("security_id") % 10).cast("string").alias("underlying"),
    )


PACKETS_SQL = f"""{TICKS_SQL}, packets AS (
    SELECT security_id, 'c' || security_id AS contract_id, 'line' || (security_id % 4) AS connection_id, seq AS message_id,
        volume % 3 AS packet_offset, seq, event_time AS ts, event_type || ':' || volume AS payload,
        CASE WHEN volume % 10 = 0 THEN 'failed' WHEN volume % 25 = 1 THEN '' ELSE 'success' END AS decode_status,
        CASE WHEN event_type <> 'view' THEN price END AS ltp, epoch_us(event_time) // 1000000 AS last_trade_time,
        volume AS last_trade_volume, price - volume % 3 AS bid, price AS ask, volume % 4 AS depth, (volume % 2)::INT AS generation,
        CASE WHEN volume % 7 <> 0 THEN 2 END AS response_code, CASE WHEN volume % 13 = 0 THEN 'bad' END AS error,
        (security_id % 10)::VARCHAR AS underlying
    FROM ticks
), ids AS (
    SELECT *, sha256(connection_id || message_id || packet_offset || sha256(payload)) AS event_id FROM packets
)"""


def identified(spark, sf_dir) -> DataFrame:
    p = packets(spark, sf_dir)
    return E.event_id(p.withColumn("payload_hash", F.sha2(F.col("payload").cast("binary"), 256)))


@query("event_ids", f"WITH {PACKETS_SQL} SELECT seq, event_id FROM ids")
def event_ids(spark, sf_dir):
    return identified(spark, sf_dir).select("seq", "event_id")


@query("dedup_events", f"WITH {PACKETS_SQL} SELECT event_id, seq FROM ids")
def dedup_events(spark, sf_dir):
    """Every third event comes twice; one of each is left."""
    p = identified(spark, sf_dir).select("event_id", "seq")
    return E.drop_duplicate_events(p.unionByName(p.filter("seq % 3 = 0")))


@query("dedup_history", f"WITH {PACKETS_SQL} SELECT event_id, seq FROM ids WHERE seq % 4 <> 0")
def dedup_history(spark, sf_dir):
    p = identified(spark, sf_dir).select("event_id", "seq")
    return E.dedup_against(p, p.filter("seq % 4 = 0"))


_ROUTED = "decode_status = 'success'"


@query(
    "route_status",
    f"WITH {PACKETS_SQL} SELECT event_id, CASE WHEN {_ROUTED} THEN 'bronze' ELSE 'quarantine' END AS sink FROM ids",
)
def route_status(spark, sf_dir):
    kept, failed = E.route_by_status(identified(spark, sf_dir).withColumn("decoded_payload", F.col("payload")))
    return kept.select("event_id", F.lit("bronze").alias("sink")).unionByName(failed.select("event_id", F.lit("quarantine").alias("sink")))


@query(
    "conservation",
    f"""WITH {PACKETS_SQL}, o AS (SELECT CASE WHEN NOT ({_ROUTED}) THEN 'quarantined' WHEN seq % 20 = 0 THEN 'spooled' WHEN seq % 20 = 1 THEN 'queued' WHEN seq % 20 = 2 THEN 'dropped'
        WHEN seq % 20 = 3 AND security_id % 7 = 0 THEN 'lost' ELSE 'persisted' END AS outcome FROM ids),
    c AS (SELECT count(*) AS received, count_if(outcome = 'persisted')::BIGINT AS persisted, count_if(outcome = 'quarantined')::BIGINT AS quarantined,
        count_if(outcome = 'queued')::BIGINT AS queued, count_if(outcome = 'spooled')::BIGINT AS spooled, count_if(outcome = 'dropped')::BIGINT AS dropped FROM o)
    SELECT *, received = persisted + quarantined + queued + spooled + dropped AS balanced FROM c""",
)
def conservation(spark, sf_dir):
    """Some packets get no outcome that is known, so what was received does not balance."""
    nth = F.col("seq") % 20
    outcome = F.when(F.col("decode_status") != "success", "quarantined").when(nth == 0, "spooled").when(nth == 1, "queued").when(nth == 2, "dropped")
    outcome = outcome.when((nth == 3) & (F.col("security_id") % 7 == 0), "lost").otherwise("persisted")
    return E.conservation_check(packets(spark, sf_dir).withColumn("outcome", outcome))


_FLAGS = f"""{PACKETS_SQL}, flags AS (
    SELECT *, coalesce(ltp > 0, false) AS valid_ltp, last_trade_time > 0 AS valid_time, last_trade_volume > 0 AS valid_volume,
        bid > 0 AND bid <= ask AS valid_spread, depth >= 1 AS valid_depth FROM packets
), ready AS (
    SELECT *, valid_ltp AND valid_time AS quote_ready, valid_ltp AND valid_time AND valid_spread AND valid_depth AS full_ready FROM flags
), latest AS (
    SELECT contract_id, arg_max(quote_ready, (ts, seq)) AS quote_ready, arg_max(full_ready, (ts, seq)) AS full_ready,
        min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS packet_count FROM ready GROUP BY 1
)"""


@query(
    "ready_flags",
    f"WITH {_FLAGS} SELECT seq, valid_ltp, valid_time, valid_volume, valid_spread, valid_depth, quote_ready, full_ready FROM ready",
)
def ready_flags(spark, sf_dir):
    names = ["valid_ltp", "valid_time", "valid_volume", "valid_spread", "valid_depth", "quote_ready", "full_ready"]
    return E.ready_flags(packets(spark, sf_dir)).select("seq", *names)


@query("latest_readiness", f"WITH {_FLAGS} SELECT * FROM latest")
def latest_readiness(spark, sf_dir):
    return naive(E.latest_flags(packets(spark, sf_dir)), "first_ts", "last_ts")


def _contracts(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("contract_id"), F.col("c_custkey").alias("security_id"))


@query(
    "ready_level",
    f"""WITH {_FLAGS} SELECT count(*) AS contracts, count_if(coalesce(quote_ready, false))::BIGINT AS ready,
    count_if(coalesce(quote_ready, false)) >= 0.5 * count(*) AS enough
    FROM (SELECT 'c' || c_custkey AS contract_id FROM customer) LEFT JOIN latest USING (contract_id)""",
)
def ready_level(spark, sf_dir):
    return E.readiness_level(E.latest_flags(packets(spark, sf_dir)), _contracts(spark, sf_dir), min_ratio=0.5)


@query(
    "pair_ready",
    f"""WITH {_FLAGS}, legs AS (
        SELECT contract_id, underlying, (security_id // 20) AS strike, CASE WHEN security_id // 10 % 2 = 0 THEN 'CE' ELSE 'PE' END AS option_type
        FROM (SELECT DISTINCT security_id, contract_id, underlying FROM packets))
    SELECT underlying, strike, count(DISTINCT option_type) = 2 AND bool_and(coalesce(quote_ready, false)) AS pair_ready
    FROM legs LEFT JOIN latest USING (contract_id) GROUP BY ALL""",
)
def pair_ready(spark, sf_dir):
    p = packets(spark, sf_dir)
    legs = p.select("security_id", "contract_id", "underlying").distinct()
    leg = F.when(F.floor(F.col("security_id") / 10) % 2 == 0, "CE").otherwise("PE")
    legs = legs.select("contract_id", "underlying", F.floor(F.col("security_id") / 20).alias("strike"), leg.alias("option_type"))
    return E.contract_pair_ready(E.latest_flags(p), legs)


@query(
    "warm_recent",
    f"""WITH {_FLAGS} SELECT contract_id, packet_count, last_ts, epoch_us(TIMESTAMP '2024-01-31') - epoch_us(last_ts) <= 86400000000 AS recent
    FROM latest WHERE packet_count >= 3""",
)
def warm_recent(spark, sf_dir):
    found = E.warm_recent(E.latest_flags(packets(spark, sf_dir)), F.lit("2024-01-31"), max_age_s=86_400)
    return naive(found.select("contract_id", "packet_count", "last_ts", "recent"), "last_ts")


@query("unregistered", f"WITH {PACKETS_SQL} SELECT contract_id, count(*) AS packets FROM packets WHERE security_id NOT IN (SELECT s_suppkey FROM supplier) GROUP BY 1")
def unregistered(spark, sf_dir):
    known = table(spark, sf_dir, "supplier").select(F.concat(F.lit("c"), F.col("s_suppkey").cast("string")).alias("contract_id"))
    return E.unregistered_packets(packets(spark, sf_dir), known)


@query(
    "stale_generation",
    f"""WITH {PACKETS_SQL}, g AS (SELECT underlying, arg_max(generation, (ts, seq)) AS generation FROM packets GROUP BY 1)
    SELECT seq, underlying, generation FROM packets SEMI JOIN g USING (underlying, generation)""",
)
def stale_generation(spark, sf_dir):
    p = packets(spark, sf_dir)
    current = p.groupBy("underlying").agg(F.max_by("generation", F.struct("ts", "seq")).alias("generation"))
    return E.drop_stale_generation(p, current).select("seq", "underlying", "generation")


@query(
    "countable",
    f"WITH {PACKETS_SQL} SELECT seq, security_id FROM packets WHERE response_code IS NOT NULL AND error IS NULL AND security_id IN (SELECT s_suppkey FROM supplier)",
)
def countable(spark, sf_dir):
    wanted = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("security_id"))
    return E.countable_packets(packets(spark, sf_dir), wanted).select("seq", "security_id")


@query(
    "labelled_packets",
    f"WITH {PACKETS_SQL} SELECT seq, coalesce(c_name, 'c' || security_id) AS contract_id FROM packets LEFT JOIN customer ON c_custkey = security_id AND c_custkey % 2 = 0",
)
def labelled_packets(spark, sf_dir):
    names = table(spark, sf_dir, "customer").filter("c_custkey % 2 = 0").select(F.col("c_custkey").alias("security_id"), F.col("c_name").alias("contract_id"))
    return E.label_contracts(packets(spark, sf_dir).drop("contract_id"), names).select("seq", "contract_id")


# -- sets of ids ------------------------------------------------------------------------------------------------------


def _sets(spark, sf_dir) -> dict[str, DataFrame]:
    item = table(spark, sf_dir, "lineitem")
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("security_id"), "s_nationkey")
    return {
        "desired": supplier.filter("security_id % 5 <> 0").select("security_id"),
        "sent": item.filter("l_returnflag = 'A' AND l_suppkey % 7 <> 0").select(F.col("l_suppkey").alias("security_id")),
        "seen": item.filter("l_returnflag = 'R' AND l_suppkey % 3 <> 0").select(F.col("l_suppkey").alias("security_id")),
        "critical": supplier.filter("s_nationkey < 3").select("security_id"),
    }


_SETS = """sets AS (
    SELECT s_suppkey AS security_id, 'desired' AS of FROM supplier WHERE s_suppkey % 5 <> 0
    UNION ALL SELECT l_suppkey, 'sent' FROM lineitem WHERE l_returnflag = 'A' AND l_suppkey % 7 <> 0
    UNION ALL SELECT l_suppkey, 'seen' FROM lineitem WHERE l_returnflag = 'R' AND l_suppkey % 3 <> 0
    UNION ALL SELECT s_suppkey, 'critical' FROM supplier WHERE s_nationkey < 3
), flags AS (
    SELECT security_id, bool_or(of = 'desired') AS desired, bool_or(of = 'sent') AS sent, bool_or(of = 'seen') AS seen,
        bool_or(of = 'critical') AS critical FROM sets GROUP BY 1
)"""


@query(
    "sub_delta",
    f"""WITH {_SETS} SELECT security_id, CASE WHEN NOT sent THEN 'add' WHEN NOT desired THEN 'remove' ELSE 'keep' END AS action
    FROM flags WHERE desired OR sent""",
)
def sub_delta(spark, sf_dir):
    s = _sets(spark, sf_dir)
    return C.subscription_delta(s["desired"], s["sent"])


@query(
    "coverage",
    f"""WITH {_SETS}, c AS (SELECT count_if(desired)::BIGINT AS desired, count_if(sent)::BIGINT AS sent, count_if(seen)::BIGINT AS seen,
        count_if(desired AND NOT sent)::BIGINT AS not_sent, count_if(sent AND NOT seen)::BIGINT AS not_seen,
        count_if(seen AND NOT desired)::BIGINT AS unwanted, count_if(critical AND seen)::BIGINT AS critical_seen FROM flags)
    SELECT *, critical_seen >= 4 AS critical_ready, seen >= 30 AS broad_ready, CASE WHEN critical_seen >= 4 AND seen >= 30 THEN 'PASS'
        WHEN critical_seen >= 4 THEN 'CONDITIONAL_FAIL' ELSE 'CONTINUITY_FAIL' END AS verdict FROM c""",
)
def coverage(spark, sf_dir):
    return C.coverage_report(C.coverage_flags(**_sets(spark, sf_dir)), 4, 30)


@query(
    "reconcile3",
    f"""WITH {_SETS} SELECT security_id, CASE WHEN desired AND NOT seen THEN 'missing' ELSE 'extra' END AS issue,
        CASE WHEN desired AND NOT seen THEN 'subscribe' WHEN NOT sent THEN 'unsubscribe' ELSE 'keep' END AS repair
    FROM flags WHERE desired <> seen""",
)
def reconcile3(spark, sf_dir):
    s = _sets(spark, sf_dir)
    return C.reconcile_three_way(C.coverage_flags(desired=s["desired"], active=s["sent"], broker=s["seen"], critical=s["critical"]))


@query(
    "refcounts",
    f"""WITH {TICKS_SQL}, l AS (
        SELECT security_id, 'u' || (seq % 3) AS consumer_id, seq, CASE WHEN event_type IN ('click', 'view', 'purchase') THEN 1 ELSE -1 END AS step
        FROM ticks), s AS (SELECT *, sum(step) OVER w AS s FROM l WINDOW w AS (PARTITION BY security_id, consumer_id ORDER BY seq)),
    m AS (SELECT *, least(0, min(s) OVER (PARTITION BY security_id, consumer_id ORDER BY seq)) AS low FROM s),
    r AS (SELECT security_id, consumer_id, arg_max(s - low, seq)::BIGINT AS refs FROM m GROUP BY ALL)
    SELECT *, (sum(refs) OVER (PARTITION BY security_id))::BIGINT AS total, sum(refs) OVER (PARTITION BY security_id) > 0 AS needed FROM r""",
)
def refcounts(spark, sf_dir):
    op = F.when(F.col("event_type").isin("click", "view", "purchase"), "add").otherwise("remove")
    log = ticks(spark, sf_dir).select("security_id", F.concat(F.lit("u"), (F.col("seq") % 3).cast("string")).alias("consumer_id"), op.alias("op"), "seq")
    return C.subscription_refcount(log)


_DAY_GAPS = f"""{PACKETS_SQL}, g AS (
    SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY security_id ORDER BY ts, seq))) / 1e6 AS gap FROM packets
), gaps AS (
    SELECT security_id, count(*) AS packets, round(max(gap), 3) AS longest_gap,
        count_if(gap > 3600 AND gap <= 43200)::BIGINT AS warnings, count_if(gap > 43200)::BIGINT AS stalls,
        round(coalesce(sum(gap) FILTER (gap > 43200), 0), 3) AS stalled_s, min(ts) AS first_ts, max(ts) AS last_ts,
        round((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6, 3) AS covered_s,
        round(100 * ((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 - coalesce(sum(gap) FILTER (gap > 43200), 0)) / 2592000, 6) AS coverage_pct
    FROM g GROUP BY 1
)"""


def _gaps(spark, sf_dir) -> DataFrame:
    found = C.packet_gaps(packets(spark, sf_dir), F.lit("2024-01-01"), F.lit("2024-01-31"), 3600, 43_200)
    return found.withColumns({c: F.round(c, 3) for c in ("longest_gap", "stalled_s", "covered_s")}).withColumn("coverage_pct", F.round("coverage_pct", 6))


@query("packet_gaps", f"WITH {_DAY_GAPS} SELECT * FROM gaps")
def packet_gaps(spark, sf_dir):
    return naive(_gaps(spark, sf_dir), "first_ts", "last_ts")


@query(
    "feed_gaps",
    f"""WITH {TICKS_SQL}, g AS (SELECT event_time AS ts, lag(event_time) OVER (ORDER BY event_time) AS before FROM ticks)
    SELECT ts, before, round((epoch_us(ts) - epoch_us(before)) / 1e6, 3) AS gap_s FROM g WHERE (epoch_us(ts) - epoch_us(before)) / 1e6 > 600""",
)
def feed_gaps(spark, sf_dir):
    found = C.feed_gaps(packets(spark, sf_dir)).filter("gap_s > 600").withColumn("gap_s", F.round("gap_s", 3))
    return naive(found, "ts", "before")


@query(
    "continuity",
    f"""WITH {_DAY_GAPS}, c AS (
        SELECT security_id, count(*) AS packets, count_if(error IS NOT NULL AND seq % 50 = 0)::BIGINT AS dropped,
            count_if(decode_status <> 'success')::BIGINT AS quarantined, count_if(response_code IS NULL)::BIGINT AS failures FROM packets GROUP BY 1)
    SELECT c.*, longest_gap, CASE WHEN dropped > 0 THEN 'DROPPED_EVENTS' WHEN quarantined > 0.5 * c.packets AND c.packets > 100 THEN 'HIGH_QUARANTINE'
        WHEN longest_gap > 86400 THEN 'CONTINUITY_FAIL' WHEN failures > 0 THEN 'PARTIAL_FAIL' ELSE 'PASS' END AS verdict
    FROM c JOIN gaps USING (security_id)""",
)
def continuity(spark, sf_dir):
    counts = packets(spark, sf_dir).groupBy("security_id").agg(
        F.count("*").alias("packets"),
        F.count_if(F.col("error").isNotNull() & (F.col("seq") % 50 == 0)).alias("dropped"),
        F.count_if(F.col("decode_status") != "success").alias("quarantined"),
        F.count_if(F.col("response_code").isNull()).alias("failures"),
    )
    joined = counts.join(_gaps(spark, sf_dir).select("security_id", "longest_gap"), "security_id")
    return C.continuity_verdict(joined, 86_400)


@query(
    "failure_streak",
    f"""WITH {PACKETS_SQL}, i AS (
        SELECT security_id, seq, ts, error IS NULL AND response_code IS NOT NULL AS healthy FROM packets),
    j AS (SELECT *, sum(healthy::INT) OVER (PARTITION BY security_id ORDER BY ts, seq) AS island FROM i),
    s AS (SELECT *, (sum((NOT healthy)::INT) OVER (PARTITION BY security_id, island ORDER BY ts, seq))::BIGINT AS streak FROM j)
    SELECT security_id, seq, healthy, streak, CASE WHEN streak >= 5 THEN 'BLOCKED' WHEN streak >= 2 THEN 'DEGRADED'
        WHEN streak >= 1 THEN 'DEGRADED_WARNING' ELSE 'HEALTHY' END AS health FROM s""",
)
def failure_streak(spark, sf_dir):
    healthy = F.col("error").isNull() & F.col("response_code").isNotNull()
    checks = packets(spark, sf_dir).select("security_id", "seq", "ts", healthy.alias("healthy"))
    return C.failure_streak_health(checks).drop("ts")


@query(
    "coverage_gaps",
    """WITH d AS (SELECT DISTINCT user_id AS security_id, ts::DATE AS day FROM events),
    g AS (SELECT *, lead(day) OVER (PARTITION BY security_id ORDER BY day) AS after FROM d)
    SELECT security_id, (day + 1)::DATE AS gap_start, (after - 1)::DATE AS gap_end FROM g WHERE after - day > 1""",
)
def coverage_gaps(spark, sf_dir):
    return C.coverage_gaps(packets(spark, sf_dir), "ts", keys=("security_id",))


@query(
    "recovery_latency",
    f"""WITH {PACKETS_SQL}, r AS (
        SELECT security_id, ts, error, min(CASE WHEN error IS NULL THEN ts END) OVER (PARTITION BY security_id ORDER BY ts, seq
            ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS recovered_at FROM packets)
    SELECT security_id, ts AS lost_at, recovered_at, round((epoch_us(recovered_at) - epoch_us(ts)) / 1e6, 3) AS latency_s FROM r WHERE error IS NOT NULL""",
)
def recovery_latency(spark, sf_dir):
    kind = F.when(F.col("error").isNull(), "packet").otherwise("disconnect")
    found = C.recovery_latency(packets(spark, sf_dir).withColumn("kind", kind)).withColumn("latency_s", F.round("latency_s", 3))
    return naive(found, "lost_at", "recovered_at")


@query(
    "run_report",
    f"""WITH {PACKETS_SQL} SELECT underlying AS run, max(ask) AS most, arg_min(ask, (ts, seq)) AS first, arg_max(ask, (ts, seq)) AS last,
        sum((error IS NOT NULL)::INT)::BIGINT AS errors, sum((response_code IS NULL)::INT)::BIGINT AS violations,
        CASE WHEN sum((error IS NOT NULL)::INT) > 0 THEN 'ERROR' WHEN sum((response_code IS NULL)::INT) > 0 THEN 'INVARIANT_FAILURE' ELSE 'PASS' END AS result
    FROM packets GROUP BY 1""",
)
def run_report(spark, sf_dir):
    p = packets(spark, sf_dir)
    return C.run_report(
        p.select(
            F.col("underlying").alias("run"), "ts", "seq", F.col("ask").alias("gauge"),
            F.col("error").isNotNull().cast("int").alias("errors"), F.col("response_code").isNull().cast("int").alias("violations"),
        )
    )
