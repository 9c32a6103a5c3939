"""Registered queries that run streams over the given tables to their end."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.operators.events import OUTCOMES
from tickloom.plans.feed import ORACLES as ORACLES_FEED
from tickloom.plans.feed import PACKETS_SQL, _sets, identified, packets
from tickloom.plans.market import _FEATURES
from tickloom.plans.views import AS_OF, DAILY_SQL, DAY, TICKS_SQL, daily_bars, naive, ticks
from tickloom.session import shared_dir, written
from tickloom.sources.frames import decode_frames
from tickloom.streaming import keyed, stateful, stateless

QUERIES, ORACLES = {}, {}
#: Rows of a key that a run of a replayed stream takes.
AT_ONCE = 1_000_000


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _as_stream(df: DataFrame, name: str) -> DataFrame:
    """The rows of df as a stream of files."""
    path = written(df, name).inputFiles()[0].rpartition("/")[0]
    return df.sparkSession.readStream.schema(df.schema).parquet(path)


def _result(stream: DataFrame, name: str, mode: str = "append", keys: list[str] = ()) -> DataFrame:
    """What the stream leaves: all rows in append mode, the last row of each key in update mode."""
    spark, base = stream.sparkSession, f"{shared_dir(stream.sparkSession)}/tickloom/{name}-{uuid.uuid4().hex}"
    schema = stream.schema
    if mode == "append":
        stateless.run_to_end(stream, f"{base}/checkpoint", "append", f"{base}/out")
    else:
        def each(batch: DataFrame, batch_id: int) -> None:
            batch.write.mode("overwrite").parquet(f"{base}/out/batch={batch_id}")

        stateless.run_to_end(stream, f"{base}/checkpoint", mode, each=each)
        last = Window.partitionBy(*keys).orderBy(F.desc("batch"))
        rows = spark.read.schema(schema.add("batch", "long")).parquet(f"{base}/out")
        return rows.withColumn("nth", F.row_number().over(last)).filter("nth = 1").drop("nth", "batch")
    return spark.read.schema(schema).parquet(f"{base}/out")


def _replayed(rows: DataFrame, name: str, build, key: Column, at_once: int = AT_ONCE) -> DataFrame:
    """What the stream that build makes leaves in append mode, fed in the order of time; it is keyed by key."""
    spark, base = rows.sparkSession, f"{shared_dir(rows.sparkSession)}/tickloom/{name}-{uuid.uuid4().hex}"
    stream = stateless.replay(rows, base, build, lambda s, checkpoint: stateless.run_to_end(s, checkpoint, "append", f"{base}/out"), key, at_once)
    return spark.read.schema(stream.schema).parquet(f"{base}/out")


def _stateful(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


@query("stream_bars", f"WITH {DAILY_SQL} SELECT * FROM bars")
def stream_bars(spark, sf_dir):
    """Bars of one day each, as the stream of all ticks leaves them."""
    stream = _as_stream(ticks(spark, sf_dir), "ticks")
    bars = _result(stateless.stream_bars(stream, "1 day", "60 days"), "bars", "update", ["security_id", "event_time"])
    return naive(bars.drop("last_tick"), "event_time")


@query(
    "stream_bars_revised",
    f"""WITH {DAILY_SQL}, first AS (SELECT security_id, date_trunc('day', event_time)::TIMESTAMP AS day, bool_or(seq % 10 <> 0) AS known, bool_or(seq % 10 = 0) AS more
            FROM ticks GROUP BY ALL),
        seen AS (SELECT max(event_time) AS seen FROM ticks WHERE seq % 10 <> 0),
        flagged AS (SELECT security_id, day, known AND more AND day + INTERVAL 1 DAY <= seen AS late FROM first, seen)
        SELECT bars.*, late::INT AS revision, late AS is_corrected, CASE WHEN late THEN event_time END AS correction_of
        FROM bars JOIN flagged ON bars.security_id = flagged.security_id AND event_time = day""",
)
def stream_bars_revised(spark, sf_dir):
    """Bars of one day; every tenth tick comes after all others, so that bars whose day was over are corrected."""
    _stateful(spark)
    base, rows = f"{shared_dir(spark)}/tickloom/revised-{uuid.uuid4().hex}", ticks(spark, sf_dir)
    stream = None
    for part in ("seq % 10 <> 0", "seq % 10 = 0"):
        rows.filter(part).write.mode("append").parquet(f"{base}/in")
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), DAY, 60 * DAY, DAY)
        stateless.run_to_end(stream, f"{base}/checkpoint", "append", f"{base}/out")
    return naive(keyed.newest_bars(spark.read.schema(stream.schema).parquet(f"{base}/out")), "event_time", "correction_of")


@query(
    "stream_bars_rejected",
    f"""WITH {TICKS_SQL}, seen AS (SELECT max(epoch_us(event_time)) // 1000 AS seen FROM ticks WHERE seq % 10 <> 0)
    SELECT seq, event_time FROM ticks, seen WHERE seq % 10 = 0 AND seen - epoch_us(event_time) // 3600000000 * 3600000 > 10 * 86400000""",
)
def stream_bars_rejected(spark, sf_dir):
    """Bars of an hour; of the tenth of the ticks that come last, those over ten days behind are rejected."""
    _stateful(spark)
    base, rows = f"{shared_dir(spark)}/tickloom/rejected-{uuid.uuid4().hex}", ticks(spark, sf_dir)
    stream = None
    for part in ("seq % 10 <> 0", "seq % 10 = 0"):
        rows.filter(part).write.mode("append").parquet(f"{base}/in")
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(rows.schema).parquet(f"{base}/in"), 3600, 10 * DAY, 60 * DAY)
        stateless.run_to_end(stream, f"{base}/checkpoint", "append", f"{base}/out")
    return naive(spark.read.schema(stream.schema).parquet(f"{base}/out").filter("kind = 'late'").select("seq", "event_time"), "event_time")


_ATM_ROWS = f"""{TICKS_SQL}, x AS (SELECT * FROM (VALUES ('far', 25), ('near', 10)) t(expiry, step)),
k AS (SELECT DISTINCT security_id::VARCHAR AS symbol, expiry, floor(price / step + 0.5) * step AS strike FROM ticks, x),
g AS (SELECT symbol, expiry, min(gap) AS gap FROM (SELECT *, lead(strike) OVER (PARTITION BY symbol, expiry ORDER BY strike) - strike AS gap FROM k) GROUP BY ALL),
s AS (SELECT security_id::VARCHAR AS symbol, expiry, event_time, seq, price AS spot, event_time >= TIMESTAMP '2024-01-15' AS later, row_number() OVER (PARTITION BY security_id, expiry ORDER BY event_time, seq) AS n FROM ticks, x),
near AS (SELECT s.*, gap, (SELECT max_by(strike, (-abs(strike - spot), strike)) FROM k WHERE k.symbol = s.symbol AND k.expiry = s.expiry) AS nearest FROM s JOIN g USING (symbol, expiry)),
held AS (SELECT symbol, expiry, n, nearest AS atm, later FROM near WHERE n = 1
    UNION ALL SELECT near.symbol, near.expiry, near.n, CASE WHEN held.later = near.later AND gap > 0 AND abs(nearest - held.atm) < 2.5 * gap THEN held.atm ELSE nearest END, near.later
    FROM held JOIN near ON near.symbol = held.symbol AND near.expiry = held.expiry AND near.n = held.n + 1)"""


@query(
    "stream_atm_expiries",
    f"""WITH RECURSIVE {_ATM_ROWS} SELECT symbol, expiry, event_time, seq, spot, atm, lag(CASE WHEN later THEN NULL ELSE atm END) OVER w IS DISTINCT FROM atm AND NOT later
        OR later AND lag(CASE WHEN later THEN atm END) OVER w IS DISTINCT FROM atm AS changed FROM held JOIN near USING (symbol, expiry, n, later) WINDOW w AS (PARTITION BY symbol, expiry ORDER BY n)""",
)
def stream_atm_expiries(spark, sf_dir, at_once: int = AT_ONCE):
    """Two expiries of each symbol list strikes of their own; what they hold is forgotten in the middle of January."""
    _stateful(spark)
    steps = spark.createDataFrame([("far", 25), ("near", 10)], "expiry string, step int")
    t = ticks(spark, sf_dir).select(F.col("security_id").cast("string").alias("symbol"), "event_time", "seq", "price").join(F.broadcast(steps))  # two rows
    row = lambda kind, time, seq, value: [F.lit(kind).alias("kind"), time.alias("event_time"), seq.alias("seq"), value.alias("value")]
    at = lambda d: F.lit(d).cast("timestamp")
    strike, none = F.floor(F.col("price") / F.col("step") + 0.5) * F.col("step"), F.lit(-1).cast("long")
    spots = t.select("symbol", "expiry", *row("spot", F.col("event_time"), F.col("seq"), F.col("price")))
    listed = t.select("symbol", "expiry", *row("strike", at("2000-01-01"), none, strike.cast("double"))).distinct()
    resets = t.select("symbol", "expiry", *row("reset", at("2024-01-15"), none, F.lit(0.0))).distinct()
    rows = spots.unionByName(listed).unionByName(resets)
    return naive(_replayed(rows, "expiries", lambda s: keyed.stream_atm_by_expiry(s, 2.5), stateful.part_of("symbol", "expiry"), at_once), "event_time")


@query("stream_dedup", f"WITH {PACKETS_SQL} SELECT event_id, seq, ts AS event_time FROM ids")
def stream_dedup(spark, sf_dir):
    events = identified(spark, sf_dir).select("event_id", "seq", F.col("ts").alias("event_time"))
    stream = _as_stream(events.unionByName(events.filter("seq % 3 = 0")), "events")
    return naive(_result(stateless.stream_dedup(stream, horizon="60 days"), "events"), "event_time")


@query("stream_readiness", ORACLES_FEED["latest_readiness"])
def stream_readiness(spark, sf_dir):
    return naive(_result(stateless.stream_readiness(_as_stream(packets(spark, sf_dir), "packets")), "ready", "update", ["contract_id"]), "first_ts", "last_ts")


_SAME = ["returns", "range", "atr", "vwap", "rsi", "rvol", "oi_change"]


@query("stream_features", f"{_FEATURES} SELECT security_id, event_time, {', '.join(_SAME)} FROM features")
def stream_features(spark, sf_dir):
    _stateful(spark)
    bars = daily_bars(spark, sf_dir).select("security_id", "event_time", "high", "low", "close", "volume", "oi_close")
    found = _replayed(bars, "features", stateful.stream_features, stateful.part_of("security_id"))
    return naive(found.withColumns({c: F.round(c, 6) for c in _SAME}), "event_time")


_SPOTS = f"""{TICKS_SQL}, k AS (SELECT DISTINCT security_id::VARCHAR AS symbol, round(price / 10) * 10 AS strike FROM ticks),
s AS (SELECT security_id::VARCHAR AS symbol, event_time, price AS spot, row_number() OVER (PARTITION BY security_id ORDER BY event_time) AS n FROM ticks),
near AS (SELECT s.*, (SELECT max_by(strike, (-abs(strike - spot), strike)) FROM k WHERE k.symbol = s.symbol) AS nearest FROM s),
held AS (SELECT symbol, n, nearest AS atm FROM near WHERE n = 1
    UNION ALL SELECT near.symbol, near.n, CASE WHEN abs(spot - held.atm) < 0.3 * held.atm THEN held.atm ELSE nearest END FROM held JOIN near ON near.symbol = held.symbol AND near.n = held.n + 1)"""


@query(
    "stream_atm",
    f"""WITH RECURSIVE {_SPOTS} SELECT symbol, event_time, spot, atm, lag(atm) OVER (PARTITION BY symbol ORDER BY n) IS DISTINCT FROM atm AS changed FROM held JOIN near USING (symbol, n)""",
)
def stream_atm(spark, sf_dir):
    """Strikes of every tenth unit, listed first, and each tick as a spot price."""
    _stateful(spark)
    t = ticks(spark, sf_dir).select(F.col("security_id").cast("string").alias("symbol"), "event_time", "price")
    spots = t.select("symbol", "event_time", F.lit("spot").alias("kind"), F.col("price").alias("value"))
    strikes = t.select("symbol", F.lit("2000-01-01").cast("timestamp").alias("event_time"), F.lit("strike").alias("kind"), (F.round(F.col("price") / 10) * 10).alias("value")).distinct()
    return naive(_replayed(strikes.unionByName(spots), "atm", lambda s: stateful.stream_atm(s, 0.3), stateful.part_of("symbol")), "event_time")


def _group(n: int):
    """Name of the group of n neighbouring securities: groups grow in number, not in securities."""
    return F.floor(F.col("security_id") / n).cast("string")


_CANDIDATES = f"""{TICKS_SQL}, c AS (SELECT (security_id // 10)::VARCHAR AS underlying, event_time, epoch_us(event_time) // 1000 AS ms, round(price / 50) * 50 AS new,
    row_number() OVER (PARTITION BY security_id // 10 ORDER BY event_time) AS n FROM ticks),
w AS (SELECT underlying, n, event_time, new, NULL::DOUBLE AS active, new AS pending, ms AS first, 0 AS seen, 'DETECTED' AS event FROM c WHERE n = 1
    UNION ALL SELECT underlying, n, event_time, new, CASE WHEN kind = 'CONFIRMED' THEN new ELSE active END, CASE kind WHEN 'DETECTED' THEN new WHEN 'CONFIRMED' THEN NULL ELSE pending END,
        CASE kind WHEN 'DETECTED' THEN ms ELSE first END, CASE kind WHEN 'DETECTED' THEN 0 WHEN 'same' THEN seen + 1 ELSE seen END, CASE WHEN kind IN ('DETECTED', 'CONFIRMED') THEN kind END
    FROM (SELECT c.*, active, pending, first, seen, CASE WHEN c.new = active THEN 'none' WHEN pending IS NULL OR pending <> c.new AND NOT abs(c.new - pending) < abs(pending) / 2 THEN 'DETECTED'
        WHEN pending <> c.new THEN 'none' WHEN seen + 1 >= 3 AND ms - first >= 2000 THEN 'CONFIRMED' ELSE 'same' END AS kind FROM w JOIN c ON c.underlying = w.underlying AND c.n = w.n + 1))"""


@query(
    "stream_atm_shifts",
    f"WITH RECURSIVE {_CANDIDATES} SELECT underlying, event_time, 0.0::DOUBLE AS old_atm, new AS new_atm, event AS event_type FROM w WHERE event IS NOT NULL",
)
def stream_atm_shifts(spark, sf_dir):
    """Candidates are ticks' prices in steps of 50; ten neighbouring securities have one underlying."""
    _stateful(spark)
    c = ticks(spark, sf_dir).select(
        _group(10).alias("underlying"), "event_time", F.lit(0.0).alias("old_atm"), (F.round(F.col("price") / 50) * 50).alias("candidate_atm")
    )
    return naive(_replayed(c, "shifts", stateful.confirm_atm_shift, stateful.part_of("underlying")), "event_time")


def switch_rows(spark, sf_dir) -> DataFrame:
    """Sign-ups ask for a universe of two securities, clicks and purchases say that one is ready."""
    t = ticks(spark, sf_dir)
    kind = F.when(F.col("event_type") == "signup", "request").when(F.col("event_type").isin("click", "purchase"), "ready").otherwise("tick")
    v = F.col("volume") % 2
    ids = F.when(kind == "request", F.array(v, v + 1)).when(kind == "ready", F.array(v, v + 1, v + 2))
    return t.select(_group(10).alias("underlying"), "event_time", kind.alias("kind"), ids.alias("security_ids"))


_SWITCHES = f"""{TICKS_SQL}, r AS (SELECT (security_id // 10)::VARCHAR AS u, epoch_us(event_time) AS us, row_number() OVER (PARTITION BY security_id // 10 ORDER BY event_time) AS n,
    CASE event_type WHEN 'signup' THEN 'request' WHEN 'click' THEN 'ready' WHEN 'purchase' THEN 'ready' ELSE 'tick' END AS kind,
    CASE event_type WHEN 'signup' THEN [volume % 2, volume % 2 + 1] ELSE [volume % 2, volume % 2 + 1, volume % 2 + 2] END AS ids FROM ticks),
w AS (SELECT DISTINCT u, 0::BIGINT AS n, 'STABLE' AS phase, []::BIGINT[] AS active, []::BIGINT[] AS desired, []::BIGINT[] AS ready, 0::BIGINT AS since, 0::BIGINT AS gen, NULL::BIGINT AS rat, []::BIGINT[] AS rids,
        []::STRUCT(t BIGINT, e VARCHAR, g BIGINT, b VARCHAR, a VARCHAR, i BIGINT[])[] AS events FROM r
    UNION ALL SELECT u, n, CASE WHEN kind = 'request' THEN 'WAITING' WHEN done THEN 'STABLE' ELSE p1 END, CASE WHEN done THEN desired ELSE active END, CASE kind WHEN 'request' THEN ids ELSE desired END,
        CASE WHEN kind = 'request' THEN [] WHEN kind = 'ready' AND p1 = 'WAITING' THEN now_ready ELSE ready END, CASE kind WHEN 'request' THEN us ELSE since END, CASE kind WHEN 'request' THEN gen + 1 ELSE gen END,
        CASE WHEN done AND len(gone) > 0 THEN us + 3600000000 WHEN released THEN NULL ELSE rat END, CASE WHEN done AND len(gone) > 0 THEN gone ELSE rids END,
        list_filter(list_concat(due, [CASE WHEN kind = 'request' AND p1 = 'WAITING' THEN {{t: us, e: 'SUPERSEDED', g: gen, b: 'WAITING', a: 'STABLE', i: list_sort(desired)}} END,
            CASE WHEN kind = 'request' THEN {{t: us, e: 'REQUESTED', g: gen + 1, b: CASE p1 WHEN 'WAITING' THEN 'STABLE' ELSE p1 END, a: 'WAITING', i: list_sort(ids)}} END,
            CASE WHEN done THEN {{t: us, e: 'SWITCHED', g: gen, b: 'WAITING', a: 'STABLE', i: list_sort(desired)}} END]), lambda x: x IS NOT NULL)
    FROM (SELECT *, kind = 'ready' AND p1 = 'WAITING' AND len(now_ready) = len(list_distinct(desired)) AS done, list_sort(list_filter(active, lambda x: NOT list_contains(desired, x))) AS gone,
            [CASE WHEN released AND NOT (failed AND fat < rat) THEN {{t: rat, e: 'RELEASED', g: gen, b: phase, a: phase, i: rids}} END,
             CASE WHEN failed THEN {{t: fat, e: 'FAILED', g: gen, b: 'WAITING', a: 'FAILED', i: list_sort(desired)}} END,
             CASE WHEN released AND failed AND fat < rat THEN {{t: rat, e: 'RELEASED', g: gen, b: 'FAILED', a: 'FAILED', i: rids}} END] AS due
        FROM (SELECT *, coalesce(rat <= us, false) AS released, coalesce(fat <= us, false) AS failed, CASE WHEN coalesce(fat <= us, false) THEN 'FAILED' ELSE phase END AS p1,
                list_sort(list_distinct(list_intersect(list_concat(ready, ids), desired))) AS now_ready
            FROM (SELECT r.*, w.phase, w.active, w.desired, w.ready, w.since, w.gen, w.rat, w.rids, CASE w.phase WHEN 'WAITING' THEN w.since + CASE WHEN len(w.ready) > 0 THEN 7200000000 ELSE 3600000000 END END AS fat
                FROM w JOIN r ON r.u = w.u AND r.n = w.n + 1)))),
last AS (SELECT *, CASE phase WHEN 'WAITING' THEN since + CASE WHEN len(ready) > 0 THEN 7200000000 ELSE 3600000000 END END AS fat, (SELECT max(us) - 1000000 FROM r) AS mark FROM w
    WHERE n = (SELECT max(n) FROM r WHERE r.u = w.u)),
told AS (SELECT u, unnest(events) AS x FROM w UNION ALL SELECT u, {{t: rat, e: 'RELEASED', g: gen, b: CASE WHEN fat < rat THEN 'FAILED' ELSE phase END, a: CASE WHEN fat < rat THEN 'FAILED' ELSE phase END, i: rids}} FROM last WHERE rat < mark
    UNION ALL SELECT u, {{t: fat, e: 'FAILED', g: gen, b: 'WAITING', a: 'FAILED', i: list_sort(desired)}} FROM last WHERE fat < mark)"""


@query(
    "stream_switches",
    f"""WITH RECURSIVE {_SWITCHES} SELECT u AS underlying, make_timestamp(x.t) AS event_time, x.e AS event_type, x.g AS generation, x.b AS state_before, x.a AS state_after,
        array_to_string(x.i, ',') AS security_ids FROM told""",
)
def stream_switches(spark, sf_dir, at_once: int = AT_ONCE):
    _stateful(spark)
    build = lambda s: stateful.universe_switch_timeline(s, 3600, 7200, 3600, "1 second")
    found = _replayed(switch_rows(spark, sf_dir), "switches", build, F.col("underlying"), at_once)
    return naive(found.withColumn("security_ids", F.array_join(F.col("security_ids").cast("array<string>"), ",")), "event_time")


def health_rows(spark, sf_dir) -> DataFrame:
    """Packets of lines of 100 neighbouring securities each; a line's generation changes every ten days."""
    generation = F.floor(F.dayofyear("ts") / 10)
    return packets(spark, sf_dir).select(_group(100).alias("connection_id"), F.col("ts").alias("event_time"), "security_id", generation.alias("generation"))


_HEALTH = f"""{TICKS_SQL}, r AS (SELECT (security_id // 100)::VARCHAR AS line, epoch_us(event_time) AS us, security_id AS id, dayofyear(event_time) // 10 AS gen,
    row_number() OVER (PARTITION BY security_id // 100 ORDER BY event_time) AS n FROM ticks WHERE security_id IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 5 <> 0)),
w AS (SELECT line, n, us AS last, gen, 'FIRST_PACKET' AS phase, [id] AS ids, [{{t: us, b: 'SUBSCRIBED', a: 'FIRST_PACKET', k: 1::BIGINT}}] AS events FROM r WHERE n = 1
    UNION ALL SELECT line, n, us, gen, CASE WHEN healthy THEN 'HEALTHY' ELSE phase3 END, ids, list_filter([
        CASE WHEN stalled THEN {{t: last + 1800000000, b: old, a: 'STALLED', k: known}} END, CASE WHEN first THEN {{t: us, b: 'SUBSCRIBED', a: 'FIRST_PACKET', k: len(ids)}} END,
        CASE WHEN healthy THEN {{t: us, b: phase3, a: 'HEALTHY', k: len(ids)}} END], lambda e: e IS NOT NULL)
    FROM (SELECT *, phase3 IN ('FIRST_PACKET', 'STALLED') AND len(ids) >= 30 AS healthy FROM (SELECT *, CASE WHEN first THEN 'FIRST_PACKET' WHEN stalled THEN 'STALLED' ELSE old END AS phase3,
        CASE WHEN len(had) < 30 THEN list_distinct(list_append(had, id)) ELSE had END AS ids FROM (SELECT r.*, w.last, w.phase AS old, len(w.ids) AS known, w.gen <> r.gen AS first,
            w.phase IN ('FIRST_PACKET', 'HEALTHY') AND r.us > w.last + 1800000000 AS stalled, CASE WHEN w.gen <> r.gen THEN [] ELSE w.ids END AS had FROM w JOIN r ON r.line = w.line AND r.n = w.n + 1)))),
silent AS (SELECT line, last + 1800000000 AS t, phase, len(ids) AS k FROM w WHERE phase IN ('FIRST_PACKET', 'HEALTHY') AND last + 1800000000 < (SELECT max(us) - 1000000 FROM r)
    AND n = (SELECT max(n) FROM r WHERE r.line = w.line)),
e AS (SELECT line, unnest(events) AS e FROM w)"""


@query(
    "stream_feed_health",
    f"""WITH RECURSIVE {_HEALTH} SELECT line AS connection_id, make_timestamp(e.t) AS event_time, e.b AS state_before, e.a AS state_after, e.k AS distinct_ids FROM e
        UNION ALL SELECT line, make_timestamp(t), phase, 'STALLED', k FROM silent""",
)
def stream_feed_health(spark, sf_dir, at_once: int = AT_ONCE):
    _stateful(spark)
    desired = written(_sets(spark, sf_dir)["desired"].select("security_id").distinct(), "desired")
    build = lambda s: stateful.feed_health(s, desired, 30, 1800, "1 second")
    return naive(_replayed(health_rows(spark, sf_dir), "health", build, F.col("connection_id"), at_once), "event_time")


@query("stream_route", f"WITH {PACKETS_SQL} SELECT event_id, CASE WHEN decode_status = 'success' THEN 'kept' ELSE 'failed' END AS sink FROM ids")
def stream_route(spark, sf_dir):
    """Events of a stream with repeats, each written once to the table that its status says."""
    base = f"{shared_dir(spark)}/tickloom/route-{uuid.uuid4().hex}"
    events = identified(spark, sf_dir).select("event_id", "seq", F.col("ts").alias("event_time"), "decode_status", F.col("payload").alias("decoded_payload"))
    stream = stateless.stream_dedup(_as_stream(events.unionByName(events.filter("seq % 4 = 0")), "events"), horizon="60 days")
    stateless.run_to_end(stream, f"{base}/checkpoint", "append", each=stateless.route_batch(f"{base}/kept", f"{base}/failed"))
    both = [spark.read.schema(stream.schema).parquet(f"{base}/{x}").select("event_id", F.lit(x).alias("sink")) for x in ("kept", "failed")]
    return both[0].unionByName(both[1])


@query(
    "stream_route_counters",
    f"""WITH {PACKETS_SQL}, n AS (SELECT count(*) + count_if(seq % 4 = 0)::BIGINT AS received, count_if(decode_status = 'success')::BIGINT AS persisted,
        count_if(decode_status <> 'success')::BIGINT AS quarantined, count_if(seq % 4 = 0)::BIGINT AS dropped FROM ids)
    SELECT received, persisted, quarantined, 0::BIGINT AS queued, 0::BIGINT AS spooled, dropped, received = persisted + quarantined + dropped AS balanced FROM n""",
)
def stream_route_counters(spark, sf_dir):
    """What the micro-batches of a routed stream with repeats observed, added up."""
    base = f"{shared_dir(spark)}/tickloom/counted-{uuid.uuid4().hex}"
    events = identified(spark, sf_dir).select("event_id", "seq", F.col("ts").alias("event_time"), "decode_status", F.col("payload").alias("decoded_payload"))
    rows = events.unionByName(events.filter("seq % 4 = 0"))
    rows.repartition(8).write.parquet(f"{base}/in")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 3).parquet(f"{base}/in")
    stream = stateless.counted_route(source, horizon="60 days")
    done = stateless.run_to_end(stream, f"{base}/checkpoint", "append", each=stateless.route_batch(f"{base}/kept", f"{base}/failed"))
    counts = [stateless.batch_counters(p) for p in done.recentProgress]  # a row for each micro-batch
    names = ("received", *OUTCOMES)
    per = spark.createDataFrame([tuple(c[n] for n in names) for c in counts], ", ".join(f"{n} long" for n in names))
    sums = per.agg(*[F.sum(n).alias(n) for n in names])
    return sums.withColumn("balanced", F.col("received") == sum((F.col(o) for o in OUTCOMES), F.lit(0)))


@query(
    "stream_late",
    f"""WITH {TICKS_SQL} SELECT seq, CASE WHEN epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - epoch_us(event_time) // 60000000 * 60 > 300 THEN 'late' ELSE 'kept' END AS sink FROM ticks""",
)
def stream_late(spark, sf_dir):
    """All ticks as a stream, each written to the table of those in time or to that of late ones."""
    base, stream = f"{shared_dir(spark)}/tickloom/late-{uuid.uuid4().hex}", _as_stream(ticks(spark, sf_dir).select("seq", "event_time"), "ticks")
    stateless.run_to_end(stream, f"{base}/checkpoint", "append", each=stateless.late_batch(f"{base}/kept", f"{base}/late", F.lit(AS_OF)))
    both = [spark.read.schema(stream.schema).parquet(f"{base}/{x}").select("seq", F.lit(x).alias("sink")) for x in ("kept", "late")]
    return both[0].unionByName(both[1])


def _hex_le(c, n: int):
    """n little-endian bytes of a whole number, as hexadecimal text."""
    return F.concat(*[F.substring(F.lpad(F.hex(c), 2 * n, "0"), 2 * (n - i) - 1, 2) for i in range(n)])


def _frames(spark, sf_dir) -> DataFrame:
    """Each tick as a frame of an open-interest packet, written natively: header and body as little-endian bytes."""
    t = ticks(spark, sf_dir)
    body = F.concat(F.lit("05"), _hex_le(F.lit(12), 2), F.lit("02"), _hex_le(F.col("security_id"), 4), _hex_le(F.coalesce("oi", F.lit(0)), 4))
    return t.select(
        F.unhex(F.concat(body, body)).alias("frame"), (F.unix_micros("event_time") * 1000).alias("receive_ts_ns"), F.lit("line").alias("connection_id"),
        F.col("seq").cast("int").alias("websocket_message_id"),
    )


_DECODED = f"""WITH {TICKS_SQL} SELECT seq::INT AS websocket_message_id, unnest([0, 1])::INT AS packet_offset, 'oi' AS packet_type, security_id,
    coalesce(oi, 0) AS oi"""


@query("decode_frames", _DECODED + ", epoch_us(event_time) * 1000 AS receive_ts_ns FROM ticks")
def decoded(spark, sf_dir):
    return decode_frames(_frames(spark, sf_dir)).select("websocket_message_id", "packet_offset", "packet_type", "security_id", "oi", "receive_ts_ns")


@query("stream_decode", _DECODED + " FROM ticks")
def stream_decode(spark, sf_dir):
    """The same frames as a stream, replayed from files."""
    return _result(decode_frames(_as_stream(_frames(spark, sf_dir), "frames")).select("websocket_message_id", "packet_offset", "packet_type", "security_id", "oi"), "packets")


def _packed(*fields):
    """Fields (layout letter of struct, whole number from 1 on for floats) as the hexadecimal text of their little-endian
    bytes. The highest bit of a float's number gives its exponent, the rest the fraction."""
    size = {"h": 2, "H": 2, "i": 4, "I": 4, "f": 4}
    given = F.array(*[F.struct(v.cast("long").alias("v"), F.lit(size[k]).alias("n"), F.lit(k == "f").alias("real")) for k, v in fields])

    def text(x):
        v, e = x["v"], (F.length(F.bin(x["v"])) - 1).cast("double")
        power = F.pow(F.lit(2.0), e).cast("long")
        bits = F.when(x["real"], (e.cast("long") + 127) * 8388608 + (v - power) * F.pow(F.lit(2.0), 23 - e).cast("long")).otherwise(v)
        digits = F.lpad(F.hex(bits), 8, "0")
        return F.array_join(F.transform(F.sequence(F.lit(1), x["n"]), lambda i: F.substring(digits, 9 - 2 * i, F.lit(2))), "")

    return F.array_join(F.transform(given, text), "")


def _mixed_frames(spark, sf_dir) -> DataFrame:
    """Each tick as a frame of two packets: one of a kind that changes from tick to tick, or of an unknown code, with a full
    packet of no to five levels; then one of open interest. Every seventh frame lacks its last three bytes."""
    t, v, seq = ticks(spark, sf_dir), F.col("volume") % 200 + 1, F.col("seq")
    head = [("f", v), ("h", v), ("I", F.unix_seconds("event_time"))]
    quote = [*head, ("f", v + 1), *[("I", v + i) for i in (2, 3, 4)]]
    day = [("f", v + i) for i in (5, 6, 7, 8)]
    levels = v % 6
    depth = [x for i in range(5) for x in (("i", v + i), ("i", v + 10 + i), ("H", F.lit(i)), ("H", F.lit(2 * i)), ("f", v + 20 + i), ("f", v + 30 + i))]

    def packet(code: int, body, size):
        header = F.concat(F.lit(f"{code:02X}"), _packed(("H", F.lit(8) + size)), F.lit("02"), _packed(("I", F.col("security_id"))))
        return F.concat(header, body)

    full = F.concat(_packed(*quote, *[("i", v + i) for i in (40, 41, 42)], *day), F.substring(_packed(*depth), F.lit(1), (levels * 40).cast("int")))
    first = (
        F.when(seq % 6 == 0, packet(2, _packed(head[0], head[2]), F.lit(8)))
        .when(seq % 6 == 1, packet(4, _packed(*quote, *day), F.lit(42)))
        .when(seq % 6 == 2, packet(6, _packed(("f", v), ("i", v + 9)), F.lit(8)))
        .when(seq % 6 == 3, packet(8, full, 54 + 20 * levels))
        .when(seq % 6 == 4, packet(50, F.lit("0102"), F.lit(2)))
        .otherwise(packet(4, _packed(*quote), F.lit(26)))  # a quote that is cut short inside
    )
    whole = F.concat(first, packet(5, _packed(("i", v)), F.lit(4)))
    frame = F.unhex(F.when(seq % 7 == 0, F.substring(whole, F.lit(1), F.length(whole) - 6)).otherwise(whole))
    return t.select(frame.alias("frame"), (F.unix_micros("event_time") * 1000).alias("receive_ts_ns"), F.lit("line").alias("connection_id"), seq.cast("int").alias("websocket_message_id"))


_MIXED = f"""WITH {TICKS_SQL}, t AS (SELECT seq, security_id, volume % 200 + 1 AS v, epoch_us(event_time) // 1000000 AS s, seq % 6 AS k FROM ticks),
a AS (SELECT seq, 0 AS packet_offset, CASE k WHEN 0 THEN 'ticker' WHEN 1 THEN 'quote' WHEN 2 THEN 'prev_close' ELSE 'full' END AS packet_type, CASE k WHEN 0 THEN 2 WHEN 1 THEN 4 WHEN 2 THEN 6 ELSE 8 END AS response_code,
    security_id, CASE WHEN k <> 2 THEN v END AS ltp, CASE WHEN k <> 2 THEN s END AS last_trade_time, CASE WHEN k IN (1, 3) THEN v END AS last_trade_qty, CASE WHEN k IN (1, 3) THEN v + 1 END AS atp,
    CASE WHEN k IN (1, 3) THEN v + 2 END AS volume, CASE WHEN k IN (1, 3) THEN v + 4 END AS total_buy_qty, CASE WHEN k IN (1, 3) THEN v + 7 END AS day_high, CASE k WHEN 3 THEN v + 40 END AS oi,
    CASE k WHEN 2 THEN v END AS prev_close, CASE k WHEN 2 THEN v + 9 END AS prev_oi, CASE k WHEN 3 THEN v % 6 END AS levels,
    CASE WHEN k = 3 AND v % 6 > 0 THEN v + 20 END AS best_bid, CASE WHEN k = 3 AND v % 6 > 0 THEN v + 30 + v % 6 - 1 END AS last_ask FROM t WHERE k < 4),
b AS (SELECT seq, 1 AS packet_offset, 'oi' AS packet_type, 5 AS response_code, security_id, v AS oi FROM t WHERE seq % 7 <> 0)
SELECT seq::INT AS websocket_message_id, packet_offset::INT AS packet_offset, packet_type, response_code::INT AS response_code, security_id, ltp::DOUBLE AS ltp, last_trade_time, last_trade_qty::INT AS last_trade_qty,
    atp::DOUBLE AS atp, volume, total_buy_qty, day_high::DOUBLE AS day_high, oi, prev_close::DOUBLE AS prev_close, prev_oi, levels::INT AS levels, best_bid::DOUBLE AS best_bid, last_ask::DOUBLE AS last_ask
FROM (SELECT * FROM a UNION ALL BY NAME SELECT * FROM b)"""


@query("decode_packets", _MIXED)
def decode_packets(spark, sf_dir):
    """Frames of all kinds of packets, of unknown codes, with bodies and ends that are cut short."""
    found = decode_frames(_mixed_frames(spark, sf_dir))
    level = lambda i, field: F.try_element_at("depth", F.lit(i))[field].cast("double")
    return found.select(
        "websocket_message_id", "packet_offset", "packet_type", "response_code", "security_id", F.col("ltp").cast("double").alias("ltp"), "last_trade_time", "last_trade_qty",
        F.col("atp").cast("double").alias("atp"), "volume", "total_buy_qty", F.col("day_high").cast("double").alias("day_high"), "oi", F.col("prev_close").cast("double").alias("prev_close"), "prev_oi",
        F.when(F.col("depth").isNotNull(), F.size("depth")).alias("levels"), level(1, "bid").alias("best_bid"), level(-1, "ask").alias("last_ask"),
    )


@query(
    "replays_agree",
    f"""WITH {TICKS_SQL} SELECT 2 * count(*) AS packets, 2 * count(*) AS again, 0::BIGINT AS first_alone, 0::BIGINT AS second_alone,
        (SELECT count_if(seq % 100 = 0) FROM ticks)::BIGINT AS missed, (SELECT count_if(seq % 100 = 0) FROM ticks)::BIGINT AS changed FROM ticks""",
)
def replays_agree(spark, sf_dir):
    """One capture replayed in one batch and in several, and once more with an open interest off in every hundredth frame."""
    frames = written(_frames(spark, sf_dir).repartition(6), "frames")
    path = frames.inputFiles()[0].rpartition("/")[0]
    columns = ["websocket_message_id", "packet_offset", "packet_type", "security_id", "oi", "receive_ts_ns"]
    runs = []
    for at_once in (1000, 2):
        source = spark.readStream.schema(frames.schema).option("maxFilesPerTrigger", at_once).parquet(path)
        runs.append(_result(decode_frames(source).select(*columns), "replay"))
    wrong = (F.col("websocket_message_id") % 100 == 0) & (F.col("packet_offset") == 1)
    off = runs[1].withColumn("oi", F.when(wrong, F.col("oi") + 1).otherwise(F.col("oi")))
    same, other = stateless.replay_difference(runs[0], runs[1]), stateless.replay_difference(runs[0], off)
    return same.join(F.broadcast(other.select(F.col("first_alone").alias("missed"), F.col("second_alone").alias("changed")))).select(
        F.col("first_rows").alias("packets"), F.col("second_rows").alias("again"), "first_alone", "second_alone", "missed", "changed"
    )  # one row each


@query(
    "stream_late_counts",
    f"""WITH {TICKS_SQL}, t AS (SELECT epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - epoch_us(event_time) // 60000000 * 60 > 300 AS late FROM ticks)
    SELECT count_if(NOT late)::BIGINT AS kept, count_if(late)::BIGINT AS late FROM t""",
)
def stream_late_counts(spark, sf_dir):
    """Late ticks as the micro-batches of a stream of six files counted them."""
    rows = written(ticks(spark, sf_dir).select("seq", "event_time").repartition(6), "late-ticks")
    path = rows.inputFiles()[0].rpartition("/")[0]
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)
    base = f"{shared_dir(spark)}/tickloom/late-counts-{uuid.uuid4().hex}"
    done = stateless.run_to_end(stateless.counted_late(source, F.lit(AS_OF)), f"{base}/checkpoint", "append", f"{base}/out")
    found = [(x["kept"], x["late"]) for x in stateless.observed(done, "lateness")]  # a row for each micro-batch
    return spark.createDataFrame(found, "kept long, late long").agg(F.sum("kept").alias("kept"), F.sum("late").alias("late"))
