"""Registered queries over audits, splits and leakage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import audit as A
from tickloom.operators import bars as B
from tickloom.operators import coverage as C
from tickloom.operators import research as R
from tickloom.operators import validation as V
from tickloom.plans.feed import PACKETS_SQL, packets
from tickloom.plans.market import _FEATURES, BAR, features
from tickloom.plans.master import MASTER, master
from tickloom.plans.views import AS_OF, DAILY_SQL, TICKS_SQL, bars_sql, checksum_sql, daily_bars, naive, ticks

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


#: Fixed value: what a vendor says of its delivery.
MANIFEST = {
    "timezone": "UTC", "timestamp_precision": "microsecond", "strike_adjustment": "true", "oi_semantics": "intraday", "volume_semantics": "reported",
    "bid_ask_available": "false", "missing_minute_rate": "3.5%", "late_corrections": "true", "survivorship": "current_only",
}


def _manifest(bars: DataFrame) -> DataFrame:
    pairs = [F.lit(x) for kv in MANIFEST.items() for x in kv]
    return A.source_profile(bars).withColumn("metadata", F.create_map(*pairs))


@query(
    "source_profile",
    f"""WITH {DAILY_SQL} SELECT min(event_time)::DATE AS coverage_start, max(event_time)::DATE AS coverage_end, count(DISTINCT security_id) AS contract_count,
    count(DISTINCT event_time::DATE) AS day_count, count(*) AS row_count, {checksum_sql(event_time="time", **{c: "double" for c in ("open", "high", "low", "close")}, **{c: "" for c in BAR[6:] + ["security_id"]})} AS checksum FROM bars""",
)
def source_profile(spark, sf_dir):
    return A.source_profile(daily_bars(spark, sf_dir).select(*BAR))


_CHECKS = f"""{MASTER}, {DAILY_SQL}, audited AS (SELECT security_id, event_time, CASE WHEN trade_count % 10 = 9 THEN -volume ELSE volume END AS volume FROM bars
    UNION ALL SELECT security_id, event_time, volume FROM bars WHERE trade_count % 10 = 8), checks AS (
    SELECT 'contract_identity_accuracy' AS "check", (SELECT bool_and(strike_price > 0 AND expiry_date IS NOT NULL AND regexp_matches(symbol, '^[A-Z0-9]+$')) FROM master) AS passed
    UNION ALL SELECT 'expiry_mapping', (SELECT bool_and(coalesce(expiry_date >= (SELECT min(ts)::DATE FROM events), false)) FROM master)
    UNION ALL SELECT 'duplicate_primary_keys', (SELECT count(*) = count(DISTINCT (security_id, event_time)) FROM audited)
    UNION ALL SELECT 'unexplained_negative_volume', (SELECT count_if(volume < 0) = 0 FROM audited)
    UNION ALL SELECT unnest(['timestamp_timezone_precision', 'strike_adjustment', 'oi_semantics', 'volume_semantics', 'bid_ask_availability', 'missing_minute_rate',
        'late_correction_policy', 'survivorship_coverage']), true
    UNION ALL SELECT unnest(['timezone_ambiguity', 'corporate_action_handling']), false)"""


def _audit(spark, sf_dir) -> DataFrame:
    """Of a delivery with repeated bars and negative volumes, if any bar has so many trades."""
    plain, nth = daily_bars(spark, sf_dir), F.col("trade_count") % 10
    bars = plain.withColumn("volume", F.when(nth == 9, -F.col("volume")).otherwise(F.col("volume"))).unionByName(plain.filter(nth == 8))
    return A.audit_source(bars, master(spark, sf_dir), _manifest(plain))


@query("audit_checks", f"WITH {_CHECKS} SELECT * FROM checks")
def audit_checks(spark, sf_dir):
    return _audit(spark, sf_dir)


@query(
    "audit_verdict",
    f"""WITH {_CHECKS}, n AS (SELECT count(*) AS checks, count_if(passed)::BIGINT AS passed, string_agg("check", ', ' ORDER BY "check") FILTER (NOT passed) AS failed FROM checks)
    SELECT checks, passed, 'vendor' AS source, CASE WHEN checks = passed THEN 'APPROVED' WHEN checks - passed <= 3 THEN 'LIMITED' WHEN checks - passed <= 6 THEN 'QUARANTINED'
        ELSE 'REJECTED' END AS verdict, 'vendor: ' || verdict || ', ' || passed || '/' || checks || '; failed: ' || failed AS summary FROM n""",
)
def audit_verdict(spark, sf_dir):
    return A.audit_verdict(_audit(spark, sf_dir), "vendor").drop("failures")


@query(
    "manifest_checks",
    f"""WITH {MASTER}, m AS (SELECT s_suppkey AS k FROM supplier), c AS (SELECT k, k % 5 <> 0 AS zone, k % 7 <> 0 AS oi, k % 3 <> 0 AS rate, k % 4 <> 0 AS dst, k % 2 = 0 AS actions FROM m)
    SELECT k AS manifest, zone AS timestamp_timezone_precision, oi AS oi_semantics, rate AS missing_minute_rate, k % 5 <> 0 AND dst AS timezone_ambiguity, actions AS corporate_action_handling FROM c""",
)
def manifest_checks(spark, sf_dir):
    """Manifests that say different things, each of them judged on its own."""
    from tickloom.session import table

    k = F.col("s_suppkey")
    says = {
        "timezone": F.when(k % 5 != 0, "UTC"), "timestamp_precision": F.lit("second"), "oi_semantics": F.when(k % 7 != 0, "EOD").otherwise("unclear"),
        "missing_minute_rate": F.when(k % 3 == 0, "300%").otherwise("3.5%"), "dst_policy": F.when(k % 4 != 0, "none"), "corporate_actions": F.when(k % 2 == 0, "true").otherwise("false"),
    }
    said = F.map_filter(F.create_map(*[x for name, value in says.items() for x in (F.lit(name), value)]), lambda _, v: v.isNotNull())
    checks = A.manifest_lines(table(spark, sf_dir, "supplier").select(k.alias("manifest"), said.alias("metadata")))
    return checks.select("manifest", "timestamp_timezone_precision", "oi_semantics", "missing_minute_rate", "timezone_ambiguity", "corporate_action_handling")


@query(
    "sample_contracts",
    f"""WITH {MASTER}, p AS (SELECT security_id, symbol, row_number() OVER (ORDER BY security_id) - 1 AS position, count(*) OVER () AS n FROM master)
    SELECT security_id, symbol FROM p WHERE position % greatest(n // 100, 1) = 0 AND position // greatest(n // 100, 1) < 100""",
)
def sample_contracts(spark, sf_dir):
    return A.sample_contracts(master(spark, sf_dir)).select("security_id", "symbol")


# -- training rows ----------------------------------------------------------------------------------------------------

_LABELLED = f"""{_FEATURES}, raw AS (SELECT security_id, event_time, lead(CASE WHEN c1 <> 0 THEN (close - c1) / c1 END) OVER (PARTITION BY security_id ORDER BY event_time) AS after FROM f),
labelled AS (SELECT *, (after > 0)::INT AS label FROM raw WHERE after IS NOT NULL)"""


def labelled(spark, sf_dir) -> DataFrame:
    return V.forward_label(features(spark, sf_dir))


@query("labels", f"{_LABELLED} SELECT security_id, event_time, label FROM labelled")
def labels(spark, sf_dir):
    return naive(labelled(spark, sf_dir).select("security_id", "event_time", "label"), "event_time")


@query(
    "chrono_split",
    f"""{_LABELLED}, p AS (SELECT *, row_number() OVER (ORDER BY event_time, security_id) - 1 AS position, count(*) OVER () AS n FROM labelled)
    SELECT security_id, event_time, label, CASE WHEN position < floor(0.8 * n) THEN 'train' ELSE 'early_stopping' END AS role FROM p""",
)
def chrono_split(spark, sf_dir):
    return naive(V.chrono_split(labelled(spark, sf_dir)).select("security_id", "event_time", "label", "role"), "event_time")


@query("busiest", f"WITH {DAILY_SQL} SELECT security_id, count(*) AS n FROM bars GROUP BY 1 ORDER BY n DESC, 1 LIMIT 1")
def busiest(spark, sf_dir):
    return V.busiest_security(daily_bars(spark, sf_dir))


def _rows(spark, sf_dir) -> DataFrame:
    """Packets as rows to train on: predicted at their time, evaluated 30 minutes to 5.5 hours later."""
    hold = F.make_dt_interval(mins=F.lit(30) + (F.col("last_trade_volume") % 11).cast("int") * 30)
    return packets(spark, sf_dir).select(F.col("seq").alias("row_id"), F.col("ts").alias("prediction_time"), (F.col("ts") + hold).alias("evaluation_time"), "security_id")


_ROWS = f"""{PACKETS_SQL}, rows AS (SELECT seq AS row_id, ts AS prediction_time, ts + INTERVAL 1 MINUTE * (30 + last_trade_volume % 11 * 30) AS evaluation_time, security_id FROM packets)"""


@query(
    "purged_folds",
    f"""WITH {_ROWS}, p AS (SELECT *, row_number() OVER (ORDER BY prediction_time, row_id) - 1 AS position, count(*) OVER () AS n FROM rows),
    o AS (SELECT *, CASE WHEN position < (n % 5) * (n // 5 + 1) THEN position // (n // 5 + 1) ELSE n % 5 + (position - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END::INT AS own FROM p),
    b AS (SELECT own AS fold, min(prediction_time) AS low, max(evaluation_time) AS high FROM o GROUP BY 1)
    SELECT row_id, fold, CASE WHEN own = fold THEN 'test' WHEN prediction_time <= high + INTERVAL 30 MINUTE AND evaluation_time >= low - INTERVAL 30 MINUTE
        OR prediction_time > high AND prediction_time <= high + INTERVAL 2 HOUR THEN 'purged' ELSE 'train' END AS role FROM o, b""",
)
def purged_folds(spark, sf_dir):
    return V.purged_kfold(_rows(spark, sf_dir), 5, 1800, 7200).select("row_id", "fold", "role")


_LEAKS = f"""WITH {_ROWS}, e AS (SELECT row_id, evaluation_time AS moment, prediction_time AS low, NULL::TIMESTAMP AS reach FROM rows WHERE security_id % 2 = 0
        UNION ALL SELECT NULL, prediction_time, NULL, evaluation_time FROM rows WHERE security_id % 2 <> 0),
    m AS (SELECT row_id, low, max(reach) OVER (ORDER BY moment RANGE UNBOUNDED PRECEDING) AS reach FROM e)
    SELECT row_id FROM m WHERE row_id IS NOT NULL AND reach >= low"""


@query("leakage_pairs", _LEAKS)
@query("leakage_whole", _LEAKS)
def leakage_pairs(spark, sf_dir):
    """Every row is on one of the two sides: those of even securities train, those of odd ones test."""
    r = _rows(spark, sf_dir)
    return V.temporal_leakage(r.filter("security_id % 2 = 0"), r.filter("security_id % 2 <> 0")).select("row_id")


@query(
    "snapshot_invariants",
    f"""WITH {PACKETS_SQL}, s AS (SELECT seq, list_filter([CASE WHEN last_trade_volume % 19 = 0 THEN 'no_id' END, CASE WHEN depth = 0 THEN 'no_contracts' END,
        CASE WHEN last_trade_volume % 3 = 2 THEN 'phase_not_terminal' END, CASE WHEN last_trade_volume % 3 <> 2 AND generation <> security_id % 2 THEN 'generations_differ' END,
        CASE WHEN packet_offset <> last_trade_volume % 2 THEN 'duplicates_missed' END], lambda x: x IS NOT NULL) AS broken FROM packets)
    SELECT seq, array_to_string(broken, ',') AS broken, len(broken) = 0 AS ok FROM s""",
)
def snapshot_invariants(spark, sf_dir):
    v = F.col("last_trade_volume")
    s = packets(spark, sf_dir).select(
        "seq", F.when(v % 19 != 0, F.lit("id")).alias("universe_snapshot_id"), F.size("bids").alias("contract_count"),
        F.when(v % 3 == 0, "STABLE").when(v % 3 == 1, "FAILED").otherwise("WAITING").alias("phase"), F.col("generation").alias("active_generation"),
        (F.col("security_id") % 2).alias("desired_generation"), F.col("packet_offset").alias("injected_duplicates"), (v % 2).alias("detected_duplicates"),
    )
    return C.snapshot_invariants(s).select("seq", F.array_join("broken", ",").alias("broken"), "ok")


@query("lineage", f"WITH {PACKETS_SQL} SELECT seq AS prediction_id, security_id::VARCHAR AS universe_snapshot_id FROM packets WHERE security_id NOT IN (SELECT s_suppkey FROM supplier)")
def lineage(spark, sf_dir):
    from tickloom.session import table

    predictions = packets(spark, sf_dir).select(F.col("seq").alias("prediction_id"), F.col("security_id").cast("string").alias("universe_snapshot_id"))
    snapshots = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("universe_snapshot_id"))
    return V.lineage_integrity(predictions, snapshots)


@query(
    "classification_metrics",
    f"""{_LABELLED}, c AS (SELECT security_id, count_if(p AND y)::BIGINT AS tp, count_if(NOT p AND NOT y)::BIGINT AS tn, count_if(p AND NOT y)::BIGINT AS fp, count_if(NOT p AND y)::BIGINT AS fn
        FROM (SELECT security_id, day(event_time) % 2 = 1 AS p, label = 1 AS y FROM labelled) GROUP BY 1)
    SELECT *, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
        round((coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2, 6) AS balanced_accuracy,
        round(coalesce((tp::DOUBLE * tn - fp::DOUBLE * fn) / nullif(sqrt((tp + fp)::DOUBLE * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0), 6) AS mcc FROM c""",
)
def classification_metrics(spark, sf_dir):
    """A guess by the day of the month, measured against the labels of each security."""
    guessed = labelled(spark, sf_dir).withColumn("prediction", (F.dayofmonth("event_time") % 2).cast("int"))
    found = V.classification_metrics(guessed, ("security_id",))
    return found.withColumns({c: F.round(c, 6) for c in ("accuracy", "balanced_accuracy", "mcc")})


@query(
    "seed_medians",
    f"""{_LABELLED}, guess AS (SELECT security_id % 10 AS k, seed, (day(event_time) * seed + security_id) % 3 = 0 AS p, label = 1 AS y FROM labelled, (SELECT unnest([7, 19, 42, 73, 101]) AS seed)),
    conf AS (SELECT k, seed, count_if(p AND y)::DOUBLE AS tp, count_if(NOT p AND NOT y)::DOUBLE AS tn, count_if(p AND NOT y)::DOUBLE AS fp, count_if(NOT p AND y)::DOUBLE AS fn FROM guess GROUP BY ALL),
    met AS (SELECT k, (tp + tn) / (tp + tn + fp + fn) AS accuracy, (coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / 2 AS balanced_accuracy,
        coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0) AS mcc FROM conf)
    SELECT k, count(*) AS seeds, round(median(accuracy), 6) AS accuracy, round(median(balanced_accuracy), 6) AS balanced_accuracy, round(median(mcc), 6) AS mcc FROM met GROUP BY 1""",
)
def seed_medians(spark, sf_dir):
    """Guesses of five seeds, measured for each tenth of the securities and seed, and their medians."""
    seed = F.explode(F.array(*map(F.lit, (7, 19, 42, 73, 101))))
    guessed = labelled(spark, sf_dir).select((F.col("security_id") % 10).alias("k"), "security_id", F.dayofmonth("event_time").alias("day"), "label", seed.alias("seed"))
    guessed = guessed.withColumn("prediction", ((F.col("day") * F.col("seed") + F.col("security_id")) % 3 == 0).cast("int"))
    found = V.median_metrics(V.classification_metrics(guessed, ("k", "seed")), ("k",))
    return found.withColumns({c: F.round(c, 6) for c in ("accuracy", "balanced_accuracy", "mcc")})


# -- research ---------------------------------------------------------------------------------------------------------

_SLOTS = f"""WITH {DAILY_SQL}, s AS (SELECT security_id AS slot, event_time, close, round(close, -2) AS strike FROM bars),
c AS (SELECT *, coalesce(strike <> lag(strike) OVER w, false) AS segment_boundary FROM s WINDOW w AS (PARTITION BY slot ORDER BY event_time)),
g AS (SELECT *, (sum(segment_boundary::INT) OVER (PARTITION BY slot ORDER BY event_time))::BIGINT AS rolling_segment_id FROM c)"""


@query(
    "rolling_segments",
    _SLOTS + """ SELECT slot, event_time, strike, segment_boundary, rolling_segment_id, round((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 6) AS returns
    FROM g WINDOW w AS (PARTITION BY slot, rolling_segment_id ORDER BY event_time)""",
)
def rolling_segments(spark, sf_dir):
    slots = daily_bars(spark, sf_dir).select(F.col("security_id").alias("slot"), "event_time", "close", F.round("close", -2).alias("strike"))
    return naive(R.rolling_segments(slots).withColumn("returns", F.round("returns", 6)).drop("close"), "event_time")


@query(
    "segment_features",
    f"""WITH {DAILY_SQL}, s AS (SELECT *, round(close, -2) AS strike FROM bars),
    c AS (SELECT *, coalesce(strike <> lag(strike) OVER w, false) AS segment_boundary FROM s WINDOW w AS (PARTITION BY security_id ORDER BY event_time)),
    g AS (SELECT *, (sum(segment_boundary::INT) OVER (PARTITION BY security_id ORDER BY event_time))::BIGINT AS segment FROM c)
    SELECT security_id, event_time, segment AS rolling_segment_id, round((close - lag(close) OVER w) / nullif(lag(close) OVER w, 0), 6) AS returns,
        round((oi_close - lag(oi_close) OVER w) / nullif(lag(oi_close) OVER w, 0), 6) AS oi_change,
        round(coalesce(sum((high + low + close) / 3 * volume) OVER w / nullif(sum(volume) OVER w, 0), 0), 6) AS vwap
    FROM g WINDOW w AS (PARTITION BY security_id, segment ORDER BY event_time)""",
)
def segment_features(spark, sf_dir):
    found = R.segment_features(daily_bars(spark, sf_dir).withColumn("strike", F.round("close", -2)), slot="security_id")
    return naive(found.select("security_id", "event_time", "rolling_segment_id", *[F.round(c, 6).alias(c) for c in ("returns", "oi_change", "vwap")]), "event_time")


@query(
    "silver_flags",
    f"""WITH {TICKS_SQL} SELECT seq, row_number() OVER (PARTITION BY security_id, event_time, price, volume ORDER BY seq) > 1 AS is_duplicate,
    epoch(TIMESTAMP '{AS_OF}')::BIGINT - epoch_us(event_time) // 1000000 > 300 AS is_late, coalesce(price <= 0, true) OR coalesce(volume < 0, false) AS is_invalid FROM ticks""",
)
def silver_flags(spark, sf_dir):
    return R.silver_flags(ticks(spark, sf_dir), F.lit(AS_OF)).select("seq", "is_duplicate", "is_late", "is_invalid")


@query(
    "missing_minutes",
    f"""WITH {TICKS_SQL}, {bars_sql(60)} SELECT security_id, event_time::DATE AS day, count(DISTINCT event_time) AS present,
    ((epoch_us(max(event_time)) - epoch_us(min(event_time))) // 60000000 + 1)::BIGINT AS expected,
    round(1 - count(DISTINCT event_time) / ((epoch_us(max(event_time)) - epoch_us(min(event_time))) // 60000000 + 1), 6) AS missing_rate FROM bars GROUP BY ALL""",
)
def missing_minutes(spark, sf_dir):
    return R.missing_minutes(B.build_bars(ticks(spark, sf_dir), 60)).withColumn("missing_rate", F.round("missing_rate", 6))


@query(
    "oi_jumps",
    f"""WITH {DAILY_SQL}, b AS (SELECT *, last_value(oi_close IGNORE NULLS) OVER (PARTITION BY security_id ORDER BY event_time ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS oi_before FROM bars)
    SELECT security_id, event_time, oi_before, oi_close FROM b WHERE abs(oi_close - oi_before) > 0.5 * oi_before""",
)
def oi_jumps(spark, sf_dir):
    return naive(R.oi_jumps(daily_bars(spark, sf_dir)).select("security_id", "event_time", "oi_before", "oi_close"), "event_time")


def _later(m: int) -> str:
    return f"""(first_value(close) OVER (PARTITION BY security_id ORDER BY epoch_us(event_time) // 1000000
        RANGE BETWEEN {60 * m} FOLLOWING AND {60 * m + 86400} FOLLOWING) > close)::INT AS label_{m}"""


@query("horizon_labels", f"WITH {TICKS_SQL}, {bars_sql(60)} SELECT security_id, event_time, {', '.join(map(_later, (5, 15, 30, 60)))} FROM bars")
def horizon_labels(spark, sf_dir):
    found = R.horizon_labels(B.build_bars(ticks(spark, sf_dir), 60), [5, 15, 30, 60])
    return naive(found.select("security_id", "event_time", *[f"label_{m}" for m in (5, 15, 30, 60)]), "event_time")


@query(
    "combinatorial_folds",
    f"""WITH {_ROWS}, p AS (SELECT *, row_number() OVER (ORDER BY prediction_time, row_id) - 1 AS position, count(*) OVER () AS n FROM rows),
    o AS (SELECT *, least(floor(position * 8 / n), 7)::INT AS own FROM p), b AS (SELECT own AS g, min(prediction_time) AS low, max(evaluation_time) AS high FROM o GROUP BY 1),
    s AS (SELECT row_number() OVER (ORDER BY a.g, c.g) - 1 AS split, a.g AS g1, c.g AS g2 FROM b a, b c WHERE a.g < c.g),
    t AS (SELECT split, g1, g2, b.low, b.high FROM s JOIN b ON b.g IN (g1, g2)),
    x AS (SELECT row_id, split, bool_or(own IN (g1, g2)) AS test, bool_or(prediction_time <= high + INTERVAL 30 MINUTE AND evaluation_time >= low - INTERVAL 30 MINUTE
        OR prediction_time > high AND prediction_time <= high + INTERVAL 5 MINUTE) AS near FROM o, t GROUP BY ALL)
    SELECT row_id, split::INT AS split, CASE WHEN test THEN 'test' WHEN near THEN 'purged' ELSE 'train' END AS role FROM x""",
)
def combinatorial_folds(spark, sf_dir):
    """8 groups, 2 of them for tests: 28 splits."""
    return R.combinatorial_folds(_rows(spark, sf_dir)).select("row_id", "split", "role")


@query(
    "combinatorial_paths",
    f"""WITH {_ROWS}, o AS (SELECT row_id, least(floor((row_number() OVER (ORDER BY prediction_time, row_id) - 1) * 8 / count(*) OVER ()), 7)::INT AS own FROM rows),
    g AS (SELECT unnest(range(8)) AS g), s AS (SELECT row_number() OVER (ORDER BY a.g, c.g) - 1 AS split, a.g AS g1, c.g AS g2 FROM g a, g c WHERE a.g < c.g),
    w AS (SELECT split, g.g AS own, row_number() OVER (PARTITION BY g.g ORDER BY split) - 1 AS path FROM s JOIN g ON g.g IN (g1, g2))
    SELECT row_id, split::INT AS split, path::INT AS path FROM o JOIN w USING (own)""",
)
def combinatorial_paths(spark, sf_dir):
    """The path of each test row: 7 paths, each of them all rows."""
    return R.combinatorial_folds(_rows(spark, sf_dir)).filter("role = 'test'").select("row_id", "split", "path")
