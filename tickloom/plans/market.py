"""Registered queries over bars and features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import bars as B
from tickloom.operators import features as X
from tickloom.plans.views import AS_OF, DAILY_SQL, DAY, EXPIRY, TICKS_SQL, bars_sql, daily_bars, naive, ticks

QUERIES, ORACLES = {}, {}
BAR = ["security_id", "event_time", "open", "high", "low", "close", "volume", "volume_delta", "oi_open", "oi_high", "oi_low", "oi_close", "trade_count"]
_BAR = ", ".join(BAR)


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _bars(interval_s: int):
    def run(spark, sf_dir) -> DataFrame:
        return naive(B.build_bars(ticks(spark, sf_dir), interval_s).select(*BAR), "event_time")

    return run


for _name, _s in (("bars_minute", 60), ("bars_5m", 300), ("bars_daily", DAY)):
    query(_name, f"WITH {TICKS_SQL}, {bars_sql(_s)} SELECT {_BAR} FROM bars")(_bars(_s))


@query("bars_rolled_up", f"WITH {TICKS_SQL}, {bars_sql(3600)} SELECT {_BAR} FROM bars")
def bars_rolled_up(spark, sf_dir):
    minute = B.build_bars(ticks(spark, sf_dir), 60)
    return naive(B.roll_up(minute, 3600).select(*BAR), "event_time")


def _revised(spark, sf_dir):
    t = ticks(spark, sf_dir)
    return B.merge_bar_revisions(B.build_bars(t.filter("seq % 5 <> 0"), DAY), B.build_bars(t.filter("seq % 5 = 0"), DAY))


_REVISED = f"""WITH {TICKS_SQL}, on_time AS (SELECT * FROM ticks WHERE seq % 5 <> 0), late AS (SELECT * FROM ticks WHERE seq % 5 = 0),
{bars_sql(DAY, "on_time", "o")}, {bars_sql(DAY, "late", "n")},
revised AS (
    SELECT coalesce(o.security_id, n.security_id) AS security_id, coalesce(o.event_time, n.event_time) AS event_time,
        least(o.open, n.open) AS open, greatest(o.high, n.high) AS high, least(o.low, n.low) AS low,
        coalesce(n.close, o.close) AS close, coalesce(o.volume, 0) + coalesce(n.volume, 0) AS volume,
        CASE WHEN o.volume_delta IS NOT NULL OR n.volume_delta IS NOT NULL
            THEN coalesce(o.volume_delta, 0) + coalesce(n.volume_delta, 0) END AS volume_delta,
        CASE WHEN o.open IS NOT NULL THEN o.oi_open ELSE n.oi_open END AS oi_open,
        greatest(o.oi_high, n.oi_high) AS oi_high, least(o.oi_low, n.oi_low) AS oi_low,
        coalesce(n.oi_close, o.oi_close) AS oi_close, coalesce(o.trade_count, 0) + coalesce(n.trade_count, 0) AS trade_count,
        (o.open IS NOT NULL AND n.open IS NOT NULL)::INT AS revision, (o.open IS NOT NULL AND n.open IS NOT NULL) AS is_corrected,
        CASE WHEN o.open IS NOT NULL AND n.open IS NOT NULL THEN o.event_time END AS correction_of
    FROM o FULL JOIN n ON o.security_id = n.security_id AND o.event_time = n.event_time
)"""


@query("bars_revised", _REVISED + " SELECT * FROM revised")
def bars_revised(spark, sf_dir):
    return naive(_revised(spark, sf_dir), "event_time", "correction_of")


_FOLDED = f"""WITH {TICKS_SQL}, part AS (SELECT *, CASE WHEN seq % 5 <> 0 OR security_id % 4 = 0 AND seq % 2 = 0 THEN 0 ELSE seq % 15 + 1 END AS arrival FROM ticks),
b AS (SELECT security_id, date_trunc('day', event_time)::TIMESTAMP AS event_time, arrival, arg_min(price, (event_time, seq)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (event_time, seq)) AS close,
    sum(volume)::BIGINT AS volume, sum(CASE WHEN trade_sign <> 0 THEN volume * trade_sign END)::BIGINT AS volume_delta, arg_min(oi, (event_time, seq)) FILTER (oi IS NOT NULL) AS oi_open, max(oi) AS oi_high,
    min(oi) AS oi_low, arg_max(oi, (event_time, seq)) FILTER (oi IS NOT NULL) AS oi_close, count(*) AS trade_count FROM (SELECT * FROM part) p GROUP BY security_id, date_trunc('day', p.event_time)::TIMESTAMP, arrival),
l AS (SELECT security_id, event_time, list({{o: open, h: high, l: low, c: close, v: volume, d: volume_delta, oo: oi_open, oh: oi_high, ol: oi_low, oc: oi_close, n: trade_count, r: 0}} ORDER BY arrival) AS pieces FROM b GROUP BY ALL),
f AS (SELECT security_id, event_time, list_reduce(pieces, lambda a, p: {{o: least(a.o, p.o), h: greatest(a.h, p.h), l: least(a.l, p.l), c: coalesce(p.c, a.c), v: a.v + p.v,
    d: CASE WHEN a.d IS NULL AND p.d IS NULL THEN NULL ELSE coalesce(a.d, 0) + coalesce(p.d, 0) END, oo: a.oo, oh: greatest(a.oh, p.oh), ol: least(a.ol, p.ol), oc: coalesce(p.oc, a.oc), n: a.n + p.n, r: a.r + 1}}) AS x FROM l)
SELECT security_id, event_time, x.o AS open, x.h AS high, x.l AS low, x.c AS close, x.v AS volume, x.d AS volume_delta, x.oo AS oi_open, x.oh AS oi_high, x.ol AS oi_low, x.oc AS oi_close, x.n AS trade_count,
    x.r::INT AS revision, x.r > 0 AS is_corrected, CASE WHEN x.r > 0 THEN event_time END AS correction_of FROM f"""


@query("bars_folded", _FOLDED)
def bars_folded(spark, sf_dir):
    """Closed bars and up to three partials of each, told apart by when they arrived; some bars have partials alone."""
    t = ticks(spark, sf_dir)
    late = (F.col("seq") % 5 == 0) & ~((F.col("security_id") % 4 == 0) & (F.col("seq") % 2 == 0))
    partials = [B.build_bars(t.filter(late & (F.col("seq") % 15 == k)), DAY).withColumn("arrival", F.lit(k)) for k in (0, 5, 10)]
    whole = partials[0].unionByName(partials[1]).unionByName(partials[2])
    return naive(B.merge_bar_revisions(B.build_bars(t.filter(~late), DAY), whole, "arrival"), "event_time", "correction_of")


_LATE = f"epoch(TIMESTAMP '{AS_OF}')::BIGINT - (epoch_us(event_time) // 60000000) * 60 > 300"


@query(
    "revision_stats",
    _REVISED + f""" SELECT count(*) AS bars, count_if(is_corrected)::BIGINT AS corrected, sum(revision)::BIGINT AS revisions,
        (SELECT count_if({_LATE}) FROM ticks)::BIGINT AS late_rejected FROM revised""",
)
def revision_stats(spark, sf_dir):
    return B.revision_stats(_revised(spark, sf_dir), ticks(spark, sf_dir), F.lit(AS_OF))


@query("late_filter", f"WITH {TICKS_SQL} SELECT seq, security_id, event_time, price FROM ticks WHERE NOT ({_LATE})")
def late_filter(spark, sf_dir):
    kept = B.drop_late(ticks(spark, sf_dir), F.lit(AS_OF))
    return naive(kept.select("seq", "security_id", "event_time", "price"), "event_time")


@query(
    "bar_range",
    f"WITH {DAILY_SQL} SELECT {_BAR} FROM bars WHERE security_id = 7 AND event_time BETWEEN '2024-01-05' AND '2024-01-20'",
)
def bar_range(spark, sf_dir):
    day = lambda d: F.lit(d).cast("timestamp")
    return naive(B.bars_between(daily_bars(spark, sf_dir), 7, day("2024-01-05"), day("2024-01-20")).select(*BAR), "event_time")


@query(
    "bar_quality",
    f"""WITH {DAILY_SQL}, faulty AS (SELECT * REPLACE (CASE WHEN volume % 4 = 0 THEN low ELSE high END AS high, CASE WHEN volume % 7 = 0 THEN 0 ELSE trade_count END AS trade_count),
        event_time + CASE WHEN day(event_time) % 3 = 0 THEN INTERVAL 60 HOUR ELSE INTERVAL 0 HOUR END AS arrival FROM bars),
    o AS (SELECT *, lag(event_time) OVER (PARTITION BY security_id ORDER BY arrival) AS before FROM faulty)
    SELECT security_id, count(*) AS bars, count_if(event_time <= before)::BIGINT AS out_of_order, count_if(trade_count = 0)::BIGINT AS empty,
    count_if(NOT (open BETWEEN low AND high AND close BETWEEN low AND high))::BIGINT AS outside_range FROM o GROUP BY 1""",
)
def bar_quality(spark, sf_dir):
    """Bars of every third day come 60 hours late, some are empty, and some have lost their high."""
    late = F.when(F.dayofmonth("event_time") % 3 == 0, F.make_dt_interval(hours=F.lit(60))).otherwise(F.make_dt_interval())
    faulty = daily_bars(spark, sf_dir).withColumns(
        {
            "high": F.when(F.col("volume") % 4 == 0, F.col("low")).otherwise(F.col("high")),
            "trade_count": F.when(F.col("volume") % 7 == 0, F.lit(0)).otherwise(F.col("trade_count")),
            "arrival": F.col("event_time") + late,
        }
    )
    return B.bar_quality(faulty)


_FEATURES = f"""WITH RECURSIVE {DAILY_SQL},
f AS (
    SELECT *, row_number() OVER w AS n, lag(close) OVER w AS c1, lag(oi_close) OVER w AS o1 FROM bars
    WINDOW w AS (PARTITION BY security_id ORDER BY event_time)
),
g AS (
    SELECT *, CASE WHEN c1 IS NULL THEN high - low ELSE greatest(high - low, abs(high - c1), abs(low - c1)) END AS tr,
        greatest(close - c1, 0.0) AS gain, greatest(c1 - close, 0.0) AS loss FROM f
),
s AS (
    SELECT security_id, sum(tr) FILTER (n BETWEEN 1 AND 14) / 14 AS tr, sum(gain) FILTER (n BETWEEN 2 AND 15) / 14 AS gain,
        sum(loss) FILTER (n BETWEEN 2 AND 15) / 14 AS loss FROM g GROUP BY 1
),
a AS (
    SELECT security_id, 14::BIGINT AS n, tr AS atr FROM s
    UNION ALL SELECT g.security_id, g.n, (a.atr * 13 + g.tr) / 14 FROM a JOIN g ON g.security_id = a.security_id AND g.n = a.n + 1
),
r AS (
    SELECT security_id, 15::BIGINT AS n, gain, loss FROM s
    UNION ALL SELECT g.security_id, g.n, (r.gain * 13 + g.gain) / 14, (r.loss * 13 + g.loss) / 14
    FROM r JOIN g ON g.security_id = r.security_id AND g.n = r.n + 1
),
features AS (
    SELECT g.security_id, g.event_time,
        round(CASE WHEN c1 <> 0 THEN (close - c1) / c1 END, 6) AS returns,
        round(CASE WHEN close = 0 THEN 0 ELSE (high - low) / close END, 6) AS range,
        round(tr, 6) AS true_range, round(a.atr, 6) AS atr,
        round(CASE WHEN sum(volume) OVER w = 0 THEN 0 ELSE sum((high + low + close) / 3 * volume) OVER w / sum(volume) OVER w END, 6) AS vwap,
        round(CASE WHEN r.loss = 0 THEN 100 ELSE 100 - 100 / (1 + r.gain / r.loss) END, 6) AS rsi,
        round(CASE WHEN g.n >= 20 THEN CASE WHEN avg(volume) OVER v = 0 THEN 0 ELSE volume / avg(volume) OVER v END END, 6) AS rvol,
        round(CASE WHEN o1 <> 0 THEN (oi_close - o1) / o1 END, 6) AS oi_change,
        round(epoch(TIMESTAMP '{EXPIRY}' - g.event_time) / 60, 6) AS minutes_to_expiry
    FROM g LEFT JOIN a ON a.security_id = g.security_id AND a.n = g.n LEFT JOIN r ON r.security_id = g.security_id AND r.n = g.n
    WINDOW w AS (PARTITION BY g.security_id ORDER BY g.event_time ROWS UNBOUNDED PRECEDING),
        v AS (PARTITION BY g.security_id ORDER BY g.event_time ROWS 19 PRECEDING)
)"""
FEATURES = ["returns", "range", "true_range", "atr", "vwap", "rsi", "rvol", "oi_change", "minutes_to_expiry"]


def features(spark, sf_dir) -> DataFrame:
    return X.compute_features(daily_bars(spark, sf_dir), F.lit(EXPIRY))


def _some(*columns: str):
    def run(spark, sf_dir):
        found = features(spark, sf_dir).select("security_id", "event_time", *[F.round(c, 6).alias(c) for c in columns])
        return naive(found, "event_time")

    return run


for _name, _columns in {
    "feat_returns_range": ["returns", "range"],
    "feat_true_range": ["true_range"],
    "feat_atr": ["atr"],
    "feat_vwap": ["vwap"],
    "feat_rsi": ["rsi"],
    "feat_rvol": ["rvol"],
    "feat_oi_change": ["oi_change"],
    "feat_minutes_to_expiry": ["minutes_to_expiry"],
    "feat_all": FEATURES,
}.items():
    query(_name, f"{_FEATURES} SELECT security_id, event_time, {', '.join(_columns)} FROM features")(_some(*_columns))


@query(
    "feat_causal",
    f"""{_FEATURES} SELECT security_id, event_time, atr, rsi, event_time + INTERVAL 86401 SECOND AS available_time FROM features
    WHERE atr IS NOT NULL AND rsi IS NOT NULL AND returns IS NOT NULL AND event_time + INTERVAL 86401 SECOND <= TIMESTAMP '{AS_OF}'""",
)
def feat_causal(spark, sf_dir):
    """Complete rows whose features are known at the decision."""
    known = X.causal_filter(features(spark, sf_dir), F.lit(AS_OF).cast("timestamp"), DAY)
    known = known.dropna(subset=["returns", "rsi", "atr"])
    known = known.withColumn("available_time", X.feature_available_time(F.col("event_time"), DAY))
    return naive(
        known.select("security_id", "event_time", F.round("atr", 6).alias("atr"), F.round("rsi", 6).alias("rsi"), "available_time"),
        "event_time",
        "available_time",
    )
