"""Registered queries over what decides whether a candidate goes live, and over an exchange's daily files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators import research as R
from tickloom.operators import selection as S
from tickloom.operators.bars import build_bars, roll_up
from tickloom.plans.checks import _ROWS, _rows
from tickloom.plans.views import DAILY_SQL, DAY, TICKS_SQL, daily_bars, naive, ticks
from tickloom.session import shared_dir, written
from tickloom.sources.tables import DAILY_FIELDS, read_daily_derivatives

QUERIES, ORACLES = {}, {}
TRIALS = 10


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def _returns(spark, sf_dir) -> DataFrame:
    """A trial holds each tenth security and earns what its bars gain from open to close, in cents a day."""
    cents = lambda c: F.round(F.col(c) * 100)
    daily = daily_bars(spark, sf_dir).groupBy((F.col("security_id") % TRIALS).alias("trial"), "event_time")
    return daily.agg(F.sum(cents("close") - cents("open")).alias("value"))


_RETURNS = f"""{DAILY_SQL}, r AS (SELECT security_id % {TRIALS} AS trial, event_time, sum(round(100 * close) - round(100 * open)) AS value FROM bars GROUP BY ALL)"""
_SPLITS = f"""WITH {_RETURNS}, span AS (SELECT min(epoch_us(event_time) // 1000000) AS lo, max(epoch_us(event_time) // 1000000) AS hi FROM r),
x AS (SELECT trial, floor((epoch_us(event_time) // 1000000 - lo) * 8 / (hi - lo + 1))::INT AS block, count(value) AS n, sum(value) AS s, sum(value * value) AS q FROM r, span GROUP BY ALL),
w AS (SELECT row_number() OVER (ORDER BY m DESC) - 1 AS split, m FROM range(256) t(m) WHERE bit_count(m) = 4),
h0 AS (SELECT split, trial, ((m >> (7 - block)) & 1) = 1 AS inside, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM x, w GROUP BY ALL),
h AS (SELECT split, trial, inside, CASE WHEN n > 1 AND (q - s * s / n) / (n - 1) > 0 THEN s / n / sqrt((q - s * s / n) / (n - 1)) END AS ratio FROM h0),
p AS (SELECT i.split, i.trial, i.ratio AS a, o.ratio AS b FROM h i JOIN h o ON i.split = o.split AND i.trial = o.trial AND i.inside AND NOT o.inside
    WHERE i.ratio IS NOT NULL AND o.ratio IS NOT NULL),
best AS (SELECT split, trial, b FROM p QUALIFY row_number() OVER (PARTITION BY split ORDER BY a DESC, trial DESC) = 1),
ranked AS (SELECT p.split::INT AS split, any_value(best.trial) AS best_trial, (count_if(p.b < best.b) + 1)::BIGINT AS rank, count(*) AS trials FROM p JOIN best ON p.split = best.split GROUP BY ALL),
pbo AS (SELECT count(*) AS splits, avg((ln(rank / (trials + 1 - rank)) <= 0)::INT) AS pbo FROM ranked)"""


@query("overfit_splits", f"{_SPLITS} SELECT *, round(ln(rank / (trials + 1 - rank)), 6) AS logit FROM ranked")
def overfit_splits(spark, sf_dir):
    return S.overfit_splits(_returns(spark, sf_dir)).withColumn("logit", F.round("logit", 6))


@query("overfit_probability", f"{_SPLITS} SELECT splits, round(pbo, 6) AS pbo, CASE WHEN pbo < 0.25 THEN 'pass' WHEN pbo <= 0.4 THEN 'warning' ELSE 'reject' END AS verdict FROM pbo")
def overfit_probability(spark, sf_dir):
    return S.overfit_probability(S.overfit_splits(_returns(spark, sf_dir))).withColumn("pbo", F.round("pbo", 6))


_DSR = f"""dev AS (SELECT trial, count(value) AS n, avg(value) AS m, stddev_samp(value) AS sd FROM r GROUP BY 1),
mom AS (SELECT trial, any_value(n) AS n, any_value(m / sd) AS sharpe, avg((value - m) ** 2) AS m2, avg((value - m) ** 3) AS m3, avg((value - m) ** 4) AS m4 FROM r JOIN dev USING (trial) GROUP BY 1),
ratios AS (SELECT trial, n, sharpe, m3 / m2 ** 1.5 AS skew, m4 / m2 ** 2 AS kurtosis, count(*) OVER () AS trials, sqrt(var_samp(sharpe) OVER ()) * 1.57459830134575::DOUBLE AS lucky_sharpe,
    1 - skew * sharpe + (kurtosis - 1) / 4 * sharpe * sharpe AS spread FROM mom),
z AS (SELECT *, (sharpe - lucky_sharpe) * sqrt(n - 1) / sqrt(spread) AS z, 1 / (1 + 0.2316419::DOUBLE * abs(z)) AS t FROM ratios),
d AS (SELECT *, exp(-z * z / 2) / sqrt(2 * pi()) * t * (0.319381530::DOUBLE + t * (-0.356563782::DOUBLE + t * (1.781477937::DOUBLE + t * (-1.821255978::DOUBLE + t * 1.330274429::DOUBLE)))) AS upper,
    CASE WHEN z >= 0 THEN 1 - upper ELSE upper END AS dsr FROM z)"""


@query(
    "deflated_sharpe",
    f"""WITH {_RETURNS}, {_DSR} SELECT trial, n, trials, round(sharpe, 6) AS sharpe, round(skew, 6) AS skew, round(kurtosis, 6) AS kurtosis, round(lucky_sharpe, 6) AS lucky_sharpe,
    round(dsr, 6) AS dsr, CASE WHEN sharpe > 0 THEN round(1 + spread * (1.6448536269514722::DOUBLE / sharpe) ** 2, 3) END AS min_track_record, dsr >= 0.95 AS significant FROM d""",
)
def deflated_sharpe(spark, sf_dir):
    found = S.deflated_sharpe(_returns(spark, sf_dir))
    return found.withColumns({c: F.round(c, 6) for c in ("sharpe", "skew", "kurtosis", "lucky_sharpe", "dsr")} | {"min_track_record": F.round("min_track_record", 3)})


def _daily_rows(spark, sf_dir) -> DataFrame:
    """What each bar gains from open to close, in cents: predicted at its start, known a day later."""
    cents = lambda c: F.round(F.col(c) * 100)
    rows = daily_bars(spark, sf_dir).select((F.col("security_id") % TRIALS).alias("candidate"), "security_id", "event_time", (cents("close") - cents("open")).alias("value"))
    day = F.make_dt_interval(days=F.lit(1))
    return rows.withColumns({"row_id": F.col("security_id"), "prediction_time": F.col("event_time"), "evaluation_time": F.col("event_time") + day})


_PATHS = f"""rows AS (SELECT security_id % {TRIALS} AS candidate, security_id, event_time, event_time AS t0, event_time + INTERVAL 1 DAY AS t1, round(100 * close) - round(100 * open) AS value FROM bars),
own AS (SELECT *, least(floor((row_number() OVER (ORDER BY t0, security_id) - 1) * 8 / count(*) OVER ()), 7)::INT AS own FROM rows),
bound AS (SELECT own AS g, min(t0) AS low, max(t1) AS high FROM own GROUP BY 1),
ways AS (SELECT row_number() OVER (ORDER BY a.g, c.g) - 1 AS split, a.g AS g1, c.g AS g2, a.low AS l1, a.high AS h1, c.low AS l2, c.high AS h2 FROM bound a, bound c WHERE a.g < c.g),
numbered AS (SELECT split, g, row_number() OVER (PARTITION BY g ORDER BY split) - 1 AS path FROM ways JOIN bound ON g IN (g1, g2)),
fold AS (SELECT own.*, ways.*, own IN (g1, g2) AS test, t0 <= h1 + INTERVAL 30 MINUTE AND t1 >= l1 - INTERVAL 30 MINUTE OR t0 > h1 AND t0 <= h1 + INTERVAL 5 MINUTE
    OR t0 <= h2 + INTERVAL 30 MINUTE AND t1 >= l2 - INTERVAL 30 MINUTE OR t0 > h2 AND t0 <= h2 + INTERVAL 5 MINUTE AS near FROM own, ways),
taught AS (SELECT split, security_id, sum(value) AS learned, avg((value > 0)::INT) AS chance FROM fold WHERE NOT test AND NOT near GROUP BY ALL),
gain AS (SELECT f.candidate, f.security_id, f.event_time, f.split, path, value, chance, sign(coalesce(learned, 0)) * value AS gain FROM fold f JOIN numbered n ON n.split = f.split AND n.g = own
    LEFT JOIN taught ON taught.split = f.split AND taught.security_id = f.security_id WHERE test),
perf AS (SELECT candidate, path, count(*) AS n, sum(gain) AS total, avg(gain) / nullif(stddev_samp(gain), 0) AS ratio FROM gain GROUP BY ALL)"""


@query("path_performance", f"WITH {DAILY_SQL}, {_PATHS} SELECT candidate, path::INT AS path, n, total, round(ratio, 6) AS ratio FROM perf")
def path_performance(spark, sf_dir):
    """Each security is held by the sign of what it gained in a split's train rows; every tenth security is one candidate."""
    gains = R.path_gains(R.combinatorial_folds(_daily_rows(spark, sf_dir)))
    return R.path_performance(gains).withColumn("ratio", F.round("ratio", 6))


_METRICS = f"""{_PATHS}, times AS (SELECT min(epoch_us(event_time) // 1000000) AS low, max(epoch_us(event_time) // 1000000) - min(epoch_us(event_time) // 1000000) + 1 AS length FROM rows),
day AS (SELECT candidate, event_time, sum(value) AS v, any_value((epoch_us(event_time) // 1000000 - low) / length) AS place FROM rows, times GROUP BY 1, 2),
five AS (SELECT candidate, floor(place * 5) AS k, sum(v) > 0 AS up FROM day GROUP BY ALL),
outer_folds AS (SELECT candidate, count_if(up) / 5 AS outer_folds, coalesce(bool_or(up) FILTER (k = 4), false) AS shadow FROM five GROUP BY 1),
hold AS (SELECT candidate, abs(avg(v) FILTER (place >= 0.8) / nullif(stddev_samp(v) FILTER (place >= 0.8), 0) - avg(v) FILTER (place < 0.8) / nullif(stddev_samp(v) FILTER (place < 0.8), 0)) AS stable FROM day GROUP BY 1),
path AS (SELECT candidate, quantile_cont(ratio, 0.5) AS median_path, quantile_cont(ratio, 0.1) AS worst_path FROM perf GROUP BY 1),
bin AS (SELECT candidate, least(floor(chance * 10), 9) AS bin, count(*) AS n, sum(chance) AS said, count_if(value > 0) AS came FROM gain WHERE chance IS NOT NULL GROUP BY ALL),
cal AS (SELECT candidate, sum(abs(said - came)) / sum(n) AS error FROM bin GROUP BY 1),
stock AS (SELECT candidate, max(a) / sum(a) AS share FROM (SELECT candidate, security_id, abs(sum(value)) AS a FROM rows GROUP BY ALL) GROUP BY 1),
week AS (SELECT candidate, max(a) / sum(a) AS share FROM (SELECT candidate, date_trunc('week', event_time) AS w, abs(sum(value)) AS a FROM rows GROUP BY ALL) GROUP BY 1),
leak AS (SELECT candidate, count_if(NOT test AND NOT near AND (t0 <= h1 AND t1 >= l1 OR t0 <= h2 AND t1 >= l2)) AS n FROM fold GROUP BY 1),
metric AS (SELECT candidate, leak.n = 0 AS leakage, error <= 0.15 AS calibrated, shadow, stock.share <= 0.5 AS stock, week.share <= 0.5 AS week, median_path, worst_path, outer_folds, stable
    FROM outer_folds JOIN hold USING (candidate) JOIN path USING (candidate) JOIN cal USING (candidate) JOIN stock USING (candidate) JOIN week USING (candidate) JOIN leak USING (candidate))"""


def _metrics(spark, sf_dir) -> DataFrame:
    """Bars rolled up from hours replay those of a day; train rows leak if their time meets a test group's."""
    rows = written(_daily_rows(spark, sf_dir), "candidate-rows")
    folds = written(R.combinatorial_folds(rows), "candidate-folds")
    bounds = folds.filter("role = 'test'").groupBy("split", "path").agg(F.min("prediction_time").alias("low"), F.max("evaluation_time").alias("high"))
    meets = (F.col("prediction_time") <= F.col("high")) & (F.col("evaluation_time") >= F.col("low"))
    train = folds.filter("role = 'train'").drop("path").join(F.broadcast(bounds), "split")  # 56 bounds
    leaks = train.groupBy("candidate").agg(F.count_if(meets).alias("n"))
    daily, rolled = daily_bars(spark, sf_dir), roll_up(build_bars(ticks(spark, sf_dir), 3600), DAY)
    same = lambda c: F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    both = daily.alias("a").join(rolled.alias("b"), ["security_id", "event_time"], "full")
    replayed = both.select((F.col("security_id") % TRIALS).alias("candidate"), (same("open") & same("close") & same("volume") & same("oi_close")).alias("same"))
    return S.candidate_metrics(rows, R.path_gains(folds), replayed, leaks, period="week")


@query(
    "candidate_metrics",
    f"""WITH {DAILY_SQL}, {_METRICS} SELECT candidate, unnest([{{metric: 'leakage_suite', value: leakage::DOUBLE}}, {{metric: 'calibration_acceptable', value: calibrated::DOUBLE}}, {{metric: 'live_replay_parity', value: 1.0::DOUBLE}},
    {{metric: 'shadow_performance', value: shadow::DOUBLE}}, {{metric: 'no_single_stock_dependency', value: stock::DOUBLE}}, {{metric: 'no_single_month_dependency', value: week::DOUBLE}},
    {{metric: 'median_path', value: round(median_path, 6)}}, {{metric: 'worst_decile_path', value: round(worst_path, 6)}}, {{metric: 'outer_folds', value: round(outer_folds, 6)}}, {{metric: 'stable_holdout', value: round(stable, 6)}}], recursive := true) FROM metric""",
)
def candidate_metrics(spark, sf_dir):
    return _metrics(spark, sf_dir).withColumn("value", F.round("value", 6))


@query(
    "promotion_gates",
    f"""{_SPLITS}, {_DSR}, {_METRICS}, f AS (SELECT trial AS candidate, pbo, list_filter([CASE WHEN NOT leakage THEN 'leakage_suite' END, CASE WHEN NOT coalesce(dsr >= 0.95, false) THEN 'dsr' END,
        CASE WHEN NOT calibrated THEN 'calibration_acceptable' END, CASE WHEN NOT shadow THEN 'shadow_performance' END, CASE WHEN NOT stock THEN 'no_single_stock_dependency' END,
        CASE WHEN NOT week THEN 'no_single_month_dependency' END, CASE WHEN pbo > 0.4 THEN 'pbo' END, CASE WHEN NOT coalesce(median_path > 0, false) THEN 'median_path' END,
        CASE WHEN NOT coalesce(worst_path >= -0.25, false) THEN 'worst_decile_path' END, CASE WHEN outer_folds < 0.6 THEN 'outer_folds' END, CASE WHEN NOT coalesce(stable <= 0.5, false) THEN 'stable_holdout' END],
        lambda x: x IS NOT NULL) AS failed FROM d JOIN metric ON trial = candidate, pbo)
    SELECT candidate, array_to_string(failed, ',') AS failed, CASE WHEN len(failed) > 0 THEN 'reject' WHEN pbo >= 0.25 THEN 'warning' ELSE 'promote' END AS verdict FROM f""",
)
def promotion_gates(spark, sf_dir):
    """Twelve gates on what was measured of each candidate."""
    returns = written(_returns(spark, sf_dir), "returns")
    pbo = S.overfit_probability(S.overfit_splits(returns)).select("pbo")
    row = lambda name, value: (F.lit(name).alias("metric"), value.cast("double").alias("value"))
    trials = returns.select(F.col("trial").alias("candidate")).distinct()
    metrics = trials.join(F.broadcast(pbo)).select("candidate", *row("pbo", F.col("pbo")))  # one row
    metrics = metrics.unionByName(S.deflated_sharpe(returns).select(F.col("trial").alias("candidate"), *row("dsr", F.col("dsr"))))
    return S.promotion_gates(metrics.unionByName(_metrics(spark, sf_dir))).withColumn("failed", F.array_join("failed", ","))


@query(
    "executable_fills",
    f"""WITH {TICKS_SQL}, q AS (SELECT security_id, event_time, seq, price - volume % 7 * 0.125 AS bid, price + seq % 5 * 0.125 AS ask, volume % 5 AS depth FROM ticks WHERE event_type NOT IN ('purchase', 'error')),
    o AS (SELECT seq AS order_id, security_id, event_time, CASE event_type WHEN 'purchase' THEN 'entry' ELSE 'exit' END AS side, volume % 9 / 8.0 AS edge FROM ticks WHERE event_type IN ('purchase', 'error')),
    lim AS (SELECT security_id, quantile_cont(ask - bid, 0.9) AS most FROM q WHERE event_time < TIMESTAMP '2024-01-15' GROUP BY 1),
    m AS (SELECT o.*, bid, ask, depth FROM o LEFT JOIN q ON o.security_id = q.security_id AND q.event_time BETWEEN o.event_time - INTERVAL 6 HOUR AND o.event_time
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY q.event_time DESC NULLS LAST, q.seq DESC) = 1),
    b AS (SELECT m.*, CASE WHEN bid IS NULL OR ask IS NULL THEN 'no_fresh_quote' ELSE array_to_string(list_filter([CASE WHEN NOT coalesce(ask - bid <= most, false) THEN 'spread' END,
        CASE WHEN NOT coalesce(depth >= 1, false) THEN 'depth' END, CASE WHEN NOT coalesce(edge > (ask - bid) / 2 + 0.125, false) THEN 'edge' END], lambda x: x IS NOT NULL), ',') END AS blocked_by
        FROM m LEFT JOIN lim USING (security_id))
    SELECT order_id, side, blocked_by, CASE WHEN blocked_by = '' THEN CASE side WHEN 'entry' THEN ask + 0.125 ELSE bid - 0.125 END END AS fill_price FROM b""",
)
def executable_fills(spark, sf_dir):
    """Purchases enter and errors exit; all other events quote, good for six hours."""
    t, v = ticks(spark, sf_dir), F.col("volume")
    trade = F.col("event_type").isin("purchase", "error")
    quotes = t.filter(~trade).select(
        "security_id", "event_time", "seq", (F.col("price") - v % 7 * 0.125).alias("bid"), (F.col("price") + F.col("seq") % 5 * 0.125).alias("ask"), (v % 5).alias("depth")
    )
    side = F.when(F.col("event_type") == "purchase", "entry").otherwise("exit")
    orders = t.filter(trade).select(F.col("seq").alias("order_id"), "security_id", "event_time", side.alias("side"), (v % 9 / 8).alias("edge"))
    found = S.executable_fills(orders, quotes, F.lit("2024-01-15").cast("timestamp"), 0.125, 0.9, 6 * 3600)
    return found.select("order_id", "side", F.array_join("blocked_by", ",").alias("blocked_by"), "fill_price")


@query(
    "block_folds",
    f"""WITH {_ROWS}, blk AS (SELECT block AS row_id, make_timestamp(block * 3600000000) AS low_time, max(evaluation_time) AS high_time
        FROM (SELECT epoch_us(prediction_time) // 3600000000 AS block, evaluation_time FROM rows) GROUP BY ALL),
    p AS (SELECT *, row_number() OVER (ORDER BY low_time) - 1 AS position, count(*) OVER () AS n FROM blk),
    o AS (SELECT *, CASE WHEN position < (n % 5) * (n // 5 + 1) THEN position // (n // 5 + 1) ELSE n % 5 + (position - (n % 5) * (n // 5 + 1)) // greatest(n // 5, 1) END::INT AS own FROM p),
    b AS (SELECT own AS fold, min(low_time) AS low, max(high_time) AS high FROM o GROUP BY 1),
    roles AS (SELECT row_id AS block, fold, CASE WHEN own = fold THEN 'test' WHEN low_time <= high + INTERVAL 30 MINUTE AND high_time >= low - INTERVAL 30 MINUTE
        OR low_time > high AND low_time <= high + INTERVAL 2 HOUR THEN 'purged' ELSE 'train' END AS role FROM o, b)
    SELECT rows.row_id, fold, role FROM rows JOIN roles ON epoch_us(rows.prediction_time) // 3600000000 = block""",
)
def block_folds(spark, sf_dir):
    return S.block_folds(_rows(spark, sf_dir), 3600, 5, 1800, 7200).select("row_id", "fold", "role")


@query(
    "daily_derivatives",
    f"""WITH {DAILY_SQL} SELECT 'OPT' || CASE security_id % 3 WHEN 0 THEN 'STK' ELSE 'IDX' END AS instrument_type, 'S' || security_id AS symbol, event_time::DATE AS expiry_date, close AS strike_price,
    'CE' AS option_type, open, high, low, close, CASE WHEN trade_count % 4 <> 0 THEN close END AS settle_price, trade_count AS contracts, volume::DOUBLE AS value_lakh, oi_close AS oi, oi_close - oi_open AS oi_change
    FROM bars WHERE security_id % 3 <> 2""",
)
def daily_derivatives(spark, sf_dir):
    """Bars written as daily files and read again; a third of the securities are futures, and some have no settlement price."""
    b, third = daily_bars(spark, sf_dir), F.col("security_id") % 3
    values = [
        F.when(third == 0, "OPTSTK").when(third == 1, "OPTIDX").otherwise("FUTSTK"), F.concat(F.lit("S"), "security_id"), F.date_format("event_time", "dd-MMM-yyyy"), F.col("close"), F.lit("CE"),
        F.col("open"), F.col("high"), F.col("low"), F.col("close"), F.when(F.col("trade_count") % 4 != 0, F.col("close").cast("string")).otherwise("-"), F.col("trade_count"), F.col("volume"),
        F.col("oi_close"), F.col("oi_close") - F.col("oi_open"),
    ]
    path = f"{shared_dir(spark)}/tickloom/daily-{uuid.uuid4().hex}"
    b.select(*[v.alias(f) for f, v in zip(DAILY_FIELDS, values)]).write.csv(path, header=True)
    return read_daily_derivatives(spark, path)
