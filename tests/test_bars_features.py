"""Bars, revisions, lateness and features on literal rows."""

import math

import pytest
from pyspark.sql import functions as F

from tickloom.functions import scalars
from tickloom.operators import bars as B
from tickloom.operators import features as X

TICKS = "security_id long, event_time string, seq long, price double, volume long, trade_sign int, oi long"


def ticks(spark, rows):
    df = spark.createDataFrame([(1, f"2024-01-01 {t}", i, p, v, s, o) for i, (t, p, v, s, o) in enumerate(rows)], TICKS)
    return df.withColumn("event_time", F.col("event_time").cast("timestamp"))


def one(df):
    return df.collect()[0].asDict()


def test_three_trades_and_open_interest(spark):
    bar = one(B.build_bars(ticks(spark, [("09:15:00", 150.0, 100, 1, 5000), ("09:15:20", 152.0, 200, -1, 5200), ("09:15:40", 148.0, 150, 0, 5100)])))
    assert (bar["open"], bar["high"], bar["low"], bar["close"]) == (150, 152, 148, 148)
    assert (bar["volume"], bar["volume_delta"], bar["trade_count"]) == (450, -100, 3)
    assert (bar["oi_open"], bar["oi_high"], bar["oi_low"], bar["oi_close"]) == (5000, 5200, 5000, 5100)


def test_two_minutes_and_ties(spark):
    rows = [("09:15:30", 150.0, 100, 0, None), ("09:15:45", 152.0, 200, 0, None), ("09:16:10", 153.0, 150, 0, None), ("09:16:10", 154.0, 1, 0, None)]
    found = {str(r["event_time"])[11:16]: r for r in B.build_bars(ticks(spark, rows)).collect()}
    assert (found["09:15"]["high"], found["09:15"]["volume"]) == (152, 300)
    assert (found["09:16"]["open"], found["09:16"]["close"]) == (153, 154)


def test_price_can_be_missing(spark):
    df = ticks(spark, [("09:15:30", None, 5, 0, 10), ("09:15:40", 7.0, 5, 0, 20), (None, 1.0, 1, 0, 1)]).withColumn(
        "event_time", F.when(F.col("seq") < 2, F.col("event_time"))
    )
    bar = one(B.build_bars(df))
    assert (bar["low"], bar["trade_count"], bar["volume"], bar["oi_open"]) == (7, 1, 5, 10)
    assert one(B.build_bars(df, zero_price_fill=True))["low"] == 0


def test_correction(spark):
    closed = B.build_bars(ticks(spark, [("09:15:10", 150.0, 100, 0, 50)]))
    late = B.build_bars(ticks(spark, [("09:15:50", 155.0, 50, 0, None)]))
    bar = one(B.merge_bar_revisions(closed, late))
    assert (bar["revision"], bar["is_corrected"], bar["high"], bar["volume"], bar["open"], bar["close"]) == (1, True, 155, 150, 150, 155)
    assert (bar["oi_open"], bar["oi_close"], bar["correction_of"]) == (50, 50, bar["event_time"])
    assert one(B.merge_bar_revisions(closed.limit(0), late))["revision"] == 0


def test_three_partials_fold_like_a_loop(spark):
    """Rows with and without a closed bar, without prices or open interest, folded one by one and in one go."""
    rows = [("09:15:10", 150.0, 100, 0, 50), ("09:15:50", 155.0, 50, 1, None), ("09:15:20", None, 5, 0, 40), ("09:15:30", 149.0, 7, -1, None)]
    pieces = [B.build_bars(ticks(spark, [r])) for r in rows]
    values = ["open", "high", "low", "close", "volume", "volume_delta", "oi_open", "oi_high", "oi_low", "oi_close", "trade_count", "revision", "is_corrected"]
    for first in (pieces[0], pieces[0].limit(0)):
        kept = [(min, "open"), (max, "high"), (min, "low"), (max, "oi_high"), (min, "oi_low")]
        bars = [one(p) for p in ([pieces[0]] if first is pieces[0] else []) + pieces[1:]]
        want = bars[0]
        for p in bars[1:]:
            both = lambda c: [x for x in (want[c], p[c]) if x is not None]  # noqa: B023, E731
            want = want | {c: f(both(c), default=None) for f, c in kept} | {c: sum(both(c)) if both(c) else None for c in ("volume", "volume_delta", "trade_count")}
            want |= {c: p[c] if p[c] is not None else want[c] for c in ("close", "oi_close")} | {"revision": want["revision"] + 1, "is_corrected": True}
        late = [p.withColumn("came", F.lit(i)) for i, p in enumerate(pieces[1:])]
        (got,) = B.merge_bar_revisions(first, late[2].unionByName(late[0]).unionByName(late[1]), "came").collect()
        assert [got[c] for c in values] == [want[c] for c in values] and got["revision"] == len(bars) - 1
    with pytest.raises(Exception, match="several partials"):
        B.merge_bar_revisions(pieces[0], pieces[1].unionByName(pieces[2])).collect()


def test_nanoseconds_are_whole_numbers(spark):
    day = 86_400 * 10**9
    ns = [1_705_000_000_331_141_767, 19_800 * day - 1, 19_800 * day, -1, 0]
    df = spark.createDataFrame([(n,) for n in ns], "ns long")
    got = df.select(F.unix_micros(scalars.micros(F.col("ns"))).alias("us"), F.datediff(scalars.utc_date(F.col("ns")), F.lit("1970-01-01").cast("date")).alias("day")).collect()
    assert [(r["us"], r["day"]) for r in got] == [(n // 1000, n // day) for n in ns]


@pytest.mark.parametrize("at,kept", [("09:13:00", True), ("09:12:59", True), ("09:12:30", True), ("09:11:59", False), ("10:17:30", True)])
def test_lateness_counts_from_the_start_of_the_bucket(spark, at, kept):
    df = ticks(spark, [(at, 1.0, 1, 0, None)])
    assert (B.drop_late(df, F.lit("2024-01-01 09:17:30").cast("timestamp"), window_s=330).count() == 1) == kept


def test_ranges_and_quality(spark):
    bars = B.build_bars(ticks(spark, [("09:15:00", 1.0, 1, 0, None), ("09:16:00", 1.0, 1, 0, None), ("09:17:00", 1.0, 1, 0, None)]))
    between = B.bars_between(bars, 1, F.lit("2024-01-01 09:15:00").cast("timestamp"), F.lit("2024-01-01 09:16:30").cast("timestamp"))
    assert between.count() == 2
    q = one(B.bar_quality(bars.withColumn("arrival", F.col("event_time"))))
    assert (q["bars"], q["out_of_order"], q["empty"], q["outside_range"]) == (3, 0, 0, 0)
    late = F.when(F.minute("event_time") == 16, F.lit(0)).otherwise(F.minute("event_time"))
    q = one(B.bar_quality(bars.withColumn("arrival", late).withColumn("high", F.lit(0.5)).withColumn("trade_count", F.lit(0))))
    assert (q["bars"], q["out_of_order"], q["empty"], q["outside_range"]) == (3, 1, 3, 3)


def plain_features(bars, p=14):
    out, tr, gain, loss, pv, v = [], [], [], [], 0.0, 0
    atr = g = s = None
    for i, (h, low, c, vol, oi) in enumerate(bars):
        before = bars[i - 1][2] if i else None
        tr.append(h - low if before is None else max(h - low, abs(h - before), abs(low - before)))
        if i == p - 1:
            atr = sum(tr) / p
        elif i >= p:
            atr = (atr * (p - 1) + tr[-1]) / p
        if i:
            gain.append(max(c - before, 0.0))
            loss.append(max(before - c, 0.0))
            if i == p:
                g, s = sum(gain) / p, sum(loss) / p
            elif i > p:
                g, s = (g * (p - 1) + gain[-1]) / p, (s * (p - 1) + loss[-1]) / p
        pv, v = pv + (h + low + c) / 3 * vol, v + vol
        recent = [b[3] for b in bars[max(0, i - 19) : i + 1]]
        out.append(
            {
                "returns": (c - before) / before if before else None, "atr": atr, "vwap": pv / v if v else 0.0,
                "rsi": None if g is None else 100.0 if s == 0 else 100 - 100 / (1 + g / s),
                "rvol": None if i < 19 else vol / (sum(recent) / 20) if sum(recent) else 0.0,
                "oi_change": (oi - bars[i - 1][4]) / bars[i - 1][4] if i and oi is not None and bars[i - 1][4] else None,
            }
        )
    return out


def test_features_equal_a_plain_loop_over_many_blocks(spark):
    rows = []
    for i in range(900):
        c = 100 + 10 * math.sin(i / 7) + (i * 7919 % 13) / 5
        rows.append((c + 1 + i % 3, c - 1, c, i * 31 % 17, None if i % 10 == 0 else 100 + i % 7))
    df = spark.createDataFrame([(s, i, *r, 0) for s in (1, 2) for i, r in enumerate(rows)], "security_id long, k long, high double, low double, close double, volume long, oi_close long, revision int")
    df = df.withColumn("event_time", F.timestamp_seconds(F.col("k") * 60)).drop("k")
    want = plain_features(rows)
    for s in (1, 2):
        got = X.compute_features(df).filter(F.col("security_id") == s).orderBy("event_time").collect()
        for w, g in zip(want, got, strict=True):
            for name, x in w.items():
                assert (x is None) == (g[name] is None), name
                assert x is None or g[name] == pytest.approx(x, rel=1e-8, abs=1e-10), name


@pytest.mark.parametrize("period", [1, 2, 50, 100, 500])
def test_smoothing_for_any_period(spark, period):
    flat = lambda i: 130.0 if 900 <= i < 900 + min(1500, 240 * period) else 100 + 10 * math.sin(i / 7) + (i * 7919 % 13) / 5
    rows = [(flat(i) + 1 + i % 3, flat(i) - 1, flat(i), 1, 1) for i in range(3000)]
    df = spark.createDataFrame([(1, i, *r, 0) for i, r in enumerate(rows)], "security_id long, k long, high double, low double, close double, volume long, oi_close long, revision int")
    got = X.compute_features(df.withColumn("event_time", F.timestamp_seconds(F.col("k") * 60)), period=period).orderBy("event_time").collect()
    for w, g in zip(plain_features(rows, period), got, strict=True):
        for name in ("atr", "rsi"):
            assert (w[name] is None) == (g[name] is None), name
            assert w[name] is None or g[name] == pytest.approx(w[name], rel=1e-8, abs=1e-10), (name, g["event_time"])


def test_parity_and_available_time(spark):
    df = spark.createDataFrame([(1, 0, 1.0, None), (1, 60, 2.0, 3.0)], "security_id long, t long, a double, b double").withColumn("event_time", F.timestamp_seconds("t"))
    off = df.withColumn("a", F.col("a") + F.when(F.col("t") == 60, 1e-6).otherwise(0.0)).withColumn("b", F.lit(3.0))
    got = {r["feature"]: tuple(r)[1:] for r in X.feature_parity(df, off, ["a", "b"]).collect()}
    assert got == {"a": (2, 0, 1, 0, 0), "b": (2, 0, 0, 1, 1)}
    assert X.causal_filter(df, F.timestamp_seconds(F.lit(61))).count() == 1
    assert X.causal_filter(df, F.timestamp_seconds(F.lit(60))).count() == 0
