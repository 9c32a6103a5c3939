"""Files, commits, checksums and counters that hold whatever the order of rows, writers and batches is."""

import datetime as dt
import hashlib
import random
import threading
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickloom.operators import audit as A
from tickloom.operators import instruments as I
from tickloom.operators import research as R
from tickloom.operators import universe as U
from tickloom.operators import validation as V
from tickloom.sources import tables as S
from tickloom.streaming import stateless

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def test_silver_files_hold_spans_of_time(spark, tmp_path):
    rows = [(i % 7, at(60 * (i * 37 % 1000)), i, None if i % 90 == 0 else 5.0, -1 if i % 71 == 0 else 3) for i in range(1000)] + [(1, None, 5000, 2.0, 1)]
    ticks = spark.createDataFrame(rows, "security_id int, event_time timestamp, seq int, price double, volume int").repartition(5)
    path = f"{tmp_path}/silver"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    S.write_silver(R.silver_flags(ticks, F.lit("2024-01-01 12:00:00").cast("timestamp")), path)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    index = spark.read.parquet(f"{path}/index").orderBy("low").collect()
    good = [r for r in rows if r[1] is not None and r[3] is not None and r[4] >= 0]
    assert len(index) >= 3 and sum(r["n_rows"] for r in index) == len(good)
    assert all(a["high"] <= b["low"] for a, b in zip(index, index[1:]))
    low, high = (F.lit(at(60 * m)).cast("timestamp") for m in (100, 130))
    assert 0 < len(S.silver_files(spark, path, low, high)) < len(index)
    got = S.read_silver(spark, path, low, high)
    assert sorted(r["seq"] for r in got.collect()) == sorted(r[2] for r in good if at(6000) <= r[1] <= at(7800))
    for file in {r["file"] for r in index}:
        inside = [(r["event_time"], r["security_id"]) for r in spark.read.parquet(file).collect()]
        assert inside == sorted(inside)
    assert S.read_silver_quarantine(spark, path).count() == len(rows) - len(good)
    assert S.read_silver(spark, path, F.lit(at(10**7)).cast("timestamp"), F.lit(at(10**8)).cast("timestamp")).count() == 0


def test_two_writers_of_one_snapshot_leave_one_row(spark, tmp_path):
    one = spark.createDataFrame([("id1", ["a", "b"], {"a": 1.0})], "universe_snapshot_id string, eligible array<string>, atm_strikes map<string,double>")
    one = one.withColumns({"contracts": F.array(F.lit("c")), "expiry_dates": F.create_map(F.lit("a"), F.lit("2024-01-25"))})
    path, failed = f"{tmp_path}/universe", []

    def save():
        try:
            S.save_universe_snapshot(one, path)
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    writers = [threading.Thread(target=save) for _ in range(4)]
    for w in writers:
        w.start()
    for w in writers:
        w.join()
    S.save_universe_snapshot(one.withColumn("universe_snapshot_id", F.lit("id2")), path)
    found = S.universe_snapshots(spark, path).collect()
    assert not failed and sorted(r["universe_snapshot_id"] for r in found) == ["id1", "id2"]
    assert found[0]["atm_strikes"] == {"a": 1.0} and found[0]["eligible"] == ["a", "b"] and found[0]["expiry_dates"] == {"a": "2024-01-25"}
    assert S.latest_universe_snapshot(spark, path).first()["universe_snapshot_id"] == "id2"


def test_a_failed_attempt_is_not_read(spark, tmp_path):
    one = spark.createDataFrame([("id1", ["a"])], "universe_snapshot_id string, eligible array<string>").withColumns(
        {"contracts": F.array(F.lit("c")), "expiry_dates": F.create_map(F.lit("a"), F.lit("x")), "atm_strikes": F.create_map(F.lit("a"), F.lit(1.0))}
    )
    S.save_universe_snapshot(one, f"{tmp_path}/u")
    spark.read.parquet(f"{tmp_path}/u/rows").drop("attempt").write.parquet(f"{tmp_path}/u/rows/attempt=lost")
    assert spark.read.parquet(f"{tmp_path}/u/rows").count() == 2 and S.universe_snapshots(spark, f"{tmp_path}/u").count() == 1


def test_checksum_is_that_of_the_stated_text(spark):
    rows = [(1, 2.5, "x", at(1), None, True, [1]), (2, float("nan"), None, None, dt.date(2024, 1, 2), False, None), (1, 2.5, "x", at(1), None, True, [1])]
    df = spark.createDataFrame(rows, "b long, a double, c string, t timestamp, d date, f boolean, e array<int>")
    text = lambda b, a, c, t, d, f, e: "|".join(
        ["nan" if a != a else str(Decimal(a).quantize(Decimal("0.000001"))), str(b), c or "~", str(d or "~"), "~" if e is None else str(e).replace(" ", ""), str(f).lower(), str(int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 10**6)) if t else "~"]
    )
    want = sum(int(hashlib.md5(text(*r).encode()).hexdigest()[:12], 16) for r in rows)
    sums = [d.agg(A.content_checksum(d)).first()[0] for d in (df, df.select(*reversed(df.columns)).repartition(3), df.limit(0), df.distinct())]
    assert sums[:3] == [str(want), str(want), "0"] and sums[3] != sums[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_leakage_is_that_of_all_pairs(spark, seed):
    """Many rows of one moment, rows repeated, intervals without length, other columns."""
    pick = random.Random(seed)
    rows = [(i, t, t + pick.choice([0, 0, 5, 40]), pick.random() < 0.5) for i in range(300) for t in [pick.choice([100, 100, 100, pick.randint(0, 3000)])]]
    rows += rows[:5]
    schema = "row_id int, prediction_time timestamp, evaluation_time timestamp, side boolean, _range int"
    df = spark.createDataFrame([(i, at(a), at(b), s, 7) for i, a, b, s in rows], schema).repartition(4)
    want = sorted(i for i, a, b, s in rows if s and any(a <= d and b >= c for _, c, d, other in rows if not other))
    got = V.temporal_leakage(df.filter("side"), df.filter("NOT side"))
    assert got.columns == df.columns and sorted(r["row_id"] for r in got.collect()) == want and 0 < len(want) < 200
    assert V.temporal_leakage(df.filter("side"), df.limit(0)).count() == 0 and V.temporal_leakage(df.limit(0), df).count() == 0


def test_audit_without_rows_or_metadata(spark):
    bars = spark.createDataFrame([], "security_id int, event_time timestamp, volume long")
    contracts = spark.createDataFrame([], "security_id int, symbol string, exchange string, instrument_type string, expiry_date date, strike_price double, option_type string, lot_size int")
    manifest = spark.createDataFrame([(None, None)], "metadata map<string,string>, coverage_start date")
    got = {r["check"]: r["passed"] for r in A.audit_source(bars, contracts, manifest).collect()}
    assert list(got) == list(A.CHECKS) and {k for k, v in got.items() if v} == {"duplicate_primary_keys", "unexplained_negative_volume"}


def test_route_counters_balance(spark, tmp_path):
    schema = "event_id string, event_time timestamp, decode_status string, decoded_payload string"
    rows = [(f"e{i % 40}", at(i), "success" if i % 3 else "failed", None if i % 7 == 0 else "{}") for i in range(60)]
    spark.createDataFrame(rows, schema).repartition(4).write.parquet(f"{tmp_path}/in")
    listener = stateless.RouteCounters()
    spark.streams.addListener(listener)
    try:
        source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        done = stateless.run_to_end(stateless.counted_route(source), f"{tmp_path}/c", each=stateless.route_batch(f"{tmp_path}/kept", f"{tmp_path}/failed"))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    kept, failed = (spark.read.parquet(f"{tmp_path}/{x}").count() for x in ("kept", "failed"))
    batches = [stateless.batch_counters(p) for p in done.recentProgress]
    assert (sum(b["persisted"] for b in batches), sum(b["quarantined"] for b in batches), sum(b["dropped"] for b in batches)) == (kept, failed, 20)
    assert kept + failed == 40 and listener.balanced and listener.sums["received"] == 60 and listener.batches == len(batches) >= 4


def test_replays_differ_by_rows_and_repeats(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "k int, v string")
    b = spark.createDataFrame([("x", 1), (None, 2), ("y", 3)], "v string, k int")
    assert tuple(stateless.replay_difference(a, b).first()) == (3, 3, 1, 1)
    assert tuple(stateless.replay_difference(a, a.repartition(2)).first()) == (3, 3, 0, 0)


def test_segments_start_anew(spark):
    rows = [(1, i, 100.0 if i < 2 else 200.0, 10.0 + i, 10, 4 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "slot int, event_time int, strike double, close double, volume long, oi_close long").withColumns({"high": F.col("close"), "low": F.col("close")})
    got = [(r["rolling_segment_id"], r["oi_change"], r["vwap"]) for r in R.segment_features(df).orderBy("event_time").collect()]
    assert got == [(0, None, 10.0), (0, 0.25, 10.5), (1, None, 12.0), (1, 1 / 6, 12.5)]


def test_intervals_of_rows(spark):
    rows = [(1, "OPTSTK", "a", 10.0), (2, "OPTSTK", "a", 25.0), (3, "EQUITY", "a", 0.0), (4, "OPTSTK", "b", 5.0), (5, "OPTSTK", "c", 0.0), (6, "OPTIDX", None, 5.0)]
    df = spark.createDataFrame(rows, "security_id int, instrument_type string, symbol string, strike_price double").withColumn("expiry_date", F.lit("2024-01-25").cast("date"))
    assert {r["security_id"]: r["strike_interval"] for r in I.with_strike_interval(df).collect()} == {1: 15.0, 2: 15.0, 3: 0.0, 4: 10.0, 5: 0.0, 6: 0.0}


def test_strike_is_kept_by_its_share_of_the_least_gap(spark):
    keys = {"symbol": F.lit("X"), "expiry_date": F.lit("2024-01-25").cast("date")}
    strikes = spark.createDataFrame([(100.0,), (105.0,), (125.0,)], "strike double").withColumns(keys)
    for new, old, ratio, want in [(105.0, 100.0, 0.5, 105.0), (105.0, 100.0, 1.5, 100.0), (125.0, 100.0, 5.0, 125.0), (125.0, 100.0, 5.5, 100.0), (105.0, 110.0, 9.0, 105.0)]:
        atm, before = (spark.createDataFrame([(x, x)], "spot double, atm double").withColumns(keys) for x in (new, old))
        assert U.keep_atm(atm, before, strikes, ratio=ratio).first()["atm"] == want
