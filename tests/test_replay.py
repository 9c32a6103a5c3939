"""Streams fed in slices of time against plain Python over the same rows, and revisions of streamed bars."""

import ast
import datetime as dt
import math
import os
import random
from collections import defaultdict

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickloom.operators.bars import build_bars
from tickloom.plans import live
from tickloom.plans.live import _stateful
from tickloom.streaming import keyed, stateful, stateless

DATA, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def by_hand(processor, rows, key, columns):
    """Events of each key's rows in the order of time; limits that pass by the last moment of all rows are expired."""
    keys, out = defaultdict(list), []
    for r in rows:
        keys[r[key]].append({**r.asDict(), "event_time": pd.Timestamp(r["event_time"]).tz_localize(None)})
    last = max(r["event_time"] for own in keys.values() for r in own).value / 1e9
    for name, own in keys.items():
        state = {}
        for row in sorted(own, key=lambda r: r["event_time"]):
            out += processor.step((name,), state, row)
        out += processor.expire((name,), state, last)
    return sorted(tuple(str(e[c]) for c in columns) for e in out)


def plain(found, columns):
    return sorted(tuple(str(pd.Timestamp(r[c]) if c == "event_time" else r[c]) for c in columns) for r in found.collect())


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_switches_in_slices(spark):
    columns = ["underlying", "event_time", "event_type", "generation", "state_before", "state_after", "security_ids"]
    want = by_hand(stateful.SwitchState(3600, 7200, 3600), live.switch_rows(spark, DATA).collect(), "underlying", columns)
    want = sorted((*w[:-1], ",".join(map(str, ast.literal_eval(w[-1])))) for w in want)
    assert len(want) > 20
    assert plain(live.stream_switches(spark, DATA, at_once=300), columns) == want


@pytest.mark.skipif(not os.path.isdir(LARGER), reason="no tables here")
def test_health_in_slices(spark):
    columns = ["connection_id", "event_time", "state_before", "state_after", "distinct_ids"]
    desired = live._sets(spark, LARGER)["desired"].select("security_id").distinct()
    rows = live.health_rows(spark, LARGER).join(desired, "security_id", "left_semi").collect()
    want = by_hand(stateful.HealthState(30, 1800), rows, "connection_id", columns)
    assert len({w[3] for w in want}) == 3
    assert plain(live.stream_feed_health(spark, LARGER, at_once=2500), columns) == want


def test_late_ticks_raise_the_revision_of_bars_that_were_over(spark, tmp_path):
    at = lambda s: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s)
    schema = "security_id long, event_time timestamp, seq long, price double, volume long, trade_sign int, oi long"
    tick = lambda s, seq, price, sign=1: (1, at(s), seq, price, 10, sign, None)
    _stateful(spark)
    base, stream, late = f"{tmp_path}/in", None, []
    parts = [tick(1, 1, 5.0), tick(70, 2, 7.0)], [tick(80, 3, 8.0)], [tick(30, 4, 4.0, -1)], [tick(200, 6, 9.0)], [tick(40, 5, 6.0), tick(90, 7, 1.0)], [tick(700, 8, 2.0)], [tick(350, 9, 3.0), tick(610, 10, None)]
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(base)
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(schema).parquet(base))
        stateless.run_to_end(stream, f"{tmp_path}/checkpoint", "append", f"{tmp_path}/out")
    changes = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    found = keyed.newest_bars(changes).orderBy("event_time").collect()
    got = [(r["open"], r["high"], r["low"], r["close"], r["volume_delta"], r["revision"], r["is_corrected"], r["correction_of"] is None) for r in found]
    assert got[:3] == [(5.0, 6.0, 4.0, 6.0, 10, 2, True, False), (7.0, 8.0, 1.0, 1.0, 30, 1, True, False), (9.0, 9.0, 9.0, 9.0, 10, 0, False, True)]
    late = changes.filter("kind = 'late'").select("seq", F.unix_seconds("event_time")).collect()
    assert [tuple(r) for r in late] == [(9, int(at(350).timestamp()))]
    assert got[3:] == [(None, None, None, None, None, 0, False, True), (2.0, 2.0, 2.0, 2.0, 10, 0, False, True)]


def test_streamed_bars_are_those_of_the_batch(spark, tmp_path):
    """Ticks without price, open interest or sign, ties of time, and bars that several batches fill."""
    pick = random.Random(8)
    schema = "security_id long, event_time timestamp, seq long, price double, volume long, trade_sign int, oi long"
    when = lambda: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=pick.randint(0, 170))
    rows = [(pick.randint(1, 3), when(), i, pick.choice([None, 1.0, 2.0, 3.5]), pick.randint(0, 9), pick.choice([0, 1, -1]), pick.choice([None, 5, 8])) for i in range(120)]
    _stateful(spark)
    stream = None
    for part in (rows[:50], rows[50:80], rows[80:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"))
        stateless.run_to_end(stream, f"{tmp_path}/checkpoint", "append", f"{tmp_path}/out")
    columns = ["security_id", "event_time", "open", "high", "low", "close", "volume", "volume_delta", "oi_open", "oi_high", "oi_low", "oi_close", "trade_count"]
    got = keyed.newest_bars(spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")).select(*columns).collect()
    assert sorted(map(str, got)) == sorted(map(str, build_bars(spark.createDataFrame(rows, schema)).select(*columns).collect()))


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no tables here")
def test_expiries_in_slices(spark):
    """The strikes held by each expiry, by a loop; state goes from slice to slice."""
    ticks = live.ticks(spark, DATA).select(F.col("security_id").cast("string").alias("s"), "event_time", "seq", "price").collect()
    want = []
    for expiry, step in (("far", 25), ("near", 10)):
        for symbol in {r["s"] for r in ticks}:
            own = sorted((r for r in ticks if r["s"] == symbol), key=lambda r: (r["event_time"], r["seq"]))
            strikes = sorted({math.floor(r["price"] / step + 0.5) * float(step) for r in own})
            gap, held, later = min((b - a for a, b in zip(strikes, strikes[1:])), default=0), None, False
            for r in own:
                if not later and pd.Timestamp(r["event_time"]).tz_localize(None) >= pd.Timestamp("2024-01-15"):
                    held, later = None, True
                nearest = min(strikes, key=lambda k: (abs(k - r["price"]), -k))  # noqa: B023
                atm = held if held is not None and gap > 0 and abs(nearest - held) < 2.5 * gap else nearest
                want.append((symbol, expiry, r["seq"], atm, atm != held))
                held = atm
    got = [(r["symbol"], r["expiry"], r["seq"], r["atm"], r["changed"]) for r in live.stream_atm_expiries(spark, DATA, at_once=900).collect()]
    assert sorted(got) == sorted(want) and {c for *_, c in want} == {True, False}
