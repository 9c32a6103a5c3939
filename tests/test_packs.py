"""Ticks of a key travel to its bars in packs, and a state is handed over as a few values, however many bars it has."""

import datetime as dt
import random

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from tickloom.operators.bars import build_bars
from tickloom.plans.live import _stateful
from tickloom.streaming import keyed, stateless

SCHEMA = "security_id long, event_time timestamp, seq long, price double, volume long, trade_sign int, oi long"


class _Kept:
    """The handle of a state and its only value, which notes what it is given."""

    def __init__(self):
        self.value, self.given = None, []

    def getValueState(self, name, schema):
        return self

    def registerTimer(self, at):
        pass

    def getCurrentWatermarkInMs(self):
        return 0

    def get(self):
        return self.value

    def update(self, value):
        self.value = value
        self.given.append(sum(len(v) if isinstance(v, list) else 1 for v in value))


def test_a_state_is_few_values_however_many_bars_it_has():
    n, kept, state = 600, _Kept(), keyed.BarState(60_000, 300_000, 600_000)
    state.init(kept)
    column = lambda c: np.arange(n) % 200 if c == "security_id" else np.full(n, keyed.NONE) if c in ("oi", "price") else np.full(n, 60_000_000)
    ticks = np.stack([column(c) if c != "price" else np.full(n, 2.5).view("<i8") for c in keyed._PACKED], 1).astype("<i8")
    for _ in range(2):
        out = list(state.handleInputRows((0, 0), iter([pd.DataFrame({"ticks": [ticks[:300].tobytes(), ticks[300:].tobytes()]})]), kept))
    assert kept.given == [len(keyed._TYPES)] * 2
    bars = out[-1]
    assert len(bars) == 200 and set(bars["trade_count"]) == {6} and set(bars["updates"]) == {2} and set(bars["open"]) == {2.5} and bars["oi_low"].isna().all()


def test_packed_bars_are_those_of_the_batch(spark, tmp_path):
    """Ticks with and without a security, a price, a volume or open interest, more of a key than a pack holds."""
    pick = random.Random(3)
    when = lambda: dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(microseconds=pick.randint(0, 170_000_000))
    rows = [
        (pick.choice([None, 1, 2, 300, -5]), when(), 2**60 + i, pick.choice([None, 1.0, -0.0, 3.5]), pick.choice([None, *range(9)]), pick.choice([0, 1, -1, None]), pick.choice([None, 5, 8]))
        for i in range(1200)
    ]
    _stateful(spark)
    stream = None
    for part in (rows[:900], rows[900:]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"))
        stateless.run_to_end(stream, f"{tmp_path}/checkpoint", "append", f"{tmp_path}/out")
    columns = ["security_id", "event_time", "open", "high", "low", "close", "volume", "volume_delta", "oi_open", "oi_high", "oi_low", "oi_close", "trade_count"]
    changes = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    known = lambda df: sorted(str(tuple(r)) for r in df.filter("trade_count > 0").select(*columns).collect())
    ticks = spark.createDataFrame([(r[:4] + (r[4] or 0,) + r[5:]) for r in rows], SCHEMA)
    assert known(keyed.newest_bars(changes)) == known(build_bars(ticks))


def test_ticks_are_packed_by_key(spark):
    spread = spark.range(2000).select((F.col("id") % 3).alias("near"), F.when(F.col("id") % 2 == 0, 7).cast("long").alias("span"), *[F.col("id").alias(c) for c in ("security_id", "begun")], F.when(F.col("id") % 2 == 0, F.col("id")).alias("at"), F.col("id").alias("seq"), F.lit(None).cast("double").alias("price"), *[F.lit(None).cast("long").alias(c) for c in ("volume", "trade_sign", "oi")])
    packs = spread.coalesce(1).mapInArrow(keyed._packs, "near long, span long, event_time timestamp, ticks binary").collect()
    assert len(packs) == 6 * -(-(2000 // 6) // keyed.PACK)
    found = []
    for p in packs:
        ticks = keyed._unpacked([bytes(p["ticks"])])
        assert set(ticks["seq"] % 3) == {p["near"]} and {7 if n % 2 == 0 else None for n in ticks["seq"]} == {p["span"]}
        assert (p["event_time"] is None) == (p["span"] is None) and (p["span"] is None or p["event_time"].microsecond == max(ticks["at"]))
        assert len(ticks["seq"]) <= keyed.PACK
        found += ticks["seq"].tolist()
    assert sorted(found) == list(range(2000))


def test_old_ticks_beside_others_are_rejected(spark, tmp_path):
    tick = lambda s, seq: (1, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc) + dt.timedelta(seconds=s), seq, 1.0, 1, 1, None)
    _stateful(spark)
    stream = None
    for part in ([tick(1200, 1)], [tick(1300, 2)], [tick(10, 3), tick(1210, 4)], [tick(20, 5)]):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = stream or keyed.stream_revised_bars(spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in"))
        stateless.run_to_end(stream, f"{tmp_path}/checkpoint", "append", f"{tmp_path}/out")
    out = spark.read.schema(stream.schema).parquet(f"{tmp_path}/out")
    assert [r["seq"] for r in out.filter("kind = 'late'").collect()] == [3]
    assert {(r["trade_count"], r["revision"]) for r in keyed.newest_bars(out).collect()} == {(2, 1), (1, 0)}
