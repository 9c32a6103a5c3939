"""Frames, events, coverage and state machines on literal rows."""

import datetime as dt
import random
import struct

import pandas as pd
import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql import functions as F

from tickloom.operators import coverage as C
from tickloom.operators import events as E
from tickloom.sources import schemas
from tickloom.sources.frames import LAYOUTS, decode_batch, decode_frames
from tickloom.streaming.stateful import AtmState, HealthState, ShiftState, SwitchState


def packet(code, security_id, body, segment=2, length=None):
    return struct.pack("<BHbI", code, length or 8 + len(body), segment, security_id) + body


def target():
    return to_arrow_schema(StructType.fromDDL(schemas.PACKETS))


def packets_of(frame):
    """The packets of one frame without what they lack."""
    _, columns = decode_batch(pa.array([frame], pa.binary()), target())
    return [{k: v for k, v in row.items() if v is not None} for row in pa.table(columns).to_pylist()]


def plain_packets(frame):
    """The same, by a loop."""
    at, nth, out = 0, 0, []
    while at + 8 <= len(frame):
        code, length, segment, security_id = struct.unpack_from("<BHbI", frame, at)
        if length < 8 or at + length > len(frame):
            break
        if code in LAYOUTS:
            kind, layout, names = LAYOUTS[code]
            size = struct.calcsize(layout)
            if length >= 8 + size:
                row = {k: v for k, v in zip(names, struct.unpack_from(layout, frame, at + 8)) if k in target().names}
                if kind == "full":
                    levels = [struct.unpack_from("<iiHHff", frame, at + 8 + size + 20 * i) for i in range(min(5, (length - 8 - size) // 20))]
                    row["depth"] = [dict(zip(("bid_qty", "ask_qty", "bid_orders", "ask_orders", "bid", "ask"), x)) for x in levels]
                out.append(row | {"packet_offset": nth, "packet_type": kind, "response_code": code, "exchange_segment": segment, "security_id": security_id})
        at, nth = at + length, nth + 1
    return out


def test_packets_of_many_frames(spark):
    """Frames of all codes, unknown ones, short bodies, cut ends and nulls, as slices of an array too."""
    pick = random.Random(4)
    numbers = lambda layout: struct.pack(layout, *[pick.uniform(-9, 9) if c == "f" else pick.randint(0, 99) for c in layout[1:]])
    frames = [None, b""]
    for _ in range(300):
        parts = []
        for _ in range(pick.randint(0, 6)):
            code = pick.choice([2, 4, 5, 6, 8, 8, 1, 7, 50, 200])
            body = numbers(LAYOUTS[code][1]) if code in LAYOUTS else b"x" * pick.randint(0, 9)
            if code == 8:
                body += b"".join(numbers("<iiHHff") for _ in range(pick.randint(0, 6)))
            parts.append(packet(code, pick.randint(0, 2**32 - 1), body[: len(body) - pick.choice([0, 0, 0, 0, 1, 3])], pick.randint(-128, 127)))
        whole = b"".join(parts)
        frames.append(whole[: len(whole) - pick.choice([0, 0, 0, 1, 5])])
    want = [(i, p) for i, f in enumerate(frames) for p in plain_packets(f or b"")]
    for first in (0, 7):
        rows, columns = decode_batch(pa.array(frames, pa.binary())[first:], target())
        got = [{k: v for k, v in row.items() if v is not None} for row in pa.table(columns).to_pylist()]
        assert list(zip((rows + first).tolist(), got)) == [(i, p) for i, p in want if i >= first]
    assert len({p["packet_type"] for _, p in want}) == 5


QUOTE = struct.pack("<fhIfIIIffff", 25230.0, 5, 1700000000, 25200.0, 900, 10, 20, 1.0, 2.0, 3.0, 0.5)
OI = struct.pack("<i", 1250000)


def test_packets_of_a_frame(spark):
    frame = packet(4, 57340, QUOTE) + packet(5, 57340, OI) + packet(5, 57341, OI, 99)
    got = list(packets_of(frame))
    assert [(p["packet_type"], p["security_id"], p["packet_offset"]) for p in got] == [("quote", 57340, 0), ("oi", 57340, 1), ("oi", 57341, 2)]
    assert got[0]["ltp"] == 25230.0 and got[1]["oi"] == 1250000 and got[2]["exchange_segment"] == 99
    assert [p["prev_oi"] for p in packets_of(packet(6, 1, struct.pack("<fi", 25100.0, 1200000)))] == [1200000]


def test_odd_frames(spark):
    good = packet(5, 1, OI)
    for frame, n in [(b"", 0), (good[:5], 0), (packet(50, 1, b"xx"), 0), (packet(50, 1, b"xx") + good, 1), (packet(5, 1, OI, 2, 9999), 0), (good + good[:9], 1), (good + bytes(8), 1)]:
        assert len(list(packets_of(frame))) == n
    assert list(packets_of(struct.pack("<BHbI", 5, 0, 0, 1) + OI)) == []


def test_full_packet_has_depth(spark):
    body = struct.pack("<fhIfIIIiiiffff", 1.5, 1, 2, 3.0, 4, 5, 6, 7, 8, 9, 1.0, 2.0, 3.0, 4.0) + b"".join(struct.pack("<iiHHff", i, i, 1, 1, i + 0.5, i + 1.5) for i in range(5))
    (p,) = packets_of(packet(8, 9, body))
    assert (p["oi"], len(p["depth"]), p["depth"][4]["ask"]) == (7, 5, 5.5)
    assert len(packets_of(packet(8, 9, body[:-1]))[0]["depth"]) == 4
    assert packets_of(packet(8, 9, body[:51])) == [] and [p["packet_offset"] for p in packets_of(packet(5, 9, OI[:3]) + packet(5, 9, OI))] == [1]


def test_decode_job(spark):
    df = spark.createDataFrame([(bytearray(packet(5, 7, OI)), 1, "c", 0), (None, 2, "c", 1)], "frame binary, receive_ts_ns long, connection_id string, websocket_message_id int")
    (row,) = decode_frames(df).collect()
    assert (row["security_id"], row["oi"], row["receive_ts_ns"], row["depth"]) == (7, 1250000, 1, None)


def test_event_ids_and_envelopes(spark):
    df = spark.createDataFrame(
        [("c", 1, 0, bytearray(b"x"), "success", "{}", 5, None), ("c", 1, 0, bytearray(b"y"), "failed", "{}", 5, None), ("c", 1, 1, None, "", None, None, "given")],
        "connection_id string, message_id long, packet_offset int, raw_payload binary, decode_status string, decoded_payload string, last_trade_time long, event_id string",
    )
    got = E.to_envelope(df, F.lit(9)).collect()
    assert len({r["event_id"] for r in got}) == 3 and len(got[0]["event_id"]) == 64 and got[2]["event_id"] == "given"
    assert got[2]["payload_hash"] == "" and got[1]["decoded_payload"] is None and got[0]["exchange_ts_ns"] == 5_000_000_000
    kept, failed = E.route_by_status(E.to_envelope(df, F.lit(9)))
    assert (kept.count(), failed.count()) == (1, 2)


def test_conservation(spark):
    rows = [(o,) for o, n in zip(E.OUTCOMES, (85, 5, 3, 5, 2)) for _ in range(n)]
    assert E.conservation_check(spark.createDataFrame(rows, "outcome string")).first()["balanced"]
    assert not E.conservation_check(spark.createDataFrame([*rows, (None,)], "outcome string")).first()["balanced"]


def test_readiness_levels(spark):
    latest = spark.createDataFrame([(c, c != "d") for c in "abcd"], "contract_id string, quote_ready boolean")
    contracts = latest.select("contract_id")
    assert E.readiness_level(latest, contracts, min_ratio=0.5).first()["enough"]
    assert not E.readiness_level(latest, contracts, strict=True).first()["enough"]
    assert E.readiness_level(latest, contracts.limit(0), strict=True).first()["enough"]


def test_refcounts_never_fall_below_zero(spark):
    log = spark.createDataFrame([(1, "a", "add", 1), (1, "b", "add", 2), (1, "a", "add", 3), (2, "a", "remove", 4), (2, "a", "add", 5), (2, "a", "remove", 6)], "security_id int, consumer_id string, op string, seq long")
    got = {(r["security_id"], r["consumer_id"]): (r["refs"], r["total"]) for r in C.subscription_refcount(log).collect()}
    assert got == {(1, "a"): (2, 3), (1, "b"): (1, 3), (2, "a"): (0, 0)}


def test_gaps(spark):
    at = [0, 30, 130, 600]
    df = spark.createDataFrame([(1, i, t) for i, t in enumerate(at)], "security_id int, seq long, t long").withColumn("ts", F.timestamp_seconds("t"))
    r = C.packet_gaps(df, F.timestamp_seconds(F.lit(0)), F.timestamp_seconds(F.lit(600))).first()
    assert (r["longest_gap"], r["warnings"], r["stalls"], r["stalled_s"]) == (470, 1, 1, 470)
    assert sorted(x["gap_s"] for x in C.feed_gaps(df, 100).collect()) == [30, 100, 470]


def steps(processor, rows, columns):
    state, out = {}, []
    for row in rows:
        out += processor.step(("k",), state, dict(zip(columns, row, strict=True)))
    return out


def at(s):
    return pd.Timestamp(dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s))


def test_shift_needs_repeats_and_time():
    columns = ["event_time", "old_atm", "candidate_atm"]
    got = steps(ShiftState(3, 2000), [(at(i), 100.0, 110.0) for i in range(4)], columns)
    assert [e["event_type"] for e in got] == ["DETECTED", "CONFIRMED"]
    got = steps(ShiftState(3, 2000), [(at(i / 10), 100.0, 110.0) for i in range(9)], columns)
    assert [e["event_type"] for e in got] == ["DETECTED"]
    got = steps(ShiftState(3, 2000), [(at(0), 100.0, 110.0), (at(1), 100.0, 120.0), (at(2), 100.0, 122.0)], columns)
    assert [e["new_atm"] for e in got] == [110.0, 120.0]


def test_switch_timeline():
    columns = ["event_time", "kind", "security_ids"]
    rows = [(at(0), "request", [1, 2]), (at(1), "ready", [1]), (at(2), "ready", [2, 9]), (at(3), "request", [2, 3]), (at(4), "ready", [2, 3]), (at(63), "tick", None), (at(64), "tick", None)]
    got = [(e["event_type"], e["security_ids"]) for e in steps(SwitchState(10, 30, 60), rows, columns)]
    assert got == [("REQUESTED", [1, 2]), ("SWITCHED", [1, 2]), ("REQUESTED", [2, 3]), ("SWITCHED", [2, 3]), ("RELEASED", [1])]
    late = steps(SwitchState(10, 30, 60), [(at(0), "request", [1]), (at(11), "tick", None)], columns)
    assert late[-1]["event_type"] == "FAILED"
    slow = steps(SwitchState(10, 30, 60), [(at(0), "request", [1, 2]), (at(1), "ready", [1]), (at(31), "tick", None)], columns)
    assert slow[-1]["state_after"] == "FAILED"


def test_atm_ties_go_up_and_hold():
    columns = ["event_time", "kind", "value"]
    rows = [(at(0), "strike", 1440.0), (at(0), "strike", 1450.0), (at(1), "spot", 1445.0), (at(2), "spot", 1446.5), (at(3), "reset", None), (at(4), "spot", 1.0)]
    assert [e["atm"] for e in steps(AtmState(0.003), rows, columns)] == [1450.0, 1450.0]


def test_feed_health():
    columns = ["event_time", "security_id", "generation"]
    rows = [(at(0), 1, 0), (at(1), 2, 0), (at(200), 1, 0), (at(201), 1, 1)]
    got = [e["state_after"] for e in steps(HealthState(2, 120), rows, columns)]
    assert got == ["FIRST_PACKET", "HEALTHY", "STALLED", "HEALTHY", "FIRST_PACKET"]


def test_streak_ladder(spark):
    df = spark.createDataFrame([(1, i, ok) for i, ok in enumerate([True, False, False, False, False, False, True])], "security_id int, seq long, healthy boolean").withColumn("ts", F.timestamp_seconds("seq"))
    got = [r["health"] for r in C.failure_streak_health(df).orderBy("seq").collect()]
    assert got == ["HEALTHY", "DEGRADED_WARNING", "DEGRADED", "DEGRADED", "DEGRADED", "BLOCKED", "HEALTHY"]
