"""Binary feed frames decoded into packets.

A frame holds packets one after the other, little endian, each with an 8-byte header: code (u8), total length (u16),
segment (i8), security id (u32).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tickloom.sources import schemas

HEADER = np.dtype([("code", "u1"), ("length", "<u2"), ("segment", "i1"), ("security_id", "<u4")])
#: Packet codes, their layouts and the names of their fields.
LAYOUTS = {
    2: ("ticker", "<fI", ("ltp", "last_trade_time")),
    4: (
        "quote", "<fhIfIIIffff",
        ("ltp", "last_trade_qty", "last_trade_time", "atp", "volume", "total_sell_qty", "total_buy_qty", "day_open", "day_close", "day_high", "day_low"),
    ),
    5: ("oi", "<i", ("oi",)),
    6: ("prev_close", "<fi", ("prev_close", "prev_oi")),
    8: (
        "full", "<fhIfIIIiiiffff",
        ("ltp", "last_trade_qty", "last_trade_time", "atp", "volume", "total_sell_qty", "total_buy_qty", "oi", "oi_high", "oi_low", "day_open", "day_close", "day_high", "day_low"),
    ),
}
#: One level of the depth that follows the body of a full packet, and how many levels there are at most.
DEPTH = ("<iiHHff", ("bid_qty", "ask_qty", "bid_orders", "ask_orders", "bid", "ask"))
LEVELS = 5
_NUMPY = {"f": "<f4", "h": "<i2", "I": "<u4", "i": "<i4", "H": "<u2"}


def _record(layout: str, names: tuple[str, ...]) -> np.dtype:
    return np.dtype([(n, _NUMPY[c]) for n, c in zip(names, layout[1:], strict=True)])


_BODY = {code: (kind, _record(layout, names)) for code, (kind, layout, names) in LAYOUTS.items()}
_LEVEL = _record(*DEPTH)


def _records(data: np.ndarray, at: np.ndarray, kind: np.dtype) -> np.ndarray:
    """The records of one kind that begin at some places, copied out in one go."""
    return np.ascontiguousarray(data[at[:, None] + np.arange(kind.itemsize)]).view(kind)[:, 0]


def _walk(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Frame, number in the frame, place and header of all packets: step n reads the nth header of every frame that still
    has one. A header or packet that is cut short, or a length below that of a header, ends its frame."""
    frame, at, found, nth = np.arange(len(begin)), begin, [], 0
    while True:
        whole = at + HEADER.itemsize <= end[frame]
        frame, at = frame[whole], at[whole]
        headers = _records(data, at, HEADER)
        length = headers["length"].astype(np.int64)
        good = (length >= HEADER.itemsize) & (at + length <= end[frame])
        frame, at, headers = frame[good], at[good], headers[good]
        if not len(frame):
            break
        found.append((frame, np.full(len(frame), nth), at, headers))
        at, nth = at + length[good], nth + 1
    if not found:
        none = np.zeros(0, np.int64)
        return none, none, none, np.zeros(0, HEADER)
    frame, number, at, headers = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((number, frame))
    return frame[order], number[order], at[order], headers[order]


def _scattered(rows: np.ndarray, values: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """n values, null but in some rows."""
    whole, missing = np.zeros(n, values.dtype), np.ones(n, bool)
    whole[rows], missing[rows] = values, False
    return pa.array(whole, mask=missing).cast(kind)


def _depth(data: np.ndarray, rows: np.ndarray, at: np.ndarray, levels: np.ndarray, n: int, kind: pa.DataType) -> pa.Array:
    """Lists of as many levels as each full packet holds; other packets have none."""
    sizes = np.zeros(n, np.int64)
    sizes[rows] = levels
    first = np.repeat(np.cumsum(levels) - levels, levels)
    places = np.repeat(at, levels) + (np.arange(levels.sum()) - first) * _LEVEL.itemsize
    found = _records(data, places, _LEVEL)
    values = pa.StructArray.from_arrays([pa.array(found[f.name]).cast(f.type) for f in kind.value_type], fields=list(kind.value_type))
    missing = np.ones(n, bool)
    missing[rows] = False
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values, type=kind, mask=pa.array(missing))


def decode_batch(frames: pa.Array, target: pa.Schema) -> tuple[np.ndarray, dict[str, pa.Array]]:
    """The packets of all frames: the row of each one's frame, and its columns of target.

    Packets of codes without a layout, and those whose body is cut short, are passed over but counted. A full packet has
    the levels of depth that it has bytes for.
    """
    frames = pa.concat_arrays([frames.cast(pa.large_binary()).fill_null(b"")])
    ends = np.frombuffer(frames.buffers()[1], np.int64)[frames.offset : frames.offset + len(frames) + 1]
    buffer = frames.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    frame, number, at, headers = _walk(data, ends[:-1], ends[1:])
    room = headers["length"].astype(np.int64) - HEADER.itemsize
    needs = np.full(256, -1)
    for code, (_, body) in _BODY.items():
        needs[code] = body.itemsize
    kept = (needs[headers["code"]] >= 0) & (room >= needs[headers["code"]])
    frame, number, at, headers, room = frame[kept], number[kept], at[kept] + HEADER.itemsize, headers[kept], room[kept]
    n, fields, columns = len(frame), {f.name: f.type for f in target}, {}
    parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}  # fields that target lacks are not read
    kinds = np.full(256, "", object)
    for code, (kind, body) in _BODY.items():
        kinds[code] = kind
        rows = np.flatnonzero(headers["code"] == code)
        found = _records(data, at[rows], body)
        for name in fields.keys() & {*body.names}:
            parts.setdefault(name, []).append((rows, found[name]))
        if kind == "full":
            levels = np.minimum(LEVELS, (room[rows] - body.itemsize) // _LEVEL.itemsize)
            columns["depth"] = _depth(data, rows, at[rows] + body.itemsize, levels, n, fields["depth"])
    for name, found in parts.items():
        rows, values = (np.concatenate(x) for x in zip(*found, strict=True))
        columns[name] = _scattered(rows, values, n, fields[name])
    columns |= {"packet_offset": number, "packet_type": kinds[headers["code"]], "response_code": headers["code"], "exchange_segment": headers["segment"], "security_id": headers["security_id"]}
    return frame, {c: v if isinstance(v, pa.Array) else pa.array(v, type=pa.string() if v.dtype == object else None).cast(fields[c]) for c, v in columns.items()}


def decode_frames(frames: DataFrame) -> DataFrame:
    """Packets of all frames (batch or stream): frame, receive_ts_ns, connection_id, websocket_message_id in, PACKETS out.

    Headers are walked for all frames of an Arrow batch at once, and the packets of one code are read as one array of
    records, so no Python runs for a packet.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    target = to_arrow_schema(StructType.fromDDL(schemas.PACKETS))
    kept = ["receive_ts_ns", "connection_id", "websocket_message_id"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame, columns = decode_batch(batch.column("frame"), target)
            columns |= {c: batch.column(c).take(pa.array(frame)).cast(target.field(c).type) for c in kept}
            yield pa.RecordBatch.from_arrays([columns[n] for n in target.names], schema=target)

    return frames.select("frame", *kept).mapInArrow(run, schemas.PACKETS)
