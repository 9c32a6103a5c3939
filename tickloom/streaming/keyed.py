"""Streams whose state Spark keeps as typed columns: bars of a security and time, strikes at the money of a symbol and expiry."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tickloom.functions.scalars import bucket_start
from tickloom.streaming.stateful import nearest, part_of

_VALUES = [
    "open double", "high double", "low double", "close double", "volume long", "volume_delta long", "oi_open long", "oi_high long", "oi_low long", "oi_close long",
    "trade_count long", "revision int", "updates long",
]
#: The moment (microseconds, seq) of what was first or last, so that an earlier or later tick can take its place.
_MOMENTS = [f"{c}_{x} long" for c in ("open", "close", "oi_open", "oi_close") for x in ("at", "seq")]
_NAMES = [c.split()[0] for c in (*_VALUES, *_MOMENTS)]
BARS = "kind string, security_id long, event_time timestamp, seq long, " + ", ".join(_VALUES)


#: Neighbouring securities, and buckets of time, whose bars are one key's state.
SECURITIES, BUCKETS = 256, 24
#: Bars that a task has put together of a key's ticks before it folds them.
HELD = 50_000
#: Ticks of a key that travel as one row, and those that a task gathers before it packs them.
PACK, GATHERED = 128, 200_000
_PACKED = ["security_id", "begun", "at", "seq", "price", "volume", "trade_sign", "oi"]
_TYPES = {"security_id": "long", "begun": "long"} | {c: t for c, t in (x.split() for x in (*_VALUES, *_MOMENTS))}
#: How the state keeps the numbers of a column.
_KEPT = {"double": "<f8", "long": "<i8", "int": "<i8"}


#: Stands for a missing whole number in arrays; a missing double is NaN.
NONE, MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


def _packs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ticks of one key (near, span), PACK at most, as a row: the latest of their times, and the bytes of their columns."""
    parts, held = [], 0
    for batch in batches:
        whole = [batch.column(c).fill_null(np.nan).to_numpy().astype("<f8").view("<i8") if c == "price" else batch.column(c).fill_null(NONE).to_numpy() for c in ("near", "span", *_PACKED)]
        parts.append(np.stack(whole, 1))
        held += batch.num_rows
        if held >= GATHERED:
            yield _packed(np.concatenate(parts))
            parts, held = [], 0
    if held:
        yield _packed(np.concatenate(parts))


def _packed(ticks: np.ndarray) -> pa.RecordBatch:
    ticks = ticks[np.lexsort((ticks[:, 1], ticks[:, 0]))]
    first = np.flatnonzero(np.append(True, (np.diff(ticks[:, :2], axis=0) != 0).any(1)))
    sizes = np.diff(first, append=len(ticks))
    cuts = np.repeat(first, -(-sizes // PACK))
    cuts += PACK * (np.arange(len(cuts)) - np.searchsorted(cuts, cuts))
    whole = lambda v, kind: pa.array(v, kind, mask=v == NONE)
    near, span, latest = ticks[cuts, 0], ticks[cuts, 1], np.maximum.reduceat(ticks[:, 2 + _PACKED.index("at")], cuts)
    packs = [ticks[a:b, 2:].astype("<i8").tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(ticks)))]
    columns = {"near": whole(near, pa.int64()), "span": whole(span, pa.int64()), "event_time": whole(latest, pa.int64()).cast(pa.timestamp("us", "UTC"))}
    return pa.record_batch(columns | {"ticks": pa.array(packs, pa.binary())})


def _unpacked(packs: list[bytes]) -> dict[str, np.ndarray]:
    ticks = np.frombuffer(b"".join(packs), "<i8").reshape(-1, len(_PACKED)).T.copy()
    return {c: v.view("<f8") if c == "price" else v for c, v in zip(_PACKED, ticks)}


class BarState(StatefulProcessor):
    """The bars of neighbouring securities and buckets of time, as bars.build_bars makes them of the same ticks.

    What a micro-batch has of a bucket changes its bar, which is emitted (kind 'bar'); updates counts how often. seen is the
    latest time of all ticks of the batches before, told by the watermark. Ticks that come for a known bar whose time is over
    at seen raise its revision, once for each batch; ticks of a bucket that began over lateness_ms before seen are rejected
    and emitted as they are (kind 'late'). A timer drops the state when no tick can change it any more. A key's bars are read,
    folded by columns and written once in a batch, as a key costs some milliseconds; a task holds SECURITIES * BUCKETS of them
    and HELD more at most, however many ticks they have. A column of bars is kept as the bytes of its numbers: Spark's client
    would look at each number of a list by itself.
    """

    def __init__(self, interval_ms: int, lateness_ms: int, delay_ms: int):
        self.interval_ms, self.lateness_ms, self.delay_ms = interval_ms, lateness_ms, delay_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.bars = handle.getValueState("bars", ", ".join(f"{c} binary" for c in _TYPES))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        seen = watermark + self.delay_ms if watermark > 0 else None
        parts, held = [], 0
        for packs in (p[i : i + HELD // PACK] for f in rows for p in [f["ticks"].tolist()] for i in range(0, len(p), HELD // PACK)):
            ticks = _unpacked(packs)
            late = np.zeros(len(ticks["at"]), bool) if seen is None else seen - ticks["begun"] // 1000 > self.lateness_ms
            if late.any():
                yield self._out("late", *(ticks[c][late] for c in ("security_id", "at", "seq")))
            if not late.all():
                parts.append(self._ticks({c: v[~late] for c, v in ticks.items()}))
                held += len(parts[-1]["begun"])
            if held > HELD:
                parts = [self._fold(parts)]
                held = len(parts[0]["begun"])
        if not parts:
            return
        found = self.bars.get()
        if found:
            known = {c: np.frombuffer(v, _KEPT[t]) for (c, t), v in zip(_TYPES.items(), found)}
            parts.append(known | {"now": np.zeros(len(known["begun"]), bool), "known": np.ones(len(known["begun"]), bool)})
        bars = self._fold(parts)
        now = bars["now"]
        bars["updates"] += now
        if seen is not None:
            bars["revision"] += now & bars["known"] & (bars["begun"] // 1000 + self.interval_ms <= seen)
        self.bars.update(tuple(bars[c].astype(_KEPT[t]).tobytes() for c, t in _TYPES.items()))
        if not found:
            last = 0 if pd.isna(key[1]) else (int(key[1]) * BUCKETS + BUCKETS - 1) * self.interval_ms
            self.handle.registerTimer(max(last, (watermark or 0) - self.lateness_ms) + self.lateness_ms + 1)
        changed = {c: v[now] for c, v in bars.items()}
        yield self._out("bar", changed["security_id"], changed["begun"], np.full(now.sum(), NONE), changed)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.bars.clear()
        yield from ()

    def close(self) -> None:
        pass

    def _ticks(self, ticks: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Each tick as a bar of its own."""
        price, at, oi, volume, sign, seq = (ticks[c] for c in ("price", "at", "oi", "volume", "trade_sign", "seq"))
        traded, none = ~np.isnan(price), np.zeros(len(at), np.int64)
        volume = np.where((volume != NONE) & traded, volume, 0)
        bar = {c: ticks[c] for c in ("security_id", "begun")}
        for value, there, names in ((price, traded, ("open", "high", "low", "close")), (oi, oi != NONE, ("oi_open", "oi_high", "oi_low", "oi_close"))):
            bar |= dict.fromkeys(names, value)
            for name in (names[0], names[3]):
                bar |= {f"{name}_at": np.where(there, at, NONE), f"{name}_seq": np.where(there, seq, NONE)}
        signed = traded & (sign != 0) & (sign != NONE)
        bar |= {"volume": volume, "volume_delta": np.where(signed, volume * np.where(signed, sign, 0), NONE), "trade_count": traded.astype(np.int64)}
        return bar | {"revision": none, "updates": none, "now": none == 0, "known": none > 0}

    def _fold(self, parts: list[dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
        """The bars that parts of them make together."""
        every = {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}
        order = np.lexsort((every["begun"], every["security_id"]))
        every = {c: v[order] for c, v in every.items()}
        new = np.append(True, (np.diff(every["security_id"]) != 0) | (np.diff(every["begun"]) != 0))
        starts, group = np.flatnonzero(new), np.cumsum(new)
        bars = {c: every[c][starts] for c in ("security_id", "begun")}
        bars |= {c: np.add.reduceat(every[c], starts) for c in ("volume", "trade_count", "revision", "updates")}
        bars |= {c: np.logical_or.reduceat(every[c], starts) for c in ("now", "known")}
        delta = every["volume_delta"]
        some = np.logical_or.reduceat(delta != NONE, starts)
        bars["volume_delta"] = np.where(some, np.add.reduceat(np.where(delta != NONE, delta, 0), starts), NONE)
        bars["high"], bars["low"] = np.fmax.reduceat(every["high"], starts), np.fmin.reduceat(every["low"], starts)
        low = np.minimum.reduceat(np.where(every["oi_low"] != NONE, every["oi_low"], MOST), starts)
        bars["oi_high"], bars["oi_low"] = np.maximum.reduceat(every["oi_high"], starts), np.where(low != MOST, low, NONE)
        for name, first in (("open", True), ("close", False), ("oi_open", True), ("oi_close", False)):
            at, seq = every[f"{name}_at"], every[f"{name}_seq"]
            found = np.lexsort((seq, np.where(at != NONE, at, MOST) if first else at, group))  # missing ones come last or first
            found = found[starts if first else np.append(starts[1:], len(new)) - 1]
            bars |= {c: every[c][found] for c in (name, f"{name}_at", f"{name}_seq")}
        return bars

    def _given(self, values: np.ndarray) -> np.ndarray:
        """values with None for what is missing."""
        out = values.astype(object)
        out[np.isnan(values) if values.dtype.kind == "f" else values == NONE] = None
        return out

    def _out(self, kind: str, security_id: np.ndarray, times: np.ndarray, seqs: np.ndarray, bars: dict[str, np.ndarray] | None = None) -> pd.DataFrame:
        whole = lambda v: pd.arrays.IntegerArray(v.astype(np.int64), v == NONE)
        columns = {"kind": [kind] * len(times), "security_id": whole(security_id), "event_time": times.astype("datetime64[us]"), "seq": whole(seqs)}
        for c in _NAMES[: len(_VALUES)]:
            v = np.full(len(times), NONE) if bars is None else bars[c]
            columns[c] = (v if v.dtype.kind == "f" else whole(v)) if bars is not None else self._given(v)
        return pd.DataFrame(columns)


def stream_revised_bars(ticks: DataFrame, interval_s: int = 60, lateness_s: int = 300, grace_s: int = 300) -> DataFrame:
    """Changed bars and rejected ticks (BARS) of a stream of ticks, as BarState makes them; append mode.

    SECURITIES neighbouring securities and BUCKETS buckets share a state, so a batch's work depends on its own ticks and the
    bars around them. Ticks up to grace_s older than lateness_s are rejected with a row. Spark hands rows to a state one by one,
    at some 50 microseconds each, so PACK ticks of a key travel as one; Spark drops a pack whose ticks are all older than
    lateness_s and grace_s together and counts it, older ticks beside others are rejected with a row.
    """
    delay_s = lateness_s + grace_s
    bucket = bucket_start(F.col("event_time"), interval_s)
    near, span = F.floor(F.col("security_id") / SECURITIES), F.floor(F.unix_seconds(bucket) / (interval_s * BUCKETS))
    whole = [F.col(c).cast("long").alias(c) for c in ("security_id", "seq", "volume", "trade_sign", "oi")]
    rows = ticks.select(near.alias("near"), span.alias("span"), F.unix_micros(bucket).alias("begun"), F.unix_micros("event_time").alias("at"), F.col("price").cast("double").alias("price"), *whole)
    rows = rows.mapInArrow(_packs, "near long, span long, event_time timestamp, ticks binary").withWatermark("event_time", f"{delay_s} seconds")
    return rows.groupBy("near", "span").transformWithStateInPandas(BarState(interval_s * 1000, lateness_s * 1000, delay_s * 1000), BARS, "Append", "EventTime")


def newest_bars(changes: DataFrame) -> DataFrame:
    """The newest state of each bar of stream_revised_bars, with is_corrected and correction_of."""
    names = [c.split()[0] for c in _VALUES if not c.startswith("updates")]
    newest = changes.filter("kind = 'bar'").groupBy("security_id", "event_time").agg(F.max_by(F.struct(*names), "updates").alias("_bar"))
    corrected = F.col("revision") > 0
    return newest.select("security_id", "event_time", "_bar.*").withColumns({"is_corrected": corrected, "correction_of": F.when(corrected, F.col("event_time"))})


ATM = "symbol string, expiry string, event_time timestamp, seq long, spot double, atm double, changed boolean"


class AtmByExpiry(StatefulProcessor):
    """The strike at the money of a symbol and expiry among those listed for that expiry; a key is a part of the symbols.

    Rows in the order of event_time, kind, seq: kind 'reset' forgets the strike held, 'spot' brings a price, 'strike' lists one
    (value). The strike held stays unless the nearest one (the higher of two) is hold times the least gap between listed
    strikes away from it, or it is held no more. A part's strikes are read and written once in a batch.
    """

    def __init__(self, hold: float):
        self.hold = hold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("state", "symbol array<string>, expiry array<string>, listed array<array<double>>, held array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        ordered = pd.concat(frames).sort_values(["event_time", "kind", "seq"], kind="stable")
        # of each symbol and expiry: sorted strikes, their least gap, the one held
        states = {(s, e): [list(k), self._gap(k), held] for s, e, k, held in zip(*(self.state.get() or ([], [], [], [])))}
        out, names = [], [c.split()[0] for c in ATM.split(", ")]
        for symbol, expiry, time, kind, seq, value in zip(*(ordered[c] for c in ("symbol", "expiry", "event_time", "kind", "seq", "value"))):
            state = states.setdefault((symbol, expiry), [[], 0.0, None])
            strikes, gap, held = state
            if kind == "reset":
                state[2] = None
            elif kind == "strike":
                at = bisect_left(strikes, value)
                if at == len(strikes) or strikes[at] != value:
                    strikes.insert(at, float(value))
                    beside = self._gap(strikes[max(at - 1, 0) : at + 2])
                    state[1] = min(gap, beside) if gap else beside
            elif strikes:
                near = nearest(strikes, value)
                atm = held if held is not None and gap > 0 and abs(near - held) < self.hold * gap else near
                out.append((symbol, expiry, time, seq, value, atm, atm != held))
                state[2] = atm
                if len(out) >= HELD:
                    yield pd.DataFrame(out, columns=names)
                    out = []
        self.state.update(tuple(map(list, zip(*((s, e, k, held) for (s, e), (k, _, held) in states.items())))))
        if out:
            yield pd.DataFrame(out, columns=names)

    def _gap(self, strikes: list[float]) -> float:
        return min((b - a for a, b in zip(strikes, strikes[1:])), default=0.0)

    def close(self) -> None:
        pass


def stream_atm_by_expiry(rows: DataFrame, hold: float = 0.5) -> DataFrame:
    """symbol, expiry, event_time, seq, kind, value in; a row (ATM) for each spot that finds listed strikes out."""
    return rows.withColumn("_part", part_of("symbol", "expiry")).groupBy("_part").transformWithStateInPandas(AtmByExpiry(hold), ATM, "Append", "None")
