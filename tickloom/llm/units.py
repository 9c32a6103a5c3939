"""Texts cut into units that a pre-tokenizer can treat one by one."""

from __future__ import annotations

import ctypes
import re
import threading
import time
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

_last_stage: dict[str, int | None] = {}
#: Seconds between two looks at whether a worker is idle.
LOOK_S = 0.5
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")


def listed(values: pa.Array | pa.ChunkedArray) -> list:
    """Strings or binary values as a list, by way of NumPy, which is much faster than one by one."""
    return values.to_numpy(zero_copy_only=False).tolist() if isinstance(values, pa.Array) else values.to_numpy().tolist()


def _give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def _watch_idle() -> None:
    """Give memory back once a worker has had no task for two looks in a row, and then not again before its next task."""
    idle = 0
    while True:
        time.sleep(LOOK_S)
        idle = idle + 1 if TaskContext.get() is None else 0
        if idle == 2:
            _give_back()


def release() -> None:
    """Hand memory that a worker no longer uses back to the system when it begins with another stage, and when it falls
    idle: workers live on, and what they keep is lost to others. Inside a stage the next group needs as much again."""
    context = TaskContext.get()
    stage = context.stageId() if context else None
    if stage == _last_stage.get("id", -1):
        return
    if not _last_stage and context:
        threading.Thread(target=_watch_idle, daemon=True).start()
    _last_stage["id"] = stage
    _give_back()


def bounded(docs: DataFrame, most: str = "8m") -> DataFrame:
    """docs, after Arrow batches of its session were bounded by bytes, as texts differ in length ten thousandfold and a
    limit of rows bounds nothing. A limit other than Spark's own default stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    conf = docs.sparkSession.conf
    if conf.get(name, "64m") in ("67108864b", "64m"):
        conf.set(name, most)
    return docs


def slices(batch: pa.RecordBatch, column: str, most_bytes: int, most_rows: int) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most so many rows and so many bytes of one column; a longer value stands alone."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        before = int(size[at - 1]) if at else 0
        upto = min(at + most_rows, max(at + 1, int(np.searchsorted(size, before + most_bytes, "right"))))
        yield batch.slice(at, upto - at)
        at = upto


def spaced_units(text: str) -> list[str]:
    """The text cut before each single space between two other characters; an empty text has no units.

    No match of a pre-tokenizer whose words may start with one space, and whose runs of white space stand alone, can
    reach across such a cut, so the units can be split into words one by one.
    """
    parts = _INNER_SPACE.split(text) if text else []
    return [*parts[:1], *[" " + p for p in parts[1:]]]


def as_text(raw: pa.Array) -> pa.Array:
    """Binary values as strings; bytes that are no UTF-8 become replacement characters."""
    try:
        return raw.cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([x.decode("utf-8", "replace") for x in raw.to_pylist()], pa.string())


def split_units(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """spaced_units of many texts: the distinct units, the number of each text's units in turn, and how many each has."""
    if not len(texts):
        return [], np.zeros(0, np.int64), np.zeros(0, np.int64)
    parts = pc.split_pattern(texts, " ")
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    # texts with a space beside other white space are cut by spaced_units, the others in one go
    bad = pc.or_(pc.equal(pc.binary_length(flat), 0), pc.not_equal(pc.utf8_trim_whitespace(flat), flat))
    upto = np.append(0, np.cumsum(bad.to_numpy(zero_copy_only=False)))
    odd = np.flatnonzero(upto[offsets[1:]] > upto[offsets[:-1]])
    coded = flat.dictionary_encode()
    code = coded.indices.to_numpy().astype(np.int64) * 2 + 1
    code[offsets[:-1]] -= 1  # the first unit has no space before it
    sizes = np.diff(offsets)
    if len(odd):
        rows = np.split(code, offsets[1:-1])
        for i in odd:
            rows[i] = code[:0]
        code = np.concatenate(rows)
        sizes[odd] = 0
    used = np.zeros(2 * len(coded.dictionary), bool)
    used[code] = True
    index = (np.cumsum(used) - 1)[code]
    some = np.flatnonzero(used)
    plain = listed(coded.dictionary.take(pa.array(some // 2)))
    units = [" " + u if spaced else u for u, spaced in zip(plain, (some % 2).tolist(), strict=True)]
    if len(odd):
        number = {u: i for i, u in enumerate(units)}
        rows = np.split(index, np.cumsum(sizes)[:-1])
        for i in odd:
            rows[i] = np.array([number.setdefault(u, len(number)) for u in spaced_units(texts[int(i)].as_py())], np.int64)
            sizes[i] = len(rows[i])
        index, units = np.concatenate(rows), list(number)
    return units, index, sizes


def one_line(unit: str) -> bool:
    """Whether a unit has no white space but a space at its start: such units can be joined by line ends, which the
    pre-tokenizer then gives back as words of their own."""
    found = unit.split()
    return len(found) == 1 and (found[0] == unit or " " + found[0] == unit)
