"""Documents dealt into chunks of bounded size, and compact rows that carry many small values through a shuffle.

A chunk is a group of documents that one task reads as a whole. Words are collected once for each chunk, so what meets
in a shuffle is one entry for each chunk and distinct word, however often a word or a copy occurs. There are as many
tasks that answer for words as there are chunks, and entries reach them in steps of bounded fan-out (Exchange).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.units import bounded, listed, release

CHUNK_BYTES = 12_000_000
#: A map task holds at most this many bytes of text before it hands on what it has.
FLUSH_BYTES = 24_000_000
#: Rows that a task writes for other tasks at most, in each step of an exchange.
FAN = 256

_ZSTD = pa.ipc.IpcWriteOptions(compression="zstd")


def packed(**columns: pa.Array) -> bytes:
    """Equally long arrays as one compressed value."""
    batch = pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema, options=_ZSTD) as writer:
        writer.write_batch(batch)
    return out.getvalue().to_pybytes()


def unpacked(blob: bytes) -> pa.Table:
    return pa.ipc.open_stream(blob).read_all()


def text_bytes(docs: DataFrame, text_col: str = "text") -> int:
    """UTF-8 bytes of all texts."""
    return docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def parts_for(total: int, each: int) -> int:
    return max(1, ceil(total / each))


def _flush(tables: list[pa.Table]) -> Iterator[pa.RecordBatch]:
    whole = pa.concat_tables(tables).combine_chunks()
    chunk = whole["chunk"].to_numpy()
    order = np.argsort(chunk, kind="stable")
    cuts = np.flatnonzero(np.diff(chunk[order])) + 1
    rest = whole.drop_columns(["chunk"])
    for rows in np.split(order, cuts):
        some = rest.take(pa.array(rows))
        blob = packed(**{c: some[c].combine_chunks() for c in some.column_names})
        yield pa.record_batch({"chunk": pa.array([int(chunk[rows[0]])], pa.int64()), "docs": pa.array([blob], pa.binary())})


def _pack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            size += batch.nbytes
        if size > FLUSH_BYTES:
            yield from _flush(held)
            held, size = [], 0
    if held:
        yield from _flush(held)


def in_chunks(
    docs: DataFrame, id_col: str, text_col: str, n_chunks: int, carry: list[str] = (), below: int | None = None
) -> DataFrame:
    """Rows (chunk, docs): compressed groups of (id long, text binary, carried columns); the rows of a chunk together
    hold its documents.

    The chunk is a hash of id and text: a task that runs again deals each document as before. Null texts are empty. below:
    only chunks of smaller numbers.
    """
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    carried = [F.col(c).alias(f"carried_{i}") for i, c in enumerate(carry)]
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), text.alias("text"), *carried)
    slim = slim.withColumn("chunk", F.pmod(F.xxhash64("id", "text"), F.lit(n_chunks)).cast("long"))
    if below is not None:
        slim = slim.filter(F.col("chunk") < below)
    return slim.mapInArrow(_pack, "chunk long, docs binary")


def chunk_table(rows: pa.Table) -> pa.Table:
    """The documents of one chunk in the order of id and text, null ids last: id, text (binary), carried columns."""
    whole = pa.concat_tables([unpacked(b) for b in rows["docs"].to_pylist()]).combine_chunks()
    ids, texts = whole["id"].to_pylist(), listed(whole["text"])
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return whole.take(pa.array(order, pa.int64())).combine_chunks()


def chunk_documents(rows: pa.Table) -> tuple[list[int | None], pa.Array]:
    """Ids and texts of chunk_table."""
    if not rows.num_rows:
        return [], pa.array([], pa.binary())
    whole = chunk_table(rows)
    return whole["id"].to_pylist(), pa.concat_arrays(whole["text"].chunks)


# -- keys that many chunks share ----------------------------------------------------------------------------------------


def numbers(keys: pa.Array) -> np.ndarray:
    """A number below 2^32 for each key: hashes of binary keys, the low bits of 64-bit keys, which are hashes."""
    if keys.type == pa.uint64():
        return (keys.to_numpy() & np.uint64(2**32 - 1)).astype(np.int64)
    return np.fromiter(map(crc32, listed(keys)), np.int64, len(keys))


@dataclass(frozen=True)
class Exchange:
    """How entries go from any of n tasks to any other by levels of steps, in which a task writes at most base rows.

    Tasks and destinations are numbers of levels digits. At each level the task's digit is replaced by the destination's, so
    after the last one entries are where they go. Rows written grow as n times base times levels, that is, in proportion
    to the input with a factor of its logarithm, and not as n times n.
    """

    base: int
    levels: int

    @classmethod
    def of(cls, n: int, fan: int = FAN) -> Exchange:
        levels = 1
        while fan**levels < n:
            levels += 1
        base = 1
        while base**levels < n:
            base += 1
        return cls(base, levels)

    @property
    def size(self) -> int:
        return self.base**self.levels

    def digit(self, number, level: int):
        return number // self.base**level % self.base

    def beside(self, node: int, level: int, digit: int) -> int:
        """The node with another digit at a level."""
        return node + (digit - self.digit(node, level)) * self.base**level

    def deal(self, node: int, level: int, to: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """The nodes that entries go to next, and the places of their entries in the order that they have."""
        if not len(to):
            return []
        digits = self.digit(to, level)
        order = np.argsort(digits.astype(np.uint16) if self.base <= 1 << 16 else digits, kind="stable")  # small ones by radix
        cuts = np.flatnonzero(np.diff(digits[order])) + 1
        return [(self.beside(node, level, int(digits[at[0]])), at) for at in np.split(order, cuts)]


ASKED = "node long, slot int, entries binary"
ANSWERED = "node long, slot int, answer binary"


def asked(way: Exchange, node: int, level: int, keys: pa.Array, **values: np.ndarray) -> pa.Table:
    """Rows that ask the next nodes for what belongs to distinct ascending keys; values are summed on the way."""
    plain = keys.to_numpy() if keys.type == pa.uint64() else None
    out = way.deal(node, level, numbers(keys))
    blobs = []
    for _, at in out:
        some = keys.take(pa.array(at)) if plain is None else pa.array(np.diff(plain[at], prepend=np.uint64(0)))
        blobs.append(packed(key=some, **{c: pa.array(v[at]) for c, v in values.items()}))
    return pa.table(
        {
            "node": pa.array([n for n, _ in out], pa.int64()),
            "slot": pa.array([way.digit(node, level)] * len(out), pa.int32()),
            "entries": pa.array(blobs, pa.binary()),
        }
    )


class Asks:
    """What a node is asked: distinct ascending keys, the sums of their values, and where each asker's keys are in them."""

    def __init__(self, rows: pa.Table):
        self.slots = rows["slot"].to_pylist()
        tables = [unpacked(x) for x in rows["entries"].to_pylist()]
        cuts = np.cumsum([t.num_rows for t in tables])[:-1]
        if tables[0].schema.field("key").type == pa.uint64():
            whole = np.concatenate([np.cumsum(t["key"].to_numpy(), dtype=np.uint64) for t in tables])
            distinct, place = np.unique(whole, return_inverse=True)
            self.keys = pa.array(distinct)
        else:
            coded = pa.concat_arrays([c for t in tables for c in t["key"].chunks]).dictionary_encode()
            order = pc.sort_indices(coded.dictionary).to_numpy().astype(np.int64)
            self.keys = coded.dictionary.take(pa.array(order))
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            place = rank[coded.indices.to_numpy()]
        self.index = np.split(place, cuts)
        self.sums = {
            c: np.bincount(place, weights=np.concatenate([t[c].to_numpy() for t in tables]), minlength=len(self.keys)).astype(np.int64)
            for c in tables[0].column_names
            if c != "key"
        }

    def answered(self, way: Exchange, node: int, level: int, values: pa.Array) -> pa.Table:
        """Each asker's rows of values, sent back over the step that led here."""
        return pa.table(
            {
                "node": pa.array([way.beside(node, level, s) for s in self.slots], pa.int64()),
                "slot": pa.array([way.digit(node, level)] * len(self.slots), pa.int32()),
                "answer": pa.array([packed(v=values.take(pa.array(at))) for at in self.index], pa.binary()),
            }
        )


def collected(way: Exchange, node: int, level: int, keys: pa.Array, answers: pa.Table) -> pa.Array | None:
    """The values of the keys that asked() asked for; None if there are no keys."""
    parts = way.deal(node, level, numbers(keys))
    if not parts:
        return None
    got = dict(zip(answers["slot"].to_pylist(), answers["answer"].to_pylist(), strict=True))
    values = pa.concat_arrays([c for n, _ in parts for c in unpacked(got[way.digit(n, level)])["v"].chunks])
    place = np.empty(len(keys), np.int64)
    place[np.concatenate([at for _, at in parts])] = np.arange(len(keys))
    return values.take(pa.array(place))


def _with(rows: pa.Table, also: list[str], values: tuple[pa.Scalar, ...]) -> pa.Table:
    for name, value in zip(also, values, strict=True):
        rows = rows.append_column(name, pa.array([value.as_py()] * rows.num_rows, pa.int32()))
    return rows


def _merge(way: Exchange, level: int, also: list[str]):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        asks = Asks(rows)
        return _with(asked(way, key[0].as_py(), level, asks.keys, **asks.sums), also, key[1:])

    return run


def _relay(way: Exchange, level: int, also: list[str]):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        asks, node = Asks(rows), key[0].as_py()
        return _with(asks.answered(way, node, level - 1, collected(way, node, level, asks.keys, answers)), also, key[1:])

    return run


def asked_further(asks: DataFrame, way: Exchange, also: list[str] = ()) -> list[DataFrame]:
    """Rows of ASKED at each level, from those that the chunks sent; the last ones are for the nodes that answer.

    also: columns (int) that keep questions of several kinds apart.
    """
    levels = [asks]
    for level in range(1, way.levels):
        levels.append(levels[-1].groupBy("node", *also).applyInArrow(_merge(way, level, also), asks.schema))
    return levels


def answered_back(levels: list[DataFrame], answers: DataFrame, way: Exchange, also: list[str] = ()) -> DataFrame:
    """Rows of ANSWERED for the chunks, from those of the nodes that answer."""
    for level in range(way.levels - 1, 0, -1):
        asks = levels[level - 1].groupBy("node", *also)
        answers = asks.cogroup(answers.groupBy("node", *also)).applyInArrow(_relay(way, level, also), answers.schema)
    return answers


def forwarded(rows: DataFrame, way: Exchange) -> DataFrame:
    """Rows (node, entries), whose entries have a column to, after the first step: on to the nodes that they are for."""
    for level in range(1, way.levels):
        rows = rows.groupBy("node").applyInArrow(_forward(way, level), "node long, entries binary")
    return rows


def sent(way: Exchange, node: int, level: int, entries: pa.Table) -> pa.Table:
    """Rows (node, entries) of one step towards the column to."""
    entries = entries.combine_chunks()
    out = way.deal(node, level, entries["to"].to_numpy().astype(np.int64))
    blobs = []
    for _, at in out:
        whole = at[-1] - at[0] + 1 == len(at)  # places ascend
        some = entries.slice(int(at[0]), len(at)) if whole else entries.take(pa.array(at))
        blobs.append(packed(**{c: some[c].combine_chunks() for c in some.column_names}))
    return pa.table({"node": pa.array([n for n, _ in out], pa.int64()), "entries": pa.array(blobs, pa.binary())})


def _forward(way: Exchange, level: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        return sent(way, key[0].as_py(), level, pa.concat_tables([unpacked(x) for x in rows["entries"].to_pylist()]))

    return run
