"""Token ids of documents in ORC files: run-length encoded integers, row indexes and Bloom filters on document ids."""

from __future__ import annotations

import json
import os
import uuid
import zlib
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.units import as_text, bounded, release, slices, split_units
from tickloom.session import shared_dir, written

#: A Python worker remembers the ids of at most this many units of text, then starts afresh (about 40 bytes each).
REMEMBERED = 1_500_000
#: Documents, and bytes of text, whose units are encoded together, and units that the tokenizer gets at once.
AT_ONCE, BYTES_AT_ONCE, UNITS_AT_ONCE = 4096, 6 << 20, 16_384
#: Signs that end a unit.
SIGNS = ".,;:!?"


class _Known:
    """Ids of units by the 128-bit hash of the unit, in sorted arrays."""

    def __init__(self):
        self.high, self.low = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.first, self.size = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.int32)

    @staticmethod
    def hashes(units: list[str]) -> np.ndarray:
        return np.frombuffer(b"".join([xxhash.xxh3_128_digest(u) for u in units]), ">u8").astype(np.uint64).reshape(-1, 2)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The entry of each hash, or -1."""
        if not len(self.high):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.high, hashes[:, 0]), len(self.high) - 1)
        return np.where((self.high[at] == hashes[:, 0]) & (self.low[at] == hashes[:, 1]), at, -1)

    def add(self, hashes: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        order = np.argsort(hashes[:, 0])
        starts = len(self.ids) + np.cumsum(sizes) - sizes
        at = np.searchsorted(self.high, hashes[order, 0])
        self.high, self.low = np.insert(self.high, at, hashes[order, 0]), np.insert(self.low, at, hashes[order, 1])
        self.first, self.size = np.insert(self.first, at, starts[order]), np.insert(self.size, at, sizes[order])
        self.ids = np.concatenate([self.ids, ids])

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of entries in turn, and how many each has."""
        sizes = self.size[at].astype(np.int64)
        before = np.cumsum(sizes) - sizes
        return self.ids[np.repeat(self.first[at] - before, sizes) + np.arange(sizes.sum())], sizes


#: One tokenizer for each worker and file, a twin without a pattern for units of one word, and what they have encoded.
_loaded: dict[str, list] = {}


def _tokenizers(path: str) -> list:
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        whole = Tokenizer.from_file(path)
        settings = json.loads(whole.to_str())
        if (settings.get("pre_tokenizer") or {}).get("type") == "ByteLevel":
            settings["pre_tokenizer"]["use_regex"] = False
        word = Tokenizer.from_str(json.dumps(settings))
        _loaded[path] = [whole, word, _Known()]
    return _loaded[path]


def _encode_new(whole, word, known: _Known, units: list[str]) -> None:
    """Encode units that are not known. A sign after a letter or digit at a unit's end is a word of its own, so both parts
    are looked up; units of letters alone are one word."""
    ended = [u for u in units if u[-1] in SIGNS and u[-2:-1].isalnum()]
    parts = list({p for u in ended for p in (u[:-1], u[-1])}.union(units).difference(ended))
    hashes = known.hashes(parts)
    missing = np.flatnonzero(known.find(hashes) < 0)
    letters = [i for i in missing.tolist() if parts[i].removeprefix(" ").isalpha()]
    alone = set(letters)
    others = [i for i in missing.tolist() if i not in alone]
    for tokenizer, some in ((word, letters), (whole, others)):
        all_ids, all_sizes = [], []
        for at in range(0, len(some), UNITS_AT_ONCE):
            now = [parts[i] for i in some[at : at + UNITS_AT_ONCE]]
            found = [e.ids for e in tokenizer.encode_batch_fast(now, add_special_tokens=False)]
            all_sizes.append(np.fromiter(map(len, found), np.int32, len(found)))
            all_ids.append(np.fromiter(chain.from_iterable(found), np.int32, int(all_sizes[-1].sum())))
        if some:
            known.add(hashes[some], np.concatenate(all_ids), np.concatenate(all_sizes))
    if ended:
        heads, signs = (known.take(known.find(known.hashes(x))) for x in ([u[:-1] for u in ended], [u[-1] for u in ended]))
        ids = np.insert(heads[0], np.cumsum(heads[1]), signs[0])
        known.add(known.hashes(ended), ids, (heads[1] + 1).astype(np.int32))


def encode_texts(texts: pa.Array, path: str, end_id: int) -> pa.ListArray:
    """Ids of each text and the end id. Each distinct unit of a text is given to the tokenizer once and remembered."""
    whole, word, known = _tokenizers(path)
    units, index, sizes = split_units(texts)
    if len(known.high) > REMEMBERED:
        known = _loaded[path][2] = _Known()
    hashes = known.hashes(units)
    new = np.flatnonzero(known.find(hashes) < 0)
    if len(new):
        _encode_new(whole, word, known, [units[i] for i in new])
    flat, counts = known.take(known.find(hashes))
    starts = np.cumsum(counts) - counts
    # the end id stands after the ids of all units, as a unit of its own at the end of each text
    flat, counts, starts = np.append(flat, np.int32(end_id)), np.append(counts, 1), np.append(starts, len(flat))
    index = np.insert(index, np.cumsum(sizes), len(units))
    each = counts[index]
    before = np.cumsum(each) - each
    ids = flat[np.repeat(starts[index] - before, each) + np.arange(each.sum())]
    ends = np.append(0, np.cumsum(each))[np.append(0, np.cumsum(sizes + 1))]
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids))


def _encode(path: str, end_id: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for some in slices(batch, "text", BYTES_AT_ONCE, AT_ONCE):
                lists = encode_texts(as_text(some.column("text")), path, end_id)
                yield pa.record_batch({"doc_id": some.column("id"), "ids": lists})

    return run


def write_tokens(
    docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every whole text and write ORC files under path, in ascending order of document ids.

    Documents are range-partitioned by id, so file part-k holds ids below those of part-k+1; inside a file rows are
    sorted by id. Columns: part (the file's number), doc_id, ids (array<int>, the text's ids and the end id). ORC keeps
    integers in run-length encoding and an index entry with least and greatest doc_id for every 10,000 rows; a Bloom
    filter on doc_id lets a reader skip stripes that cannot hold an id. Null texts are empty, null ids come first,
    repeated rows are kept, extra columns are ignored. An empty table gives files without rows.
    """
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    placed = slim.repartitionByRange(n, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first())
    encoded = placed.mapInArrow(_encode(tokenizer_path, end_id), "doc_id long, ids array<int>")
    (
        encoded.select(F.spark_partition_id().alias("part"), "doc_id", "ids")
        .write.option("compression", "zstd")
        .option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.row.index.stride", "10000")
        .option("orc.stripe.size", str(32 << 20))
        .orc(path)
    )


def read_tokens(docs_or_spark, path: str) -> DataFrame:
    """The files of write_tokens: part, doc_id, ids. Filters on doc_id are pushed to the stripes' metadata."""
    spark = getattr(docs_or_spark, "sparkSession", docs_or_spark)
    return spark.read.schema("part int, doc_id long, ids array<int>").orc(path)


def _digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("ids")
        offsets = ids.offsets.to_numpy()
        values = memoryview(ids.values.to_numpy(zero_copy_only=False).astype("<u4").view(np.uint8))
        crcs = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
        yield pa.record_batch(
            {
                "part": batch.column("part"),
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array(np.diff(offsets).astype(np.int64)),
                "ids_crc32": pa.array(crcs, pa.int64()),
            }
        )


def token_index(tokens: DataFrame) -> DataFrame:
    """For each document of the files: where its ids start, how many there are, and their crc32.

    start counts the ids of all documents before it in the order of the files; documents of equal ids stand in the
    order of crc32 and length. One total for each file is ordered globally, no more. Returns doc_id, start, n_tokens,
    ids_crc32.
    """
    slim = written(tokens.mapInArrow(_digest, "part int, doc_id long, n_tokens long, ids_crc32 long"), "token-index")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # one row for each file
    offsets = (
        slim.groupBy("part")
        .agg(F.sum("n_tokens").alias("n"))
        .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    )
    inside = (
        Window.partitionBy("part")
        .orderBy(F.col("doc_id").asc_nulls_first(), "ids_crc32", "n_tokens")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        slim.withColumn("upto", F.sum("n_tokens").over(inside))
        .join(F.broadcast(offsets), "part")
        .select("doc_id", (F.col("offset") + F.col("upto") - F.col("n_tokens")).alias("start"), "n_tokens", "ids_crc32")
    )


def tokens_path(docs: DataFrame) -> str:
    """A fresh folder for token files, shared by driver and executors."""
    return f"{shared_dir(docs.sparkSession)}/tickloom/tokens-{uuid.uuid4().hex}"
