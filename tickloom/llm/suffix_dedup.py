"""Exact removal of repeated passages: a sparse suffix array, range-partitioned by leading bytes and sorted in buckets.

A full suffix array of all texts has one suffix for each byte. Here only the suffixes at anchors are kept. The anchor of
a 50-byte window is the place of the least hash among the SEED-byte strings inside it (the leftmost, if equal), so equal
windows have equal anchors at the same distance, and the windows of one anchor stand in a row. A repeated window is
found where suffixes with equal leading bytes meet, together with the bytes before them that its windows need.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from math import ceil
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import (
    ANSWERED,
    ASKED,
    FAN,
    Asks,
    Exchange,
    answered_back,
    asked,
    asked_further,
    chunk_documents,
    chunk_table,
    collected,
    forwarded,
    in_chunks,
    parts_for,
    sent,
    text_bytes,
    unpacked,
)
from tickloom.llm.units import bounded, listed, release, slices

#: Leading bytes that suffixes must share to meet.
SEED = 24
CHUNK_BYTES = 6_000_000
#: Bytes of text for each range of suffixes.
BUCKET_BYTES = 12_000_000
#: Suffixes of a seed in more documents than this could fill a range: they are split by longer prefixes, whole windows.
HOT_DOCUMENTS = 2000
#: Splitters are sampled from this many documents, and so many more for each range; each gives at most so many seeds.
SAMPLED, SAMPLED_EACH, SAMPLED_SEEDS = 300, 2, 16
#: Splitters go to all tasks (24 bytes each); where more ranges are needed, each is dealt into equal parts by a hash.
MOST_RANGES = 65_536

#: Windows that are hashed at once, whatever texts they are of: few enough for a processor's cache.
WINDOWS = 1 << 15

_BASE = np.uint64(0x9E3779B97F4A7C15)
_HASH_BITS = 48
NO_ID = 2**63 - 1
#: In place of an anchor's offset: a range of bytes that its chunk has settled already.
SETTLED = -2


def _eights(b: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as one number, without a copy; the first byte is the lowest."""
    return np.ndarray((max(0, len(b) - 7),), "<u8", b, strides=(1,)) if len(b) else np.zeros(0, np.uint64)


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Which rows differ from the row before them."""
    new = np.ones(len(columns[0]), bool)
    new[1:] = columns[0][1:] != columns[0][:-1]
    for column in columns[1:]:
        new[1:] |= column[1:] != column[:-1]
    return new


def seed_hashes(b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the SEED bytes from each place on."""
    n = len(b) - SEED + 1
    mixed = _eights(b) * np.uint64(0xFF51AFD7ED558CCD)
    mixed ^= mixed >> np.uint64(32)
    whole = mixed[:n].copy()
    for at in range(8, SEED, 8):
        whole *= _BASE
        whole += mixed[at : at + n]
    whole ^= whole >> np.uint64(29)
    whole *= np.uint64(0xBF58476D1CE4E5B9)
    whole ^= whole >> np.uint64(32)
    return whole


@dataclass(frozen=True)
class Runs:
    """Runs of windows with the same anchor, in the texts one after the other: hash of the anchor's seed, anchor, first
    window, one after the last, and which text. Places count from the first text on."""

    flat: bytes
    starts: np.ndarray
    hashes: np.ndarray
    anchors: np.ndarray
    first: np.ndarray
    last: np.ndarray
    row: np.ndarray


def anchored_runs(texts: list[bytes], length: int) -> Runs:
    """The runs of all windows of each text. A block of windows may cut a run in two."""
    flat = b"".join(texts)
    b = np.frombuffer(flat, np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    starts = ends - sizes
    n = max(0, len(b) - length + 1)
    # windows across the border of two texts are runs of their own, dropped in the end
    borders = np.sort(np.concatenate([starts, np.maximum(starts, ends - length + 1)]))
    # a number holds a hash's leading bits and the place, so that the least is the leftmost of the least hashes
    low = np.uint64((1 << (WINDOWS + length).bit_length()) - 1)
    width = length - SEED + 1
    found = [(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for at in range(0, n, WINDOWS):
        hashes = seed_hashes(b[at : at + WINDOWS + length - 1])
        least, covered = (hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), 1
        while covered < width:
            step = min(covered, width - covered)
            least = np.minimum(least[step:], least[:-step])
            covered += step
        place = (least & low).astype(np.int64)
        new = _changes(place)
        i, j = np.searchsorted(borders, (at, at + len(place)))
        new[borders[i:j] - at] = True
        first = np.flatnonzero(new)
        found.append((hashes[place[first]], place[first] + at, first + at))
    own, anchors, first = (np.concatenate(x) for x in zip(*found, strict=True))
    row = np.searchsorted(starts, first, "right") - 1
    inside = np.flatnonzero(first + length <= ends[row]) if len(first) else row
    # the least hashes are small numbers: scattered anew, they fill all buckets alike
    own = (own[inside] * _BASE) ^ _BASE
    own = ((own ^ (own >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - _HASH_BITS)
    return Runs(flat, starts, own, anchors[inside], first[inside], np.append(first[1:], n)[inside], row[inside])


def multikey_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows whose key is a string of words, one array for each word, and which rows start a new key.

    Multikey quicksort: rows are sorted by their first word; only those that tie go on to the next.
    """
    order = np.argsort(columns[0], kind="stable")
    new = _changes(columns[0][order])
    for column in columns[1:]:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(new)[at]
        word = column[order[at]]
        inner = np.lexsort((word, group))
        order[at] = order[at][inner]
        group, word = group[inner], word[inner]
        new[at[1:]] |= (group[1:] == group[:-1]) & (word[1:] != word[:-1])
    return order, new


def alike(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """An order in which rows with equal keys stand together, as they came, and which rows start a new key.

    The order is that of a hash of the whole key. Neighbours of equal hash are compared whole; if any differ, all rows are
    sorted by their keys.
    """
    mixed = np.zeros(len(columns[0]), np.uint64)
    for column in columns:
        mixed ^= column
        mixed *= _BASE
        mixed ^= mixed >> np.uint64(32)
    order = np.argsort(mixed, kind="stable")
    new = _changes(mixed[order])
    at = np.flatnonzero(~new)
    if any((c[order[at]] != c[order[at - 1]]).any() for c in columns):
        return multikey_order(columns)
    return order, new


class _Chunk:
    """The documents of a chunk in the order of their ids, and the runs of their windows."""

    def __init__(self, rows: pa.Table, length: int):
        ids, texts = chunk_documents(rows)
        self.null = [i is None for i in ids]
        self.ids = [NO_ID if i is None else i for i in ids]
        self.texts = listed(texts)
        self.length = length

    def runs(self) -> Runs:
        return anchored_runs(self.texts, self.length)


def _seeds(runs: Runs, ids: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of a chunk in ascending order, how many ids have each, and the place of each run's in them."""
    order = np.argsort(runs.hashes, kind="stable")
    hashes = runs.hashes[order]
    new = _changes(hashes)
    place = np.cumsum(new) - 1
    # texts are in the order of their ids, so equal ids of a hash are neighbours
    counts = np.bincount(place[_changes(hashes, np.array(ids, np.int64)[runs.row[order]])])
    index = np.empty(len(order), np.int64)
    index[order] = place
    return hashes[new], counts, index


def _chunk_seeds(length: int, way: Exchange):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        chunk = _Chunk(rows, length)
        hashes, counts, _ = _seeds(chunk.runs(), chunk.ids)
        return asked(way, key[0].as_py(), 0, pa.array(hashes), n=counts.astype(np.uint32))

    return run


def _grade_seeds(way: Exchange, hot: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """0 for seeds of one document, 1 for seeds of more, 2 for hot ones."""
        release()
        asks = Asks(rows)
        documents = asks.sums["n"]
        grade = (documents > 1).astype(np.uint8) + (documents > hot).astype(np.uint8)
        return asks.answered(way, key[0].as_py(), way.levels - 1, pa.array(grade))

    return run


@dataclass(frozen=True)
class Ranges:
    """Ranges of strings between splitters, each in so many parts. A splitter is a seed, so equal seeds share a range."""

    splitters: list[bytes]
    parts: int

    @property
    def size(self) -> int:
        return (len(self.splitters) + 1) * self.parts

    def of(self, prefix: bytes) -> int:
        return bisect_right(self.splitters, prefix) * self.parts + (crc32(prefix) % self.parts if self.parts > 1 else 0)

    def of_all(self, heads: np.ndarray, flat: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """of() for many prefixes, from places of flat on; heads: their first eight bytes, the first one highest."""
        cuts = np.array([int.from_bytes(x[:8], "big") for x in self.splitters], np.uint64)
        out = np.searchsorted(cuts, heads, "right")
        # only prefixes that begin as a splitter does have to be looked at whole
        hard = np.arange(len(heads)) if self.parts > 1 else np.flatnonzero(np.searchsorted(cuts, heads) < out)
        out[hard] = [self.of(flat[a:e]) for a, e in zip(starts[hard].tolist(), ends[hard].tolist(), strict=True)]
        return out


def _spread(starts: list[int], ends: list[int], size: int) -> np.ndarray:
    """Which of size places lie in any of the ranges."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(steps[:size]) > 0


def _edges(covered: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    steps = np.diff(covered.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(steps > 0), np.flatnonzero(steps < 0)


_ENTRIES = pa.schema(
    {"to": pa.int64(), "chunk": pa.int64(), "content": pa.binary(), "off": pa.int8(), "doc": pa.int64(), "row": pa.int32(), "start": pa.int32(), "end": pa.int32()}
)


def _chunk_suffixes(length: int, way: Exchange, ranges: Ranges):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        chunk, node = _Chunk(rows, length), key[0].as_py()
        runs = chunk.runs()
        hashes, _, index = _seeds(runs, chunk.ids)
        found = collected(way, node, 0, pa.array(hashes), answers)
        grade = np.zeros(0, np.uint8) if found is None else found.to_numpy()[index]
        at = np.flatnonzero(grade)
        if not len(at):
            return sent(way, node, 0, _ENTRIES.empty_table())
        # a hot seed's windows go one by one, each to the range of all its bytes
        pieces = np.where(grade[at] > 1, runs.last[at] - runs.first[at], 1)
        nth = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = np.repeat(at, pieces)
        single = grade[at] > 1
        start = runs.first[at] + nth
        end = np.where(single, start, runs.last[at] - 1) + length
        off = np.where(single, -1, runs.anchors[at] - start)
        row = runs.row[at]
        docs = np.array(chunk.ids, np.int64)[row]
        eights = _eights(np.frombuffer(runs.flat, np.uint8))
        size = end - start
        columns = [(size << 8 | off + 1).astype(np.uint64)]
        columns += [eights[np.minimum(start + j, end - 8)] for j in range(0, int(size.max()), 8)]
        order, new = alike(columns)
        before = np.empty(len(at), np.int64)
        before[order] = docs[order[new]][np.cumsum(new) - 1]  # equal entries are in the order of their ids
        some, settled = np.flatnonzero(before == docs), np.flatnonzero(before < docs)
        base = start[some] + np.maximum(off[some], 0)
        upto = np.where(single[some], base + length, base + SEED)
        heads = [eights[np.minimum(base + j, len(eights) - 1)].byteswap() for j in range(0, SEED + 8, 8)]
        to = ranges.of_all(heads[0], runs.flat, base, upto)
        order, _ = multikey_order([to.astype(np.uint64), *heads])  # neighbours that begin alike are packed well
        some, to = some[order], to[order]
        content = [runs.flat[a:e] for a, e in zip(start[some].tolist(), end[some].tolist(), strict=True)]
        place = start - runs.starts[row]
        whole = [_entries(to, node, content, off[some], docs[some], row[some], place[some], np.zeros(len(some)))]
        if len(settled):  # settled here; such ranges only pass through
            row, place, size = row[settled], place[settled], size[settled]
            reach = np.maximum.accumulate(end[settled])
            new = _changes(row)
            new[1:] |= start[settled][1:] > reach[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(settled)) - 1
            row, docs, place = row[first], docs[settled[first]], place[first]
            upto = reach[last] - runs.starts[row]
            n = len(first)
            whole.append(_entries(np.full(n, node % ranges.size), node, [b""] * n, np.full(n, SETTLED), docs, row, place, upto))
        return sent(way, node, 0, pa.concat_tables(whole))

    return run


def _entries(to: np.ndarray, node: int, content: list[bytes], *rest: np.ndarray) -> pa.Table:
    columns = [to, np.full(len(to), node), content, *rest]
    plain = (c if isinstance(c, list) else c.astype(f.type.to_pandas_dtype()) for c, f in zip(columns, _ENTRIES, strict=True))
    return pa.table([pa.array(c, f.type) for c, f in zip(plain, _ENTRIES, strict=True)], schema=_ENTRIES)


#: What keeps the first 0 to 8 bytes of a number.
_LEADING = np.array([(1 << 64) - (1 << 8 * (8 - n)) for n in range(9)], np.uint64)
#: The least numbers of 1 to 8 bytes.
_BYTES = np.array([1 << 8 * n for n in range(8)], np.uint64)


def _words(eights: np.ndarray, at: np.ndarray, sizes: np.ndarray, most: int, ahead: bool = True) -> list[np.ndarray]:
    """So many bytes from each place on as columns of words that sort as bytes do, zeros after the first sizes ones; if not
    ahead, the bytes before each place, from the last one back."""
    return [
        (eights[at + j].byteswap() if ahead else eights[at - j - 8]) & _LEADING[np.clip(sizes - j, 0, 8)] for j in range(0, most, 8)
    ]


def _common(columns: list[np.ndarray], order: np.ndarray) -> np.ndarray:
    """How many leading bytes each row of words shares with the one before it in an order; none for the first one."""
    out = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for column in columns:
        equal = 8 - np.searchsorted(_BYTES, column[order[at]] ^ column[order[at - 1]], "right")
        out[at] += equal
        at = at[equal == 8]
    return out


def _least(order: np.ndarray, new: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each row the smallest document of the rows with its key."""
    least = np.empty(len(docs), docs.dtype)
    if len(docs):
        least[order] = np.minimum.reduceat(docs[order], np.flatnonzero(new))[np.cumsum(new) - 1]
    return least


def repeated_windows(contents: list[bytes] | pa.Array, off: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For each entry one bit for each of its windows: whether an entry of a smaller document has the same window.

    An entry's bytes hold its windows; its anchor's suffix starts off bytes in. off -1: one window, without an anchor.

    Of equal entries one of the smallest document stands for all. These are sorted by the suffixes at their anchors, and once
    more by the bytes before those, from the anchor back. Entries have the window that starts some bytes before the
    anchor in common if they share so many bytes back and the rest ahead: such entries stand in a row in either order,
    and the bytes that neighbours share tell where rows end.
    """
    left = length - SEED
    contents = pa.array(contents, pa.binary()) if isinstance(contents, list) else contents
    sizes = pc.binary_length(contents).to_numpy().astype(np.int64)
    pad = bytes(left + 8)  # words reach across an entry's ends
    eights = _eights(np.frombuffer(b"".join([pad, *listed(contents), bytes(length + left + 8)]), np.uint8))
    anchor = len(pad) + np.cumsum(sizes) - sizes + np.maximum(off, 0)
    mask = np.zeros(len(off), np.uint64)
    single = np.flatnonzero(off < 0)
    if len(single):
        own = docs[single]
        columns = _words(eights, anchor[single], sizes[single], length)
        mask[single] = own > _least(*alike(columns), own)
    rest = np.flatnonzero(off >= 0)
    if not len(rest):
        return mask
    nth, windows, own, anchor = off[rest], sizes[rest] - length + 1, docs[rest], anchor[rest]
    ahead = _words(eights, anchor, sizes[rest] - nth, length)
    back = _words(eights, anchor, nth, max(1, left), ahead=False)
    order, new = alike([(windows << 8 | nth).astype(np.uint64), *ahead, *back])
    least = _least(order, new, own)
    # of each kind of entry, one of the smallest document
    kind = np.empty(len(rest), np.int64)
    kind[order] = np.cumsum(new) - 1
    head = np.empty(int(new.sum()), np.int64)
    smallest = np.flatnonzero(own == least)
    head[kind[smallest]] = smallest
    bits = np.zeros(len(head), np.uint64)
    # the sparse suffix array of the heads whose seed others have too
    words = [c[head] for c in ahead]
    order, _ = multikey_order(words)
    common = _common(words, order)
    shared = common >= SEED
    shared[:-1] |= shared[1:]
    order, common = order[shared], common[shared]
    words = [c[head[order]] for c in back]
    turned, _ = multikey_order(words)
    common_back = _common(words, turned)
    nth, windows, own_head = nth[head[order]], windows[head[order]], own[head[order]]
    side = np.empty(len(order), np.int64)
    for before in range(left + 1):
        at = np.flatnonzero((nth >= before) & (nth - before < windows))
        group = np.cumsum(common < length - before)[at]
        alone = _changes(group)
        alone[:-1] &= alone[1:]
        at, group = at[~alone], group[~alone]
        if not len(at):
            continue
        side[turned] = np.cumsum(common_back < before)
        both = group * (len(order) + 1) + side[at]
        by = np.argsort(both, kind="stable")
        of = own_head[at]
        found = at[of > _least(by, _changes(both[by]), of)]
        bits[order[found]] |= np.uint64(1) << (nth[found] - before).astype(np.uint64)
    every = (np.uint64(1) << (sizes[rest] - length + 1).astype(np.uint64)) - np.uint64(1)
    mask[rest] = np.where(own > least, every, bits[kind])
    return mask


def _set_bits(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The mask and the place of each bit that is set."""
    return np.nonzero(np.unpackbits(masks.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))


def _compare(length: int, way: Exchange):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        whole = pa.concat_tables([unpacked(x) for x in rows["entries"].to_pylist()]).combine_chunks()
        chunk, row, start, end, off, docs = (whole[c].to_numpy().astype(np.int64) for c in ("chunk", "row", "start", "end", "off", "doc"))
        settled, own = np.flatnonzero(off == SETTLED), np.flatnonzero(off != SETTLED)
        mask = repeated_windows(pa.concat_arrays(whole["content"].take(pa.array(own)).chunks), off[own], docs[own], length)
        at = np.flatnonzero(mask)
        mask = mask[at]
        # windows in a row make one range
        entry, nth = _set_bits(mask & ~(mask << np.uint64(1)))
        last = _set_bits(mask & ~(mask >> np.uint64(1)))[1]
        entry = own[at[entry]]
        first, last = start[entry] + nth, start[entry] + last
        every = np.concatenate([settled, entry])
        found = pa.table(
            {
                "to": pa.array(chunk[every]),
                "row": pa.array(row[every].astype(np.int32)),
                "start": pa.array(np.concatenate([start[settled], first]).astype(np.int32)),
                "end": pa.array(np.concatenate([end[settled], last + length]).astype(np.int32)),
            }
        )
        return sent(way, key[0].as_py(), 0, found)

    return run


def _cut(length: int, keep_text: bool, n_carried: int):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, found: pa.Table) -> pa.Table:
        release()
        chunk = _Chunk(rows, length)
        tables = [unpacked(x) for x in found["entries"].to_pylist()]
        ranges: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        if tables:
            row, start, end = (np.concatenate([t[c].to_numpy() for t in tables]) for c in ("row", "start", "end"))
            order = np.argsort(row, kind="stable")
            cuts = np.flatnonzero(np.diff(row[order])) + 1
            for at in np.split(order, cuts):
                ranges[int(row[at[0]])] = (start[at], end[at])
        out = []
        for i, text in enumerate(chunk.texts):
            removed = spans = 0
            if i in ranges:
                covered = _spread(*ranges[i], len(text))
                removed, spans = int(covered.sum()), len(_edges(covered)[0])
                kept = np.frombuffer(text, np.uint8)[~covered].tobytes()
            else:
                kept = text
            out.append((None if chunk.null[i] else chunk.ids[i], len(text), removed, spans, sha256(kept).hexdigest(), kept))
        ids, sizes, removed, spans, digests, kept = zip(*out, strict=True) if out else ([],) * 6
        columns = {
            "id": pa.array(ids, pa.int64()),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(removed, pa.int64()),
            "n_spans": pa.array(spans, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()),
        }
        if keep_text:
            columns["kept"] = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string())
        if n_carried:
            whole = chunk_table(rows)
            columns |= {f"carried_{i}": whole[f"carried_{i}"] for i in range(n_carried)}
        return pa.table(columns)

    return run


def _some_seeds(length: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for some in slices(batch, "text", 4 << 20, 1024):
                seeds = []
                for text in listed(some.column("text")):
                    at = anchored_runs([text], length).anchors
                    seeds += [text[a : a + SEED] for a in at[:: max(1, -(-len(at) // SAMPLED_SEEDS))].tolist()]
                yield pa.record_batch({"seed": pa.array(seeds, pa.binary())})

    return run


def sample_splitters(docs: DataFrame, n: int, length: int, id_col: str, text_col: str) -> list[bytes]:
    """At most n - 1 seeds that cut the suffixes of a sample evenly: some seeds of SAMPLED documents and SAMPLED_EACH more for
    each range, chosen by a hash. Splitters set where suffixes meet, not whether they do.
    """
    if n < 2:
        return []
    share = min(1.0, (SAMPLED + SAMPLED_EACH * n) / max(1, docs.count()))
    chosen = F.pmod(F.xxhash64(id_col, text_col), F.lit(1 << 30)) < int(share * (1 << 30))
    some = bounded(docs).filter(chosen).select(F.col(text_col).cast("binary").alias("text")).filter("text IS NOT NULL")
    seeds = sorted(bytes(r["seed"]) for r in some.mapInArrow(_some_seeds(length), "seed binary").collect())
    return sorted({seeds[i * len(seeds) // n] for i in range(1, n)}) if seeds else []


def remove_repeats(
    docs: DataFrame,
    length: int = 50,
    keep_text: bool = True,
    carry: list[str] = (),
    id_col: str = "doc_id",
    text_col: str = "text",
    fan: int = FAN,
    hot: int = HOT_DOCUMENTS,
) -> DataFrame:
    """Remove each byte of a text that is covered by a string of length bytes that starts in a smaller document too.

    Chunks give the distinct hashes of their anchors' seeds; hashes in two documents or more are worth a look. Suffixes
    at such anchors, with the bytes that their windows need, are dealt into ranges by sampled splitters on their leading
    SEED bytes, sorted there by multikey quicksort and compared with their neighbours. A window that a smaller
    document of the same chunk has is settled in the chunk, so a passage travels once for each chunk and not once for
    each copy. Equal leading bytes never lie on both sides of a splitter, so no comparison crosses a range; suffixes of
    seeds in over hot documents are split by longer prefixes, the bytes of whole windows. All matches are
    confirmed byte by byte. Hashes and suffixes travel in steps of at most fan rows for each task (chunks.Exchange).

    A null text is empty. A null id counts as larger than all ids; rows of equal ids do not remove each other's bytes.
    Extra columns are ignored but for those named in carry. Returns id_col, n_bytes, n_removed, n_spans (runs of removed
    bytes), kept_sha256 (of the remaining bytes), with keep_text the remaining text, kept, without the bytes of characters
    that a cut went through, and the carried columns.
    """
    total = text_bytes(docs, text_col)
    n_chunks, n_parts = parts_for(total, CHUNK_BYTES), parts_for(total, BUCKET_BYTES)
    n_ranges = min(n_parts, MOST_RANGES)
    ranges = Ranges(sample_splitters(docs, n_ranges, length, id_col, text_col), ceil(n_parts / n_ranges))
    way = Exchange.of(max(n_chunks, ranges.size), fan)
    chunks = in_chunks(docs, id_col, text_col, n_chunks, carry)
    asks = asked_further(chunks.groupBy("chunk").applyInArrow(_chunk_seeds(length, way), ASKED), way)
    grades = answered_back(asks, asks[-1].groupBy("node").applyInArrow(_grade_seeds(way, hot), ANSWERED), way)
    suffixes = (
        chunks.groupBy("chunk")
        .cogroup(grades.groupBy("node"))
        .applyInArrow(_chunk_suffixes(length, way, ranges), "node long, entries binary")
    )
    compared = forwarded(suffixes, way).groupBy("node").applyInArrow(_compare(length, way), "node long, entries binary")
    found = forwarded(compared, way)
    schema = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * keep_text
    schema += "".join(f", carried_{i} {docs.schema[c].dataType.simpleString()}" for i, c in enumerate(carry))
    done = chunks.groupBy("chunk").cogroup(found.groupBy("node")).applyInArrow(_cut(length, keep_text, len(carry)), schema)
    return done.withColumnsRenamed({"id": id_col} | {f"carried_{i}": c for i, c in enumerate(carry)})
