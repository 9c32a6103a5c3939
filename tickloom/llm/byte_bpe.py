"""Byte-level BPE: ranked merges folded over the distinct words by Spark's higher-order functions."""

from __future__ import annotations

import base64
import json
from collections.abc import Callable
from hashlib import sha256
from heapq import heapify, heappop, heappush
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import (
    ANSWERED,
    ASKED,
    CHUNK_BYTES,
    FAN,
    Asks,
    Exchange,
    answered_back,
    asked,
    asked_further,
    chunk_documents,
    collected,
    in_chunks,
    parts_for,
    text_bytes,
)
from tickloom.llm.units import as_text, listed, one_line, release, split_units

#: Words of more bytes than this are cut, without effect on their ids.
LONG = 512
#: Units whose texts are put together at once, from some 6 bytes each.
UNITS_AT_ONCE = 250_000
#: The rank map is a list of this many small maps, as Spark searches a map from its start.
RANK_MAPS = 8192
NO_RANK = 2**31 - 1


def load_ranks(path: str) -> dict[bytes, int]:
    """Byte strings and their ranks from a vocabulary file with a line of base64 and rank for each."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


# -- the fold ---------------------------------------------------------------------------------------------------------


def rank_literal(ranks: dict[bytes, int]) -> Column:
    """The rank map as a literal: array<map<string,int>> of hexadecimal keys, indexed by crc32 of the key's bytes."""
    maps: list[dict[str, int]] = [{} for _ in range(RANK_MAPS)]
    for k, v in ranks.items():
        maps[crc32(k) % RANK_MAPS][k.hex().upper()] = v
    return F.from_json(F.lit(json.dumps(maps)), "array<map<string,int>>")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def encode_word(word: Column, ranks: Column) -> Column:
    """_encode_word with the rank map named once in the plan."""
    return _let(ranks, lambda r: _encode_word(word, r))


def _encode_word(word: Column, ranks: Column) -> Column:
    """Token ids of one binary word: pairs of pieces are merged in the order of their rank, the leftmost first.

    The fold's state has one long for each piece: the rank of the piece joined with the next one, and, in the lower 32
    bits, the piece's first byte, so the least long is the pair to merge. Two entries after the last piece end it.
    """
    size = F.octet_length(word)
    no_rank = F.lit(NO_RANK << 32)

    def rank(first: Column, end: Column) -> Column:
        def found(piece: Column) -> Column:
            at = (F.crc32(piece) % RANK_MAPS).cast("int") + 1
            return F.try_element_at(F.element_at(ranks, at), F.hex(piece))

        return _let(F.substring(word, first, end - first), found)

    def entry(first: Column, end: Column) -> Column:
        high = F.when(end > first, F.coalesce(rank(first, end), F.lit(NO_RANK))).otherwise(F.lit(NO_RANK))
        return F.shiftleft(high.cast("long"), 32) + first

    def start(acc: Column, i: Column) -> Column:
        return F.element_at(acc, i).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")

    def step(acc: Column, _: Column) -> Column:
        def merged_at(p: Column) -> Column:
            first, after, end = start(acc, p), start(acc, p + 2), start(acc, p + 3)
            new = F.when(after <= size, entry(first, end)).otherwise(no_rank + first)
            before = F.when(p > 1, F.array(entry(start(acc, F.greatest(p - 1, F.lit(1))), after))).otherwise(
                F.array().cast("array<bigint>")
            )
            return F.concat(
                F.slice(acc, 1, F.greatest(p - 2, F.lit(0))), before, F.array(new), F.slice(acc, p + 2, F.size(acc))
            )

        def maybe(least: Column) -> Column:
            return F.when(least < no_rank, _let(F.array_position(acc, least).cast("int"), merged_at)).otherwise(acc)

        return _let(F.array_min(acc), maybe)

    pairs = F.transform(F.sequence(F.lit(1), size), lambda i: entry(i, F.when(i < size, i + 2).otherwise(i)))
    ends = F.array((no_rank + size + 1), (no_rank + size + 1))
    steps = F.when(size > 1, F.sequence(F.lit(1), size - 1)).otherwise(F.array().cast("array<int>"))

    def ids(acc: Column) -> Column:
        pieces = F.sequence(F.lit(1), F.size(acc) - 2)
        return F.transform(pieces, lambda i: rank(start(acc, i), start(acc, i + 1)))

    whole = F.array(rank(F.lit(1), size + 1))
    folded = F.aggregate(steps, F.concat(pairs, ends), step, ids)
    return _let(whole, lambda w: F.when(F.element_at(w, 1).isNotNull(), w).otherwise(folded))


def merge_ends(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Where the pieces of a word end once all merges are done, by a heap of pairs: near linear in the word's length."""
    n = len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))  # the first bytes of the pieces beside each piece

    def rank(first: int) -> int | None:
        second = after[first]
        return ranks.get(word[first : after[second]]) if second < n else None

    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    gone = bytearray(n)
    while heap:
        _, i, end = heappop(heap)
        if gone[i] or after[i] == n or after[after[i]] != end:
            continue  # one of the two pieces has changed since
        j = after[i]
        gone[j] = 1
        after[i] = end
        if end < n:
            before[end] = i
        for k in (before[i], i):
            if k >= 0 and (r := rank(k)) is not None:
                heappush(heap, (r, k, after[after[k]]))
    return [after[i] for i in range(n) if not gone[i]]


def safe_pieces(word: str, ranks: dict[bytes, int]) -> list[str]:
    """A word as it is up to LONG bytes, else in pieces of about half of that, cut where its merges end.

    No merge reaches across such a place, so the pieces' ids joined are the word's. The fold's work grows with the square of
    a word's length, which this bounds. A cut inside a character is moved on to the next one that is none.
    """
    raw = word.encode()
    if len(raw) <= LONG:
        return [word]
    pieces, at = [], 0
    for end in merge_ends(raw, ranks):
        if end == len(raw) or (end - at >= LONG // 2 and raw[end] & 0xC0 != 0x80):
            pieces.append(raw[at:end].decode())
            at = end
    return pieces


# -- around the fold: words of a chunk, and texts from the ids of its words ----------------------------------------------


def stand_ins() -> dict[int, str]:
    """Characters that the tiktoken library's tables of letters and digits class otherwise than the regex module's, which
    are of another version of Unicode, each with a character of the class that the library gives it.

    One call for each class asks the library which of all characters it matches.
    """
    import regex
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    found: dict[int, str] = {}
    for kind, instead in ((r"\p{L}", "x"), (r"\p{N}", "0")):
        library = tiktoken.Encoding("class", pat_str=kind, mergeable_ranks={bytes([i]): i for i in range(256)}, special_tokens={})
        theirs = {*bytes(library.encode_ordinary(every)).decode()}
        ours = {*regex.findall(kind, every)}
        found |= {ord(c): "!" for c in ours - theirs if ord(c) not in found} | {ord(c): instead for c in theirs - ours}
    return found


def _with_any(units: list[str], points: Iterable[int]) -> np.ndarray:
    """Whether each unit has one of some code points, by a table that all characters are looked up in at once."""
    found, whole = np.zeros(len(units), bool), "".join(units)
    if not whole.isascii():
        table = np.zeros(0x110000, bool)
        table[[*points]] = True
        ends = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        found[np.searchsorted(ends, np.flatnonzero(table[np.frombuffer(whole.encode("utf-32-le"), "<u4")]), "right")] = True
    return found


class _Words:
    """The distinct words of a chunk's texts, the words of each distinct unit, and the units of each text."""

    def __init__(self, raw: pa.Array, pattern: str, ranks: dict[bytes, int], instead: dict[int, str]):
        units, self.units, self.sizes = split_units(as_text(raw))
        self._find_words(units, pattern, ranks, instead)

    def _find_words(self, units: list[str], pattern: str, ranks: dict[bytes, int], instead: dict[int, str]) -> None:
        """Units without inner white space are searched in one go, a line for each; line ends are words of their own. A unit
        with a character of instead is searched alone, with the characters that stand in for them.

        Words ascend, and stand in for the pieces of a word longer than LONG, cut where no merge reaches across.
        """
        import regex

        compiled = regex.compile(pattern)

        def find(text: str, plain: bool = True) -> list[str]:
            found = compiled.findall(text) if plain else [text[slice(*m.span())] for m in compiled.finditer(text.translate(instead))]
            if len(text) > LONG // 4 and any(len(w) > LONG // 4 and len(w.encode()) > LONG for w in found):
                found = [p for w in found for p in safe_pieces(w, ranks)]
            return found

        usual = (~_with_any(units, instead)).tolist()
        plain = [a and one_line(u) for a, u in zip(usual, units, strict=True)]
        found = pa.array(find("\n".join([u for u, p in zip(units, plain, strict=True) if p])), pa.string())
        ends = np.append(np.flatnonzero(pc.equal(found, "\n").to_numpy(zero_copy_only=False)), len(found))
        sizes = np.diff(ends, prepend=-1) - 1
        single = [find(u, a) for u, p, a in zip(units, plain, usual, strict=True) if not p]
        words = pa.concat_arrays([found, pa.array([w for x in single for w in x], pa.string())]).dictionary_encode()
        index = words.indices.to_numpy().astype(np.int64)
        # where the words of each unit start in index, and how many there are
        first, self.unit_sizes = np.zeros(len(units), np.int64), np.zeros(len(units), np.int64)
        plain = np.array(plain, bool)
        if plain.any():
            first[plain], self.unit_sizes[plain] = np.append(0, ends[:-1] + 1), sizes
        lengths = np.fromiter(map(len, single), np.int64, len(single))
        first[~plain], self.unit_sizes[~plain] = len(found) + np.cumsum(lengths) - lengths, lengths
        before = np.cumsum(self.unit_sizes) - self.unit_sizes
        raw = words.dictionary.cast(pa.binary())
        order = pc.sort_indices(raw).to_numpy().astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.unit_words = rank[index[np.repeat(first - before, self.unit_sizes) + np.arange(self.unit_sizes.sum())]]
        self.words = raw.take(pa.array(order))


def _joined(values: pa.Array, at: np.ndarray, sizes: np.ndarray, between: str | bytes) -> pa.Array:
    """For each size: so many of values[at], joined."""
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), values.take(pa.array(at))), between)


def _ranges(starts: np.ndarray, counts: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
    """The places start, start + 1, ... of each range, or of each range at a place of at."""
    if at is not None:
        starts, counts = starts[at], counts[at]
    before = np.cumsum(counts) - counts
    return np.repeat(starts - before, counts) + np.arange(counts.sum())


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    ends = np.append(0, np.cumsum(values))
    upto = np.cumsum(sizes)
    return ends[upto] - ends[upto - sizes]


def _chunk_words(pattern: str, ranks: dict[bytes, int], instead: dict[int, str], way: Exchange):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        return asked(way, key[0].as_py(), 0, _Words(chunk_documents(rows)[1], pattern, ranks, instead).words)

    return run


def _distinct_words(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
    words = Asks(rows).keys
    return pa.table({"node": pa.array([key[0].as_py()] * len(words), pa.int64()), "word": words})


def _answer_words(way: Exchange):
    def run(key: tuple[pa.Scalar, ...], encoded: pa.Table, rows: pa.Table) -> pa.Table:
        release()
        asks, encoded = Asks(rows), encoded.combine_chunks()
        order = pc.sort_indices(encoded["word"])  # keys of asks ascend
        return asks.answered(way, key[0].as_py(), way.levels - 1, encoded["ids"].combine_chunks().take(order))

    return run


def _text_slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Ranges of texts that have at most so many units together; a longer text stands alone."""
    upto, cuts = np.cumsum(sizes), [0]
    while cuts[-1] < len(sizes):
        before = int(upto[cuts[-1] - 1]) if cuts[-1] else 0
        cuts.append(max(cuts[-1] + 1, int(np.searchsorted(upto, before + most, "right"))))
    return list(zip(cuts, cuts[1:]))


def _encode_chunk(pattern: str, ranks: dict[bytes, int], instead: dict[int, str], way: Exchange, pieces: list[bytes], keep_ids: bool, keep_decoded: bool, at_once: int):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        ids, texts = chunk_documents(docs)
        chunk = _Words(texts, pattern, ranks, instead)
        del texts, docs
        found = collected(way, key[0].as_py(), 0, chunk.words, answers)
        if found is None:
            found = pa.array([], pa.list_(pa.int32()))
        tokens, counts = found.flatten(), pc.list_value_length(found).to_numpy(zero_copy_only=False).astype(np.int64)
        every = np.arange(len(tokens))
        # from tokens to words and from words to units, each distinct one once; then, a slice at a time, from units to texts
        words = chunk.unit_words
        names = _joined(_joined(tokens.cast(pa.string()), every, counts, " "), words, chunk.unit_sizes, " ")
        raw = _joined(_joined(pa.array(pieces, pa.binary()).take(tokens), every, counts, b""), words, chunk.unit_sizes, b"")
        in_units = _sums(counts[words], chunk.unit_sizes)
        n_tokens = _sums(in_units[chunk.units], chunk.sizes)
        at_word = _ranges((np.cumsum(counts) - counts)[words], counts[words]) if keep_ids else None
        first, unit = np.cumsum(in_units) - in_units, np.append(0, np.cumsum(chunk.sizes))
        hashed: dict[str, list[str]] = {"ids_sha256": [], "decoded_sha256": []}
        kept: dict[str, list[pa.Array]] = {"token_ids": [], "decoded": []}
        for begin, end in _text_slices(chunk.sizes, at_once):
            units, sizes = chunk.units[unit[begin] : unit[end]], chunk.sizes[begin:end]
            for name, values, between in (("ids_sha256", names, " "), ("decoded_sha256", raw, b"")):
                whole = _joined(values, units, sizes, between).cast(pa.binary())
                hashed[name] += [sha256(x.as_buffer()).hexdigest() for x in whole]
                if keep_decoded and name == "decoded_sha256":
                    kept["decoded"].append(whole)
            if keep_ids:
                at = at_word[_ranges(first, in_units, units)]
                ends = np.append(0, np.cumsum(n_tokens[begin:end])).astype(np.int32)
                kept["token_ids"].append(pa.ListArray.from_arrays(pa.array(ends), tokens.take(pa.array(at))))
        columns = {"id": pa.array(ids, pa.int64()), "n_tokens": pa.array(n_tokens)} | {c: pa.array(v, pa.string()) for c, v in hashed.items()}
        if keep_ids:
            columns["token_ids"] = pa.chunked_array(kept["token_ids"], pa.list_(pa.int32()))
        if keep_decoded:
            columns["decoded"] = pa.chunked_array(kept["decoded"], pa.binary())
        return pa.table(columns)

    return run


def encode_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keep_ids: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    fan: int = FAN,
    keep_decoded: bool | None = None,
) -> DataFrame:
    """Token ids of every text by the given ranks, each match of pattern encoded on its own, and the decoded bytes.

    Documents are dealt into chunks; each chunk gives its distinct words; the distinct words of all chunks are encoded
    once each by a fold over their bytes (encode_word); the ids return to the chunks that asked, which put them in
    the order of their texts and decode them by joining the pieces. Texts are shuffled once, compressed; words travel in
    steps of at most fan rows for each task (chunks.Exchange). The fold's work grows with the square of a word's length;
    words over LONG bytes, however long, are cut first where no merge reaches across.

    Letters and digits are those of the tiktoken library's tables (stand_ins).

    Returns one row for each row of docs: id_col, n_tokens, ids_sha256 (of the decimal ids joined by spaces),
    decoded_sha256, with keep_ids token_ids, and with keep_decoded (if not given: with keep_ids) decoded. A null or empty text has no tokens. Repeated rows give
    repeated rows; null ids stay null. Extra columns are ignored.
    """
    keep_decoded = keep_ids if keep_decoded is None else keep_decoded
    ranks, instead = load_ranks(ranks_path), stand_ins()
    n_chunks = parts_for(text_bytes(docs, text_col), chunk_bytes)
    way = Exchange.of(n_chunks, fan)
    chunks = in_chunks(docs, id_col, text_col, n_chunks)
    asks = asked_further(chunks.groupBy("chunk").applyInArrow(_chunk_words(pattern, ranks, instead, way), ASKED), way)
    distinct = asks[-1].groupBy("node").applyInArrow(_distinct_words, "node long, word binary")
    encoded = distinct.select("node", "word", encode_word(F.col("word"), rank_literal(ranks)).alias("ids"))
    found = encoded.groupBy("node").cogroup(asks[-1].groupBy("node")).applyInArrow(_answer_words(way), ANSWERED)
    answers = answered_back(asks, found, way)
    schema = "id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", token_ids array<int>" * keep_ids + ", decoded binary" * keep_decoded
    pieces = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        pieces[i] = piece
    done = (
        chunks.groupBy("chunk")
        .cogroup(answers.groupBy("node"))
        .applyInArrow(_encode_chunk(pattern, ranks, instead, way, pieces, keep_ids, keep_decoded, UNITS_AT_ONCE), schema)
    )
    return done.withColumnRenamed("id", id_col)
