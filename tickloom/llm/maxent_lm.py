"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax and pair features.

A word's chance in its context mixes two parts. The first is that of its class, a softmax over hashed features of the
context - the word before (bigram), the classes of the two words before (trigram), and the word before that (skip) - times
its count plus one among the words of its class. Classes follow the shape of a word; the end of a text has its own. The
second is that of the word after the word before, by the counts of all hashed pairs of the corpus: what is gathered grows
with the corpus, and a word inside its class depends on its context. How much the second part weighs depends on how often
the word before was seen, and is fitted leaving each token's own pair out. All words never seen are one unknown word, as
in the base score, so the chances of all words of the training texts and of the unknown word sum to one.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from math import log10
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.chunks import (
    ANSWERED,
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
from tickloom.llm.lang_id import held_out
from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: The end of a text; no word holds white space.
END = b"\n"
#: The end's class and classes by shape.
CLASSES = 32
#: Hash buckets of each kind of feature; a row of the model for each, and one for what is always there.
BUCKETS = 4096
ROWS = 3 * BUCKETS + 1
BLOCK_ROWS = 512
MINIBATCH = 16_384
RATE = 0.25
#: Rounds of training; each takes its share of the documents and starts from the mean of the round before.
ROUNDS = 4
#: The weights of pairs are fitted for words before in so many grades of frequency.
GRADES = 20
WEIGHTS = np.array([0.0, 0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95])
LN10 = np.log(10.0)

_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def split_tokens(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct tokens (binary, END first), the tokens of all texts in turn, and how many each text has with its end.

    texts: binary. A-Z are lower-cased; tokens are what stands between white space (space and bytes 9 to 13).
    """
    parts = pc.ascii_split_whitespace(pc.ascii_lower(texts.view(pa.string())))
    flat, offsets = parts.flatten(), parts.offsets.to_numpy().astype(np.int64)
    full = pc.greater(pc.binary_length(flat), 0)
    upto = np.append(0, np.cumsum(full.to_numpy(zero_copy_only=False)))
    ends = upto[offsets - offsets[0]]
    coded = flat.filter(full).dictionary_encode()
    codes = np.insert(coded.indices.to_numpy().astype(np.int64) + 1, ends[1:], 0)
    tokens = pa.concat_arrays([pa.array([END], pa.binary()), coded.dictionary.view(pa.binary())])
    return tokens, codes, np.diff(ends) + 1


def class_of(word: bytes) -> int:
    """The end's class, or one by how the word begins and whether it ends in a sign."""
    if word == END:
        return 0
    last = word[-1:]
    return 1 + crc32(word[:2] + (last if not last.isalnum() and last < b"\x80" else b"")) % (CLASSES - 1)


#: Bytes that are signs at the end of a word.
_SIGN = np.array([i < 128 and not bytes([i]).isalnum() for i in range(256)])


def classes_of(words: pa.Array) -> np.ndarray:
    """class_of of binary words, asked once for those that begin and end alike."""
    if not len(words):
        return np.zeros(0, np.int32)
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    size = np.diff(ends)
    if not size.all():
        return np.fromiter(map(class_of, listed(words)), np.int32, len(words))
    data = np.frombuffer(words.buffers()[2], np.uint8)
    first, last = data[ends[:-1]].astype(np.int64), data[ends[1:] - 1].astype(np.int64)
    second = np.where(size > 1, data[np.minimum(ends[:-1] + 1, len(data) - 1)].astype(np.int64) + 1, 0)
    alike = pa.array((first * 257 + second) * 257 + np.where(_SIGN[last], last + 1, 0)).dictionary_encode().indices.to_numpy()
    one = np.zeros(alike.max() + 1, np.int64)
    one[alike] = np.arange(len(alike))
    return np.fromiter(map(class_of, listed(words.take(pa.array(one)))), np.int32, len(one))[alike]


def contexts(codes: np.ndarray, sizes: np.ndarray, end: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The token before each one, and the one before that; an end stands before each text."""
    before = np.append(end, codes)[:-1]
    further = np.append(end, before)[:-1]
    further[np.cumsum(sizes) - sizes] = end
    return before, further


def pair_keys(tokens: list[bytes], before: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each token and the one before it."""
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    mixed = hashes[before] * _LEFT + hashes[codes]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _RIGHT
    return mixed ^ (mixed >> np.uint64(29))


def in_training(ids: list[int | None], folds: int, fold: int) -> np.ndarray:
    return np.array([i is None or crc32(str(i).encode()) % folds != fold for i in ids], bool)


@dataclass
class ClassModel:
    """The counts plus one of all words of each class, the weights of the features for each class, and those of pairs."""

    class_weight: np.ndarray
    tokens: int
    types: int
    weights: np.ndarray = field(default_factory=lambda: np.zeros((ROWS, CLASSES), np.float32))
    pair_weight: np.ndarray = field(default_factory=lambda: np.zeros(GRADES))

    @property
    def unknown(self) -> float:
        """The chance of the unknown word where pairs say nothing."""
        return 1 / (self.tokens + self.types + 1)

    def features(self, tokens: pa.Array, codes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The class of each token and the rows of its three features."""
        classes = classes_of(tokens)
        hashes = np.fromiter(map(crc32, listed(tokens)), np.int64, len(tokens)).astype(np.int32) % BUCKETS
        before, further = contexts(codes, sizes)
        pair = (classes[before] * CLASSES + classes[further]) % BUCKETS
        return classes[codes], np.stack([hashes[before], BUCKETS + hashes[further], 2 * BUCKETS + pair])

    def logits(self, rows: np.ndarray) -> np.ndarray:
        z = self.weights.take(rows[0], 0)  # three times as fast as an index
        z += self.weights.take(rows[1], 0)
        z += self.weights.take(rows[2], 0)
        z += self.weights[-1]
        return z

    def exponents(self, own: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """exp of the logits, its sum for each token, and the logit of each token's class; where exp would leave float32's
        range, each token's logits are less by their greatest."""
        at, z = np.arange(len(own)), self.logits(rows)
        got = z[at, own]
        with np.errstate(over="ignore"):
            sums = np.einsum("ij->i", np.exp(z, out=z))
        if not (sums.min() > 1e-20 and sums.max() < 1e30):
            z = self.logits(rows)
            z -= z.max(1, keepdims=True)
            got = z[at, own]
            sums = np.einsum("ij->i", np.exp(z, out=z))
        return z, sums, got

    def class_scores(self, own: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """The natural logarithm of the chance of each token's class."""
        out = np.empty(len(own))
        for at in range(0, len(own), MINIBATCH // 4):  # what stays near the processor
            some = slice(at, at + MINIBATCH // 4)
            _, sums, got = self.exponents(own[some], rows[:, some])
            out[some] = got - np.log(sums)
        return out


class Trainer:
    """Gradient steps on the weights of a model, each row with a rate that falls with what it has been moved."""

    def __init__(self, model: ClassModel, rate: float = RATE):
        self.model, self.rate = model, rate
        self.moved = np.full(ROWS, 1.0, np.float32)
        self.used = np.zeros(ROWS, np.int64)

    def learn(self, own: np.ndarray, rows: np.ndarray) -> None:
        for at in range(0, len(own), MINIBATCH):
            self._step(own[at : at + MINIBATCH], rows[:, at : at + MINIBATCH])

    def _step(self, own: np.ndarray, rows: np.ndarray) -> None:
        z, sums, _ = self.model.exponents(own, rows)
        z /= sums[:, None]
        z[np.arange(len(z)), own] -= 1
        for kind in rows:
            order = np.argsort((kind % BUCKETS).astype(np.uint16), kind="stable")
            kind = kind[order]
            first = np.flatnonzero(np.diff(kind, prepend=-1))
            n = np.diff(first, append=len(kind))
            self._move(kind[first], self._sums(z, order, first, n), n)
        self._move(np.array([ROWS - 1]), z.sum(0, keepdims=True), np.array([len(z)]))

    def _sums(self, z: np.ndarray, order: np.ndarray, first: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Sums of the rows of z in groups of order, which begin at first and have n rows. reduceat takes as long for a group of
        one or two as for a larger one, and for two numbers (as a complex one) as for one."""
        sums = z.take(order[first], 0)
        two, more = np.flatnonzero(n == 2), np.flatnonzero(n > 2)
        sums[two] += z.take(order[first[two] + 1], 0)
        if len(more):
            rows = z.take(order[np.repeat(n > 2, n)], 0).view(np.complex64)
            sums[more] = np.add.reduceat(rows, np.cumsum(n[more]) - n[more], axis=0).view(np.float32)
        return sums

    def _move(self, at: np.ndarray, gradient: np.ndarray, n: np.ndarray) -> None:
        gradient /= np.sqrt(n)[:, None].astype(np.float32)
        self.moved[at] += np.einsum("ij,ij->i", gradient, gradient)
        self.model.weights[at] -= gradient * (self.rate / np.sqrt(self.moved[at]))[:, None] * 2
        self.used[at] += n


# -- words, pairs and their counts ----------------------------------------------------------------------------------------


class _Chunk:
    """The tokens of a chunk, and its distinct words and pairs in ascending order with their counts in training texts."""

    def __init__(self, rows: pa.Table, folds: int, fold: int):
        self.ids, texts = chunk_documents(rows)
        words, codes, self.sizes = split_tokens(texts)
        order = pc.sort_indices(words).to_numpy().astype(np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        self.words, self.codes, end = words.take(pa.array(order)), rank[codes], rank[0]
        self.tokens = listed(self.words)
        self.learned = in_training(self.ids, folds, fold)
        self.before, self.further = contexts(self.codes, self.sizes, end)
        self.pairs, self.pair = np.unique(pair_keys(self.tokens, self.before, self.codes), return_inverse=True)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        learned = np.repeat(self.learned, self.sizes)
        words, pairs = np.bincount(self.codes[learned], minlength=len(self.words)), np.bincount(self.pair[learned], minlength=len(self.pairs))
        return words.astype(np.uint32), pairs.astype(np.uint32)


#: Rows of chunks.ASKED, kind 0 for words and 1 for pairs; nodes of pairs come after those of words.
def _chunk_counts(folds: int, fold: int, way: Exchange):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        release()
        chunk, node = _Chunk(rows, folds, fold), key[0].as_py()
        words, pairs = chunk.counts()
        return pa.concat_tables(
            [_of_kind(0, asked(way, node, 0, chunk.words, n=words)), _of_kind(1, asked(way, node, 0, pa.array(chunk.pairs), n=pairs))]
        )

    return run


def _of_kind(kind: int, rows: pa.Table) -> pa.Table:
    return rows.append_column("kind", pa.array([kind] * rows.num_rows, pa.int32()))


_ASKED = "node long, slot int, entries binary, kind int"
_COUNTED = ANSWERED + ", kind int, what string, n long"


def _sum_counts(way: Exchange):
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        """For each asker the counts of its keys; for words also their sums and those of each class."""
        release()
        asks, node, kind = Asks(rows), key[0].as_py(), key[1].as_py()
        n = asks.sums["n"]
        found = _of_kind(kind, asks.answered(way, node, way.levels - 1, pa.array(n)))
        found = found.append_column("what", pa.nulls(found.num_rows, pa.string())).append_column("n", pa.nulls(found.num_rows, pa.int64()))
        if kind:
            return found
        known = np.flatnonzero(n)
        classes = classes_of(asks.keys.take(pa.array(known)))
        weight = np.bincount(classes, weights=n[known] + 1, minlength=CLASSES).astype(np.int64).tolist()
        what, sums = ["tokens", "types", *map(str, range(CLASSES))], [int(n.sum()), len(known), *weight]
        nothing = {c: pa.nulls(len(what), t) for c, t in (("node", pa.int64()), ("slot", pa.int32()), ("answer", pa.binary()))}
        more = pa.table({**nothing, "kind": pa.array([-1] * len(what), pa.int32()), "what": pa.array(what), "n": pa.array(sums, pa.int64())})
        return pa.concat_tables([found, more])

    return run


def class_model(counted: DataFrame) -> ClassModel:
    """Sizes and classes from the written counts: one row for each class reaches the driver, and two more."""
    sums = {r["what"]: r["n"] for r in counted.filter("kind = -1").groupBy("what").agg(F.sum("n").alias("n")).collect()}
    weight = np.array([sums.get(str(i), 0) for i in range(CLASSES)], np.float64)
    model = ClassModel(weight, sums.get("tokens", 0), sums.get("types", 0))
    # before any step, the features say nothing and each class has its share; a class without words has none
    model.weights[-1] = np.where(weight > 0, np.log(np.maximum(weight, 1) / max(weight.sum(), 1)), -1e4)
    return model


# -- training and scoring ---------------------------------------------------------------------------------------------


def _train(shared, rate: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        start: ClassModel = shared.value
        trainer = Trainer(ClassModel(start.class_weight, start.tokens, start.types, start.weights.copy()), rate)
        for batch in batches:
            for some in slices(batch, "text", 4 << 20, 4096):
                tokens, codes, sizes = split_tokens(some.column("text"))
                trainer.learn(*trainer.model.features(tokens, codes, sizes))
        for block in range(0, ROWS, BLOCK_ROWS):
            some = slice(block, block + BLOCK_ROWS)
            if trainer.used[some].any():
                weighted = trainer.model.weights[some] * trainer.used[some, None].astype(np.float32)
                yield pa.record_batch(
                    {
                        "block": pa.array([block], pa.int32()),
                        "used": pa.array([trainer.used[some].astype("<i8").tobytes()], pa.binary()),
                        "weighted": pa.array([weighted.astype("<f4").tobytes()], pa.binary()),
                    }
                )

    return run


def _sum_blocks(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    used, weighted = 0, 0
    for batch in batches:
        for u, w in zip(batch.column("used").to_pylist(), batch.column("weighted").to_pylist(), strict=True):
            used = used + np.frombuffer(u, "<i8")
            weighted = weighted + np.frombuffer(w, "<f4").astype(np.float64)
    yield pa.record_batch(
        {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "used": pa.array([used.astype("<i8").tobytes()], pa.binary()),
            "weighted": pa.array([weighted.astype("<f4").tobytes()], pa.binary()),
        }
    )


def train_classes(docs: DataFrame, model: ClassModel, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> ClassModel:
    """Fit the weights of the features to all texts of docs, each seen once, in so many synchronous rounds.

    A round takes the documents of one hash of the id. Each task takes gradient steps over its own texts from the model of
    the round before; a row of the model then is the mean of the tasks' rows, each weighed by how often the task used it,
    and rates fall from round to round. The softmax has a fixed size (BUCKETS, CLASSES) that is broadcast; tasks' rows are
    summed in two steps, and only the sums reach the driver.
    """
    spark = docs.sparkSession
    schema = "block int, used binary, weighted binary"
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        now = bounded(docs).filter(F.pmod(F.xxhash64(id_col), F.lit(rounds)) == turn)
        slim = now.select(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
        parts = slim.mapInArrow(_train(shared, RATE / (1 + turn) ** 0.5), schema).withColumn("salt", F.spark_partition_id() % 16)
        some = parts.groupBy("block", "salt").applyInArrow(_sum_blocks, schema)
        weights = model.weights.copy()
        for row in some.groupBy("block").applyInArrow(_sum_blocks, schema).collect():
            used = np.frombuffer(row["used"], "<i8")
            mean = np.frombuffer(row["weighted"], "<f4").reshape(len(used), CLASSES) / np.maximum(used, 1)[:, None]
            at = slice(row["block"], row["block"] + len(used))
            weights[at] = np.where(used[:, None] > 0, mean, weights[at])
        model = ClassModel(model.class_weight, model.tokens, model.types, weights, model.pair_weight)
        shared.unpersist()
    return model


def _chances(model: ClassModel, chunk: _Chunk, way: Exchange, node: int, answers: pa.Table) -> tuple[np.ndarray, ...]:
    """For the tokens of a chunk: count, the count of the word before, that of the pair, and the chance without pairs."""
    found = []
    for kind, keys in enumerate((chunk.words, pa.array(chunk.pairs))):
        got = collected(way, node, 0, keys, answers.filter(pc.equal(answers["kind"], kind)))
        found.append(np.zeros(0, np.int64) if got is None else got.to_numpy())
    words, pairs = found
    n = words[chunk.codes]
    classes = classes_of(chunk.words)
    hashes = (np.fromiter(map(crc32, chunk.tokens), np.int64, len(chunk.tokens)) % BUCKETS).astype(np.int32)
    own, skip = classes[chunk.codes], classes[chunk.before] * CLASSES + classes[chunk.further]
    rows = np.stack([hashes[chunk.before], BUCKETS + hashes[chunk.further], 2 * BUCKETS + skip % BUCKETS])
    plain = np.exp(model.class_scores(own, rows)) * (n + 1) / np.maximum(model.class_weight, 1)[own]
    plain = np.where(n > 0, (1 - model.unknown) * plain, model.unknown)
    return n, words[chunk.before], pairs[chunk.pair], plain


def grade(n: np.ndarray) -> np.ndarray:
    """The grade of frequency of words before: how many binary digits their count has."""
    return np.minimum(np.ceil(np.log2(n + 1.0)).astype(np.int64), GRADES - 1)


def _fit(shared, folds: int, fold: int, way: Exchange):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        """The log likelihood of the chunk's training tokens for each grade and each of WEIGHTS, their own pair left out."""
        release()
        chunk = _Chunk(docs, folds, fold)
        n, before, pair, plain = _chances(shared.value, chunk, way, key[0].as_py(), answers)
        own = np.repeat(chunk.learned, chunk.sizes) & (before > 1)
        before, pair, plain = before[own] - 1.0, pair[own] - 1.0, (plain * n / (n + 1))[own]
        grades, met = grade(before), pair > 0
        share, left = (pair / before)[met], plain[met]
        # a pair that is met nowhere else has the chance without pairs, times what its weight leaves
        alone, alone_sum = np.bincount(grades[~met], minlength=GRADES), np.bincount(grades[~met], np.log(plain[~met]), minlength=GRADES)
        sums = [alone_sum + alone * np.log(1 - w) + np.bincount(grades[met], np.log(w * share + (1 - w) * left), minlength=GRADES) for w in WEIGHTS]
        at, of = np.indices((len(WEIGHTS), GRADES))
        return pa.table({"weight": pa.array(at.ravel(), pa.int32()), "grade": pa.array(of.ravel(), pa.int32()), "fits": pa.array(np.array(sums, np.float64).ravel())})

    return run


def _score(shared, folds: int, fold: int, way: Exchange):
    def run(key: tuple[pa.Scalar, ...], docs: pa.Table, answers: pa.Table) -> pa.Table:
        release()
        model: ClassModel = shared.value
        chunk = _Chunk(docs, folds, fold)
        n, before, pair, plain = _chances(model, chunk, way, key[0].as_py(), answers)
        weight = np.where(before > 0, model.pair_weight[grade(before)], 0.0)
        score = np.log10(weight * pair / np.maximum(before, 1) + (1 - weight) * plain)
        base = np.log10(n + 1.0) - log10(model.tokens + model.types + 1)
        starts = np.cumsum(chunk.sizes) - chunk.sizes
        add = np.add.reduceat if len(starts) else lambda x, _: x[:0]
        return pa.table(
            {
                "id": pa.array(chunk.ids, pa.int64()),
                "held_out": pa.array(~chunk.learned, pa.bool_()),
                "n_tokens": pa.array(chunk.sizes.astype(np.int64)),
                "n_known": pa.array(add((n > 0).astype(np.int64), starts)),
                "base_score": pa.array(add(base, starts)),
                "score": pa.array(add(score, starts)),
            }
        )

    return run


def score_documents(
    docs: DataFrame,
    folds: int = 7,
    fold: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    fan: int = FAN,
) -> DataFrame:
    """Learn from the documents outside one fold of ids and score all whole texts.

    Counts of words and of pairs cover all training texts: chunks give their distinct words and pairs with counts, as many
    nodes sum them and answer each chunk (chunks.Exchange), and the chunk scores its texts, so no vocabulary is ever in
    one place. The weights of pairs are fitted on all training texts, chunk by chunk. Score is the log10 of the
    chance of the text's tokens and its end; base_score is that of single tokens with counts plus one.

    A null or empty text has its end alone. Null ids are trained on and not held out. Repeated rows count and are scored
    each; extra columns are ignored; an empty table gives no rows. Returns id_col, held_out, n_tokens, n_known,
    train_tokens, base_score, score.
    """
    spark = docs.sparkSession
    n_chunks = parts_for(text_bytes(docs, text_col), chunk_bytes)
    way = Exchange.of(n_chunks, fan)
    chunks = in_chunks(docs, id_col, text_col, n_chunks)
    asks = asked_further(chunks.groupBy("chunk").applyInArrow(_chunk_counts(folds, fold, way), _ASKED), way, ["kind"])
    counted = written(asks[-1].groupBy("node", "kind").applyInArrow(_sum_counts(way), _COUNTED), "token-counts")
    model = train_classes(docs.filter(~held_out(id_col, folds, fold)), class_model(counted), id_col, text_col)
    answers = answered_back(asks, counted.filter("kind >= 0").select("node", "slot", "answer", "kind"), way, ["kind"])

    shared = spark.sparkContext.broadcast(model)
    fitted = chunks.groupBy("chunk").cogroup(answers.groupBy("node")).applyInArrow(_fit(shared, folds, fold, way), "weight int, grade int, fits double")
    fits = np.zeros((len(WEIGHTS), GRADES))
    for row in fitted.groupBy("weight", "grade").agg(F.sum("fits").alias("fits")).collect():
        fits[row["weight"], row["grade"]] = row["fits"]
    model.pair_weight = WEIGHTS[fits.argmax(0)]
    shared = spark.sparkContext.broadcast(model)
    schema = "id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    scored = chunks.groupBy("chunk").cogroup(answers.groupBy("node")).applyInArrow(_score(shared, folds, fold, way), schema)
    return scored.withColumnRenamed("id", id_col).withColumn("train_tokens", F.lit(model.tokens).cast("long"))
