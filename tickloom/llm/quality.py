"""Text quality by hashed word n-gram logistic regression with follow-the-regularised-leader updates."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.lang_id import held_out
from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: Hash buckets of all n-grams; the first one is the constant.
FEATURES = 1 << 18
#: Labelled documents that the model is fitted on at most (in expectation), and parts that they are learned in.
FIT_ROWS, SHARDS = 20_000, 8
#: Bytes of a text that are hashed at once.
PIECE_BYTES = 1 << 20
#: Words as their shapes: a lower-case or non-ASCII letter is a, an upper-case one A, a digit 0; runs count once.
_SHAPE = bytes(97 if b >= 128 or 97 <= b <= 122 else 65 if 65 <= b <= 90 else 48 if 48 <= b <= 57 else b for b in range(256))


def _hashed(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(crc32, words), np.uint32, len(words))


def _bucket(h: np.ndarray) -> np.ndarray:
    """Buckets from 1 on for 32-bit hashes."""
    return (h * np.uint32(0x9E3779B1) >> np.uint32(14)).astype(np.int64) % (FEATURES - 1) + 1


def _shapes(text: bytes) -> list[bytes]:
    b = np.frombuffer(text.translate(_SHAPE), np.uint8)
    return b[np.append(True, b[1:] != b[:-1])].tobytes().split() if len(b) else []


def _pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        upto = len(text) if len(text) - at <= PIECE_BYTES else text.find(b" ", at + PIECE_BYTES)
        upto = len(text) if upto < 0 else upto
        yield text[at:upto]
        at = upto


def ngrams(text: bytes) -> tuple[np.ndarray, int]:
    """Buckets of the n-grams of one piece of text, repeats included, and its number of words.

    Words are split at ASCII white space. N-grams are words, pairs of words (A-Z lower-cased), shapes, pairs and
    triples of shapes, and a mark for each word that repeats the one before. None spans two pieces of PIECE_BYTES.
    """
    words = _hashed(text.lower().split())
    shapes = _hashed(_shapes(text))
    a, b, c = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x27D4EB2F)
    pairs = words[:-1] * a + words[1:] * b
    two = shapes[:-1] * a + shapes[1:] * c
    three = two[:-1] * b + shapes[2:]
    again = np.full(int((words[1:] == words[:-1]).sum()), 7, np.uint32)
    return np.concatenate([_bucket(x) for x in (words, pairs, shapes ^ a, two, three, again)]), len(words)


@dataclass
class QualityModel:
    """Sums of the follow-the-regularised-leader updates: adjusted gradients z and squared gradients n of each bucket."""

    z: np.ndarray
    n: np.ndarray
    alpha: float = 0.5
    beta: float = 0.1
    l1: float = 0.0005
    l2: float = 0.001

    @classmethod
    def empty(cls) -> QualityModel:
        return cls(np.zeros(FEATURES), np.zeros(FEATURES))

    def weights(self, at: np.ndarray | slice = slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = z - np.sign(z) * self.l1
        return np.where(np.abs(z) <= self.l1, 0.0, -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        """One document: distinct buckets, their values, and whether it is good."""
        w = self.weights(at)
        g = (chance_of(float(w @ values)) - label) * values
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def chance_of(logit: float) -> float:
    return float(1 / (1 + np.exp(-min(max(logit, -700.0), 700.0))))


#: An n-gram's value is its share of the text's words times this; the constant has the value 1.
SCALE = 10.0


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text and their values."""
    total, n = np.zeros(FEATURES, np.int64) if len(text) > PIECE_BYTES else None, 0
    found = np.zeros(0, np.int64)
    for piece in _pieces(text):
        found, k = ngrams(piece)
        n += k
        if total is not None:
            total += np.bincount(found, minlength=FEATURES)
    at, counts = np.unique(found, return_counts=True) if total is None else (np.flatnonzero(total), total[total > 0])
    return np.append(0, at), np.append(1.0, counts * (SCALE / max(n, 1)))


def score_text(weights: np.ndarray, text: bytes) -> float:
    """The chance that a whole text is good: a sparse dot product, summed over pieces."""
    total, n = 0.0, 0
    for piece in _pieces(text):
        found, k = ngrams(piece)
        total += float(weights[found].sum())
        n += k
    return chance_of(float(weights[0]) + total * SCALE / max(n, 1))


def _featurise(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for some in slices(batch, "text", PIECE_BYTES, 512):
            got = [features(x or b"") for x in listed(some.column("text"))]
            yield pa.record_batch(
                {
                    **{c: some.column(c) for c in ("shard", "place", "label")},
                    "at": pa.array([a.astype("<i4").tobytes() for a, _ in got], pa.binary()),
                    "value": pa.array([v.astype("<f4").tobytes() for _, v in got], pa.binary()),
                }
            )


def _learn(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        shard, model = None, None

        def learned() -> pa.RecordBatch:
            return pa.record_batch({"shard": pa.array([shard], pa.int32()), "z": pa.array([model.z.tobytes()]), "n": pa.array([model.n.tobytes()])})

        for batch in batches:
            for of, label, at, value in zip(*(listed(batch.column(c)) for c in ("shard", "label", "at", "value")), strict=True):
                if of != shard:
                    if model is not None:
                        yield learned()
                    start: QualityModel = shared.value
                    shard, model = of, QualityModel(start.z.copy(), start.n.copy())
                model.learn(np.frombuffer(at, "<i4"), np.frombuffer(value, "<f4").astype(float), label)
        if model is not None:
            yield learned()

    return run


def train_quality(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, rounds: int = 3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality"
) -> QualityModel:
    """Fit the regression to labelled documents.

    Labels other than 0 and 1 and null ids teach nothing; a document with both labels teaches both; rows equal in id
    and text count once. Of more than fit_rows labels, those whose hashed id falls below the share that fit_rows
    is of them are used, so about fit_rows labels are broadcast and learned from at any size. Documents are dealt into
    SHARDS parts in an order of their hashed ids; in each round every part goes on from the same model and the parts'
    sums are averaged. Without labels the model is empty and every score 0.5.
    """
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label")).filter("id IS NOT NULL AND label IN (0, 1)").distinct()
    known = written(known.withColumn("place", F.pmod(F.xxhash64("id"), F.lit(1 << 30))), "quality-labels")
    share = min(1.0, fit_rows / max(1, known.count()))
    some = F.broadcast(known.filter(F.col("place") < int(share * (1 << 30))))
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    rows = slim.join(some, "id").dropDuplicates(["id", "text", "label"]).withColumn("shard", (F.col("place") % SHARDS).cast("int"))
    rows = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", "id", "label", "text")
    rows = written(rows.select("shard", "place", "label", "text").mapInArrow(_featurise, "shard int, place long, label int, at binary, value binary"), "quality-features")
    model = QualityModel.empty()
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(model)
        ordered = rows.repartition(SHARDS, "shard").sortWithinPartitions("shard", "place", "label")
        parts = ordered.mapInArrow(_learn(shared), "shard int, z binary, n binary").collect()  # SHARDS rows of 4 MB
        if not parts:
            break
        parts.sort(key=lambda r: r["shard"])
        model = QualityModel(*(np.mean([np.frombuffer(r[c]) for r in parts], axis=0) for c in ("z", "n")))
        shared.unpersist()
    return model


def _score(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            for some in slices(batch, "text", PIECE_BYTES, 4096):
                scores = [score_text(shared.value, x or b"") for x in listed(some.column("text"))]
                yield pa.record_batch({"id": some.column("id"), "score": pa.array(scores, pa.float64())})

    return run


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id_col and score, the chance that a whole text is good, and predicted (1 from a score of 0.5 on).

    Null and empty texts have the score of the constant alone. Nothing but the text is read; repeated rows score alike,
    null ids stay null, other columns are ignored. The model is FEATURES numbers at any size, so it is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model.weights().astype(np.float32))
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("text"))
    scored = slim.mapInArrow(_score(shared), "id long, score double")
    return scored.select(F.col("id").alias(id_col), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def judge_quality(
    docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", fit_rows: int = FIT_ROWS
) -> DataFrame:
    """Learn from the labels outside one fold of the ids and score all documents: held_out and score_quality."""
    model = train_quality(docs, labels.filter(~held_out(id_col, folds, fold)), fit_rows, id_col=id_col, text_col=text_col, label_col=label_col)
    return score_quality(docs, model, id_col, text_col).withColumn("held_out", held_out(id_col, folds, fold))
