"""Language identification by error-correcting output codes over hashed byte n-grams."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType

from tickloom.llm.units import bounded, listed, release, slices

UNKNOWN = "und"
#: Hash buckets of byte pairs and of byte triples.
PAIRS, TRIPLES = 4096, 8192
FEATURES = PAIRS + TRIPLES
#: What a task holds as Python strings at once.
AT_ONCE, BYTES_AT_ONCE = 512, 1 << 20
#: Labels beyond this are no list of languages; each costs the driver 100 KB.
MOST_LANGUAGES = 1000

#: ASCII characters that are no letters count as spaces.
_SPACES = {c: " " for c in range(128) if not chr(c).isalpha()}


def has_letters(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def ngram_counts(text: str) -> np.ndarray:
    """Hashed counts of the byte pairs and triples of the lower-cased text; runs of spaces count once."""
    plain = " ".join(text.lower().translate(_SPACES).split())
    b = np.frombuffer(f" {plain} ".encode(), np.uint8).astype(np.uint32)
    pairs = (b[:-1] * np.uint32(0x9E3779B1) + b[1:] * np.uint32(0x85EBCA6B)) >> np.uint32(20)
    triples = (b[:-2] * np.uint32(0xC2B2AE35) + b[1:-1] * np.uint32(0x27D4EB2F) + b[2:] * np.uint32(0x165667B1)) >> np.uint32(19)
    return np.concatenate([np.bincount(pairs, minlength=PAIRS), np.bincount(triples, minlength=TRIPLES)])


def code_words(n: int) -> np.ndarray:
    """n rows of -1 and 1: the exhaustive code for up to 5 languages, else the best of 50 seeded random codes."""
    if n < 2:
        return np.ones((n, 1), np.int8)
    if n <= 5:
        bits = [[1 if (k >> i) & 1 or i == n - 1 else -1 for i in range(n)] for k in range(2 ** (n - 1) - 1)]
        return np.array(bits, np.int8).T
    width = 10 * int(np.ceil(np.log2(n)))
    best, most = None, -1
    for seed in range(50):
        code = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (n, width))
        apart = min(int((code[i] != code[i + 1 :]).sum(1).min()) for i in range(n - 1))
        mixed = bool((np.abs(code.sum(0)) < n).all())
        if mixed and apart > most:
            best, most = code, apart
    return best if best is not None else code


@dataclass
class LanguageModel:
    """Languages, their codewords, and for each bit the weights of its binary classifier and its weight in decoding."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    reliability: np.ndarray
    min_gap: float = 0.2

    def decode(self, counts: np.ndarray, total: int) -> tuple[str, float, bool]:
        """The language of the nearest codeword, its share of the decoding weight, and whether a second one is near."""
        if len(self.languages) < 2 or not total:
            return (self.languages or [UNKNOWN])[0], float(bool(self.languages)), False
        margins = counts @ self.weights / np.float32(total)
        # the logistic loss of each bit against each codeword, weighted by how reliable the bit's classifier is
        losses = np.logaddexp(0, -self.code * margins) @ self.reliability
        chance = np.exp(losses.min() - losses)
        chance /= chance.sum()
        order = np.argsort(-chance, kind="stable")
        first, second = chance[order[0]], chance[order[1]]
        return self.languages[order[0]], float(first), bool(first - second < self.min_gap)


def _language_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for some in slices(batch, "text", BYTES_AT_ONCE, AT_ONCE):
            for text, lang in zip(listed(some.column("text")), listed(some.column("lang")), strict=True):
                if has_letters(text):
                    counts = ngram_counts(text)
                    if lang in held:
                        held[lang] += counts
                    else:
                        held[lang] = counts.astype(np.int64)
    for lang, counts in held.items():
        yield pa.record_batch({"lang": pa.array([lang]), "counts": pa.array([counts.astype("<i8").tobytes()], pa.binary())})


def _sum_counts(key: tuple[pa.Scalar, ...], rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(FEATURES, np.int64)
    for batch in rows:
        for blob in batch.column("counts").to_pylist():
            total += np.frombuffer(blob, "<i8")
    yield pa.record_batch({"lang": pa.array([key[0].as_py()]), "counts": pa.array([total.tobytes()], pa.binary())})


def train_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit the binary classifiers to all labelled rows of docs.

    Each task counts n-grams by language; one row of FEATURES counts for each language reaches the driver, so what is
    sent depends on the number of languages alone. Bit b separates the languages with 1 at b from those with -1: its
    weights are the log ratio of the two sides' n-gram probabilities, languages on a side counting alike, scaled so
    that the language nearest to the border has an expected margin of 6. A bit's reliability is that expected margin
    before scaling, against the best bit's. More than MOST_LANGUAGES distinct labels raise.
    """
    slim = bounded(docs).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).filter("text IS NOT NULL AND lang IS NOT NULL")
    counted = slim.mapInArrow(_language_counts, "lang string, counts binary").withColumn("salt", F.spark_partition_id() % 16)
    counted = counted.groupBy("lang", "salt").applyInArrow(_sum_counts, "lang string, counts binary")
    rows = counted.groupBy("lang").applyInArrow(_sum_counts, "lang string, counts binary").limit(MOST_LANGUAGES + 1).collect()
    if len(rows) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} distinct values of {lang_col}")
    rows = sorted(rows, key=lambda r: r["lang"])
    languages = [r["lang"] for r in rows]
    code = code_words(len(languages))
    if len(languages) < 2:
        return LanguageModel(languages, code, np.zeros((FEATURES, 1), np.float32), np.ones(1))
    counts = np.array([np.frombuffer(r["counts"], "<i8") for r in rows], np.float64) + 0.5
    chances = counts / counts.sum(1, keepdims=True)
    sides = [(chances[code[:, b] > 0].mean(0), chances[code[:, b] < 0].mean(0)) for b in range(code.shape[1])]
    weights = np.array([np.log(one) - np.log(other) for one, other in sides]).T
    expected = (chances @ weights * code).min(0)
    expected = np.maximum(expected, 1e-6)
    return LanguageModel(languages, code, (weights * (6 / expected)).astype(np.float32), expected / expected.max())


def _predict(shared):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model: LanguageModel = shared.value
        for batch in batches:
            for some in slices(batch, "text", BYTES_AT_ONCE, AT_ONCE):
                langs, scores, flags = [], [], []
                for text in listed(some.column("text")):
                    lang, score, ambiguous = UNKNOWN, 0.0, False
                    if has_letters(text):
                        counts = ngram_counts(text)
                        lang, score, ambiguous = model.decode(counts.astype(np.float32), int(counts.sum()))
                    langs.append(lang)
                    scores.append(score)
                    flags.append(ambiguous)
                yield pa.record_batch(
                    {
                        "id": some.column("id"),
                        "lang_pred": pa.array(langs, pa.string()),
                        "score": pa.array(scores, pa.float64()),
                        "ambiguous": pa.array(flags, pa.bool_()),
                    }
                )

    return run


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % folds == fold, F.lit(False))


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Language, score and ambiguity of every whole text: id_col, lang_pred, score (0 to 1), ambiguous.

    A null text and one without letters get "und" and score 0, as do all texts if nothing was learned. Nothing but the
    text is read. The model's size depends on the number of languages alone, so it is broadcast. Repeated rows are
    predicted alike; null ids stay null; extra columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    slim = bounded(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = slim.mapInArrow(_predict(shared), "id long, lang_pred string, score double, ambiguous boolean")
    return found.withColumnRenamed("id", id_col)


def _identified(shared, min_score: float):
    def run(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        model: LanguageModel = shared.value
        for whole in texts:
            keep = []
            for some in slices(pa.record_batch({"text": whole}), "text", BYTES_AT_ONCE, AT_ONCE):
                for text in listed(some.column("text")):
                    counts = ngram_counts(text) if has_letters(text) else None
                    keep.append(counts is not None and model.decode(counts.astype(np.float32), int(counts.sum()))[1] >= min_score)
            yield pa.array(keep, pa.bool_())

    return run


def keep_identified(docs: DataFrame, model: LanguageModel, min_score: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs whose language is identified: a text with letters and a score of min_score or more.

    Only texts go to Python and only verdicts come back; all columns pass as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    identified = F.arrow_udf(_identified(shared, min_score), "boolean", ArrowUDFType.SCALAR_ITER)
    return bounded(docs).filter(identified(F.col(text_col)))


def identify(docs: DataFrame, folds: int = 4, fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents outside one fold and predict all: id_col, held_out and predict_languages."""
    model = train_languages(docs.filter(~held_out(id_col, folds, fold)), text_col, lang_col)
    return predict_languages(docs, model, id_col, text_col).withColumn("held_out", held_out(id_col, folds, fold))
