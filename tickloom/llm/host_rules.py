"""Quality rules of documents, judged by host: failure rates shrunk by an empirical beta prior."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.units import bounded, listed, release, slices
from tickloom.session import written

#: Characters counted as symbols.
SYMBOLS = "#*$%&|<>"
WINDOW = 5
#: What a task holds as Python values at once.
AT_ONCE, BYTES_AT_ONCE = 256, 1 << 20

_SYMBOL_BYTES = np.zeros(256, bool)
_SYMBOL_BYTES[list(SYMBOLS.encode())] = True


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """How many words stand in a window of so many words that occurs twice or more, the first time included."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    index: dict[bytes, int] = {}
    ids = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words))
    if len(index) == len(words):
        return 0
    # windows are numbered exactly: by the pair of the number of their first words and of the next word
    code = ids
    for k in range(1, window):
        pair = code[: len(ids) - k] * len(index) + ids[k:]
        code = np.unique(pair, return_inverse=True)[1]
    often = np.bincount(code)[code] > 1
    covered = np.zeros(len(words) + 1, np.int64)
    np.add.at(covered, np.flatnonzero(often), 1)
    np.add.at(covered, np.flatnonzero(often) + window, -1)
    return int((np.cumsum(covered[:-1]) > 0).sum())


def text_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of one text."""
    words = text.split()
    joined = np.frombuffer(b"".join(words), np.uint8)
    chars = int(((joined & 0xC0) != 0x80).sum())  # code points: bytes that continue none
    symbols = int(_SYMBOL_BYTES[joined].sum())  # no symbol is white space
    lines = [x for x in text.split(b"\n") if x.split(None, 1)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def _count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for some in slices(batch, "text", BYTES_AT_ONCE, AT_ONCE):
            got = [text_counts(x or b"") for x in listed(some.column("text"))]
            columns = list(zip(*got, strict=True))
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            counted = {c: pa.array(v, pa.int64()) for c, v in zip(names, columns, strict=True)}
            yield pa.record_batch({"id": some.column("id"), "host": some.column("host"), **counted})


def document_counts(docs: DataFrame, host: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, host and the counts of text_counts for each document; a null text has no words."""
    slim = bounded(docs).select(
        F.col(id_col).alias("id"), host.cast("string").alias("host"), F.col(text_col).cast("binary").alias("text")
    )
    schema = "id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
    return slim.mapInArrow(_count, schema)


def failed_rules() -> dict[str, Column]:
    """Rules on the counts; true: the document fails."""
    return {
        "few_words": F.col("n_words") < 10,
        "repeated": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 3 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words")),
        "dup_lines": 5 * F.col("n_dup_lines") > F.col("n_words"),
    }


def host_rates(counted: DataFrame) -> DataFrame:
    """For each host: documents, those that fail a rule, the failure rate shrunk towards the mean of all hosts, and that mean.

    The beta prior is fitted to the hosts' rates by moments: m is the mean rate over documents, s the strength that
    explains the spread of the rates beyond chance, so rate = (failed + m s) / (n + s). With one host, or without any
    spread beyond chance, s is that of the average host's documents.
    """
    hosts = counted.groupBy("host").agg(F.count("*").alias("n"), F.count_if("any_failed").alias("failed"))
    hosts = written(hosts, "host-counts")
    whole = hosts.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum("failed").alias("failed"),
        F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
        F.sum(F.col("failed").cast("double") * F.col("failed") / F.col("n")).alias("ff"),
    ).first()
    k, n = whole["k"], whole["n"] or 0
    if not n:
        return hosts.withColumn("rate", F.lit(0.0)).withColumn("mean", F.lit(0.0))
    mean = whole["failed"] / n
    between = whole["ff"] - n * mean * mean  # sum of n (rate - mean)^2
    spread = n - whole["nn"] / n
    chance = mean * (1 - mean)
    extra = (between - (k - 1) * chance) / spread if k > 1 and spread > 0 else 0.0
    strength = chance / extra - 1 if extra > 0 and chance > extra else n / k
    rate = (F.col("failed") + F.lit(mean * strength)) / (F.col("n") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("mean", F.lit(mean))


def judge_documents(
    docs: DataFrame,
    host: Column,
    max_rate: float = 0.5,
    max_times: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Counts, base rule and verdict for each document.

    A document fails the base rule with fewer than 10 words, or with over 20 % of its words in repeated windows. A host is
    bad if its shrunk rate of documents that fail any rule is over max_rate, or over max_times the mean rate of all
    documents; documents of bad hosts are not kept, nor are those that fail the base rule. Failures are counted by host inside each task first; texts are never shuffled.
    Hosts meet documents by a broadcast if the written rates are below Spark's broadcast limit, else by a join that Spark
    splits where a host is hot.

    Null texts have no words, null hosts are one host, null ids stay null, repeated rows are judged alike; extra columns
    are ignored. Returns id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, host,
    host_rate.
    """
    rules = failed_rules()
    any_failed = F.lit(False)
    for failed in rules.values():
        any_failed = any_failed | failed
    counted = written(
        document_counts(docs, host, id_col, text_col)
        .withColumn("base_failed", rules["few_words"] | rules["repeated"])
        .withColumn("any_failed", any_failed),
        "host-documents",
    )
    rates = host_rates(counted).withColumn("limit", F.least(F.lit(max_rate), F.lit(max_times) * F.col("mean")))
    rates = written(rates.select(F.col("host").alias("of_host"), F.col("rate").alias("host_rate"), "limit"), "host-rates")
    return counted.join(rates, F.col("host").eqNullSafe(F.col("of_host")), "inner").select(
        F.col("id").alias(id_col),
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.col("host_rate") <= F.col("limit"))).alias("kept"),
        "host",
        "host_rate",
    )
