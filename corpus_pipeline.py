"""A corpus in five stages: language ID, near-dedup, repeated passages, source mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes what a stage returns as Parquet in the shared
folder and reads it again as the next stage's docs. All stages but the last return the columns of documents. A row that
repeats the id and text of another goes with the near copies, as does one of several rows without an id that share a
text; near copies without an id stay. A null text goes at the first stage. Extra columns are kept up to the last stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.byte_bpe import encode_documents
from tickloom.llm.hyperminhash import near_duplicates
from tickloom.llm.lang_id import keep_identified, train_languages
from tickloom.llm.mixing import mix_sources
from tickloom.llm.suffix_dedup import remove_repeats
from tickloom.session import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the labelled ones teach; those without letters or without a clear language go."""
    return keep_identified(docs, train_languages(docs))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the least id, of each group linked by runs of five words at a similarity of 0.8 or more.

    Equal rows count once.
    """
    judged = written(near_duplicates(docs, n_words=5, percent=80).select("doc_id", "kept"), "near-judged")
    kept = judged.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.bool_or("kept"), F.count("*")).toDF("id", "is_kept", "n_rows")
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*docs.columns).alias("row"))  # names of docs clash with none of these
    whole = rows.join(kept.filter("is_kept"), "id")
    # ids that stand on several rows, and rows without one: equal texts count once; no other text is shuffled for this
    again = whole.filter("n_rows > 1").select("row.*").unionByName(docs.filter("doc_id IS NULL"))
    return whole.filter("n_rows = 1").select("row.*").unionByName(again.dropDuplicates(["doc_id", "text"]))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the bytes of 50-byte strings that start in a smaller document too; a text can be empty after that.

    Bytes of characters that a cut went through are dropped.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    cut = remove_repeats(docs, carry=rest)
    return cut.withColumnRenamed("kept", "text").withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that a source's share follows the square root of its size."""
    return mix_sources(docs, power=0.5).select(*docs.columns)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the hash of what they decode to."""
    encoded = encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep_decoded=False)
    return encoded.select("doc_id", "n_tokens", "token_ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("mixing", mixing),
    ("byte_bpe", byte_bpe),
]

#: SQL has no way to express the trained language ID, the similarity search or the encoding.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
