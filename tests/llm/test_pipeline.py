"""The stages on a small table, against what each must do."""

import hashlib

from pyspark.sql import Row
from pyspark.sql import functions as F

import corpus_pipeline


def test_stages(spark, docs, rows, tmp_path):
    whole = docs.select("doc_id", "text", "lang", "source", "n_chars")
    whole.write.parquet(f"{tmp_path}/documents.parquet")
    kept = whole
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, kept, str(tmp_path))
        assert out.columns == whole.columns
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        before, kept = kept, spark.read.parquet(path)
        ids = {r["doc_id"] for r in kept.collect()}
        assert ids <= {r["doc_id"] for r in before.collect()}
        if name == "language_id":
            assert ids == {r[0] for r in rows if r[1] and any(map(str.isalpha, r[1]))}
        if name == "near_dedup":
            assert rows[16][0] in ids and rows[17][0] not in ids and rows[18][0] not in ids
        if name == "suffix_dedup":
            texts = {r["doc_id"]: r["text"] for r in kept.collect()}
            assert all(r["n_chars"] == len(r["text"]) for r in kept.collect())
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(r["doc_id"] for r in kept.collect())
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in got)
    assert isinstance(got[0], Row)


def test_registered():
    from tickloom.llm.queries import ORACLE_SQL, QUERIES

    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_repeated_rows_and_rows_without_ids(spark, docs):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, long, "x"), (1, long, "x"), (2, long, "y"), (3, "other text of its own here", "x"), (None, long, "x"), (None, long, "x"), (None, None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = sorted((r["doc_id"] or 0, r["text"] or "", r["n"]) for r in corpus_pipeline.near_dedup(spark, df, "").collect())
    assert got == sorted([(1, long, "x"), (3, rows[3][1], "x"), (0, long, "x"), (0, "", "x")])


def test_stages_of_an_empty_table(spark, no_docs):
    whole = no_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, whole, "").count() == 0


def test_extra_columns_and_a_very_long_text(spark, docs, tmp_path):
    """Columns with names that the operators use inside, and a text of a megabyte, go through all stages."""
    words = [f"{a}{b}{c}ing" for a in "bcdfghjklm" for b in "aeiou" for c in "lmnrst"]
    long = " ".join(words[i * i % 300] + str(i) for i in range(90_000))
    more = spark.createDataFrame([(1000, long, "en", "s0", len(long), 4, "b", 0.1)], docs.schema)
    kept = docs.unionByName(more).withColumns({"copy_no": F.lit("x"), "mix_key": F.lit(1.5), "__kept": F.lit(2), "carried_0": F.lit(True)})
    columns, texts = kept.columns, {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, kept, str(tmp_path))
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == columns
        out.write.parquet(f"{tmp_path}/{i}")
        kept = spark.read.parquet(f"{tmp_path}/{i}")
        if name == "suffix_dedup":
            texts = {r["doc_id"]: r["text"] for r in kept.collect()}
            assert texts[1000] == long and {tuple(r) for r in kept.select("copy_no", "mix_key", "__kept", "carried_0").distinct().collect()} == {("x", 1.5, 2, True)}
    assert all(r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() for r in kept.collect())
