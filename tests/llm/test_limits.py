"""What the corpus operators refuse, and what they must not do twice."""

import pytest

import corpus_pipeline
from tickloom.llm.hyperminhash import BANDS, ROWS, near_duplicates


def test_near_duplicates_refuses_what_its_bands_lose(docs):
    assert (1 - 0.8**ROWS) ** BANDS < 1e-5 < 0.5 < (1 - 0.5**ROWS) ** BANDS
    with pytest.raises(ValueError, match="80"):
        near_duplicates(docs, percent=50)


def test_repeats_are_removed_once(spark, docs, monkeypatch):
    calls = []
    monkeypatch.setattr(corpus_pipeline, "remove_repeats", lambda df, carry: calls.append(carry) or df.withColumnRenamed("text", "kept"))
    corpus_pipeline.suffix_dedup(spark, docs, "")
    assert len(calls) == 1
