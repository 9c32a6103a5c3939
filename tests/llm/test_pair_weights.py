"""op1: the weights of pairs come from all training texts, however many chunks these are dealt into."""

import random

from tickloom.llm import maxent_lm


def test_pair_weights_are_fitted_on_all_chunks(spark, monkeypatch):
    pick, seen, train = random.Random(2), [], maxent_lm.train_classes
    texts = [" ".join(pick.choice(["a b", "c d", "e f"]) for _ in range(40)) if i % 2 else " ".join(pick.choice("abcdefgh") for _ in range(80)) for i in range(80)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    monkeypatch.setattr(maxent_lm, "train_classes", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    for size in (1 << 20, 400):
        maxent_lm.score_documents(docs, chunk_bytes=size).count()
    assert seen[0].tokens == seen[1].tokens
    assert seen[0].pair_weight.tolist() == seen[1].pair_weight.tolist()
