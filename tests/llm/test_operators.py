"""Each operator against a plain version of what it should give, on nulls, empty and long texts, ties and copies."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict
from math import log10

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tickloom.llm import byte_bpe, hyperminhash, maxent_lm, suffix_dedup
from tickloom.llm.byte_bpe import encode_documents, load_ranks
from tickloom.llm.chunks import Exchange
from tickloom.llm.host_rules import host_rates, judge_documents, repeated_words
from tickloom.llm.hyperminhash import chance_collisions, connected, near_duplicates, registers
from tickloom.llm.lang_id import code_words, identify, keep_identified, train_languages
from tickloom.llm.maxent_lm import score_documents
from tickloom.llm.mixing import mix_sources, source_rates
from tickloom.llm.sharding import byte_shards, range_id
from tickloom.llm.suffix_dedup import multikey_order, remove_repeats
from tickloom.llm.token_orc import read_tokens, token_index, tokens_path, write_tokens
from tickloom.llm.topk_fagin import SortedLists, top_k
from tickloom.llm.units import spaced_units


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# -- op 1 -------------------------------------------------------------------------------------------------------------


def spy_on_models(monkeypatch):
    """The models that score_documents broadcasts, the last one complete."""
    seen, train = [], maxent_lm.train_classes
    monkeypatch.setattr(maxent_lm, "train_classes", lambda *a, **k: seen.append(train(*a, **k)) or seen[-1])
    return seen


def plain_chance(model, counts, pairs, further, before, word):
    """The chance of a word after two others, written out; the unknown word is None."""
    n, v = sum(counts.values()), len(counts)
    unknown = 1 / (n + v + 1)
    rows = [zlib.crc32(before) % 4096, 4096 + zlib.crc32(further) % 4096, 8192 + (maxent_lm.class_of(before) * maxent_lm.CLASSES + maxent_lm.class_of(further)) % 4096]
    z = model.weights[rows].astype(float).sum(0) + model.weights[-1]
    classes = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    q = unknown
    if word in counts:
        c = maxent_lm.class_of(word)
        q = (1 - unknown) * classes[c] * (counts[word] + 1) / sum(k + 1 for w, k in counts.items() if maxent_lm.class_of(w) == c)
    m = counts.get(before, 0)
    mu = model.pair_weight[min(int(np.ceil(np.log2(m + 1))), maxent_lm.GRADES - 1)] if m else 0.0
    return mu * pairs.get((before, word), 0) / max(m, 1) + (1 - mu) * q


@pytest.mark.parametrize("chunk_bytes, fan", [(12_000_000, 256), (6000, 256), (4000, 2)])
def test_scores_follow_the_counts(docs, rows, monkeypatch, chunk_bytes, fan):
    seen = spy_on_models(monkeypatch)
    got = by_id(score_documents(docs, chunk_bytes=chunk_bytes, fan=fan))
    tokens = {r[0]: (r[1] or "").encode().lower().split() + [b"\n"] for r in rows}
    out = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in tokens}
    counts = Counter(t for i, ts in tokens.items() if not out[i] for t in ts)
    pairs = Counter(p for i, ts in tokens.items() if not out[i] for p in zip([b"\n", *ts], ts))
    n, v, model = sum(counts.values()), len(counts), seen[-1]
    assert (model.tokens, model.types) == (n, v) and model.pair_weight.max() > 0
    for i, ts in tokens.items():
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (out[i], len(ts), sum(t in counts for t in ts), n)
        assert r["base_score"] == pytest.approx(sum(log10((counts[t] + 1) / (n + v + 1)) for t in ts))
        if len(ts) < 200:
            want = [plain_chance(model, counts, pairs, *c) for c in zip([b"\n", b"\n", *ts], [b"\n", *ts], ts)]
            assert r["score"] == pytest.approx(sum(map(log10, want)), rel=1e-4)
    for before, further in ((b"the", b"in"), (b"\n", b"\n"), (b"never-seen", b"der")):
        assert sum(plain_chance(model, counts, pairs, further, before, w) for w in [*counts, None]) == pytest.approx(1)
    assert sum(got[i]["score"] for i in got) > sum(got[i]["base_score"] for i in got)
    assert all(got[i]["score"] > got[i]["base_score"] for i in got if out[i] and got[i]["n_known"] > 50)


def test_rounds_move_the_model(docs):
    start = maxent_lm.ClassModel(np.ones(maxent_lm.CLASSES), 1, 1)
    one, four = (maxent_lm.train_classes(docs, start, rounds=k).weights for k in (1, 4))
    assert np.abs(one).sum() > 0 and not np.allclose(one, four)


def test_scores_of_no_documents(no_docs):
    assert score_documents(no_docs).count() == 0


# -- op 2 -------------------------------------------------------------------------------------------------------------


def test_languages(docs, rows):
    got = by_id(identify(docs))
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        r = got[i]
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
        if not text or not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        else:
            assert r["lang_pred"] in {"en", "de", "fr"}
    assert [got[r[0]]["lang_pred"] for r in rows[:16]] == ["en"] * 6 + ["de"] * 5 + ["fr"] * 5


def test_languages_without_labels(docs, no_docs):
    model = train_languages(no_docs)
    assert identify(no_docs).count() == 0
    assert {r["lang_pred"] for r in identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert keep_identified(docs, model).count() == 0


def test_codewords_are_apart():
    for n in (2, 3, 4, 5, 6, 40):
        code = code_words(n)
        least = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert least >= (1 if n == 2 else 2)
        assert code.shape[0] == n and (np.abs(code.sum(0)) < n).all()


# -- op 3 -------------------------------------------------------------------------------------------------------------


def plain_removal(rows, length=50):
    first = {}
    for i, t in sorted(rows):
        for p in range(len(t) - length + 1):
            first.setdefault(t[p : p + length], i)
    out = {}
    for i, t in rows:
        covered = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < i:
                covered[p : p + length] = b"\1" * length
        spans = sum(1 for j in range(len(t)) if covered[j] and (j == 0 or not covered[j - 1]))
        kept = bytes(c for c, m in zip(t, covered) if not m)
        out[i] = (len(t), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(
    "sizes, fan",
    [((8_000_000, 16_000_000, 2000, 65_536), 256), ((3000, 4000, 2000, 65_536), 256), ((3000, 4000, 1, 65_536), 256), ((3000, 1500, 1, 4), 3), ((3000, 4000, 2000, 3), 2)],
)
def test_repeats_go(docs, rows, monkeypatch, sizes, fan):
    for name, value in zip(("CHUNK_BYTES", "BUCKET_BYTES", "MOST_RANGES"), (*sizes[:2], sizes[3]), strict=True):
        monkeypatch.setattr(suffix_dedup, name, value)
    got = remove_repeats(docs, carry=["source", "chunk"], fan=fan, hot=sizes[2])
    want = plain_removal([(r[0], (r[1] or "").encode()) for r in rows])
    found = by_id(got)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in found.items()} == want
    assert all(found[r[0]]["source"] == r[3] and found[r[0]]["chunk"] == 1 for r in rows)


def test_hot_seeds_give_the_same(docs, rows):
    entries = [(t, d) for d, t in enumerate([b"q" * 60, b"a" + b"q" * 49, b"q" * 50])]
    got = suffix_dedup.repeated_windows([t[:50] for t, _ in entries], np.array([-1, -1, -1]), np.array([2, 1, 3]), 50)
    assert got.tolist() == [0, 0, 1]


def test_repeats_of_equal_ids_and_none(spark, no_docs):
    text = "abcdefghij" * 6
    df = spark.createDataFrame([(1, text), (1, text), (2, text), (None, text)], "doc_id long, text string")
    got = sorted(((r["doc_id"] or -1), r["n_removed"]) for r in remove_repeats(df).collect())
    assert got == [(-1, 60), (1, 0), (1, 0), (2, 60)]
    assert remove_repeats(no_docs).count() == 0


def test_windows_meet_in_two_sorts(monkeypatch):
    rng = np.random.default_rng(3)
    some = [bytes(rng.integers(97, 99, 70).astype(np.uint8)) for _ in range(4)]
    entries = []
    for seed in (some[0][:24], some[1][:24]):
        for _ in range(400):
            a, size = int(rng.integers(0, 27)), int(rng.integers(50, 77))
            left, right = (bytearray(some[int(rng.integers(0, 4))]) for _ in range(2))
            left[int(rng.integers(0, 70))] = right[int(rng.integers(0, 70))] = int(rng.integers(0, 256))
            content = (bytes(left)[: max(a, size - 50 - 26 + a)][-a:] if a else b"") + seed + bytes(right)
            size = min(size, 50 + a, a + 50)
            entries.append((content[:size], a, int(rng.integers(0, 60))))
    entries += [(content, a, doc + 1) for content, a, doc in entries[:200]]
    entries += [(content[:50], -1, doc) for content, _, doc in entries[:100]]
    sorts = []
    plain = suffix_dedup.multikey_order
    monkeypatch.setattr(suffix_dedup, "multikey_order", lambda columns: sorts.append(1) or plain(columns))
    contents, off, docs_of = zip(*entries, strict=True)
    got = suffix_dedup.repeated_windows(list(contents), np.array(off), np.array(docs_of), 50)
    assert len(sorts) <= 2
    first = {}
    for content, a, doc in entries:
        for p in range(len(content) - 49):
            key = (a < 0, a - p, content[p : p + 50])
            first[key] = min(doc, first.get(key, doc))
    want = [sum((first[(a < 0, a - p, c[p : p + 50])] < doc) << p for p in range(len(c) - 49)) for c, a, doc in entries]
    assert got.tolist() == want
    assert 0 < sum(map(bool, want)) < len(want)


def test_equal_hashes_of_unequal_keys(monkeypatch):
    columns = [np.array([5, 1, 5, 1, 5], np.uint64), np.array([7, 2, 8, 2, 7], np.uint64)]
    for base in (suffix_dedup._BASE, np.uint64(0)):  # zero: all hashes are equal
        monkeypatch.setattr(suffix_dedup, "_BASE", base)
        order, new = suffix_dedup.alike(columns)
        assert sorted(x.tolist() for x in np.split(order, np.flatnonzero(new)[1:])) == [[0, 4], [1, 3], [2]]


@pytest.mark.parametrize("windows", [1, 7, 1 << 15])
@pytest.mark.parametrize("length", [24, 50])
def test_runs_of_many_texts(monkeypatch, windows, length):
    monkeypatch.setattr(suffix_dedup, "WINDOWS", windows)
    rng = np.random.default_rng(4)
    texts = [bytes(rng.integers(97, 100, n).astype(np.uint8)) for n in (0, 200, 49, 50, 0, 51, 23, 300, 0)]
    texts += [b"x" + texts[1], b"q" * 120, b""]
    runs = suffix_dedup.anchored_runs(texts, length)
    found, distance = [], {}
    for seed, a, p, q, row in zip(runs.hashes, runs.anchors, runs.first, runs.last, runs.row, strict=True):
        for x in range(p - runs.starts[row], q - runs.starts[row]):
            found.append((row, x))
            window = texts[row][x : x + length]
            assert 0 <= a - runs.starts[row] - x <= length - 24
            assert distance.setdefault(window, (a - runs.starts[row] - x, seed)) == (a - runs.starts[row] - x, seed)
    assert found == [(i, x) for i, t in enumerate(texts) for x in range(len(t) - length + 1)]
    assert len(suffix_dedup.anchored_runs([], length).first) == 0


def test_ranges_of_many_prefixes():
    rng = np.random.default_rng(6)
    flat = bytes(rng.integers(0, 2, 2000).astype(np.uint8)) + b"\xff" * 60
    splitters = sorted({flat[i : i + 24] for i in range(0, 1900, 90)})
    starts = np.arange(len(flat) - 60)
    ends = starts + np.where(starts % 3, 24, 50)
    heads = np.array([int.from_bytes(flat[i : i + 8], "big") for i in starts], np.uint64)
    for cuts, parts in ((splitters, 1), (splitters, 3), ([], 1)):
        ranges = suffix_dedup.Ranges(cuts, parts)
        assert ranges.of_all(heads, flat, starts, ends).tolist() == [ranges.of(flat[a:e]) for a, e in zip(starts, ends, strict=True)]


@pytest.mark.parametrize("hot, length", [(2000, 50), (1, 50), (2000, 24)])
def test_repeats_go_in_small_blocks(docs, rows, monkeypatch, hot, length):
    monkeypatch.setattr(suffix_dedup, "CHUNK_BYTES", 3000)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 4000)
    monkeypatch.setattr(suffix_dedup, "MOST_RANGES", 3)
    got = by_id(remove_repeats(docs, length=length, hot=hot))
    want = plain_removal([(r[0], (r[1] or "").encode()) for r in rows], length)
    assert {i: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for i, r in got.items()} == want


def test_multikey_order():
    rng = np.random.default_rng(5)
    words = [rng.integers(0, 3, 500).astype(np.uint64) for _ in range(4)]
    order, new = multikey_order(words)
    keys = list(zip(*[w.tolist() for w in words]))
    ordered = [keys[i] for i in order]
    assert ordered == sorted(keys)
    assert new.tolist() == [i == 0 or ordered[i] != ordered[i - 1] for i in range(500)]


# -- op 4 -------------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("fan", [256, 2])
def test_bpe_agrees_with_the_library(docs, rows, fan):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    got = by_id(encode_documents(docs, path, public_tokenizers.PATTERN, chunk_bytes=4000, fan=fan))
    assert len(got) == len(rows)
    for i, text, *_ in rows:
        ids = library.encode_ordinary(text or "")
        r = got[i]
        assert r["token_ids"] == ids and r["n_tokens"] == len(ids)
        assert bytes(r["decoded"]) == (text or "").encode()
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()


def test_bpe_of_very_long_words(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    rng = np.random.default_rng(4)
    letters = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzé"), n))
    texts = [letters(200_000), "a" * 100_001, "-" * 50_000 + "x", "x " + " " * 20_000 + "y", "日本" * 9000, "😀" * 3000, letters(600) + " " + letters(513)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(encode_documents(df, path, public_tokenizers.PATTERN))
    for i, text in enumerate(texts):
        assert got[i]["token_ids"] == library.encode_ordinary(text)
        assert bytes(got[i]["decoded"]) == text.encode()


def test_bpe_of_every_character(spark):
    """Each code point beside letters, digits, contractions and signs, as the library's own tables class it."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_ranks(path), special_tokens={})
    points = [*range(0xD800), *range(0xE000, 0x110000)]
    texts = ["".join(f"a{chr(p)}'s {chr(p)}7{chr(p)}! " for p in points[i : i + 64]) for i in range(0, len(points), 64) if not 0x20000 <= points[i] < 0xE0000 or i % 4096 == 0]
    got = by_id(encode_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), path, public_tokenizers.PATTERN, keep_decoded=False))
    assert [i for i, text in enumerate(texts) if got[i]["token_ids"] != library.encode_ordinary(text)] == []
    assert "decoded" not in next(iter(got.values())).asDict() and byte_bpe.stand_ins()[0x558] == "!"


def test_texts_are_put_together_in_slices(docs, rows, monkeypatch):
    monkeypatch.setattr(byte_bpe, "UNITS_AT_ONCE", 7)
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    got = by_id(encode_documents(docs, path, public_tokenizers.PATTERN))
    assert all(bytes(got[i]["decoded"]) == (text or "").encode() and got[i]["n_tokens"] == len(got[i]["token_ids"]) for i, text, *_ in rows)
    assert all(got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, got[i]["token_ids"])).encode()).hexdigest() for i, *_ in rows)


def test_bpe_of_no_documents_and_copies(spark, no_docs):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert encode_documents(no_docs, path, public_tokenizers.PATTERN).count() == 0
    df = spark.createDataFrame([(1, "same"), (1, "same"), (None, "x")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in encode_documents(df, path, public_tokenizers.PATTERN).collect()) == ["1", "1", "None"]


def test_units_join_to_the_text():
    for text in ("", " ", "a b", " a", "a  b c", "a \n b", "a b ", "x  y z"):
        assert "".join(spaced_units(text)) == text


def test_steps_of_an_exchange_are_few_and_lead_everywhere():
    for n, fan in ((1, 4), (5, 4), (16, 4), (17, 4), (300, 7), (10_000, 256)):
        way = Exchange.of(n, fan)
        assert way.size >= n and way.base <= fan and way.base**way.levels < 2 ** way.levels * n
        for start, end in ((0, n - 1), (n - 1, 0), (n // 2, n // 3)):
            node = start
            for level in range(way.levels):
                node = way.deal(node, level, np.array([end]))[0][0]
            assert node == end


# -- op 5 -------------------------------------------------------------------------------------------------------------


def test_mixing_repeats_by_rate(spark):
    rows = [(i, f"t{i}", "big" if i % 10 else None, 9) for i in range(4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copy_no int")
    rates = {r["source"]: r["rate"] for r in source_rates(df).collect()}
    assert rates["big"] == pytest.approx(2000 / 3600) and rates[None] == pytest.approx(2000 / 400)
    out = mix_sources(df).collect()
    share = Counter(r["source"] for r in out)
    assert abs(share["big"] - 2000) < 200 and abs(share[None] - 2000) < 200
    copies = defaultdict(list)
    for r in out:
        copies[r["doc_id"]].append(r["copy_no"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in copies.values())
    again = mix_sources(df.repartition(7)).collect()
    assert sorted(r["mix_key"] for r in out) == sorted(r["mix_key"] for r in again)


def test_mixing_a_rare_source_many_times(spark):
    df = spark.createDataFrame([(i, "a" if i else "b") for i in range(1000)], "doc_id long, source string")
    share = Counter(r["source"] for r in mix_sources(df, {"a": 0.2, "b": 0.8, "c": 1.0}).collect())
    assert abs(share["b"] - 800) < 120 and abs(share["a"] - 200) < 60
    assert mix_sources(df, {"c": 1.0}).count() == 0
    assert mix_sources(df.limit(0)).count() == 0


# -- op 6 -------------------------------------------------------------------------------------------------------------


def plain_top(vectors, k, step):
    whole = {i: [int(np.floor(1024 * np.float64(x))) for x in v] for i, v in vectors}
    out = []
    for q in whole:
        if q % step == 0:
            scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q and len(v) == len(whole[q]))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_top_k(spark, monkeypatch):
    from tickloom.llm import topk_fagin

    monkeypatch.setattr(topk_fagin, "BLOCK", 60)
    monkeypatch.setattr(topk_fagin, "QUERY_BLOCK", 5)
    rng = np.random.default_rng(3)
    good = [(i, [float(x) for x in np.float32(rng.normal(size=6))]) for i in range(300)]
    good += [(i, [0.5, 0.25, 0.0, 0.0, -1.0, 2.0]) for i in range(300, 400)] + [(1000, [0.0] * 6), (1001, [1e7] * 6), (2000, [1.0] * 3)]
    bad = [(5000, None), (5001, [1.0, None]), (5100, [float("nan")] * 6), (5200, [float("inf")] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id long, embedding array<float>, rank int")
    got = sorted(tuple(r) for r in top_k(df, F.col("vec_id") % 100 == 0).select("query_id", "rank", "vec_id", "score").collect())
    assert got == plain_top(good, 10, 100)
    assert top_k(df.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_threshold_stops_early():
    rng = np.random.default_rng(1)
    vectors = rng.integers(-5, 5, (2000, 2))
    vectors[7] = 1000
    lists = SortedLists(np.arange(2000), vectors)
    ids, scores = lists.top(-1, np.array([3, 4]), 1)
    assert ids.tolist() == [7] and scores.tolist() == [7000]
    assert lists.rows_read < 300  # of 2000
    lists.rows_read = 0
    assert lists.top(-1, np.array([3, 4]), 1, floor=7001)[0].tolist() == [] and lists.rows_read == 0  # no row can reach it
    assert lists.top(-1, np.array([3, 4]), 1, floor=7000)[0].tolist() == [7]
    ids, scores = lists.top(-1, np.array([3, 4]), 5, floor=28)
    assert ids[0] == 7 and set(scores[1:]) <= {28}


# -- op 7 -------------------------------------------------------------------------------------------------------------


def test_host_rules(docs, rows):
    got = by_id(judge_documents(docs, F.col("source")))
    for i, text, *_ in rows:
        x = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", x)
        windows = Counter(tuple(words[j : j + 5]) for j in range(len(words) - 4))
        covered = {p for j in range(len(words) - 4) if windows[tuple(words[j : j + 5])] > 1 for p in range(j, j + 5)}
        lines = [y for y in x.split("\n") if re.search(r"[^\x20\x09-\x0D]", y)]
        want = (len(words), sum(map(len, words)), sum(x.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r["base_failed"] and r["kept"])


def test_bad_hosts_lose_their_documents(spark, no_docs):
    good, bad = " ".join(f"word{i}" for i in range(30)), "# * $"
    rows = [(i, good if h == "good" or i % 10 == 0 else bad, h) for i, h in enumerate(["good", "bad"] * 100)]
    got = by_id(judge_documents(spark.createDataFrame(rows, "doc_id long, text string, host string"), F.col("host")))
    assert all(got[i]["kept"] for i, _, h in rows if h == "good")
    assert not any(got[i]["kept"] for i, _, h in rows if h == "bad")
    assert judge_documents(no_docs, F.col("source")).count() == 0


def test_hosts_far_above_the_mean_lose_documents_that_pass(spark):
    good, bad = " ".join(f"word{i}" for i in range(30)), "# * $"
    rows = [(100 * h + i, bad if i < (12 if h == 3 else 2) else good, f"h{h}") for h in range(10) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, host string")
    got = by_id(judge_documents(df, F.col("host")))
    assert {r["host"] for r in got.values() if not r["base_failed"] and not r["kept"]} == {"h3"}
    assert all(r["kept"] for r in got.values() if r["host"] != "h3" and not r["base_failed"])
    assert not any(r["kept"] for r in got.values() if r["host"] == "h3")
    assert max(r["host_rate"] for r in got.values()) < 0.5


def test_rates_shrink_to_the_mean(spark):
    rows = [(f"h{i}", j < i) for i in range(4) for j in range(4)] + [("one", True)]
    rates = {r["host"]: r["rate"] for r in host_rates(spark.createDataFrame(rows, "host string, any_failed boolean")).collect()}
    assert rates["h0"] > 0 and rates["one"] < 1 and rates["h0"] < rates["h1"] < rates["h2"] < rates["h3"]


def test_repeated_words():
    assert repeated_words([b"a"] * 4) == 0
    assert repeated_words([b"a"] * 6) == 6
    assert repeated_words(b"a b c d e x a b c d e".split()) == 10


# -- op 8 -------------------------------------------------------------------------------------------------------------


def test_shards(docs, rows, spark):
    got = sorted(byte_shards(docs, 4).collect(), key=lambda r: r["doc_id"])
    sizes = {r[0]: len((r[1] or "").encode()) + 8 for r in rows}
    whole, upto, last = sum(sizes.values()), 0, defaultdict(int)
    for r in got:
        size = sizes[r["doc_id"]]
        assert r["size"] == size and r["shard"] == min(3, (2 * upto + size) * 4 // (2 * whole))
        assert r["slot"] == last[r["shard"]]
        last[r["shard"]] += 1
        upto += size
    assert {r["doc_id"]: r["text_crc32"] for r in got} == {r[0]: zlib.crc32((r[1] or "").encode()) for r in rows}
    odd = spark.createDataFrame([(None, "a"), (1, None), (1, None), (2, "b")], "doc_id long, text string")
    assert sorted(r["slot"] for r in byte_shards(odd, 1).collect()) == [0, 1, 2, 3]


def test_shards_of_no_documents(no_docs):
    assert byte_shards(no_docs).count() == 0


def test_range_id(spark):
    got = spark.range(10).select("id", range_id(F.col("id"), [2, 5, 9]).alias("r")).collect()
    assert [r["r"] for r in got] == [0, 0, 1, 1, 1, 2, 2, 2, 2, 3]


# -- op 9 -------------------------------------------------------------------------------------------------------------


def plain_groups(rows, n):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        span = min(n, len(words))
        sets[i] = {tuple(words[j : j + span]) for j in range(len(words) - span + 1)} if words else set()
    parent = {i: i for i in sets}

    def find(x):
        return x if parent[x] == x else find(parent[x])

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


@pytest.mark.parametrize("n, blocks", [(2, (512, 400_000)), (5, (512, 400_000)), (5, (4, 900))])
def test_near_duplicates(spark, docs, rows, monkeypatch, n, blocks):
    monkeypatch.setattr(hyperminhash, "BLOCK", blocks[0])
    monkeypatch.setattr(hyperminhash, "BLOCK_SHINGLES", blocks[1])
    rng = np.random.default_rng(n)
    base = [f"v{x}" for x in rng.integers(0, 500, 200)]
    more = []
    for i in range(60):  # a chain of small edits, so that ends are linked only through others
        base[int(rng.integers(0, 200))] = f"edit{i}"
        base[int(rng.integers(0, 200))] = f"too{i}"
        more.append((1000 + i, " ".join(base)))
    more += [(2000, "a b"), (2001, "A  b"), (2002, "b a"), (2003, "lone"), (2004, "LONE")]
    df = docs.select("doc_id", "text", "chunk").unionByName(spark.createDataFrame([(*m, 0) for m in more], "doc_id long, text string, chunk int"))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates(df, n).collect()}
    assert got == plain_groups([(r[0], r[1]) for r in rows] + more, n)


def test_near_duplicates_of_copies_and_none(spark, no_docs):
    df = spark.createDataFrame([(2, "a b c"), (2, "a b c"), (1, "a b c"), (None, "a b c")], "doc_id long, text string")
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in near_duplicates(df, 2).collect())
    assert got == [("1", "1", True), ("2", "1", False), ("2", "1", False), ("None", "None", True)]
    assert near_duplicates(no_docs).count() == 0


def test_registers_agree_as_often_as_sets_overlap():
    rng = np.random.default_rng(8)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [np.unique(pool[:2000]), np.unique(pool[1000:])]
    a, b = registers(sets)
    assert abs((a == b).mean() - 1 / 3) < 0.15
    assert 0 < chance_collisions(np.array([100.0]), np.array([100.0]))[0] < 0.002


def test_connected(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101)], "a long, b long")
    labels = {r["id"]: r["label"] for r in connected(edges).collect()}
    assert labels == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


# -- op 10 ------------------------------------------------------------------------------------------------------------


def test_token_files(spark, docs, rows):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    special = ["<|endoftext|>", "a <|endoftext|> b", "a<|endoftext|>b.", "x  <|endoftext|>\n<|endoftext|>, y", " <|endoftext|>.", "<|endoftext|", "Hello <|endoftext|>a."]
    special += ["".join(map(str, np.random.default_rng(i).choice(np.array([" ", "<|endoftext|>", "ab", ".", "\n", "9", "é"]), 30))) for i in range(40)]
    rows = [*[r[:2] for r in rows], *[(5000 + i, t) for i, t in enumerate(special)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    where = tokens_path(docs)
    write_tokens(docs, where, path)
    tokens = read_tokens(spark, where)
    ids = {r["doc_id"]: r["ids"] for r in tokens.collect()}
    index, start = by_id(token_index(tokens)), 0
    for i, text in sorted(rows):
        want = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        assert ids[i] == want
        crc = zlib.crc32(np.array(want, "<u4").tobytes())
        assert (index[i]["start"], index[i]["n_tokens"], index[i]["ids_crc32"]) == (start, len(want), crc)
        start += len(want)
    plan = tokens.filter("doc_id = 3")._jdf.queryExecution().toString()
    assert "EqualTo(doc_id,3)" in plan
    assert tokens.filter("doc_id = 3").count() == 1


def test_token_files_of_no_documents(spark, no_docs):
    where = tokens_path(no_docs)
    write_tokens(no_docs, where, public_tokenizers.path("byte_bpe_50k.json"))
    assert token_index(read_tokens(spark, where)).count() == 0
