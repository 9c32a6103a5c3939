"""Conversation repair, source divergence and the quality classifier, each against a plain version."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict
from heapq import heappop, heappush

import numpy as np
import pytest

from tickloom.llm import divergence, quality
from tickloom.llm.conversations import audit_conversations, cheapest_edits, plan_repairs, repair_conversations
from tickloom.llm.divergence import source_divergence, term_pieces
from tickloom.llm.lang_id import code_words, held_out, identify, train_languages
from tickloom.llm.quality import QualityModel, features, judge_quality, ngrams, score_quality, train_quality

TURNS = "conv_id long, turn long, role string, text string, Kind int, copies string, audit string"


# -- op 11 ------------------------------------------------------------------------------------------------------------


def plain_edits(rows):
    """rows: (role, text, fault). Cheapest edits, ASCII-least, by a search over (cost, edits)."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, edits, i, initials, out = heappop(heap)
        legal = re.fullmatch("(s?(ua)+)?", initials)
        if i == len(rows) and legal:
            return cost, edits, list(out)
        if not any(re.fullmatch("(s?(ua)+)?", initials + rest) for rest in ("", "a", "ua")) or (i, initials[-1:], bool(initials), edits, cost) in done:
            continue
        done.add((i, initials[-1:], bool(initials), edits, cost))
        if cost > 3 * len(rows) + 4:
            continue
        for role in ("user", "assistant"):
            heappush(heap, (cost + 2, edits + "I", i, initials + role[0], (*out, f"{role}:")))
        if i < len(rows):
            role, text, fault = rows[i]
            heappush(heap, (cost + 3, edits + "D", i + 1, initials, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heappush(heap, (cost + more, edits + "K", i + 1, initials + role[0] if role and role[0] in "sua" else "x", (*out, f"{role}:{text}")))
                for new in ("user", "assistant"):
                    heappush(heap, (cost + 2 + more, edits + "R", i + 1, initials + new[0], (*out, f"{new}:{text}")))


def plain_audit(rows):
    """What op11 wants for rows (conv_id, turn, role, text), damage included."""
    found = {}
    for conv in {r[0] for r in rows}:
        after = []
        for c, turn, role, text in rows:
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if c == conv and h != 0:
                text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
                after += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, judged = set(), []
        for _, role, text in after:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            judged.append((role, text, fault))
            seen.add((role, text))
        turns = {t for t, _, _ in after if t is not None}
        cost, edits, out = plain_edits(judged)
        found[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *(sum(f == x for _, _, f in judged) for x in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])),
            cost, edits, hashlib.sha256("\n".join(out).encode()).hexdigest(),
        )
    return found


def some_turns(seed, conversations):
    pick = random.Random(seed)
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, 6)):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            text = pick.choice(["Yes.", "No!", "Well", "", " \n", "a. ", None, f"Number {turn}. ", "Why? \t\n"])
            rows.append((conv if conv else None, pick.choice([turn, turn, turn, None, 3]), role, text))
    return rows + rows[:4]


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations(spark, seed):
    rows = some_turns(seed, 60)
    df = spark.createDataFrame([(*r, 5, "x", "y") for r in rows], TURNS).repartition(3)
    got = audit_conversations(df).collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {r["conv_id"]: tuple(r[n] for n in names) for r in got} == plain_audit(rows) and len(got) == 60


def test_long_conversations_and_copies(spark):
    """More rows than a checkpoint's block, rows repeated thousands of times, and what stays of them in order."""
    rows = [(1, i, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(2500)] + [(2, 0, "user", "Again.")] * 3000 + [(2, 1, "assistant", "Ok.")]
    df = spark.createDataFrame([(*r, 0, "", "") for r in rows], TURNS)
    plans, repaired = repair_conversations(df)
    got = {r["conv_id"]: r for r in plans.collect()}
    assert got[1]["cost"] == 0 and got[1]["audit"] == "K" * 2500
    assert (got[2]["duplicate"], got[2]["cost"], got[2]["illegal"]) == (2999, 3 * 2999, 2999) and got[2]["audit"] == "K" + "D" * 2999 + "K"
    kept = sorted((r["conv_id"], r["position"], r["role"], r["text"], r["edit"]) for r in repaired.collect())
    assert kept[:2500] == [(1, i, r[2], r[3], "K") for i, r in enumerate(rows[:2500])] and [k[3] for k in kept[2500:]] == ["Again.", "Ok."]


def test_checkpoints_and_search_agree():
    pick = random.Random(3)
    for n in (0, 1, 2, 3, 5, 9, 10):
        for _ in range(20):
            rows = [(pick.choice(["system", "user", "assistant", "x"]), "t", pick.choice(["", "", "blank", "duplicate", "truncated"])) for _ in range(n)]
            codes = bytes("suax".index(r[0][0]) + 4 * ("", "blank", "duplicate", "truncated").index(r[2]) for r in rows)
            assert cheapest_edits(codes) == plain_edits(rows)[:2]


def test_no_conversations(spark):
    empty = spark.createDataFrame([], TURNS)
    assert audit_conversations(empty).count() == 0 and repair_conversations(empty)[1].count() == 0
    none = spark.createDataFrame([(7, 1, "user", "Hi.", 0)], "conv_id long, turn long, role string, text string, copies long")
    assert [tuple(r)[:2] + (r["cost"], r["audit"]) for r in plan_repairs(none).collect()] == [(7, 0, 0, "")]


# -- op 12 ------------------------------------------------------------------------------------------------------------


def plain_divergence(rows, min_docs, top):
    """rows: (text, lang, source)."""
    groups, found, docs = defaultdict(Counter), Counter(), defaultdict(Counter)
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))
        groups[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: [t for t, n in docs[lang].items() if n >= min_docs] for lang, _ in groups}

    def p(counts, lang):
        total = sum(counts[t] for t in kept[lang])
        return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept[lang])) for t in kept[lang]}

    f = lambda a, b: (a - b) ** 2 // (a + b)
    out = []
    for (lang, source), counts in groups.items():
        mine, whole = p(counts, lang), p(sum((c for (x, _), c in groups.items() if x == lang), Counter()), lang)
        pairs = [(sum(f(mine[t], other[t]) for t in kept[lang]), s) for (x, s), c in groups.items() if x == lang and s != source for other in [p(c, lang)]]
        terms = [(f(mine[t], whole[t]), t) for t in kept[lang] if counts[t] and mine[t] > whole[t]]
        for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
            ranked = sorted(items, key=lambda x: (-x[0], x[1].encode()))[:most]
            out += [(lang, source, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return sorted(out)


def some_sources():
    pick = random.Random(5)
    words = [f"w{chr(97 + i)}é" for i in range(12)] + ["The", "ŒUVRE", "x2y", "日本"]
    rows = []
    for i in range(160):
        text = " ".join(pick.choice(words[: 4 + 3 * (i % 5)]) for _ in range(pick.randint(0, 30)))
        rows.append((text, pick.choice(["en", "en", "de", None]), pick.choice(["a", "a", "a", "b", "c,d", "é", "", None])))
    return [*rows, (None, "en", "only null"), ("", "xx", "alone"), ("rare words here", "xx", "other"), ("The " * 3000, "en", "a"), ("y" * 5000, "en", "b")]


@pytest.mark.parametrize("cells, held, piece", [(1_000_000, 500_000, 1 << 20), (12, 3, 40)])
def test_divergence(spark, monkeypatch, cells, held, piece):
    monkeypatch.setattr(divergence, "TREE_CELLS", cells)
    monkeypatch.setattr(divergence, "MOST_HELD", held)
    monkeypatch.setattr(divergence, "PIECE_BYTES", piece)
    rows = some_sources()
    df = spark.createDataFrame([(*r, 1, "x", 2.5, "k") for r in rows], "text string, lang string, source string, n int, term string, rank double, k string").repartition(4)
    got = sorted(tuple(r) for r in source_divergence(df, min_docs=8, top=3).collect())
    assert got == plain_divergence(rows, 8, 3)


def test_terms_are_not_cut():
    text = "Über den Wolken, ABC-defghijklmnopqrstuvwxyz 123 a's " * 5
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if c < "\x80" else c for c in text))
    assert [t.decode() for piece in term_pieces(text.encode(), 10) for t in piece] == want


def test_shared_paths_are_one_node():
    rows = [[(0, 5, 1), (1, 4, 2)], [(0, 5, 1), (1, 4, 2), (2, 9, 3)], [(0, 5, 1), (2, 9, 3)], [(1, 4, 2)]]
    pairs, nodes = divergence.tree_sums([np.array(r) for r in rows], np.array([3, 1, 2, 7]))
    f = lambda a, b: (a - b) ** 2 // (a + b)
    of = lambda p, z, q, y: f(p, q) - f(p, y) - f(z, q) + f(z, y)
    assert pairs.tolist() == [[0, 1, 4 * of(5, 1, 4, 2)], [0, 2, 3 * of(5, 1, 9, 3)], [1, 2, of(4, 2, 9, 3)]]
    assert nodes.tolist() == [[0, 5, 6], [1, 4, 11], [2, 9, 3]]


def test_divergence_of_nothing(spark):
    assert source_divergence(spark.createDataFrame([], "text string, lang string, source string")).count() == 0


# -- op 13 ------------------------------------------------------------------------------------------------------------


def labelled(spark, n=240):
    pick = random.Random(9)
    words = ["river", "stone", "über", "walk", "the", "of", "light", "and"]
    rows, marks = [], []
    for i in range(n):
        text = " ".join(pick.choice(words) for _ in range(pick.randint(5, 60)))
        good = pick.random() < 0.7
        rows.append((i, text if good else text.upper().replace(" ", "!! ") if i % 2 else " ".join(w + " " + w for w in text.split()), "x", 0.5))
        marks.append((i, int(good), 0))
    odd = [(n, None, "x", 0.5), (n + 1, "", "x", 0.5), (n + 2, "word " * 3000, "x", 0.5), (None, "river stone", "x", 0.5), (0, *rows[0][1:])]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, label string, score double").repartition(3)
    return docs, spark.createDataFrame(marks + marks[:3] + [(None, 1, 0), (5, None, 1), (6, 9, 0)], "doc_id long, quality int, toxic int"), dict(m[:2] for m in marks)


def test_quality_of_held_out_documents(spark):
    docs, labels, truth = labelled(spark)
    got = judge_quality(docs, labels).collect()
    assert len(got) == 245 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    out = [r for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(out) > 50 and np.mean([r["predicted"] == truth[r["doc_id"]] for r in out]) >= 0.95
    none = [r["score"] for r in got if r["doc_id"] in (240, 241)]
    assert none[0] == none[1]


def test_updates_follow_the_rule():
    """Weights after a few documents, by a loop over single coordinates."""
    model, z, n = QualityModel.empty(), defaultdict(float), defaultdict(float)
    weight = lambda i: 0.0 if abs(z[i]) <= model.l1 else -(z[i] - np.sign(z[i]) * model.l1) / ((model.beta + n[i] ** 0.5) / model.alpha + model.l2)
    for text, label in [(b"good river stone", 1), (b"BAD!! BAD!! word", 0), (b"good good river", 1), (b"", 0), (b"word stone", 1)]:
        at, values = features(text)
        model.learn(at, values, label)
        w = {i: weight(i) for i in at}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(at, values))))
        for i, v in zip(at, values):
            g = (p - label) * v
            sigma = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / model.alpha
            z[i] += g - sigma * w[i]
            n[i] += g * g
    assert all(model.weights()[i] == pytest.approx(weight(i)) for i in z) and np.flatnonzero(model.weights()).size <= len(z)


def test_scores_are_sparse_dot_products(spark, monkeypatch):
    docs, labels, _ = labelled(spark)
    model = train_quality(docs, labels)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    w = model.weights().astype(np.float32)
    for r in score_quality(docs, model).collect():
        found, n = ngrams((texts[r["doc_id"]] or "").encode())
        logit = float(w[0]) + quality.SCALE * sum(float(w[i]) * k for i, k in Counter(found.tolist()).items()) / max(n, 1)
        assert r["score"] == pytest.approx(1 / (1 + np.exp(-logit)), abs=1e-5)
    monkeypatch.setattr(quality, "PIECE_BYTES", 100)
    at, values = features(texts[242].encode())
    assert values[1:].sum() == pytest.approx(quality.SCALE * sum(len(ngrams(p)[0]) for p in quality._pieces(texts[242].encode())) / 3000)


def test_a_bounded_share_of_labels_is_learned(spark, monkeypatch):
    docs, labels, _ = labelled(spark)
    seen = []
    monkeypatch.setattr(quality, "written", lambda df, name: seen.append((name, df.count())) or df)
    train_quality(docs, labels, fit_rows=60)
    assert 30 < dict(seen)["quality-features"] < 90


def test_quality_without_labels_or_documents(spark):
    docs, labels, _ = labelled(spark)
    assert {r["score"] for r in judge_quality(docs, labels.limit(0)).collect()} == {0.5}
    assert judge_quality(docs.limit(0), labels).count() == 0


# -- op 2 -------------------------------------------------------------------------------------------------------------


def plain_ngrams(text):
    """Hashed byte pairs and triples of a text, by a loop over its bytes."""
    letters = "".join(" " if c < "\x80" and not c.isalpha() else c for c in text.lower())
    b = f" {' '.join(letters.split())} ".encode()
    found = Counter((b[i] * 0x9E3779B1 + b[i + 1] * 0x85EBCA6B) % 2**32 >> 20 for i in range(len(b) - 1))
    found.update(4096 + ((b[i] * 0xC2B2AE35 + b[i + 1] * 0x27D4EB2F + b[i + 2] * 0x165667B1) % 2**32 >> 19) for i in range(len(b) - 2))
    return found


def test_language_bits_margins_and_losses(spark, docs, rows):
    """Weights of each bit, its reliability, and decoding, all from the texts by loops; lang, source and id are no inputs."""
    out = lambda i: zlib.crc32(str(i).encode()) % 4 == 2
    letters = lambda t: any(map(str.isalpha, t or ""))
    taught = defaultdict(Counter)
    for i, text, lang, *_ in rows:
        if lang is not None and letters(text) and not out(i):
            taught[lang].update(plain_ngrams(text))
    langs = sorted(taught)
    code = code_words(len(langs))
    chance = {x: [(taught[x][f] + 0.5) / (sum(taught[x].values()) + 0.5 * 12288) for f in range(12288)] for x in langs}
    weights, expected = [], []
    for bit in code.T:
        sides = [[x for x, b in zip(langs, bit) if b == s] for s in (1, -1)]
        mean = [[sum(chance[x][f] for x in side) / len(side) for f in range(12288)] for side in sides]
        w = [math.log(a) - math.log(b) for a, b in zip(*mean)]
        expected.append(max(1e-6, min(b * sum(c * v for c, v in zip(chance[x], w)) for x, b in zip(langs, bit))))
        weights.append([v * 6 / expected[-1] for v in w])
    model = train_languages(docs.filter("doc_id IS NOT NULL").filter(~held_out("doc_id", 4, 2)))
    assert model.languages == langs and np.allclose(model.weights, np.array(weights).T, rtol=1e-4, atol=1e-3) and np.allclose(model.reliability, np.array(expected) / max(expected))
    got = {r["doc_id"]: r for r in identify(docs).collect()}
    for i, text, *_ in rows:
        r = got[i]
        if not letters(text):
            assert (r["lang_pred"], r["score"], r["held_out"]) == ("und", 0, out(i))
            continue
        counts = plain_ngrams(text)
        margins = [sum(n * w[f] for f, n in counts.items()) / sum(counts.values()) for w in weights]
        losses = [sum(float(np.logaddexp(0, -b * m)) * e / max(expected) for b, m, e in zip(code[k], margins, expected)) for k in range(len(langs))]
        shares = [math.exp(min(losses) - x) / sum(math.exp(min(losses) - y) for y in losses) for x in losses]
        first, second = sorted(shares, reverse=True)[:2]
        assert r["lang_pred"] == langs[shares.index(first)] and r["score"] == pytest.approx(first, rel=1e-3) and r["held_out"] == out(i)
        if abs(first - second - 0.2) > 1e-3:
            assert r["ambiguous"] == (first - second < 0.2)
