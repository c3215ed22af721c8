"""Models and fingerprints against versions written as plain loops."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracewell.llm import langid, minhash, pii, quality

M64 = (1 << 64) - 1


# --- language -----------------------------------------------------------------------------------------------------------


def plain_grams(text):
    symbols = []
    for c in (text or "").lower():
        if c.isalpha():
            symbols.append(c)
        elif not symbols or symbols[-1] != " ":
            symbols.append(" ")
    out = []
    for order in (1, 2, 3):
        for k in range(len(symbols) - order + 1):
            h = 0
            for c in symbols[k : k + order]:
                h = (h + ord(c)) * 0x9E3779B97F4A7C15 & M64
            out.append(((h ^ (h >> 29)) >> 16) % langid.BUCKETS)
    return out


def plain_language(rows, texts):
    """(label, posterior) of texts by naive Bayes over rows (lang, text)."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        counts[lang].update(plain_grams(text))
        n[lang] += 1
    out = []
    for text in texts:
        own = plain_grams(text)
        logs = {}
        for lang in counts:
            total = sum(counts[lang].values()) + 0.5 * langid.BUCKETS
            sums = sum(math.log((counts[lang][g] + 0.5) / total) for g in own)
            logs[lang] = sums * min(len(own), langid.EVIDENCE) / max(len(own), 1) + math.log(n[lang] / len(rows))
        high = max(logs.values())
        odds = {lang: math.exp(x - high) for lang, x in logs.items()}
        best = max(sorted(odds), key=odds.get)
        out.append((best, odds[best] / sum(odds.values())) if any(c.isalpha() for c in text or "") else ("und", 0.0))
    return out


WORDS = {"en": "the of and that with this have from", "de": "und der die nicht mit schön über", "pt": "não uma que coração para"}


def test_language_is_naive_bayes(spark):
    rng = random.Random(4)
    write = lambda lang, n: " ".join(rng.choice(WORDS[lang].split()) for _ in range(n))
    rows = [(lang, write(lang, rng.randint(1, 12))) for lang, many in (("en", 40), ("de", 25), ("pt", 3)) for _ in range(many)]
    train = spark.createDataFrame([(k, t, lang) for k, (lang, t) in enumerate(rows)] + [(None, "x y", "en"), (900, None, "fr"), (901, "z", None)], "doc_id long, text string, lang string")
    model = langid.train(train)
    assert model.languages == ["de", "en", "pt"]
    texts = [write(lang, n) for lang in WORDS for n in (1, 3, 30)] + ["", None, "12 !", "a", "Ü ß", "mixed the und que"]
    labels, scores = model.predict(texts)
    for label, score, (want, odds) in zip(labels, scores, plain_language(rows, texts)):
        assert label == want and abs(score - odds) < 1e-4


def test_rare_language_is_learnt(spark):
    rows = [(k, f"the words of number {k}", "en") for k in range(4000)] + [(9000 + k, "não uma coração", "pt") for k in range(3)]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), rows=300)
    assert model.languages == ["en", "pt"] and model.predict(["uma coração não"])[0] == ["pt"]
    assert langid.train(spark.createDataFrame([], "doc_id long, text string, lang string")).predict(["a", ""]) == (["und", "und"], [1.0, 0.0])


def test_long_texts_are_cut_at_white_space():
    text = "one two  three\nfour " * 50 + "x" * 100
    assert "".join(langid.pieces(text, 60)) == text and max(map(len, langid.pieces(text, 60))) <= 60
    places, parts = zip(*((p, t) for ps, ts in langid.chunks(["a b", text, ""], 60) for p, t in zip(ps, ts)))
    assert [i for i, _ in zip(places, parts) if i != 1] == [0, 2] and "".join(t for p, t in zip(places, parts) if p == 1) == text
    cut = sum(len(langid.grams([p])[0]) for p in langid.pieces(text, 60))
    assert 0.8 < cut / len(plain_grams(text)) <= 1.02


# --- quality ------------------------------------------------------------------------------------------------------------


def plain_features(text):
    words, out = (text or "").split(), Counter()
    for w in words:
        out[xxhash.xxh64_intdigest(w.encode()) % quality.BUCKETS] += 1
        framed = f"<{w}>"
        for order in quality.ORDERS:
            for k in range(len(framed) - order + 1):
                h = 0
                for c in framed[k : k + order]:
                    h = (h + ord(c)) * 0x9E3779B97F4A7C15 & M64
                out[(h >> 40) % quality.BUCKETS] += 1
    for lag in range(1, quality.LAGS + 1):
        same = sum(a == b for a, b in zip(words, words[lag:]))
        if same:
            out[quality.BUCKETS + lag - 1] += same
    return out


def plain_fit(texts, labels):
    """The same gradient descent, one feature at a time."""
    rng = np.random.default_rng(quality.SEED)
    docs = [plain_features(t) for t in texts]
    size = quality.DIMENSIONS
    embedding = rng.uniform(-1 / size, 1 / size, (quality.BUCKETS + quality.LAGS, size))
    layer, bias, done, total = np.zeros((size, 2)), np.zeros(2), 0, quality.EPOCHS * len(docs)
    for _ in range(quality.EPOCHS):
        turn = rng.permutation(len(docs))
        for k in range(0, len(docs), quality.BATCH):
            part, rate = turn[k : k + quality.BATCH], quality.RATE * (1 - done / total)
            steps, own_layer, own_bias = [], np.zeros((size, 2)), np.zeros(2)
            for d in part:
                mean = sum((n * embedding[f] for f, n in docs[d].items()), np.zeros(size)) / max(1, docs[d].total())
                logits = mean @ layer + bias
                odds = np.exp(logits) / np.exp(logits).sum()
                gradient = odds - np.eye(2)[labels[d]]
                own_layer += np.outer(mean, gradient)
                own_bias += gradient
                steps.append((d, layer @ gradient))
            layer = layer - rate * own_layer
            bias = bias - rate / len(part) * own_bias
            for d, g in steps:
                for f, n in docs[d].items():
                    embedding[f] -= rate * size * n / docs[d].total() * g
            done += len(part)
    return embedding, layer, bias


def test_quality_is_its_plain_loop():
    rng = random.Random(1)
    good, bad = "a careful study of rivers and their banks".split(), "win win cash now click click now".split()
    texts, labels = [], []
    for k in range(40):
        labels.append(k % 2)
        texts.append(" ".join(rng.choice(good if k % 2 else bad) for _ in range(rng.randint(1, 25))))
    texts, labels = [*texts, "", None, "é ß ßé é"], [*labels, 1, 0, 1]
    embedding, layer, bias = plain_fit(texts, labels)
    own = quality.fit(texts, labels)
    for text in [*texts, "unseen words now", "now now now now", "  ", "a\tcareful\nstudy"]:
        features = plain_features(text)
        mean = sum((n * embedding[f] for f, n in features.items()), np.zeros(quality.DIMENSIONS)) / max(1, features.total())
        logits = mean @ layer + bias
        assert abs(own.score(text) - np.exp(logits[1]) / np.exp(logits).sum()) < 1e-3, text


def test_quality_sample_is_bounded(spark, monkeypatch):
    docs = spark.createDataFrame([(k, "word " * 100) for k in range(60)] + [(0, "again"), (70, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(71)] + [(3, 0), (3, 1)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "fit", lambda texts, own: seen.append((texts, own)))
    quality.train(docs, labels)
    quality.train(docs, labels, chars=2000)
    assert len(seen[0][0]) == len(seen[0][1]) <= 61 and sum(len(t or "") for t in seen[0][0]) > 10_000
    assert 0 < sum(len(t or "") for t in seen[1][0]) <= 2000


# --- personal data ------------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def model(spark):
    spark.range(1).count()
    return pii._trained()


def test_expression_is_the_trees(spark, model):
    """The CASE expression gives what a walk down each tree gives."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 12, (200, len(pii.FEATURES))).astype(float)
    rows = spark.createDataFrame([(k, r.tolist()) for k, r in enumerate(x)], "k int, x array<double>")
    found = {r["k"]: r["p"] for r in rows.select("k", model.probability([F.get("x", F.lit(j)) for j in range(x.shape[1])]).alias("p")).collect()}
    for k, row in enumerate(x):
        total = model.start
        for t in model.trees:
            (j, cut), low, high = t.sides[0] if row[t.split[0]] <= t.split[1] else t.sides[1]
            total += low if row[j] <= cut else high
        assert abs(found[k] - 1 / (1 + math.exp(-(model.slope * total + model.shift)))) < 1e-9
        assert abs(model.margins(row[None, :])[0] - total) < 1e-9


@pytest.mark.parametrize("n", [0, 1, 7, 60, 700])
def test_selection_among_overlaps(spark, n):
    rng = random.Random(n)
    spans = []
    for _ in range(n):
        start = rng.randint(0, 20 * n)
        spans.append((start, rng.randint(0, 5), "x", start + rng.randint(1, 40), rng.choice([2.0, 0.5, 0.6, 0.7, 0.9])))
    rows = spark.createDataFrame([(sorted(set(spans)),), (None,)], f"every {pii.SCORED}")
    found, none = ([tuple(s) for s in r["added"]] for r in pii.with_selected(rows).collect())
    over = lambda a, b: a[0] < b[3] and b[0] < a[3]
    free = [s for s in set(spans) if s[4] < 2 and not any(o[4] == 2 and over(o, s) for o in spans)]
    want = [s for s in free if not any((-o[4], o[0], o[1]) < (-s[4], s[0], s[1]) and over(o, s) for o in free)]
    assert sorted(found) == sorted(want) and none == []


# --- fingerprints -------------------------------------------------------------------------------------------------------


def mix(x):
    x = (x ^ (x >> 30)) * 0xBF58476D1CE4E5B9 & M64
    x = (x ^ (x >> 27)) * 0x94D049BB133111EB & M64
    return x ^ (x >> 31)


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return None
    width, bins = min(minhash.SHINGLE, len(words)), {}
    for k in range(len(words) - width + 1):
        h = 0
        for w in words[k : k + width]:
            h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh64_intdigest(w)) & M64
        h = mix(h)
        bins[h >> 55] = min(h, bins.get(h >> 55, h))
    out = []
    for b in range(minhash.BINS):
        order = sorted(range(minhash.BINS), key=lambda j: mix(((b * minhash.BINS + j) * 0x9E3779B97F4A7C15 + 7) & M64))
        value = bins[b] if b in bins else bins[next(j for j in order if j in bins)]
        out.append(mix(value ^ mix((b * 0x9E3779B97F4A7C15 + 11) & M64)) & 15)
    return bytes(16 * a + b for a, b in zip(out[::2], out[1::2]))


TEXTS = ["one", "One TWO", "a b c d e", "a b c d e f g", " ".join(f"w{k}" for k in range(90)), " ".join(f"w{k % 7}" for k in range(300)), "é É ñ", "", None, " \n\t"]


def test_fingerprint_is_its_plain_loop():
    made = minhash.Fingerprinter(table_size=5)
    for text in TEXTS * 2:
        assert made.of(made.words(text)) == plain_fingerprint(text)


def test_edits_by_plain_loop(spark):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(20, TEXTS[4]), (21, TEXTS[4].upper())]
    found = {r["doc_id"]: r for r in minhash.with_edits(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    by_text = defaultdict(set)
    for k, (doc, text) in enumerate(rows):
        text, after, r = text or "", rows[(k + 1) % len(rows)][1] or "", found[doc]
        half = len(text) // 2
        own, edited, other = map(plain_fingerprint, (text, text[: len(text) - half] + after[:half], after))
        assert r["fingerprint"] == minhash.digest(own) and r["edited_fingerprint"] == minhash.digest(edited)
        near = lambda a, b: float(a is b) if a is None or b is None else min(1, max(0, (sum(x == y for p, q in zip(a, b) for x, y in ((p >> 4, q >> 4), (p & 15, q & 15))) / 512 - 1 / 16) / (15 / 16)))
        assert abs(r["near_edited"] - near(own, edited)) < 1e-12 and abs(r["near_next"] - near(own, other)) < 1e-12
        by_text[text.lower()].add(r["fingerprint"])
    assert all(len(v) == 1 for v in by_text.values()) and found[20]["near_next"] == 1.0
