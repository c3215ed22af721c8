"""op11: groups over links of full shingle sets against a plain loop."""

import numpy as np

from tracewell.llm import neardup

SCHEMA = "doc_id long, text string"


def plain(rows, share=85):
    """(doc_id, n_shingles, component_id, kept) of rows (doc_id, text), by comparing every two."""
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if c.isascii() else c for c in text or "").replace("\x0b", " ").replace("\x0c", " ")
        words = [w for w in words.translate({9: " ", 10: " ", 13: " "}).split(" ") if w]
        sets.append({" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= share * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k)), i == least.get(find(k))) for k, ((i, _), s) in enumerate(zip(rows, sets))), key=repr)


def found(spark, rows, schema=SCHEMA, **columns):
    docs = spark.createDataFrame(rows, schema)
    return sorted((tuple(r) for r in neardup.near_duplicates(docs.withColumns(columns)).collect()), key=repr)


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"e{rng.integers(1_000_000)}"
    return out


def near_rows(rng, n=40, copies=160):
    """Documents, and copies of some at similarities around 0.85; copies of copies make chains whose ends are not alike."""
    texts = [[f"w{x}" for x in rng.integers(1_000_000, size=int(rng.integers(3, 150)))] for _ in range(n)]
    for _ in range(copies):
        own = texts[int(rng.integers(len(texts)))]
        texts.append(edited(rng, own, min(len(own), int(rng.integers(0, 4)))))
    ids = rng.permutation(len(texts)).tolist()
    return [(i, " ".join(t)) for i, t in zip(ids, texts)]


def test_against_plain_loop(spark):
    rows = near_rows(np.random.default_rng(11))
    assert found(spark, rows) == plain(rows)


def test_threshold_is_exact(spark):
    """17 of 20 shingles is a link, 169 of 199 is none."""
    words = [f"w{k}" for k in range(24)]
    at = [(1, " ".join(words[:22])), (2, " ".join(words[:21] + ["x", "y"]))]  # 18 and 19 shingles, 17 in both
    base = [f"v{k}" for k in range(300)]
    under = [(3, " ".join(base[:188])), (4, " ".join(base[:173] + [f"u{k}" for k in range(15)]))]  # 169 in both, 199 in either
    rows = at + under
    told = {r[0]: r[2] for r in found(spark, rows)}
    assert told == {1: 1, 2: 1, 3: 3, 4: 4} and found(spark, rows) == plain(rows)


def test_unlike_hub(spark):
    """A large group in which few are alike: those that are not like any hub are found by one another."""
    rng = np.random.default_rng(12)
    shared = [f"t{k}" for k in range(100)]
    texts = [shared + [f"w{x}" for x in rng.integers(1_000_000, size=12)] for _ in range(150)]
    texts += [edited(rng, texts[k], 1) for k in rng.integers(150, size=60)]
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    assert found(spark, rows) == plain(rows)


def test_hot_copies_and_many_members(spark, monkeypatch):
    """A third of all rows are one text, another third near copies of one, dealt out over several tasks of a hub."""
    monkeypatch.setattr(neardup, "STAR_ROWS", 16)
    rng = np.random.default_rng(13)
    base, one = [f"w{x}" for x in range(200)], " ".join(f"c{x}" for x in range(50))
    rows = [(k, " ".join(edited(rng, base, 1))) for k in range(120)] + [(200 + k, one) for k in range(120)] + [(400 + k, f"alone {k} " + " ".join(f"q{x}" for x in rng.integers(10**6, size=30))) for k in range(120)]
    assert found(spark, rows) == plain(rows)


def test_odd_rows(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(7, text), (3, text.upper()), (3, text.upper()), (None, text), (None, "only here and nowhere else at all"), (9, None), (10, ""), (11, " \t\n "), (12, "Two  words"), (13, "two\twords"), (14, "other words"), (15, "É é"), (3, "two words")]
    assert found(spark, rows) == plain(rows)
    from pyspark.sql import functions as F

    assert found(spark, rows, component_id=F.lit("x"), fp=F.lit(1), n_shingles=F.lit(None), text_hash=F.lit(0)) == plain(rows)


def test_empty_and_long(spark):
    assert found(spark, []) == []
    long = " ".join(f"w{k % 70_000}" for k in range(200_000))
    rows = [(1, long), (2, long + " and one"), (3, "x" * 1_000_000)]
    assert found(spark, rows) == [(1, 70_000, 1, True), (2, 70_002, 1, False), (3, 1, 3, True)]
