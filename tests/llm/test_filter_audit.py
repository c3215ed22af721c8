"""op12: the audit against a plain loop over documents and orders."""

import re
from itertools import permutations

import numpy as np
from pyspark.sql import functions as F

from tracewell.llm import filteraudit

DOCS, LABELS = "doc_id long, text string, source string", "doc_id long, quality int, toxic int"


def plain(docs, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    parts = {}
    for i, text, source in docs:
        t = text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t),
            "D": re.search("[#$%&*|]", t) is not None,
            "E": i is not None and any(o is not None and o < i and (x or "") == t for o, x, _ in docs),
        }
        parts.setdefault(source or "", []).append((i, {f for f, bad in fails.items() if bad}))
    out = []
    for part, rows in parts.items():
        steps, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[f] += len(gone)
                redundant = sum(f in bad for _, bad in rows) - len(gone)
                steps.append((part, order, step, len(left), len(gone), redundant, sum(bad == {f} for _, bad in rows), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*s, shapley[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def found(spark, docs, labels, **columns):
    told = filteraudit.audit(spark.createDataFrame(docs, DOCS).withColumns(columns), spark.createDataFrame(labels, LABELS).withColumns(columns))
    assert told.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return sorted(tuple(r) for r in told.collect())


def random_rows(rng, n=120):
    docs = []
    for k in range(n):
        words = [f"w{x}" for x in rng.integers(int(rng.choice([20, 2000])), size=int(rng.choice([5, 150, 199, 200, 320])))]
        for at in rng.integers(len(words), size=int(rng.choice([0, 3, 30]))):
            words[at] = words[at].upper()
        text = str(rng.choice([" ", "\n", " \t "])).join(words) + str(rng.choice(["", " #", "|", " é"]))
        docs.append((k, text, rng.choice(["a", "b", None])))
    docs += [(n + k, docs[int(rng.integers(n))][1], "a") for k in range(40)]
    labels = [(int(i), int(rng.integers(2)), int(rng.integers(2))) for i in rng.choice(n + 40, 90, replace=False)]
    return docs, labels


def test_against_plain_loop(spark):
    docs, labels = random_rows(np.random.default_rng(5))
    assert found(spark, docs, labels) == plain(docs, labels)


def test_odd_rows(spark):
    many = " ".join(f"w{k}" for k in range(250))
    docs = [(1, None, None), (2, "", ""), (None, many, "a"), (None, many, "a"), (3, many, "a"), (4, many, "a"), (4, many, "a"), (4, "x " * 300, "a"), (5, " " + many, "b"), (6, "  ", "b"), (-1, many, "c"), (0, many, "c")]
    labels = [(3, 1, None), (3, 0, 1), (4, None, None), (None, 1, 1), (99, 1, 1), (-1, 1, 0), (-1, 1, 0)]
    assert found(spark, docs, labels) == plain(docs, labels)
    assert found(spark, docs, labels, part=F.lit(1), good=F.lit("x"), A=F.lit(None), words=F.lit(2), id=F.lit(0)) == plain(docs, labels)


def test_empty_and_long(spark):
    assert found(spark, [], []) == []
    docs = [(1, " ".join(f"w{k}" for k in range(400_000)), "a"), (2, "w " * 400_000, "a")]
    told = {(r[1], r[2]): r[3:] for r in found(spark, docs, [])}
    assert told[("ABCDE", 5)] == (1, 0, 0, 0, 0, 0, 0) and told[("BACDE", 1)][1] == 1


def test_words_do_not_cross_a_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b", "s")], DOCS)
    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_hash"), "text").repartition(3, "id", "text_hash")
    plan = filteraudit.word_counts(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1
