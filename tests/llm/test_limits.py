"""What has no cap: languages, lengths of texts and of candidates; personal data's spans as a whole against a plain version."""

import random
import re
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import langid, pii, quality

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def test_every_language_is_learnt(spark, monkeypatch):
    """Thirteen languages in blocks of two give what one block gives, and the rarest is told."""
    rng = random.Random(1)
    words = {f"l{k:02d}": ["".join(rng.choice(LETTERS[k : k + 8]) for _ in range(6)) for _ in range(30)] for k in range(13)}
    rows = [(n, " ".join(rng.choice(words[lang]) for _ in range(20)), lang) for n, lang in enumerate(lang for k, lang in enumerate(words) for _ in range(4 + 3 * k))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts = [" ".join(words[lang][:8]) for lang in words] + [None, "", "123", "abc"]
    one = langid.train(docs).predict(texts)
    monkeypatch.setattr(langid, "BLOCK_LANGUAGES", 2)
    model = langid.train(docs)
    several = model.predict(texts)
    assert len(model.blocks) == 7 and model.languages == sorted(words)
    assert several[0] == one[0] and np.allclose(several[1], one[1], atol=1e-9) and one[0][:13] == list(words)
    asked = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "`a.b` long, text string").withColumn("score", F.lit("x"))
    found = sorted(tuple(r) for r in langid.scored(asked, model).collect())
    assert [r[3] for r in found] == one[0] and np.allclose([r[4] for r in found], one[1], atol=1e-9)
    kept = langid.keep_known(docs.withColumn("lang_pred", F.lit(1)).withColumnRenamed("doc_id", "doc.id").withColumn("doc_id", F.col("`doc.id`")), least=0.0)
    assert kept.columns == ["doc.id", "text", "lang", "lang_pred", "doc_id"] and kept.count() == len(rows)


def test_quality_in_blocks(monkeypatch):
    """Texts of more words than the table, cut anywhere, and words longer than a block score as in one piece."""
    rng = np.random.default_rng(2)
    weight = rng.normal(size=quality.BUCKETS + quality.LAGS)

    def plain(text):
        words = text.split()
        bucket, _ = quality.word_features(words)
        same = quality.repeats(np.unique(words, return_inverse=True)[1])
        return 1 / (1 + np.exp(-((weight[bucket].sum() + weight[quality.BUCKETS :] @ same) / (len(bucket) + same.sum()) + 0.1)))

    for letters, table in ((1 << 19, 500_000), (50, 40), (7, 9), (20, 3)):
        monkeypatch.setattr(quality, "LETTERS", letters)
        own = quality.Scorer(weight, 0.1, table)
        for _ in range(20):
            text = " ".join(f"w{x}" * int(rng.choice([1, 1, 1, 30])) for x in rng.integers(0, 12, int(rng.integers(1, 60))))
            assert abs(own.score(text) - plain(text)) < 1e-9
        assert own.score(None) == own.score(" \n") == 1 / (1 + np.exp(-0.1))


def test_quality_of_a_long_text_in_bounded_memory():
    code = """
import numpy as np
from tracewell.llm import quality
text = "".join("".join(f"{k:08d} " for k in range(a, a + 10_000)) for a in range(0, 4_000_000, 10_000))
text2 = "".join([text[:9_000_000], "x" * 9_000_000])
own = quality.Scorer(np.ones(quality.BUCKETS + quality.LAGS), 0.0)
of = lambda name: int(open("/proc/self/status").read().split(name + ":")[1].split()[0])
resident = of("VmRSS")
own.score(text); own.score(text2)
print((of("VmHWM") - resident) / 1024)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=quality.__file__.rsplit("/tracewell/", 1)[0])
    assert float(out.stdout) < 500, out.stdout + out.stderr


# --- personal data ------------------------------------------------------------------------------------------------------


def plain_base(text):
    spans = []
    for kind, p in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(p, text):
            number = re.sub("[^0-9]", "", m[0])
            luhn = sum(int(d) if k % 2 == 0 else (2 * int(d) - 9 if int(d) > 4 else 2 * int(d)) for k, d in enumerate(reversed(number))) % 10 == 0
            if kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")) or kind == "card" and 12 <= len(number) <= 19 and luhn or kind == "phone" and 9 <= len(number) <= 15:
                spans.append((m.start(), pii.KINDS.index(kind), m.end()))
    return sorted(spans)


def plain_features(value, left):
    left, count = left.lower(), lambda p: len(re.findall(p, value))
    parts = re.split("[^0-9A-Za-z]+", value)
    near = r"[a-z]*[^a-z]{0,4}(?:[a-z]{1,8}[^a-z]{0,3}){0,2}\Z"
    return [
        count("[0-9]"), count(r"[\x20./-]"), count("[A-Za-z]"), len(value), len(parts), count(r"[()\[\]]"),
        bool(re.search("(?:phone|tel|call|fax|mobile|cell|whatsapp|sms|contact|reach|dial)" + near, left)), bool(re.search("(?:ssn|social|iban|passport|tax|identity|insurance|account|acct)" + near, left)),
        bool(re.search(r"(?:version|isbn|page|pages|order|item|invoice|ref|no|chapter|fig|figure|table|score|row|issue|vol|pp)[^a-z]{0,4}\Z", left)),
        bool(re.fullmatch(r"[12][0-9]{3}[./-][0-9]{1,2}[./-][0-9]{1,2}|[0-9]{1,2}[./-][0-9]{1,2}[./-](?:[0-9]{2}){1,2}|[12][0-9]{3}[\x20/-]{1,2}[12][0-9]{3}", value)),
        bool(re.search("(?:pass|pwd|token|secret|key)", value.lower())), bool(re.search("[0-9].*[A-Za-z].*[0-9]|[A-Za-z].*[0-9].*[A-Za-z]", value)), min(map(len, parts)), ". " in value,
    ]


def plain_spans(text, model):
    base = plain_base(text)
    more = []
    for kind, pattern, _ in pii.GENERATORS:
        ends = 0
        for m in re.finditer(pattern, text):
            left = text[ends : m.start()][-pii.LEFT :]
            ends = m.end()
            margin = model.margins(np.array([plain_features(m[0], left)], float))[0]
            p = 1 / (1 + np.exp(-(model.slope * margin + model.shift)))
            if p >= model.thresholds[kind]:
                more.append((-p, m.start(), pii.KINDS.index(kind), m.end()))
    apart = lambda a, b: a[-1] <= b[0] or b[-1] <= a[0]
    free = [s for s in more if all(apart(s[1:], b) for b in base)]
    chosen = [s[1:] for s in free if not any(o[:3] < s[:3] and not apart(o[1:], s[1:]) for o in free)]
    return ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in sorted(base + chosen))


def written(rng, n):
    """Texts of candidates and look-alikes, run together or apart."""
    out = []
    for seed in range(n):
        parts = []
        for _, left, value, right, _ in pii.examples(int(rng.integers(1, 6)), seed=1000 + seed):
            parts.append(left + value + right)
        out.append(str(rng.choice(["", " ", "\n", "-", "."])).join(parts))
    return out


def test_spans_against_a_plain_version(spark):
    model = pii._trained()
    texts = written(np.random.default_rng(6), 400)
    texts += ["x" * 70 + " (at) mail (dot) org", "a@b." + ".".join(["c"] * 3000), "a (at) " + " dot ".join(["bb"] * 2000), "call 030 " + "-".join(["123"] * 3000), "iban DE12 " + "1234 " * 400, "ssn 123-45-6789", "password=" + "x1" * 4000, "", "é 😀 call (212) 555-1234 or mail jo.doe [at] web.de now"]
    found = {r["doc_id"]: r["spans"] for r in pii.digest(pii.detect(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model)).collect()}
    for k, text in enumerate(texts):
        assert found[k] == plain_spans(text, model), text[:200]
    assert "email:0:" in found[400] and "email:0:" in found[402]


def test_many_matches_in_linear_time(spark):
    from time import time

    took = []
    for n in (10_000, 40_000):
        text = " ".join(f"u{k}@h.de" for k in range(n))
        df = spark.createDataFrame([(1, text)], "doc_id long, text string")
        start = time()
        assert pii.digest(pii.detect(df)).first()["n_email"] == n
        took.append(time() - start)
    assert took[1] < 4 * took[0] + 6


def test_redact_keeps_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "mail a@b.de", "old", 5), (2, None, "old", None)], "doc_id long, text string, redacted string, `x.y` int")
    out = pii.redact(df)
    assert out.columns == ["doc_id", "text", "x.y", "redacted"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, "mail a@b.de", 5, "mail [email]"), (2, None, None, None)]


@pytest.mark.parametrize("n", [0, 1, 255, 256, 257, 70_000])
def test_running_totals(spark, n):
    own = [k * 7 % 13 for k in range(n)]
    rows = spark.createDataFrame([(own,)], "v array<int>")
    got = pii.with_running(pii.with_running(rows, "v", "sums", 0, lambda a, x: a + x), "v", "tops", -1, lambda a, x: F.greatest(a, x)).first()
    assert got["sums"] == np.cumsum(own).tolist() and got["tops"] == np.maximum.accumulate(np.array(own, int)).tolist()
