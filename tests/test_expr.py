"""Expression builders against plain Python, on text that regular expressions stumble over."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tracewell.functions import fixed_values as V
from tracewell.functions.expr import found, noisy_or, py_round, spans, window
from tracewell.functions.literals import FOLDING, gate, passes, required
from tracewell.operators import scan

PIECES = ["CUDA", "cuda ", "torch.cuda", " A100", "h100\n", "TPU v4", "😀", "é", "É", "\r", "　", "昇腾", "海光 DCU", "ascend 910B", "Kunlun P800 chip", "MUSA university", "hip-hop", "hip ", "ſtrong", "K100 AI", "mlx training", "g4ad.xlarge", "p3.2xlarge", "maca sequence", "maca", ".", "|", " trained on ", " not ", "dtk sdk", "C550 MetaX", "\x85", "flash_attn"]


def texts(n=60, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) + rng.choice(["", " ", "\n"]) for _ in range(rng.randint(0, 40))) for _ in range(n)] + ["", "cuda", "CUDA" * 300]


def test_all_signal_spans(spark):
    own = texts()
    df = spark.createDataFrame([(k, t) for k, t in enumerate(own)], "id int, text string").repartition(4)
    rows = {r["id"]: r["h"] for r in df.select("id", scan.signal_hits("text").alias("h")).collect()}
    for k, text in enumerate(own):
        want = [(v, p, m.start(), m.end()) for v, (_, levels) in enumerate(V.SIGNALS.items()) for p, x in enumerate(x for level in V.LEVEL_WEIGHTS for x in levels[level]) for m in re.finditer(x, text, re.IGNORECASE)]
        assert sorted((h["vendor_pos"], h["pattern_pos"], h["start"], h["end"]) for h in rows[k]) == sorted(want), text[:80]


@pytest.mark.parametrize("pattern, flags, most", [("cuda", "iUd", None), ("(?:a|b)+", "Ud", 2), ("\\bé\\w*", "iUd", None), (".+", "Ud", None), ("^\\S", "Udm", None)])
def test_spans(spark, pattern, flags, most):
    own = texts(30, 4)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(own)], "id int, text string")
    rows = {r["id"]: r["s"] for r in df.select("id", spans(F.col("text"), pattern, most, flags).alias("s")).collect()}
    for k, text in enumerate(own):
        want = [m.span() for m in re.finditer(pattern, text, (re.IGNORECASE if "i" in flags else 0) | (re.MULTILINE if "m" in flags else 0))][:most]
        assert [tuple(s) for s in rows[k]] == want


CHECKS = ("EXPLICIT_TRAINING", "HARDWARE_LITERAL", "HARDWARE_DURATION", "CONDITIONAL", "LAUNCHER", "NEGATION", "COMPARISON", "EXPORT", "CARD_TRAINING", "RUNTIME_NOISE", "SHORT_TRAINING", "VENDOR_OR_TRAINING", "ANSWER_CONDITIONAL", "INTRO", "OUR_PAPER", "THIRD_PARTY")


def test_long_patterns(spark):
    rng = random.Random(5)
    bits = ["we trained", " on ", "8 A100 GPUs", "for 20 days", "can be ", "fine-tuned", "torchrun --nproc_per_node", "\n", "inference with", "compared to", "not", "our paper", "based on", "2.788M H800 GPU hours", "国产算力", "训练：", "Ascend 910B", "would", ".", "model.cuda()", " ", "Repository:", "hours of", "compute", "TensorRT-LLM", "é"]
    own = ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 14))) for _ in range(250)]
    df = spark.createDataFrame([(t,) for t in own], "text string").coalesce(1)
    rows = df.select("text", *(found("text", getattr(V, n)).alias(n) for n in CHECKS)).collect()
    for r in rows:
        for n in CHECKS:
            assert r[n] == bool(re.search(getattr(V, n), r["text"], re.IGNORECASE)), (n, r["text"])


def test_required_literals():
    for levels in V.SIGNALS.values():
        for patterns in levels.values():
            for p in patterns:
                own = required(p)
                for text in texts(40, 6):
                    if own and not any(c in text for c in FOLDING) and re.search(p, text, re.IGNORECASE):
                        assert any(x in text.lower() for x in own), (p, text)


def test_gates():
    """No match without the gate's literals."""
    for levels in V.SIGNALS.values():
        for patterns in levels.values():
            for p in patterns:
                own = gate(p)
                for text in texts(40, 7):
                    if not any(c in text for c in FOLDING) and re.search(p, text, re.IGNORECASE):
                        assert passes(own, text.lower()), (p, text)


def test_rounding(spark):
    rng = random.Random(1)
    values = [k / 200 for k in range(400)] + [rng.random() * 40 for _ in range(400)] + [0.125, 2.675, 1.005, 0.5, 1234.565]
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", py_round(F.col("v"), 2).alias("two"), py_round(F.col("v"), 1).alias("one"), py_round(F.col("v"), 0).alias("none"))
    for r in df.collect():
        if r["v"] < 1000:
            assert (r["two"], r["one"], r["none"]) == (round(r["v"], 2), round(r["v"], 1), float(round(r["v"]))), r["v"]


def test_noisy_or_and_windows(spark):
    r = spark.range(1).select(noisy_or(F.array(F.lit(0.6), F.lit(None).cast("double"), F.lit(0.6), F.lit(-1.0))).alias("n"), window(F.lit("😀bcdef"), F.lit(-3), F.lit(2)).alias("a"), window(F.lit("abc"), F.lit(2), F.lit(90)).alias("b"), window(F.lit("abc"), F.lit(2), F.lit(1)).alias("c")).first()
    assert abs(r["n"] - 0.84) < 1e-12 and (r["a"], r["b"], r["c"]) == ("😀b", "c", "")


def test_first_class_loses_no_match(spark):
    """Patterns with the class of first characters find what they find without it, in any case, letters that fold included."""
    import random

    from pyspark.sql import functions as F

    from tracewell.functions import fixed_values as V
    from tracewell.functions.expr import rx
    from tracewell.functions.literals import first_class

    assert first_class("\\bA100\\b") == "[Aa]" and first_class("(?:NVIDIA\\s+)?k80|x?") is None and first_class("\\d+ GPUs") is None
    assert first_class("(?:si|K)x") == "[KSks\\x{17f}\\x{212a}]" and first_class("a?b*[cd]") == "[ABCDabcd]" and first_class("x\\z") is None
    rng = random.Random(8)
    patterns = [p for own in V.SIGNALS.values() for level in own.values() for p in level] + [V.NEGATION, V.COMPARISON, V.EXPORT, V.HARDWARE_LITERAL, V.LAUNCHER, V.CONDITIONAL, V.RUNTIME_NOISE]
    words = [w for p in patterns for w in __import__("re").findall(r"[A-Za-z0-9.]{2,}", p)]
    fold = {"k": "K", "s": "ſ", "i": "ı", "I": "İ"}
    texts = []
    for _ in range(300):
        t = " ".join(rng.choice(words) for _ in range(12))
        texts.append("".join(fold.get(c, c.upper() if rng.random() < 0.5 else c) if rng.random() < 0.3 else c for c in t))
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for p in patterns[::6] + patterns[-7:]:
        own, plain = (F.regexp_extract_all("t", F.lit(x), F.lit(0)) for x in (rx(p), f"(?iUd){p}"))
        assert df.filter(~own.eqNullSafe(plain)).count() == 0, p


def test_spans_of_texts_with_marks(spark):
    """Characters that stand for marks may be in the text, once or beside a match; digits of any script begin a match."""
    import re

    from pyspark.sql import functions as F

    from tracewell.functions import fixed_values as V
    from tracewell.functions.expr import MARK, OTHER_MARK, rx

    texts = [f"{MARK}we trained{MARK}on it{OTHER_MARK}", f"{MARK}{MARK}", "", None, f"a{MARK}we trained x we train", "need ٣٢ GPU hours, 12.5K npu  hour", "we train" * 40, "é\U0001f600 训练: 国产算力"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    for most in (None, 2):
        got = {r["id"]: [(s["start"], s["end"]) for s in r["s"]] for r in df.select("id", spans(F.col("t"), V.EXPLICIT_TRAINING, most).alias("s")).collect()}
        assert got == {k: [m.span() for m in re.finditer(V.EXPLICIT_TRAINING, t or "", re.I)][:most] for k, t in enumerate(texts)}
    for p in (V.EXPLICIT_TRAINING, V.HARDWARE_DURATION, V.SHORT_TRAINING):
        assert rx(p).startswith("(?=[") and "\\p{Nd}" in rx(p)[: rx(p).index("]")]
        own, plain = (F.regexp_extract_all("t", F.lit(x), F.lit(0)) for x in (rx(p), f"(?iUd){p}"))
        assert df.filter(~own.eqNullSafe(plain)).count() == 0, p


def test_letters_that_fold_do_not_bypass_the_gates(spark):
    """A text with a letter that folds, or a sharp s, is searched for the patterns whose literals it has, and loses none of their matches."""
    from pyspark.sql import functions as F

    from tracewell.functions import fixed_values as V
    from tracewell.functions.expr import may_match, rx
    from tracewell.operators import scan

    texts = ["Die Straße ist groß, GROẞ und weit", "ınstınct İNSTİNCT Instinct", "Kunlunxin KUNLUN P800, baidu Kunlun", "ſnapdragon, tenſorrt; openvıno straße", "ſ ı İ K ß ẞ", "trained on Aı 1K", "fıne-tuned on x; traİned on y", None]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "id int, text string")
    told = {r["id"]: (r["may"], [(h["vendor"], h["pattern_pos"], h["start"], h["end"]) for h in r["h"] or ()]) for r in df.select("id", scan.may_hit("text").alias("may"), scan.signal_hits("text").alias("h")).collect()}
    rules = {(v, k): p for v, own in V.SIGNALS.items() for k, p in enumerate(p for level in V.LEVEL_WEIGHTS for p in own.get(level, ()))}
    n = df.select("id", F.array(*(F.size(F.regexp_extract_all("text", F.lit(rx(p)), F.lit(0))) for p in rules.values())).alias("n")).collect()
    for r in n:
        each = {}
        for v, k, *_ in told[r["id"]][1]:
            each[v, k] = each.get((v, k), 0) + 1
        assert each == {rule: m for rule, m in zip(rules, r["n"]) if (m or 0) > 0}, texts[r["id"]]
        assert not each or told[r["id"]][0]
    assert told[1][1] and told[2][1] and told[3][1]
    assert told[0][0] is False and told[4][0] is False
    assert [r[0] for r in df.select(may_match(F.col("text"), V.EXPLICIT_TRAINING)).collect()][:1] == [False]
    for p in (V.EXPLICIT_TRAINING, V.LAUNCHER):
        own = F.size(spans(F.col("text"), p)) == F.size(F.regexp_extract_all("text", F.lit(f"(?iUd){p}"), F.lit(0)))
        assert df.filter("text IS NOT NULL").filter(~own).count() == 0
