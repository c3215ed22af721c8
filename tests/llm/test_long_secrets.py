"""Secrets of any length are covered to their end."""

import random

from tracewell.llm import pii


def test_long_secrets(spark):
    rng = random.Random(3)
    code = lambda k: "".join(rng.choice("abcdef0123456789ABCXYZ_") for _ in range(k))
    values = [code(20), code(81), code(700), f"{code(36)}.{code(400)}.{code(43)}", code(342) + "==", code(30_000)]
    rows = [(k, f"some plain words token={v} and more words") for k, v in enumerate(values)]
    found = {r["doc_id"]: r["redacted"] for r in pii.redact(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {k: "some plain words [secret] and more words" for k in range(len(values))}
