"""Tokenization, packing and token files: exact round trips."""

import zlib

import numpy as np
import pytest

from tracewell.llm import packing, tokenbin
from tracewell.llm.tokenize import BatchTokenizer

TEXTS = [
    "", "  a  b\n\n c", "İstanbul ’s it's IT'S DON'T x \x1f y", "a" * 5000, "<|endoftext|> x", "é́é ñ½²", "12345 3.14 --==", "\t\r\n", " \n x", "The the THE", "中文 text 😀",
    "x y", "word " * 3000, "tail ", " 's", "'", "a'b'll c", "\n\n\nword\n.", None,
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
@pytest.mark.parametrize("size", [400_000, 40])
def test_same_as_the_library(name, size):
    t = BatchTokenizer(name, size)
    texts = [x or "" for x in TEXTS]
    for part in (texts, texts[::-1], texts):
        for text, ids in zip(part, t.ids(part)):
            assert ids.tolist() == t.lib.encode(text, add_special_tokens=False).ids, text[:40]


def brute_ids(t, text, end):
    return t.lib.encode(text or "", add_special_tokens=False).ids + [end]


ROWS = [(k, t, 7) for k, t in enumerate(TEXTS)] + [(3, "again"), (None, "no id")]
ROWS = [(*r, 7)[:3] for r in ROWS]


def test_pack(spark, monkeypatch):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, start int").repartition(3)
    for chunk in (16_384, 4):
        monkeypatch.setattr(packing, "CHUNK_PIECES", chunk)
        found = packing.pack(df, "word_bpe_49k.json", 1, 64).collect()
        t = BatchTokenizer("word_bpe_49k.json")
        assert sum(r["length"] for r in found) == sum(len(brute_ids(t, x, 1)) for _, x, _ in ROWS)
        whole = {}
        for r in found:
            assert r["length"] == len(r["ids"]) * 8 // r["bits"] and 0 < r["length"] <= 64
            whole.setdefault((r["doc_id"], r["doc_tokens"]), []).append((r["start"], np.frombuffer(r["ids"], f"<u{r['bits'] // 8}").tolist()))
        joined = sorted(((k[0], [i for _, ids in sorted(v) for i in ids]) for k, v in whole.items()), key=str)
        assert joined == sorted(((d, brute_ids(t, x, 1)) for d, x, _ in ROWS), key=str)
        sequences = {}
        for r in found:
            sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        for own in sequences.values():
            at = 0
            for offset, length in sorted(own):
                assert offset == at
                at += length
            assert at <= 64


def test_little_padding(spark):
    rng = np.random.default_rng(0)
    rows = [(k, "word " * int(n)) for k, n in enumerate(rng.integers(1, 900, 2000))]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), window=256).groupBy("sequence_id").sum("length").collect()
    assert len(found) * 256 / sum(r[1] for r in found) < 1.02


def test_best_fit_decreasing():
    rng = np.random.default_rng(5)
    lengths = rng.integers(1, 101, 300).tolist()
    room, want = [], []
    for k in sorted(range(300), key=lambda k: -lengths[k]):
        fits = [j for j, r in enumerate(room) if r >= lengths[k]]
        if fits:
            j = min(fits, key=lambda j: room[j])
            room[j] -= lengths[k]
        else:
            room.append(100 - lengths[k])
        want.append(lengths[k])
    own = packing.best_fit_decreasing(lengths, 100)
    assert sorted(k for s in own for k in s) == list(range(300))
    assert sorted(100 - sum(lengths[k] for k in s) for s in own) == sorted(room)


def test_digest(spark):
    t = BatchTokenizer("word_bpe_49k.json")
    r = packing.digest(packing.pack(spark.createDataFrame([(1, "some words here")], "doc_id long, text string"))).first()
    assert r["ids_crc32"] == zlib.crc32(np.array(brute_ids(t, "some words here", 1), "<u4").tobytes())
    assert packing.digest(packing.pack(spark.createDataFrame([], "doc_id long, text string"))).count() == 0


def test_round_trip(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, start int").repartition(3)
    uri = f"file://{tmp_path}/tokens"
    index = tokenbin.write(df, uri)
    found = sorted(tokenbin.documents(spark, uri).collect(), key=lambda r: r["start"])
    t = BatchTokenizer("byte_bpe_50k.json")
    at = 0
    for r, (doc, text, _) in zip(found, sorted(ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")), strict=True):
        ids = brute_ids(t, text, 2)
        assert (r["doc_id"], r["start"], r["n_tokens"], r["ids_crc32"]) == (doc, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert index["parts"][-1]["base"] + index["parts"][-1]["n_ids"] == at
    assert isinstance(tokenbin.mapped(uri, f"{index['parts'][0]['name']}.ids", "<u2"), np.memmap)
    assert tokenbin.round_trip(spark.createDataFrame([], "doc_id long, text string")).count() == 0
