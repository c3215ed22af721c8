"""The tokenizer's tables: what is met again and again is encoded once, whatever else comes; words of any shape are the library's."""

import random

import pyarrow as pa

from tracewell.llm import packing
from tracewell.llm.tokenize import BatchTokenizer


def test_common_words_stay_in_a_full_table(monkeypatch):
    rng = random.Random(4)
    common = [f"common{a}{b}" for a in "abcde" for b in "vwxyz"]
    t = BatchTokenizer("word_bpe_49k.json", 200)
    seen, joined = [], t._joined
    monkeypatch.setattr(t, "_joined", lambda words, glue: (seen.extend(words), joined(words, glue))[1])
    for _ in range(60):
        text = " ".join(common + ["".join(rng.choice("abcdefgh") for _ in range(12)) for _ in range(60)])
        assert t.ids([text])[0].tolist() == t.lib.encode(text, add_special_tokens=False).ids
        assert max(len(t.table.at), len(t.between_space.at)) <= 200
    assert sum(seen.count(w) for w in set(seen) if w.startswith("common")) <= 2 * len({w for w in seen if w.startswith("common")})


def test_words_of_any_shape():
    rng = random.Random(5)
    parts = ["it's", "'s", "a.b,c", "x1y22", "--", "É", "ß²", " ", "  ", "\t", "\r\n", "\n", "İ", "中", "word", "http://" + "a.b/" * 20, "q" * 60, "ā", "\x01", "\x0b", "\x85", " "]
    for size in (400_000, 30):
        t = BatchTokenizer("word_bpe_49k.json", size)
        for _ in range(40):
            texts = ["".join(rng.choice(parts) + rng.choice(["", " "]) for _ in range(rng.randrange(12))) for _ in range(9)]
            for text, ids in zip(texts, t.ids(texts), strict=True):
                assert ids.tolist() == t.lib.encode(text, add_special_tokens=False).ids, text


def test_packing_leaves_no_tables_in_workers(spark):
    """Workers stay beside those that run next and are used for other stages, so what each holds adds up."""
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{n}" for n in range(50))) for k in range(40)], "doc_id long, text string").repartition(4)
    assert packing.pack(docs).select("doc_id").distinct().count() == 40

    def held(batches):
        from tracewell.llm import tokenize

        for batch in batches:
            t = tokenize.tokenizer("word_bpe_49k.json")
            yield pa.RecordBatch.from_pydict({"n": [len(t.table.at) + len(t.between_space.at)]})

    assert {r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()} == {0}


def test_a_rested_tokenizer_learns_again():
    t = BatchTokenizer("word_bpe_49k.json", 50)
    texts = ["one two three don't", " ".join(f"w{n}" for n in range(70)), "one"]
    for _ in range(3):
        for text, ids in zip(texts, t.ids(texts), strict=True):
            assert ids.tolist() == t.lib.encode(text, add_special_tokens=False).ids
        t.rest()
        assert not t.table.at and not t.between_space.at and t.table.used == 0
