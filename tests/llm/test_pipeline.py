"""Each stage of the pipeline against a brute-force version over the stage's own input."""

import os
import re

import numpy as np
import pytest
from test_text import brute_hits

import corpus_pipeline
from tracewell.llm.tokenize import BatchTokenizer

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    rows = [tuple(r) for r in docs.collect()]
    long = [r for r in rows if 150 < len(r[1].split()) < 2000][:12]
    item = max((r["text"] for r in bench.collect()), key=len)
    new = []
    for k, r in enumerate(long):
        w = r[1].split(" ")
        w[len(w) // 2] = "changed"
        new.append((10_000 + k, " ".join(w), r[2], r[3], 0))
    new += [(20_000, "12 34 -- !!", "en", "s", 11), (20_001, None, None, None, None), (20_002, "", "en", "s", 0)]
    new += [(20_010 + k, f"Footer of all our pages. \nown words number {k} in this text here", "en", f"site{k}", 0) for k in range(14)]
    new += [(20_100, f"{long[0][1][:300]} {item} the end", "en", "src1", 0)]
    spark.createDataFrame(rows + new, docs.schema).repartition(3).write.parquet(f"{folder}/documents.parquet")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, folder)
        after.write.parquet(f"{folder}/{name}")
        after = spark.read.parquet(f"{folder}/{name}")
        out.append((name, docs.collect(), after.collect(), docs.columns, after.columns))
        docs = after
    return folder, [tuple(r) for r in bench.select("item_id", "text").collect()], out


def test_columns_stay(stages):
    for name, before, after, columns, new in stages[2][:-1]:
        assert new == columns and len(after) <= len(before), name


def test_language(stages):
    _, before, after, *_ = stages[2][0]
    gone = {r["doc_id"] for r in before} - {r["doc_id"] for r in after}
    assert {20_000, 20_001, 20_002} <= gone
    assert all(not re.search("[a-z]{3}", r["text"] or "", re.I) for r in before if r["doc_id"] in gone)


def test_lines(stages):
    _, before, after, *_ = stages[2][1]
    key = lambda x: re.sub("\r$", "", x).strip(" ")
    sites, first = {}, {}
    for r in before:
        for x in map(key, r["text"].split("\n")):
            sites.setdefault(x, set()).add(r["source"])
            first[x] = min(r["doc_id"], first.get(x, r["doc_id"]))
    want = {}
    for r in before:
        kept = "\n".join(x for x in r["text"].split("\n") if not (key(x) and len(sites[key(x)]) >= 10 and first[key(x)] != r["doc_id"]))
        if kept == r["text"] or kept.strip():
            want[r["doc_id"]] = (kept, r["n_chars"] if kept == r["text"] else len(kept))
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in after} == want
    assert sum("Footer" in r["text"] for r in after) == 1


def test_near_copies(stages):
    """Exactly the documents with a smaller one in their group go; a group is linked by shingle sets 0.8 alike."""
    _, before, after, *_ = stages[2][2]
    sets = {}
    for r in before:
        w = r["text"].encode().lower().split()
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    ids, group = sorted(sets), {}
    for i, a in enumerate(ids):
        near = {group[b] for b in ids[:i] if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
        mine = min(near, default=a)
        group = {d: mine if g in near else g for d, g in group.items()} | {a: mine}
    assert {r["doc_id"] for r in after} == set(group.values())
    assert any(10_000 <= d < 20_000 and group[d] != d for d in ids)


def test_benchmark_passages(stages):
    _, items, out = stages
    _, before, after, *_ = out[3]
    bad = {h[0] for h in brute_hits([(r["doc_id"], r["text"]) for r in before], items) if h[-1]}
    assert 20_100 in bad
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before} - bad


def test_packing(stages):
    _, before, after, *_ = stages[2][4]
    t = BatchTokenizer("word_bpe_49k.json")
    whole = {}
    for r in after:
        whole.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], f"<u{r['bits'] // 8}").tolist()))
    assert {k: [i for _, ids in sorted(v) for i in ids] for k, v in whole.items()} == {r["doc_id"]: t.lib.encode(r["text"], add_special_tokens=False).ids + [1] for r in before}


def test_run_is_its_stages(spark, stages):
    folder, _, out = stages
    key = lambda rows: sorted((r["doc_id"], r["start"], bytes(r["ids"])) for r in rows)
    assert key(corpus_pipeline.run(spark, folder).collect()) == key(out[-1][2])
    assert os.path.isdir(folder)
