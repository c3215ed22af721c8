"""The search for similar sets, cell by cell, against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.llm import minhash, similar

JUDGE = similar.Judge(0.8)


def made(rows):
    """(packed MinHashes, sets) of rows of word hashes."""
    f = minhash.Fingerprinter()
    hashes = [f.shingles(r) for r in rows]
    return similar.as_words([f.packed(h) for h in hashes]), [np.unique((h >> np.uint64(16)).astype(np.uint32)) for h in hashes]


def words(rng, n):
    return rng.integers(1 << 63, size=n, dtype=np.uint64)


def jaccard(sets):
    return np.array([[len(np.intersect1d(x, y)) / len(np.union1d(x, y)) for y in sets] for x in sets])


def roots(n, links):
    label = list(range(n))
    for a, b in links:
        low, high = sorted((label[a], label[b]))
        label = [low if x == high else x for x in label]
    return label


def test_hub():
    """Copies that are both near a document under the similarity are linked in a cell of any size."""
    rng = np.random.default_rng(8)
    hub = words(rng, 500)
    y = np.append(hub[:410], words(rng, 90))
    z = y.copy()
    z[250] = 1
    own, sets = made([hub, y, z] + [np.append(hub[:410], words(rng, 90)) for _ in range(97)])
    a, b = similar.reach(own, np.arange(100), JUDGE, sets)
    assert {tuple(sorted(p)) for p in zip(a.tolist(), b.tolist())} == {(1, 2)}


@pytest.mark.parametrize("spread", [8, 14, 20])
def test_cell_is_exact(spread):
    """A large cell of near copies around the similarity, some of them already one part: its links give the exact groups."""
    rng = np.random.default_rng(spread)
    base, rows = words(rng, 200), []
    for _ in range(120):
        own = base.copy()
        for at in rng.choice(200, int(rng.integers(1, spread)), replace=False):
            own[at] = words(rng, 1)[0]
        rows.append(own)
    own, sets = made(rows)
    like = jaccard(sets)
    linked = [(a, b) for a in range(120) for b in range(a) if like[a, b] >= 0.8]
    part = np.arange(120)
    joined = linked[:: max(1, len(linked) // 10)][:10]
    part = np.array(roots(120, joined))
    a, b = similar.reach(own, part, JUDGE, sets)
    assert all(like[x, y] >= 0.8 and part[x] != part[y] for x, y in zip(a, b))
    assert len(a) < 120 and roots(120, [*joined, *zip(a.tolist(), b.tolist())]) == roots(120, linked)


def test_recall_at_the_threshold():
    """Of pairs 0.8 alike nearly all share a band, whatever the number of documents."""
    rng = np.random.default_rng(9)
    met = 0
    for _ in range(1000):
        own = words(rng, 904)
        f = minhash.Fingerprinter()
        x, y = (f.of(r).hex() for r in (own, np.append(own[:804], words(rng, 100))))  # 800 of 1000 shingles
        met += any(x[k : k + similar.BAND_BINS] == y[k : k + similar.BAND_BINS] for k in range(0, similar.BANDS * similar.BAND_BINS, similar.BAND_BINS))
    assert met >= 992  # 998.8 are expected


def test_cost_does_not_depend_on_the_number_of_documents(spark):
    """A document goes to as many cells in a table of any size: nothing in the plan is chosen by a count."""
    assert similar.BANDS * similar.BAND_BINS <= minhash.BINS
    for n in (10, 1000):
        rows = spark.range(n).select(F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("half")).select(F.concat("half", "half").alias("own"))
        assert rows.select(F.explode(similar.band_keys(range(similar.BANDS)))).count() == n * similar.BANDS
    assert similar.BAND_BINS * minhash.BITS >= 36  # unlike documents share one of 2^36 cells: among 10^10 some 0.15 others a cell


def test_blocks_of_a_hot_cell(spark, monkeypatch):
    """Every two rows of a hot cell meet in some block unless both are of its largest part, whose rows are repeated least."""
    monkeypatch.setattr(similar, "BLOCK_ROWS", 20)
    rows = [(1, k, 7 if k < 60 else 100 + k % 13, 100) for k in range(95)] + [(2, k, 5, 100) for k in range(80)]
    placed = similar.blocks(spark.createDataFrame(rows, "cell long, fp long, part long, n_bytes long")).collect()
    assert {r["cell"] for r in placed} == {1}  # the other is of one part
    at = {}
    for r in placed:
        at.setdefault(r["fp"], set()).add(r["block"])
    assert all(at[x] & at[y] for x in range(95) for y in range(60, 95) if x != y)
    assert max(len(at[x]) for x in range(60)) <= 4  # as many as the 35 others have blocks, not as the 60 have


def test_pieces_of_one_large_group(spark, monkeypatch):
    """Groups do not depend on how cells are dealt out."""
    rng = np.random.default_rng(12)
    base, texts = [f"w{x}" for x in rng.integers(10**6, size=150)], []
    for _ in range(200):
        own = list(base)
        for at in rng.choice(150, int(rng.integers(1, 12)), replace=False):
            own[at] = f"c{rng.integers(10**6)}"
        texts.append(" ".join(own))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    whole = sorted((r["doc_id"], r["first"]["doc_id"]) for r in similar.near_copies(docs).collect())
    monkeypatch.setattr(similar, "BLOCK_ROWS", 30)
    assert sorted((r["doc_id"], r["first"]["doc_id"]) for r in similar.near_copies(docs).collect()) == whole
    like = jaccard([np.unique([hash(tuple(t.split()[k : k + 5])) for k in range(146)]) for t in texts])
    label = roots(200, [(a, b) for a in range(200) for b in range(a) if like[a, b] >= 0.8])
    assert whole == [(k, label[k]) for k in range(200)]
