"""Groups of similar documents against brute force over shingle sets."""

import numpy as np

from tracewell.llm import similar, simhash

SCHEMA = "doc_id long, text string"


def jaccard(texts):
    """The similarities of all pairs of texts by their sets of five-word shingles."""
    number = {}
    held = np.zeros((len(texts), sum(len(t.split()) for t in texts)), np.float32)
    for k, t in enumerate(texts):
        w = t.split()
        for s in range(len(w) - 4):
            held[k, number.setdefault(tuple(w[s : s + 5]), len(number))] = 1
    held = held[:, : len(number)]
    inter, size = held @ held.T, held.sum(1)
    return inter / (size[:, None] + size[None, :] - inter)


def template_texts(rng, n, copies):
    """n documents about 0.65 alike, as they share a template, and copies of some with one or two words changed."""
    shared = [f"t{k}" for k in range(100)]
    rows = [shared + [f"w{x}" for x in rng.integers(1_000_000, size=24)] for _ in range(n)]
    for _ in range(copies):
        own = list(rows[rng.integers(n)])
        for at in rng.choice(len(own), int(rng.integers(1, 3)), replace=False):
            own[at] = f"c{rng.integers(1_000_000)}"
        rows.append(own)
    return [" ".join(r) for r in rows]


def test_template_group(spark):
    """A large group of documents under the similarity hides none of the copies among them."""
    texts = template_texts(np.random.default_rng(5), 1500, 120)
    like = jaccard(texts)
    np.fill_diagonal(like, 0)
    assert 0.6 < np.median(like) < 0.7
    kept = {r["doc_id"] for r in simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), SCHEMA), 0.8).collect()}
    earlier = np.tril(like)
    copies = np.flatnonzero((earlier >= 0.9).any(1))
    assert len(copies) > 50 and not kept & set(copies.tolist())
    alone = np.flatnonzero(like.max(1) < 0.7)
    assert set(alone.tolist()) <= kept


def test_equal_fingerprints(spark):
    """Texts whose SimHash one repeated phrase sets alone are told apart by their words, and their copies are found."""
    rng = np.random.default_rng(6)
    own = [[f"w{x}" for x in rng.integers(1_000_000, size=300)] for _ in range(3)]
    near = own[2][:150] + ["changed"] + own[2][151:]
    texts = [" ".join(o) + " 0" * 400 for o in (*own, near, own[1])]
    assert len({simhash.fingerprint(t, 5) for t in texts}) == 1
    found = simhash.keep_one(spark.createDataFrame(list(enumerate(texts)), SCHEMA), 0.8).collect()
    assert sorted(r["doc_id"] for r in found) == [0, 1, 2]


def test_simhash_links(spark):
    """Near copies come from SimHashes, equal or a few bits apart, confirmed on sets: also a pair that shares no MinHash band."""
    padding = ["0"] * 500  # sets all bits of the SimHash
    own = padding + [f"a650x{k}" for k in range(404)]
    alike = own[:860] + [f"b650x{k}" for k in range(44)]
    unlike = padding + [f"c{k}" for k in range(404)]
    plain = [f"d{k}" for k in range(3000)]
    changed = [*plain[:1500], "changed", *plain[1501:]]
    texts = [" ".join(t) for t in (own, alike, unlike, plain, changed)]
    assert 0.8 < jaccard(texts[:2])[0, 1] < 0.81
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    rows = similar.with_sets(docs).cache()
    mark = {r["doc_id"]: r for r in rows.collect()}
    x, y = (mark[k]["own"].hex()[: similar.BANDS * similar.BAND_BINS] for k in (0, 1))
    assert not any(x[k : k + similar.BAND_BINS] == y[k : k + similar.BAND_BINS] for k in range(0, len(x), similar.BAND_BINS))
    apart = lambda a, b: bin((mark[a]["simhash"] ^ mark[b]["simhash"]) & (1 << 64) - 1).count("1")
    assert apart(0, 1) == apart(0, 2) == 0 and 0 < apart(3, 4) <= 4
    number = {mark[k]["fp"]: k for k in mark}
    groups = simhash.shared_groups(rows)
    held = {}
    for r in groups.collect():
        held.setdefault(r["cell"], set()).add(number[r["fp"]])
    assert sorted(map(sorted, held.values())) == [[0, 1, 2], [3, 4]]
    assert (3, 4) in {tuple(sorted((number[r["a"]], number[r["b"]]))) for r in simhash.confirmed_links(rows, groups, similar.Judge(0.8)).collect()} <= {(0, 1), (3, 4)}
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs, 0.8).collect()) == [0, 2, 3]
