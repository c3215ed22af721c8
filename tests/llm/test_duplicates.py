"""SimHash links and MinHash fingerprints against brute force."""

import hashlib

import numpy as np
import pytest
import xxhash

from tracewell.llm import components, minhash, simhash

SCHEMA = "doc_id long, text string, fp string, component_id string"  # clashing names on purpose


def words(rng, n, vocabulary=400):
    return [f"w{rng.integers(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def docs():
    rng = np.random.default_rng(1)
    out = []
    for base in range(30):
        own = words(rng, int(rng.integers(5, 160)))
        for _ in range(int(rng.integers(1, 9))):
            edited = list(own)
            for _ in range(int(rng.integers(0, 4))):
                edited[rng.integers(len(edited))] = f"e{rng.integers(99)}"
            out.append(" ".join(edited))
    out += ["", None, " \t\n", "One", "one", "Two words", "x" * 5000, "a b c d", "É É É É", "É  é\x0bÉ É"] + [out[0]] * 40
    return [(k * 3 + 7, t, "x", "y") for k, t in enumerate(out)]


def naive_fingerprint(text, width=4):
    own = (text or "").encode()
    own = bytes(c + 32 if 65 <= c <= 90 else c for c in own).split()
    if not own:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(own[k : k + width]), 42) for k in range(max(1, len(own) - width + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def naive_components(prints, radius):
    parent = list(range(len(prints)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= radius:
                parent[find(a)] = find(b)
    return [find(k) for k in range(len(prints))]


def test_near_duplicates(spark, docs):
    found = {r["doc_id"]: r for r in simhash.near_duplicates(spark.createDataFrame(docs, SCHEMA)).collect()}
    prints = [naive_fingerprint(t) for _, t, *_ in docs]
    roots = naive_components(prints, 4)
    least = {}
    for (doc, *_), root in zip(docs, roots):
        least[root] = min(doc, least.get(root, doc))
    for (doc, *_), fp, root in zip(docs, prints, roots):
        assert found[doc]["fingerprint"] == f"{fp:016x}"
        assert found[doc]["component_id"] == least[root]


def test_nulls_repeats_empty(spark):
    rows = [(None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (9, None), (None, "only nulls here now")]
    found = simhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == 5
    assert {r["component_id"] for r in found if r["fingerprint"] == f"{naive_fingerprint(rows[0][1]):016x}"} == {5}
    assert [r["component_id"] for r in found if r["fingerprint"] == f"{naive_fingerprint(rows[4][1]):016x}"] == [None]
    assert simhash.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("blocks", [5, 6, 7, 8])
def test_cells_lose_no_link(blocks):
    masks = simhash.cell_masks(blocks, 4)
    rng = np.random.default_rng(2)
    for _ in range(300):
        bits = sum(1 << int(b) for b in rng.permutation(64)[: rng.integers(0, 5)])
        assert any(bits & m == 0 for m in masks)


@pytest.mark.parametrize("size", [3, 40, 400])
def test_pairs_in_cells(size):
    rng = np.random.default_rng(size)
    centers = rng.integers(0, 1 << 63, 5, dtype=np.uint64)
    fp = np.unique([int(centers[rng.integers(5)]) ^ sum(1 << int(b) for b in rng.permutation(64)[: rng.integers(0, 6)]) for _ in range(size)]).astype(np.uint64)
    fp = fp[np.argsort(simhash.pivot_table(fp)[:, 0], kind="stable")]
    tally = simhash.Tally()
    a, b = simhash.pairs_in_cells(np.zeros(len(fp), np.int64), fp, simhash.pivot_table(fp), 4, tally=tally)
    assert all(bin(int(fp[x]) ^ int(fp[y])).count("1") <= 4 for x, y in zip(a, b))
    assert tally.links == len(a) and tally.discarded + tally.verified == tally.window
    parent = list(range(len(fp)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for x, y in zip(a.tolist(), b.tolist()):
        parent[find(x)] = find(y)
    want = naive_components([int(x) for x in fp], 4)
    pairs = [(i, j) for i in range(len(fp)) for j in range(i)]
    assert all((find(i) == find(j)) == (want[i] == want[j]) for i, j in pairs)


@pytest.mark.parametrize("size", [40, 2000])
def test_pivots_discard(size):
    """Of unlike fingerprints the window leaves some six in ten, the other pivots discard all but a few, and none that is a link."""
    rng = np.random.default_rng(size)
    fp = rng.integers(0, 1 << 63, size, dtype=np.uint64)
    fp[1::10] = fp[0::10] ^ np.uint64(0b1011)
    fp = fp[np.argsort(simhash.pivot_table(fp)[:, 0], kind="stable")]
    tally, every = simhash.Tally(), size * (size - 1) // 2
    a, _ = simhash.pairs_in_cells(np.zeros(size, np.int64), fp, simhash.pivot_table(fp), 4, tally=tally)
    print(f"{every} pairs: {tally.window} in the window, {tally.discarded} discarded by pivots, {tally.verified} verified, {tally.links} links")
    assert len(a) == tally.links >= size // 10
    assert tally.window < 0.75 * every and tally.verified <= tally.links + 1e-4 * every + 1


def test_pivot_columns(spark):
    rows = spark.createDataFrame([(5,), (-1,), (1 << 62,)], "fp long")
    for r in simhash.with_table(rows).collect():
        assert r["pivots"] == simhash.pivot_table(np.array([r["fp"]], np.int64).view(np.uint64))[0].tolist()


def test_hot_cells_are_dealt_out(spark, docs, monkeypatch):
    monkeypatch.setattr(simhash, "CELL_ROWS", 7)
    monkeypatch.setattr(simhash, "blocks_for", lambda n, radius: 5)
    df = spark.createDataFrame(docs, SCHEMA)
    few = {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    monkeypatch.undo()
    assert few == {(r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}


def test_components_of_a_chain(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 101), (200, 205), (205, 203)]
    found = {r["node"]: r["root"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(found[k] == 0 for k in range(61)) and found[101] == 100 and found[203] == 200 and found[205] == 200


def test_keep_one(spark):
    rng = np.random.default_rng(3)
    own = words(rng, 300, 5000)
    near = list(own)
    near[150] = "changed"
    rows = [(4, " ".join(own), "s"), (2, " ".join(near), "s"), (9, " ".join(words(rng, 300, 5000)), "s"), (2, " ".join(near), "s"), (None, " ".join(own), "s"), (11, " ".join(own), "s")]
    found = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["2", "9", "None"]
    assert found[0].asDict().keys() == {"doc_id", "text", "source"}


@pytest.mark.parametrize("turn", [0, 1, 2])
def test_keep_one_of_repeated_ids(spark, turn):
    """Of rows that repeat an id with other texts each is judged by its own text, in any order; clashing names do no harm."""
    rng = np.random.default_rng(4)
    one, two = (" ".join(words(rng, 200, 5000)) for _ in range(2))
    rows = [(5, one, 1), (2, two, 2), (5, two, 3)]
    rows = rows[turn:] + rows[:turn]
    found = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp long").selectExpr("doc_id", "text", "fp", "fp AS first", "fp AS `own.x`")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == [(2, two), (5, one)]
    assert [f for f in found[0].__fields__] == ["doc_id", "text", "fp", "first", "own.x"]


def test_keep_one_of_nothing(spark):
    assert simhash.keep_one(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    rows = [(3, None), (1, " "), (2, ""), (None, None), (9, "one")]
    found = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(str(r["doc_id"]) for r in found) == ["1", "9", "None"]


def test_minhash_estimates():
    rng = np.random.default_rng(4)
    made = minhash.Fingerprinter()
    errors = []
    for part in (0, 0.2, 0.5, 0.8, 0.95, 1):
        for _ in range(8):
            own = words(rng, 400, 100_000)
            other = own[: int(400 * part)] + words(rng, 400 - int(400 * part), 100_000)
            sets = [{tuple(w[k : k + 5]) for k in range(396)} for w in (own, other)]
            true = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
            errors.append(minhash.likeness(made.of(made.words(" ".join(own))), made.of(made.words(" ".join(other)))) - true)
    assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.12
    short = [made.of(made.words(w)) for w in ("alpha", "beta", "gamma delta", "alpha")]
    assert minhash.likeness(short[0], short[3]) == 1 and minhash.likeness(short[0], short[1]) < 0.1 and minhash.likeness(short[0], short[2]) < 0.1
    assert minhash.likeness(None, None) == 1 and minhash.likeness(None, short[0]) == 0
    assert minhash.undigest(minhash.digest(short[0])) == short[0] and minhash.undigest(minhash.digest(None)) is None


@pytest.mark.parametrize("rows", [
    [(k * 7 % 31, f"text number {k} " * (k + 1)) for k in range(31)] + [(3, None), (3, "zz"), (None, "first of all"), (None, None), (40, "é😀" * 9)],
    [(1, "alone here")], [(2, None)], [],
])
def test_with_edits(spark, rows):
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, next int")
    found = sorted(minhash.with_edits(df).collect(), key=str)
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want = []
    for k, (doc, text) in enumerate(ordered):
        text, after = text or "", (ordered[(k + 1) % len(ordered)][1] or "")
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        want.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in found), key=str) == sorted(want, key=str)
    by_text = {}
    for r in found:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        by_text.setdefault(r["n_chars"], set()).add(r["fingerprint"])


def test_local_roots():
    rng = np.random.default_rng(9)
    for n in (1, 5, 60, 300):
        u, v = rng.integers(-200, 200, (2, n))
        u, v = u[u != v], v[u != v]
        node, root = components.local_roots(u, v) if len(u) else ([], [])
        own = sorted({*u.tolist(), *v.tolist()})
        parent = {x: x for x in own}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in zip(u.tolist(), v.tolist()):
            low, high = sorted((find(a), find(b)))
            parent[high] = low
        assert dict(zip(list(node), list(root))) == {x: find(x) for x in own if find(x) != x}
