"""Near copies: documents whose sets of five-word shingles are similar, found without loss at a cost a document that does not
depend on how many there are.

Meeting.  Every document has its one-permutation MinHash and its set of shingle hashes.  Each of ``BANDS`` bands of ``BAND_BINS``
bins is a *cell family*, and a pair meets in every band that it agrees on.  A pair at similarity 0.8 agrees on a bin with
probability 0.8125, on a band with 0.154, and on none of 40 with 0.0012; a pair at 0.85 with 0.00001.  A band has 36 bits, so
that unlike documents hardly meet even among ten thousand millions.

Judging.  With 512 bins the estimated similarity has a standard error of 0.019 at 0.8.  A pair whose estimate is ``SURE`` above
the similarity asked for is a link, one that is ``DOUBT`` below is none, and between them the shingle sets decide exactly
(hashes of 32 bits: of two sets of 20,000 shingles less than one agrees by chance).

Rounds.  Links that are known already (``simhash.keep_one`` brings those in groups of SimHashes, confirmed on the sets) make the first
*parts*.  A first round looks for sure links only, in a few bands, and joins parts.  The second looks in all bands, and in the
groups that came with the known links, for links between different parts, exactly, so that a large group of near copies is
found once and not once a band.

Cells.  Small cells give all their pairs of different parts.  In a larger one a document (with all of its part) leaves the set of
the unreached only when its sets are found to be similar to one reached, so no document under the similarity hides others, and
a cell gives a forest of links and not the square.  Cells above ``BLOCK_ROWS`` rows or ``BLOCK_BYTES`` are dealt out as blocks: in
the first round by chance, another way in each band, each row once; in the second the rows of the largest part meet all
others but not one another, so that they are repeated only as often as the others need blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import minhash
from tracewell.llm.common import majority, stored
from tracewell.llm.components import components, named_groups

#: Bands, bins of a band, and bands of the first round.
BANDS, BAND_BINS, FIRST_BANDS = 40, 9, 8
#: How far above the similarity an estimate is sure, and how far below it is in doubt: a bit over four standard errors.
SURE, DOUBT = 0.08, 0.08
#: Cells up to this size give their pairs one by one.
SMALL_CELL = 48
#: Rows and bytes of a large cell that one task compares.
BLOCK_ROWS, BLOCK_BYTES = 16_384, 64 << 20


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def with_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp, own, simhash, shingles): the packed MinHash (null without words), a 64-bit hash of it, the SimHash of
    the shingles, repeats included, as a signed long, and the ascending 32-bit hashes of their set."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = minhash.fingerprinter()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, own, marks, sets = batch.slice(first, 256), [], [], []
                for text in part.column(2):
                    hashes = made.shingles(made.words(text.as_py()))
                    own.append(made.packed(hashes))
                    marks.append(majority(hashes))
                    sets.append(np.unique((hashes >> np.uint64(16)).astype(np.uint32)).tobytes())
                marks = np.array(marks, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(own, pa.binary()), pa.array(marks), pa.array(sets, pa.binary())], ["doc_id", "text_hash", "own", "simhash", "shingles"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    sets = rows.mapInArrow(compute, "doc_id long, text_hash long, own binary, simhash long, shingles binary")
    return sets.select("doc_id", "text_hash", F.xxhash64("own").alias("fp"), "own", "simhash", "shingles")


def sets_of(prints: DataFrame, needed: DataFrame) -> DataFrame:
    """(fp, shingles), a row each of needed (fp). One row a fingerprint before the join, so that many copies of one do not meet in a task."""
    return prints.groupBy("fp").agg(F.first("shingles").alias("shingles")).join(needed, "fp", "left_semi")


def band_keys(bands: range) -> Column:
    """The cells of a row with the column own."""
    digits = F.hex("own")  # a digit a bin
    return F.array(*(F.xxhash64(F.lit(k), F.substring(digits, BAND_BINS * k + 1, BAND_BINS)) for k in bands))


def least_equal(similarity: float) -> int:
    """How many bins two fingerprints must share for minhash.likeness to be at least that."""
    chance = 1 / (1 << minhash.BITS)
    return next((n for n in range(minhash.BINS + 1) if min(1.0, max(0.0, (n / minhash.BINS - chance) / (1 - chance))) >= similarity), minhash.BINS)


def differing(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """In how many bins (of four bits) these rows of 64-bit words differ."""
    d = x ^ y
    d |= d >> np.uint64(1)
    d |= d >> np.uint64(2)
    d &= np.uint64(0x1111111111111111)
    return np.bitwise_count(d).sum(-1, dtype=np.int64)


def as_words(own: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(own), np.uint64).reshape(len(own), -1)


def jaccard_many(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """The similarities of one ascending set to others."""
    sizes = np.fromiter(map(len, others), np.int64, len(others))
    every = np.concatenate(others)
    at = np.minimum(np.searchsorted(x, every), len(x) - 1)
    common = np.add.reduceat((x[at] == every).astype(np.int64), np.cumsum(sizes) - sizes)
    return common / (len(x) + sizes - common)


class Judge:
    """Decides on pairs by their estimate and, between sure and doubt, by their sets, ascending hashes of this kind. Where it confirms, no
    estimate makes a link: the sets decide on every pair that is not far below."""

    def __init__(self, similarity: float, kind: type = np.uint32, confirm: bool = False):
        self.similarity, self.kind = similarity, kind
        self.sure = -1 if confirm else minhash.BINS - least_equal(min(1.0, similarity + SURE))  # so many bins may differ
        self.doubt = minhash.BINS - least_equal(max(0.0, similarity - DOUBT))

    def reached(self, x: int, rest: np.ndarray, own: np.ndarray, sets: list[np.ndarray] | None) -> np.ndarray:
        """The places in rest of rows similar to row x; without sets only the sure ones."""
        most, half = self.doubt if sets is not None else self.sure, own.shape[1] // 2
        n = differing(own[rest, :half], own[x, :half])
        near = np.flatnonzero(n <= most)
        n = n[near] + differing(own[rest[near], half:], own[x, half:])
        near, n = near[n <= most], n[n <= most]
        if sets is None or not len(near):
            return near
        good, open_ = n <= self.sure, np.flatnonzero(n > self.sure)
        if len(open_):
            good[open_] = jaccard_many(sets[x], [sets[k] for k in rest[near[open_]]]) >= self.similarity
        return near[good]


def reach(own: np.ndarray, part: np.ndarray, judge: Judge, sets: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows of different parts of one cell, as many as connect all that are similar there (rows of one part count as
    connected)."""
    _, of, sizes = np.unique(part, return_inverse=True, return_counts=True)
    by_part = np.split(np.argsort(of, kind="stable"), np.cumsum(sizes)[:-1])
    order = np.argsort(sizes, kind="stable")  # the largest part last: it need not look around any more
    rank = np.empty(len(sizes), np.int64)
    rank[order] = np.arange(len(sizes))
    rest = np.argsort(rank[of], kind="stable")
    left, right, wave = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], []
    while len(rest):
        if not wave:
            mine = of[rest[0]]
            wave, rest = by_part[mine].tolist(), rest[of[rest] != mine]
            continue
        x = wave.pop()
        near = judge.reached(x, rest, own, sets)
        if len(near):
            parts, first = np.unique(of[rest[near]], return_index=True)
            found = rest[near[first]]
            left.append(np.full(len(found), x))
            right.append(found)
            for p in parts.tolist():
                wave += by_part[p].tolist()
            rest = rest[~np.isin(of[rest], parts)]
    return np.concatenate(left), np.concatenate(right)


def meetings(cell: np.ndarray, fp: np.ndarray, part: np.ndarray, open_cell: int | None = None) -> pa.RecordBatch:
    """Of rows whose cells stand together, (cell, a, b): the pairs of different parts in cells of at most SMALL_CELL rows, with a
    null cell, and the rows of larger cells of several parts, with a null b. open_cell is a large cell whose first rows went out before."""
    starts = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
    size = np.diff(np.append(starts, len(cell)))
    several = np.maximum.reduceat(part, starts) != np.minimum.reduceat(part, starts)
    large = (size > SMALL_CELL) & several
    large[0] |= cell[0] == open_cell if open_cell is not None else False
    of = np.repeat(np.arange(len(starts)), size)
    left = size[of] - (np.arange(len(cell)) - starts[of])  # rows of the cell from this one on
    rows, pairs = np.flatnonzero(several[of] & ~large[of] & (left > 1)), [np.zeros((0, 2), np.int64)]
    for shift in range(1, SMALL_CELL):
        rows = rows[left[rows] > shift]
        if not len(rows):
            break
        apart = part[rows] != part[rows + shift]
        a, b = fp[rows[apart]], fp[rows[apart] + shift]
        pairs.append(np.stack([np.minimum(a, b), np.maximum(a, b)], 1))
    both, many = np.unique(np.concatenate(pairs), axis=0), large[of]
    n, m = len(both), int(many.sum())
    return pa.RecordBatch.from_arrays(
        [pa.array(np.append(np.zeros(n, np.int64), cell[many]), mask=np.arange(n + m) < n), pa.array(np.append(both[:, 0], fp[many])), pa.array(np.append(both[:, 1], np.zeros(m, np.int64)), mask=np.arange(n + m) >= n)],
        ["cell", "a", "b"],
    )


def met_in_bands(distinct: DataFrame, bands: range, groups: DataFrame | None = None) -> DataFrame:
    """The meetings of rows of distinct (fp, own, part) in these bands, and in groups (cell, fp); a large cell's rows may be of one part where
    it fills a task's hold."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n, open_cell = 0, None
        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy() for k in range(3)]))
            n += batch.num_rows
            if n >= 200_000:
                rows = np.concatenate(held, axis=1)
                cut = int(np.searchsorted(rows[0], rows[0, -1]))
                if not cut:  # all of one cell
                    open_cell, cut = int(rows[0, 0]), rows.shape[1]
                    yield pa.RecordBatch.from_arrays([pa.array(rows[0]), pa.array(rows[1]), pa.nulls(cut, pa.int64())], ["cell", "a", "b"])
                else:
                    yield meetings(*rows[:, :cut], open_cell)
                held, n = [rows[:, cut:]], rows.shape[1] - cut
        if n:
            yield meetings(*np.concatenate(held, axis=1), open_cell)

    cells = distinct.filter("own IS NOT NULL").select(F.explode(band_keys(bands)).alias("cell"), "fp", "part")
    if groups is not None:
        cells = cells.unionByName(groups.join(distinct.select("fp", "part"), "fp"))
    return cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(meet, "cell long, a long, b long")


def estimated(pairs: DataFrame, distinct: DataFrame, judge: Judge) -> DataFrame:
    """(a, b, sure) of the pairs (a, b) that are sure or in doubt by the MinHash of distinct (fp, own)."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                n = differing(as_words(batch.column(2).to_pylist()), as_words(batch.column(3).to_pylist()))
                found = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n <= judge.sure)], ["a", "b", "sure"])
                yield found.filter(pa.array(n <= judge.doubt))

    own = distinct.select("fp", "own")
    return pairs.join(own.toDF("a", "own_a"), "a").join(own.toDF("b", "own_b"), "b").select("a", "b", "own_a", "own_b").mapInArrow(choose, "a long, b long, sure boolean")


def exact(pairs: DataFrame, sets: DataFrame, judge: Judge) -> DataFrame:
    """The pairs (a, b) whose sets (fp, shingles) are similar."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_py(), judge.kind) for v in (x, y))
                good.append(bool(jaccard_many(x, [y])[0] >= judge.similarity))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    return pairs.join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b").select("a", "b", "set_a", "set_b").mapInArrow(choose, "a long, b long")


def in_large_cells(cells: DataFrame, judge: Judge) -> DataFrame:
    """(a, b): links within the cells of cells (cell, block, part, fp, own, and shingles for exact ones), each in one task."""
    exactly = "shingles" in cells.columns

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, list[np.ndarray]]] = []

        def found() -> pa.RecordBatch:
            rows, own, sets = np.concatenate([r for r, _, _ in held], axis=1), np.concatenate([o for _, o, _ in held]), [s for _, _, own in held for s in own]
            cuts, out = np.append(np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(0)) + 1, rows.shape[1]).tolist(), []
            for a, b in zip([0, *cuts], cuts):
                x, y = reach(own[a:b], rows[2, a:b], judge, sets[a:b] if exactly else None)
                out.append(rows[3, a:b][np.stack([x, y])])
            both = np.concatenate(out, axis=1)
            return pa.RecordBatch.from_arrays([pa.array(both.min(0)), pa.array(both.max(0))], ["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(k).to_numpy() for k in range(4)])
            own = as_words(batch.column(4).to_pylist())
            sets = [np.frombuffer(s, judge.kind) for s in batch.column(5).to_pylist()] if exactly else []
            changes = np.flatnonzero((np.diff(rows[:2], axis=1) != 0).any(0))
            if held and (held[-1][0][:2, -1] != rows[:2, 0]).any():
                yield found()
                held = []
            if len(changes):
                cut = int(changes[-1]) + 1
                held.append((rows[:, :cut], own[:cut], sets[:cut]))
                yield found()
                held, rows, own, sets = [], rows[:, cut:], own[cut:], sets[cut:]
            held.append((rows, own, sets))
        if held:
            yield found()

    columns = ["cell", "block", "part", "fp", "own", *(["shingles"] if exactly else [])]
    return cells.select(*columns).repartition("cell", "block").sortWithinPartitions("cell", "block").mapInArrow(search, "a long, b long")


def sure_links(distinct: DataFrame, judge: Judge) -> DataFrame:
    """(a, b): links between rows of distinct (fp, own, part) of different parts that are sure by their estimate, as far as the first bands
    show them."""
    met = stored(met_in_bands(distinct, range(FIRST_BANDS)), "met-first")
    pairs = estimated(met.filter("b IS NOT NULL").select("a", "b").distinct(), distinct, judge).filter("sure").select("a", "b")
    members = met.filter("b IS NULL").select("cell", F.col("a").alias("fp"))
    sizes = members.groupBy("cell").agg(F.ceil(F.count("*") / BLOCK_ROWS).alias("s"))
    large = members.join(sizes, "cell").select("cell", "fp", F.pmod(F.xxhash64("cell", "fp"), F.col("s")).alias("block"))
    return pairs.unionByName(in_large_cells(large.join(distinct.select("fp", "part", "own"), "fp"), judge)).distinct()


def blocks(members: DataFrame) -> DataFrame:
    """members (cell, fp, part, n_bytes) of cells that have several parts, with block: the blocks that a row goes to.

    The rows of a cell's largest part are dealt out to ``s`` blocks, all others to ``t``; every block of the others meets each of
    those and each of the others.
    """
    by_part = members.groupBy("cell", "part").agg(F.count("*").alias("n"), F.sum("n_bytes").alias("bytes"))
    cells = by_part.groupBy("cell").agg(F.max(F.struct("n", "part", "bytes")).alias("top"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.count("*").alias("parts")).filter("parts > 1")
    count = lambda n, size: F.greatest(F.ceil(n / (BLOCK_ROWS / 2)), F.ceil(size / (BLOCK_BYTES / 2)), F.lit(1))
    cells = cells.select("cell", F.col("top.part").alias("top"), count(F.col("top.n"), F.col("top.bytes")).alias("s"), count(F.col("n") - F.col("top.n"), F.col("bytes") - F.col("top.bytes")).alias("t"))
    code = lambda i, j: i * F.lit(1 << 31) + j
    zero, hashed = F.lit(0).cast("long"), F.xxhash64("fp", F.lit("block"))
    of_top = F.transform(F.sequence(zero, F.col("t") - 1), lambda i: code(i, F.col("t") + F.pmod(hashed, F.col("s"))))
    mine = F.pmod(hashed, F.col("t"))
    with_top = F.transform(F.sequence(zero, F.col("s") - 1), lambda j: code(mine, F.col("t") + j))
    with_others = F.filter(F.transform(F.sequence(zero, F.col("t") - 1), lambda i: F.when(i != mine, code(F.least(mine, i), F.greatest(mine, i)))), lambda c: c.isNotNull())
    placed = members.join(cells, "cell")
    return placed.select("cell", "fp", "part", F.explode(F.when(F.col("part") == F.col("top"), of_top).otherwise(F.concat(with_top, with_others))).alias("block"))


def exact_links(distinct: DataFrame, sets_of: Callable[[DataFrame], DataFrame], judge: Judge, groups: DataFrame | None = None) -> DataFrame:
    """(a, b): links between rows of distinct (fp, own, n_bytes, part) of different parts that share any band, or one of groups (cell, fp),
    and whose sets (sets_of gives fp, shingles, a row each, of a table of fp) are similar: every such pair is returned or connected by
    others."""
    met = stored(met_in_bands(distinct, range(BANDS), groups), "met")
    judged = stored(estimated(met.filter("b IS NOT NULL").select("a", "b").distinct(), distinct, judge), "estimated")
    members = met.filter("b IS NULL").select("cell", F.col("a").alias("fp")).join(distinct.select("fp", "part", "n_bytes"), "fp")
    placed = stored(blocks(members), "placed")
    doubtful = judged.filter("NOT sure").select("a", "b")
    needed = placed.select("fp").unionByName(doubtful.select(F.col("a").alias("fp"))).unionByName(doubtful.select(F.col("b").alias("fp"))).distinct()
    sets = stored(sets_of(needed), "sets")
    large = placed.join(distinct.select("fp", "own"), "fp").join(sets, "fp")
    found = judged.filter("sure").select("a", "b").unionByName(exact(doubtful, sets, judge))
    return found.unionByName(in_large_cells(large, judge)).distinct()


def with_parts(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """distinct with part: the smallest fp that a row is connected with over links (a, b), its own included."""
    return distinct.join(components(links).toDF("fp", "part"), "fp", "left").withColumn("part", F.coalesce("part", "fp"))


def similar_groups(docs: DataFrame, similarity: float = 0.8, known: Callable[[DataFrame, Judge], tuple[DataFrame, DataFrame]] | None = None) -> tuple[DataFrame, DataFrame]:
    """prints (doc_id, text_hash, fp, own, simhash, shingles) of docs, and (fp, first): first is the smallest (doc_id, text_hash) of each
    fingerprint's group, null where none of its rows has a doc_id. known gives, of prints, groups (cell, fp) to look for links
    in besides bands, and links (a, b) that hold already."""
    judge = Judge(similarity)
    prints = stored(with_sets(docs), "sets-of-shingles")
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))
    distinct = stored(prints.groupBy("fp", "own").agg(F.min(named).alias("least"), F.max(F.length("shingles") + 256).cast("long").alias("n_bytes")), "distinct")
    rows = distinct.select("fp", "own", "n_bytes")
    groups, links, parts = None, None, rows.withColumn("part", F.col("fp"))
    if known:
        groups, links = known(prints, judge)
        links = stored(links, "known")
        parts = stored(with_parts(rows, links), "known-parts")
    sure = stored(sure_links(parts, judge), "sure")
    links = links.unionByName(sure) if known else sure
    second = exact_links(stored(with_parts(rows, links), "parts"), lambda needed: sets_of(prints, needed), judge, groups)
    return prints, named_groups(distinct.select("fp", "least"), links.unionByName(second)).withColumnRenamed("component_id", "first")


def near_copies(docs: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(doc_id, text_hash, first) of every row of docs: first is the smallest (doc_id, text_hash) among all documents reachable over
    links, pairs of shingle sets at least that similar; null where no row of the group has a doc_id.

    Texts without a word, null ones too, are one group. Documents of equal MinHash collapse before anything else. Repeated rows are each
    returned, an empty table gives an empty result, other columns are not looked at.
    """
    prints, groups = similar_groups(docs, similarity)
    return prints.select("doc_id", "text_hash", "fp").join(groups, "fp").select("doc_id", "text_hash", "first")
