"""SimHash near-duplicates, linked exactly at a Hamming radius through pivot distance tables.

Fingerprints.  A document's words are joined to shingles, each is hashed to 64 bits, and a fingerprint bit is set where
over half of the hashes have it.

Pivot tables.  Equal fingerprints collapse first, so a group of copies of any size is one row from there on.  Each distinct
fingerprint gets, once, its Hamming distances to many fixed reference fingerprints, the pivots, and carries them from there
on.  By the triangle inequality a pair with a coordinate difference above the radius cannot be linked.

Meeting.  Two distinct fingerprints at most ``radius`` bits apart agree on at least ``blocks - radius`` of ``blocks`` disjoint
bit blocks; every choice of that many blocks is one *cell family*, and a pair meets in the cell of any choice that it agrees
on, so no link is lost.  (Coordinates of pivots cannot deal the pairs out by themselves: at radius 4 a random pivot separates
only two pairs in five, so a grid over pivots repeats each row hundreds of times.)  ``blocks`` grows with the number of
distinct fingerprints so that a cell holds a few.  Inside a cell rows stand in order of their first coordinate: only those in
a window of the radius on either side are compared at all, the other coordinates discard nearly all that do not belong
together, and what survives is verified by its differing bits.

Large cells.  A cell is searched breadth first: what is reached leaves the set of the unreached, so a dense group of m
near copies costs about m comparisons and gives m - 1 links, a spanning forest, and not the square.  Cells above
``CELL_ROWS`` are dealt out as pairs of blocks, so that no task holds an unbounded cell.

Near copies at a shingle similarity (``keep_one``).  Groups over links of at most ``radius`` bits are found in the same way, and a
group's members are confirmed on their full sets of shingles, first beside its smallest one (``confirmed_links``): what that
joins is one part.  ``similar`` then goes on from part to part of a group, so that none hides others, and, as a pair at
similarity 0.8 lies about ten bits apart, which no cells of bits can find, from part to part in bands of MinHash bins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import neardup, similar
from tracewell.llm.common import majority, stored
from tracewell.llm.components import named_groups

BITS = 64
#: Rows of a cell (a fingerprint and its table) that one task takes at once.
CELL_ROWS = 50_000
#: Cells up to this size are searched together, pair by pair; larger ones breadth first.
SMALL_CELL = 48
#: A cell family is chosen so that a cell has about so many of evenly spread fingerprints.
CELL_MEAN = 4
PIVOTS = np.random.default_rng(20240229).integers(0, 1 << 63, 24, dtype=np.uint64) * np.uint64(2) + np.arange(24, dtype=np.uint64) % 2


def fingerprint(text: str | None, shingle: int = 4, seed: int = 42) -> int:
    """The unsigned fingerprint of one text. Null or no words: 0. Fewer words than a shingle: their whole sequence."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(shingle, len(words))
    starts = np.concatenate([[0], ends[:-1] + 1])[: len(words) - width + 1]
    hashes = np.array([xxh64_intdigest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[width - 1 :].tolist())], np.uint64)
    return majority(hashes)


def fingerprints(docs: DataFrame, shingle: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row of docs; fp holds the 64 bits as a signed long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.fromiter((fingerprint(t.as_py(), shingle, seed) for t in batch.column(1)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compute, "doc_id long, fp long")


def blocks_for(n: int, radius: int) -> int:
    """How many bit blocks: the fewest for which a cell has about CELL_MEAN of n evenly spread fingerprints."""
    return next((b for b in range(radius + 1, radius + 5) if n <= CELL_MEAN << (BITS * (b - radius) // b)), radius + 5)


def cell_masks(blocks: int, radius: int) -> list[int]:
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    own = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(own[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def pivot_table(fp: np.ndarray) -> np.ndarray:
    """The Hamming distances of each fingerprint to the pivots, a row each."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def with_table(distinct: DataFrame) -> DataFrame:
    """distinct with the column pivots, the same distances."""
    return distinct.withColumn("pivots", F.array(*(F.bit_count(F.col("fp").bitwiseXOR(F.lit(signed(int(p))))).cast("tinyint") for p in PIVOTS)))


class Tally:
    """Pairs that stood in the window of the first coordinate, that other coordinates discarded, that were verified, and that are links."""

    def __init__(self) -> None:
        self.window = self.discarded = self.verified = self.links = 0

    def add(self, window: int, verified: int, links: int) -> None:
        self.window += window
        self.discarded += window - verified
        self.verified += verified
        self.links += links


def survivors(table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Of these pairs (b may be all against one a) the places of those that no coordinate discards."""
    near = np.arange(len(b))
    for k in range(0, table.shape[1], 4):
        if not len(near):
            break
        own = table[a[near], k : k + 4] if a.ndim else table[a, k : k + 4]
        near = near[(np.abs(own - table[b[near], k : k + 4]) <= radius).all(1)]
    return near


def pairs_in_cells(cell: np.ndarray, fp: np.ndarray, table: np.ndarray, radius: int, met: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None, tally: Tally | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Links among fingerprints of the same cell (cell: ascending numbers; within one, rows ascend by their first coordinate):
    all of a small cell, but for those that have met before, and a spanning forest of the links of a large one."""
    tally = tally or Tally()
    size = np.bincount(cell, minlength=1)
    a = np.flatnonzero((size[cell] <= SMALL_CELL) & (size[cell] > 1))
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for shift in range(1, SMALL_CELL):
        a = a[a + shift < len(cell)]
        a = a[(cell[a] == cell[a + shift]) & (table[a + shift, 0] - table[a, 0] <= radius)]  # beyond the window for good
        if not len(a):
            break
        near = survivors(table, a, a + shift, radius)
        linked = a[near][np.bitwise_count(fp[a[near]] ^ fp[a[near] + shift]) <= radius]
        tally.add(len(a), len(near), len(linked))
        if met is not None:
            linked = linked[~met(linked, linked + shift)]
        left.append(linked)
        right.append(linked + shift)
    starts = np.concatenate([[0], np.cumsum(size)])
    for c in np.flatnonzero(size > SMALL_CELL).tolist():
        x, y = _reach(fp[starts[c] : starts[c + 1]], table[starts[c] : starts[c + 1]], radius, tally)
        left.append(x + starts[c])
        right.append(y + starts[c])
    return np.concatenate(left), np.concatenate(right)


def _reach(fp: np.ndarray, table: np.ndarray, radius: int, tally: Tally) -> tuple[np.ndarray, np.ndarray]:
    left, right, rest, wave = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.arange(len(fp)), []
    first = table[:, 0]
    while len(rest):
        if not wave:
            wave, rest, first = [int(rest[0])], rest[1:], first[1:]
        x = wave.pop()
        low = int(np.searchsorted(first, table[x, 0] - radius, "left"))
        high = int(np.searchsorted(first, table[x, 0] + radius, "right"))
        near = low + survivors(table, np.array(x), rest[low:high], radius)
        linked = near[np.bitwise_count(fp[rest[near]] ^ fp[x]) <= radius]
        tally.add(high - low, len(near), len(linked))
        if len(linked):
            found = rest[linked]
            left.append(np.full(len(found), x))
            right.append(found)
            wave += found.tolist()
            rest, first = np.delete(rest, linked), np.delete(first, linked)
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, radius: int = 4) -> DataFrame:
    """(a, b): links between different fingerprints of distinct (fp, pivots) at most radius bits apart: enough of them that every
    such pair is connected. A pair that agrees on several masks is returned for the first, as far as small cells go; where its
    first cell is large it is connected there, so these links are for components and not to be filtered."""
    masks = cell_masks(blocks_for(distinct.count(), radius), radius)
    cells = distinct.select("fp", "pivots", F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks))).alias("family", "key"))
    hot = stored(cells.groupBy("family", "key").count().filter(F.col("count") > CELL_ROWS), "hot-cells")
    n_hot = hot.count()
    if n_hot:
        hot = F.broadcast(hot) if n_hot <= 10_000 else hot
        cells = cells.join(hot, ["family", "key"], "left").withColumn("s", F.coalesce(F.ceil(F.col("count") / CELL_ROWS), F.lit(1)).cast("int"))
        own = F.pmod(F.xxhash64("fp"), F.col("s")).cast("int")
        pair = F.transform(F.sequence(F.lit(0), F.col("s") - 1), lambda j: F.least(own, j).cast("long") * F.lit(1 << 31) + F.greatest(own, j))
        cells = cells.select("family", "key", "fp", "pivots", F.explode(pair).alias("block"))
    else:
        cells = cells.withColumn("block", F.lit(0).cast("long"))

    order = np.array(masks, np.uint64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        n_held = 0

        def found(rows: np.ndarray, table: np.ndarray) -> pa.RecordBatch:
            cell = np.concatenate([[0], np.cumsum((np.diff(rows[:3], axis=1) != 0).any(0))])
            fp, family = rows[3].view(np.uint64), rows[0]

            def met(a: np.ndarray, b: np.ndarray) -> np.ndarray:
                out = np.zeros(len(a), bool)
                for k, mask in enumerate(order):
                    out |= (k < family[a]) & (((fp[a] ^ fp[b]) & mask) == 0)
                return out

            a, b = pairs_in_cells(cell, fp, table, radius, met)
            a, b = rows[3][a], rows[3][b]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(4)])
            held.append((rows, batch.column(4).flatten().to_numpy().reshape(-1, len(PIVOTS))))
            n_held += batch.num_rows
            if n_held >= 200_000:
                rows, table = np.concatenate([r for r, _ in held], axis=1), np.concatenate([t for _, t in held])
                changes = np.flatnonzero((np.diff(rows[:3], axis=1) != 0).any(0))
                if len(changes):
                    cut = int(changes[-1]) + 1
                    yield found(rows[:, :cut], table[:cut])
                    rows, table = rows[:, cut:], table[cut:]
                held, n_held = [(rows, table)], rows.shape[1]
        if n_held:
            yield found(np.concatenate([r for r, _ in held], axis=1), np.concatenate([t for _, t in held]))

    dealt = cells.select("family", "key", "block", "fp", "pivots").repartition("family", "key", "block").sortWithinPartitions("family", "key", "block", F.get("pivots", F.lit(0)))
    return dealt.mapInArrow(search, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, radius: int = 4, shingle: int = 4, seed: int = 42) -> DataFrame:
    """One row per row of docs: doc_id, fingerprint (16 hex digits), component_id, the smallest doc_id among all documents
    reachable over links of at most radius differing bits, its own included.

    Null or wordless texts have fingerprint zero, linked like any other. Rows with a null doc_id are kept and link, but
    lend no id: a component of such rows alone has a null component_id. Repeated rows are each returned. An empty table
    gives an empty result. Other columns of docs are not looked at.
    """
    prints = stored(fingerprints(docs, shingle, seed), "fingerprints")
    distinct = stored(with_table(prints.groupBy("fp").agg(F.min("doc_id").alias("least"))), "distinct")
    named = named_groups(distinct.select("fp", "least"), links(distinct, radius))
    return prints.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def shared_groups(prints: DataFrame, radius: int = 4) -> DataFrame:
    """(cell, fp): the groups, of two fps or more, of rows of prints (fp, own, simhash) that links of SimHashes at most radius bits apart
    connect, equal ones too. Rows without words are in none; an fp whose texts have several SimHashes may be in several."""
    marks = stored(prints.filter("own IS NOT NULL").select(F.col("simhash").alias("mark"), "fp").distinct(), "marks")
    distinct = stored(with_table(marks.select(F.col("mark").alias("fp")).distinct()), "simhashes")
    named = named_groups(distinct.select("fp", F.col("fp").alias("least")), links(distinct, radius)).toDF("mark", "group")
    grouped = stored(marks.join(named, "mark").select(F.xxhash64(F.lit("simhash"), "group").alias("cell"), "fp").distinct(), "groups")
    several = grouped.groupBy("cell").count().filter("count > 1")
    return stored(grouped.join(several, "cell", "left_semi"), "shared-groups")


def confirmed_links(prints: DataFrame, groups: DataFrame, judge: similar.Judge) -> DataFrame:
    """(a, b): of each of groups (cell, fp) its smallest fp beside each other one whose set (prints: fp, shingles) is similar."""
    hubs = groups.groupBy("cell").agg(F.min("fp").alias("hub"))
    edges = groups.join(hubs, "cell").filter("fp <> hub").select("hub", "fp").distinct()
    sets = stored(similar.sets_of(prints, groups.select("fp").distinct()), "simhash-sets")
    return neardup.confirmed(edges, sets, judge)


def keep_one(docs: DataFrame, similarity: float = 0.8, shingle: int = 5, radius: int = 4) -> DataFrame:
    """docs with one document of each group of near copies: shingle sets at least that similar, directly or through others. They
    are looked for in groups of SimHashes at most radius bits apart, and those that are further apart in bands of MinHash bins.

    The one with the smallest doc_id stays (rows that repeat that id with other texts: the one with the smallest text hash; rows
    that repeat id and text count once). Rows with a null doc_id all stay, since nothing can name them. Texts without a word,
    null ones too, are copies of one another. An empty table gives an empty result. Columns stay as they are, whatever their names.
    """
    if shingle != similar.minhash.SHINGLE:
        raise ValueError(f"the sets are of shingles of {similar.minhash.SHINGLE} words")

    def known(prints: DataFrame, judge: similar.Judge) -> tuple[DataFrame, DataFrame]:
        shared = shared_groups(prints, radius)
        return shared, confirmed_links(prints, shared, judge)

    _, groups = similar.similar_groups(docs, similarity, known)
    kept = groups.filter("first IS NOT NULL").select(F.col("first.doc_id").alias("__kept_id"), F.col("first.text_hash").alias("__kept_hash")).distinct()
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("__row"), F.col("doc_id").cast("long").alias("__id"), similar.text_hash().alias("__hash"))
    named = rows.join(kept, (F.col("__id") == F.col("__kept_id")) & (F.col("__hash") == F.col("__kept_hash")), "left_semi").dropDuplicates(["__id", "__hash"])
    return named.select("__row.*").unionByName(docs.filter("doc_id IS NULL"))
