"""Centroid clustering: Lloyd's rounds by dual trees, in exact integers.

Vectors lie in *blocks* of some hundreds, cut from the table's partitions as they stand, without a shuffle.  Each block has a cover tree
over its distinct vectors, made once and written beside them: a node's radius halves with its level, its children lie within the
radius and farther apart than half of it, and it knows how many vectors it holds and their sum.

In every round each task has a tree over the centroids (halved at the widest component) and descends both trees together, a wave of
node pairs at a time.  A pair goes when the least possible distance between its nodes is above the largest from the vector node to
some other centroid node; a vector node that one centroid is left for is assigned whole, by its count and sum.  At leaves the
remaining centroids are compared by exact squared distances, ties to the smaller number.  Bounds are widened beyond what
floating point can err, so pruning never decides a tie.

A round gives one count and sum a centroid and task; Spark adds them up, and only one row a centroid reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored

DIMENSIONS, SCALE = 64, 1024
#: Integers are below this, so that a squared distance is a long.
LIMIT = 1 << 27
#: Vectors of a block, and distinct vectors up to which a node is not divided.
BLOCK, LEAF = 1024, 8
_SLACK = 1e-6

BLOCK_SCHEMA = "ids binary, no_id binary, of binary, points binary, center binary, radius binary, first binary, last binary, parent binary"


def kept(vectors: DataFrame) -> DataFrame:
    """(vec_id, v) of the vectors with exactly DIMENSIONS components, none null or not finite, as integers floor(SCALE * x). A vector with
    an integer of LIMIT or more either way is left out too: its squared distances are no longs."""
    numbers = F.transform("embedding", lambda x: x.cast("double"))
    good = F.coalesce(F.size("embedding") == DIMENSIONS, F.lit(False)) & F.forall(numbers, lambda x: F.coalesce((F.abs(x) < LIMIT / SCALE) & ~F.isnan(x), F.lit(False)))
    return vectors.filter(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(numbers, lambda x: F.floor(F.lit(float(SCALE)) * x).cast("int")).alias("v"))


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of long integers."""
    d = x - y
    return (d * d).sum(-1)


@dataclass
class Tree:
    """Nodes in the order of their making, parents first. points[first:last] are a node's, of which center is one; a node is a leaf if no
    other names it as parent (roots are their own)."""

    points: np.ndarray
    center: np.ndarray
    radius: np.ndarray
    first: np.ndarray
    last: np.ndarray
    parent: np.ndarray

    def children(self) -> tuple[np.ndarray, np.ndarray]:
        """(order, starts): order[starts[n]:starts[n + 1]] are the children of node n."""
        own = np.flatnonzero(self.parent != np.arange(len(self.parent)))
        return own[np.argsort(self.parent[own], kind="stable")], np.concatenate([[0], np.cumsum(np.bincount(self.parent[own], minlength=len(self.parent)))])


def cover_tree(points: np.ndarray) -> tuple[Tree, np.ndarray]:
    """A cover tree over distinct integer points, and the order in which it holds them."""
    order = np.arange(len(points))
    nodes: list[tuple[int, float, int, int, int]] = []
    away = np.sqrt(squared(points, points[:1]).astype(float))
    todo = [(0, len(points), 0, away, 0)] if len(points) else []  # first, last, place of the center, distances from it, parent
    while todo:
        first, last, center, away, parent = todo.pop()
        far = float(away.max())
        me = len(nodes)
        nodes.append((center, far * (1 + 1e-9), first, last, parent if nodes else 0))
        if last - first <= LEAF or not far:
            continue
        half = 2.0 ** (np.ceil(np.log2(far)) - 1)  # the level below the smallest that covers all
        own, group, distance, k, at = order[first:last].copy(), np.full(last - first, -1), away.copy(), 0, center
        centers = []
        while True:
            mine = np.flatnonzero((group < 0) & (distance <= half))
            group[mine] = k
            centers.append((at, distance[mine]))
            rest = np.flatnonzero(group < 0)
            if not len(rest):
                break
            k, at = k + 1, own[rest[0]]
            distance = np.full(last - first, np.inf)
            distance[rest] = np.sqrt(squared(points[own[rest]], points[at]).astype(float))
        if k == 0:
            continue
        order[first:last] = own[np.argsort(group, kind="stable")]
        ends = first + np.cumsum(np.bincount(group))
        for (at, distances), a, b in zip(centers, [first, *ends], ends):
            todo.append((int(a), int(b), int(at), distances, me))
    center, radius, first, last, parent = (np.array([n[k] for n in nodes], dtype) for k, dtype in enumerate((np.int32, np.float64, np.int32, np.int32, np.int32)))
    place = np.empty(len(order), np.int32)
    place[order] = np.arange(len(order), dtype=np.int32)
    return Tree(points[order], place[center] if len(nodes) else center, radius, first, last, parent), order


def centroid_tree(centroids: np.ndarray) -> tuple[Tree, np.ndarray, np.ndarray]:
    """A tree over centroids (leaves hold one number each, equal centroids too), the middles of its nodes and the numbers of its leaves
    (-1 elsewhere)."""
    middle, radius, first, last, parent, order = [], [], [], [], [], np.arange(len(centroids))
    todo = [(0, len(centroids), 0)] if len(centroids) else []
    while todo:
        a, b, up = todo.pop()
        own, me = centroids[order[a:b]], len(middle)
        middle.append(own.mean(0) if b - a > 1 else own[0].astype(float))
        radius.append(float(np.sqrt(((own - middle[-1]) ** 2).sum(1)).max()) * (1 + 1e-9) + (_SLACK if b - a > 1 else 0))
        first.append(a), last.append(b), parent.append(up if me else 0)
        if b - a > 1:
            widest = int(np.argmax(own.max(0) - own.min(0)))
            order[a:b] = order[a:b][np.argsort(own[:, widest], kind="stable")]
            half = (a + b) // 2
            todo += [(a, half, me), (half, b, me)]
    first, last, parent = (np.array(x, np.int32) for x in (first, last, parent))
    tree = Tree(centroids[order], first, np.array(radius), first, last, parent)
    return tree, np.array(middle), np.where(last - first == 1, order[first], -1) if len(first) else first


def under(order: np.ndarray, starts: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(of, child): for each of nodes its children, itself where it has none; of is the place in nodes."""
    n = np.maximum(1, starts[nodes + 1] - starts[nodes])
    of = np.repeat(np.arange(len(nodes)), n)
    within = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    inner = starts[nodes + 1][of] > starts[nodes][of]
    at = np.minimum(starts[nodes][of] + within, max(0, len(order) - 1))
    return of, np.where(inner, order[at] if len(order) else 0, nodes[of])


def assigned(tree: Tree, centroids: np.ndarray) -> tuple[np.ndarray, int]:
    """The number of the nearest centroid of each of the tree's points, and how many exact distances leaves have taken."""
    ctree, middle, number = centroid_tree(centroids)
    down, starts = tree.children()
    cdown, cstarts = ctree.children()
    inner, cinner = np.diff(starts) > 0, np.diff(cstarts) > 0
    out, taken = np.full(len(tree.points), -1), 0
    node, cnode = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while len(node):
        # pairs of one vector node stand together
        away = np.sqrt(((tree.points[tree.center[node]] - middle[cnode]) ** 2).sum(1))
        reach = tree.radius[node] + ctree.radius[cnode]
        slack = _SLACK * (1 + away)
        starts_of = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.append(starts_of, len(node)))
        most = np.repeat(np.minimum.reduceat(away + reach + slack, starts_of), sizes)
        keep = away - reach - slack <= most
        node, cnode = node[keep], cnode[keep]
        starts_of = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1]]))
        sizes = np.diff(np.append(starts_of, len(node)))
        single = (sizes == 1) & (number[cnode[starts_of]] >= 0)
        for n, c in zip(node[starts_of[single]].tolist(), number[cnode[starts_of[single]]].tolist()):
            out[tree.first[n] : tree.last[n]] = c
        open_ = ~np.repeat(single, sizes)
        node, cnode = node[open_], cnode[open_]
        leaf = ~inner[node] & ~cinner[cnode]
        waits = np.zeros(len(inner), bool)
        waits[node[~leaf]] = True  # a vector leaf waits until all its centroid nodes are leaves
        ready = leaf & ~waits[node]
        if ready.any():
            n, c = node[ready], number[cnode[ready]]
            of = np.repeat(np.arange(len(n)), tree.last[n] - tree.first[n])
            at = tree.first[n][of] + np.arange(len(of)) - np.repeat(np.cumsum(tree.last[n] - tree.first[n]) - (tree.last[n] - tree.first[n]), tree.last[n] - tree.first[n])
            distance = squared(tree.points[at], centroids[c[of]])
            taken += len(at)
            best = np.lexsort((c[of], distance, at))
            points, firsts = np.unique(at[best], return_index=True)
            out[points] = c[of][best][firsts]
        node, cnode = node[~ready], cnode[~ready]
        # the wider of both is opened, so that bounds narrow fastest
        wide = (tree.radius[node] >= ctree.radius[cnode]) | ~cinner[cnode]
        alone = np.zeros(len(inner), bool)
        alone[node[~(wide & inner[node])]] = True  # pairs of one vector node stay together: it is opened for all or for none
        opens = inner[node] & ~alone[node]
        cof, cchild = under(cdown, cstarts, cnode)
        cnode, node, opens = np.where(opens[cof], cnode[cof], cchild), node[cof], opens[cof]
        first_of = np.concatenate([[True], cof[1:] != cof[:-1]]) if len(cof) else np.zeros(0, bool)
        own = ~opens | first_of  # an opened vector node keeps each centroid node once
        node, cnode, opens = node[own], cnode[own], opens[own]
        of, child = under(down, starts, node)
        stays = ~opens[of]
        again = np.concatenate([[True], of[1:] != of[:-1]]) if len(of) else np.zeros(0, bool)
        use = ~stays | again
        node, cnode = np.where(stays, node[of], child)[use], cnode[of][use]
        by = np.lexsort((cnode, node))
        node, cnode = node[by], cnode[by]
    return out, taken


def blocks(vectors: DataFrame, block: int = BLOCK) -> DataFrame:
    """Blocks of rows of vectors (vec_id, v), each with the cover tree of its distinct vectors."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(ids: pa.Array, v: np.ndarray) -> pa.RecordBatch:
            distinct, of = np.unique(v, axis=0, return_inverse=True)
            tree, order = cover_tree(distinct.astype(np.int64))
            place = np.empty(len(order), np.int32)
            place[order] = np.arange(len(order), dtype=np.int32)
            held = (ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), place[of.reshape(-1)], tree.points.astype(np.int32), tree.center, tree.radius, tree.first, tree.last, tree.parent)
            return pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in held], [f.split()[0] for f in BLOCK_SCHEMA.split(", ")])

        for batch in batches:
            for first in range(0, batch.num_rows, block):
                part = batch.slice(first, block)
                yield made(part.column(0), part.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS))

    return vectors.mapInArrow(build, BLOCK_SCHEMA)


@dataclass
class Block:
    ids: np.ndarray
    no_id: np.ndarray
    of: np.ndarray
    tree: Tree


def opened(batch: pa.RecordBatch) -> Iterator[Block]:
    kinds = (np.int64, bool, np.int32, np.int32, np.int32, np.float64, np.int32, np.int32, np.int32)
    for row in zip(*(batch.column(k) for k in range(len(kinds)))):
        ids, no_id, of, points, *tree = (np.frombuffer(x.as_py(), kind) for x, kind in zip(row, kinds))
        yield Block(ids, no_id, of, Tree(points.reshape(-1, DIMENSIONS).astype(np.int64), *tree))


def seeds(vectors: DataFrame, k: int, seed: str) -> list[list[int]]:
    """The k vectors with the smallest sha256 of "<seed>:<vec_id>", in that order; equal ids by vector, rows without an id last."""
    hashed = vectors.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256).alias("h"), "v")
    return [list(r["v"]) for r in hashed.orderBy(F.asc_nulls_last("h"), "v").limit(k).collect()]


def moved(held: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round over blocks: each the componentwise floor of its vectors' mean, empty ones as before."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for own in opened(batch):
                nearest, _ = assigned(own.tree, centroids)
                weight = np.bincount(own.of, minlength=len(nearest))
                n += np.bincount(nearest, weight, minlength=len(centroids)).astype(np.int64)
                for c in np.unique(nearest).tolist():
                    mine = nearest == c
                    sums[c] += weight[mine] @ own.tree.points[mine]
        some = np.flatnonzero(n)
        table = np.concatenate([n[some, None], sums[some]], axis=1)  # the count, then a sum a component
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, table.shape[1])), pa.array(np.tile(np.arange(table.shape[1]), len(some))), pa.array(table.reshape(-1))], ["cluster", "place", "total"])

    part = held.mapInArrow(add, "cluster long, place long, total long")
    totals = part.groupBy("cluster", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # a row a centroid and component
    found: dict[int, dict[int, int]] = {}
    for r in totals:
        found.setdefault(r["cluster"], {})[r["place"]] = int(r["total"])
    new = centroids.copy()
    for c, own in found.items():
        new[c] = [own[k] // own[0] for k in range(1, len(own))]
    return new


def labelled(held: DataFrame, centroids: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance) of every vector of blocks."""

    def tell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own in opened(batch):
                nearest, _ = assigned(own.tree, centroids)
                distance = squared(own.tree.points, centroids[nearest])
                yield pa.RecordBatch.from_arrays([pa.array(own.ids, mask=own.no_id), pa.array(nearest[own.of].astype(np.int32)), pa.array(distance[own.of])], ["vec_id", "cluster", "distance"])

    return held.mapInArrow(tell, "vec_id long, cluster int, distance long")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: str = "3") -> DataFrame:
    """vec_id, cluster, distance (squared, to its centroid), cluster_inertia, inertia (distances summed over the cluster and over all) and
    centroid_sha256 (of the components, as decimal integers joined by commas) of every kept vector of vectors (vec_id, embedding).

    Vectors with a null, a null or non-finite component, another length, or a component of 131,072 or more either way are left out.
    Centroids start as the k vectors with the smallest hashed ids. A row without a vec_id is clustered like others and starts a centroid
    only where rows with one are too few; with fewer than k vectors there are as many centroids. Repeated rows and equal vectors count as
    often as they stand there; equal distances go to the smaller number; an empty table gives an empty result; other columns are not
    looked at.
    """
    spark, rows = vectors.sparkSession, kept(vectors)
    centroids = np.array(seeds(rows, k, seed), np.int64).reshape(-1, DIMENSIONS)
    held = stored(blocks(rows), "blocks")
    for _ in range(rounds if len(centroids) else 0):
        new = moved(held, centroids)
        if (new == centroids).all():
            break  # no further round changes anything
        centroids = new
    found = stored(labelled(held, centroids), "assigned") if len(centroids) else spark.createDataFrame([], "vec_id long, cluster int, distance long")
    inertia = {r["cluster"]: int(r["d"]) for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # a row a centroid
    rows = [(c, d, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c].tolist())).encode()).hexdigest()) for c, d in inertia.items()]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle_sql(k: int, rounds: int, seed: str) -> str:
    """Lloyd's rounds by comparing every vector with every centroid."""
    nearest = "list_sum(list_transform(list_zip(v.v, c.c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
    parts = [
        f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {DIMENSIONS}),
c0 AS MATERIALIZED (
  SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INT) AS n, v AS c
  FROM (SELECT sha256('{seed}:' || vec_id) AS h, v FROM kept ORDER BY h LIMIT {k}))"""
    ]
    for r in range(1, rounds + 2):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, any_value(v) AS v, arg_min(n, (d, n)) AS cluster, min(d) AS distance
  FROM (SELECT v.vec_id, v.v, c.n, CAST({nearest} AS BIGINT) AS d FROM kept v, c{r - 1} c) GROUP BY vec_id)""")
        if r <= rounds:
            parts.append(f"""m{r} AS MATERIALIZED (
  SELECT cluster, list(m ORDER BY k) AS c FROM (
    SELECT cluster, k, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT cluster, generate_subscripts(v, 1) AS k, unnest(v) AS x FROM a{r}) GROUP BY 1, 2) GROUP BY 1),
c{r} AS MATERIALIZED (SELECT o.n, coalesce(m.c, o.c) AS c FROM c{r - 1} o LEFT JOIN m{r} m ON m.cluster = o.n)""")
    last = rounds + 1
    return (
        ",\n".join(parts)
        + f"""
SELECT a.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.c, ',')) AS centroid_sha256
FROM a{last} a JOIN c{rounds} c ON c.n = a.cluster
"""
    )
