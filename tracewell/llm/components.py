"""Connected components over DataFrames, by alternating large-star and small-star steps.

Each round is written to the shared folder; nothing is collected but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored


def local_roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, root) of the nodes of these edges that are not roots: root is the smallest node connected by them."""
    nodes, place = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = place[: len(u)], place[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new != new[new]).any():
            new = new[new]
        if (new == label).all():
            break
        label = new
    own = label != np.arange(len(nodes))
    return nodes[own], nodes[label[own]]


def contracted(edges: DataFrame, most: int = 1 << 20) -> DataFrame:
    """Edges (u, v) with the same components: each task replaces what it reads, ``most`` edges at a time, by stars."""

    def shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        n = 0

        def stars() -> pa.RecordBatch:
            node, root = local_roots(*np.concatenate(held, axis=1))
            return pa.RecordBatch.from_arrays([pa.array(node), pa.array(root)], ["u", "v"])

        for batch in batches:
            held.append(np.stack([batch.column(k).to_numpy() for k in range(2)]))
            n += batch.num_rows
            if n >= most:
                yield stars()
                held, n = [], 0
        if n:
            yield stars()

    return edges.mapInArrow(shrink, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of edges (a, b): root is the smallest node that it is connected with.

    Rounds of a large-star and a small-star step until nothing changes; tasks contract their edges first, so that few rounds are
    left to do."""
    edges = stored(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v"), "edges")
    edges = stored(contracted(edges).distinct(), "edges")
    state = None
    while True:
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state or not now[0]:
            break
        state = now
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        small = small.select("u", F.col("m").alias("v")).unionByName(small.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")))
        edges = stored(small.distinct(), "edges")
    stars = edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    return stars.unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def named_groups(distinct: DataFrame, edges: DataFrame) -> DataFrame:
    """(fp, component_id) of every row of distinct (fp, least): the smallest ``least`` among the connected (of any type that has an order)."""
    roots = components(edges)
    named = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = stored(named, "named")
    names = stored(named.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    return stored(named.join(names, "root").select("fp", "component_id"), "components")
