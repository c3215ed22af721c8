"""Near-duplicate documents by one-permutation MinHash: banded buckets, star-shaped candidate edges, links confirmed on full sets.

Fingerprints.  Every document has the one-permutation MinHash of ``minhash`` (one hash a shingle, bins, optimal densification) and the
set of its distinct five-word shingles.  Documents of equal sets are one *row* from here on.

Buckets and stars.  Every band of bins is a bucket, ``similar.BANDS`` of them a document.  A bucket's smallest row is its hub; the
candidate edges are those from the hub to each other row, so a bucket of n rows gives n - 1 of them and not n squared.  Pairs
whose sizes alone rule a link out are not made.  Each edge is confirmed on the full sets of both ends: the task of a hub holds
the hub's set and streams the members', and a hub of many members is dealt out over several tasks.

The rest.  Two members of a bucket may be alike though neither is like the hub.  Rows that confirmed stars have joined are one *part*;
buckets that still hold several parts are searched by ``similar.exact_links``, which goes on from row to row until no pair of
different parts is left unlooked at, again on full sets.  A pair at similarity 0.85 shares no band with probability 0.00001.

Sets are those of 64-bit hashes, made from the texts of only the documents that share a bucket with another.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import minhash
from tracewell.llm.common import planned_partitions, stored
from tracewell.llm.components import components, named_groups
from tracewell.llm.similar import BANDS, Judge, band_keys, exact_links, jaccard_many, text_hash

SIMILARITY = 0.85
#: Members of a hub that one task confirms.
STAR_ROWS = 4096


def row_key() -> Column:
    return F.xxhash64("doc_id", "text_hash")


def prints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, fp, own) of every row: a hash of the whole set and the packed MinHash, both null without words."""
    from xxhash import xxh64_intdigest

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = minhash.fingerprinter()
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part, n, fp, own = batch.slice(first, 256), [], [], []
                for text in part.column(2):
                    hashes = np.unique(made.shingles(made.words(text.as_py())))
                    n.append(len(hashes))
                    fp.append(xxh64_intdigest(hashes.tobytes()) - (1 << 63) if len(hashes) else None)
                    own.append(made.packed(hashes))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array(fp, pa.int64()), pa.array(own, pa.binary())], ["doc_id", "text_hash", "n_shingles", "fp", "own"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(compute, "doc_id long, text_hash long, n_shingles long, fp long, own binary")


def stars(distinct: DataFrame, similarity: float) -> DataFrame:
    """(hub, fp, fits): in every bucket of two rows or more of distinct (fp, own, n_shingles), each row beside the smallest; fits where
    their sizes allow a link. The hub beside itself does not fit."""
    cells = distinct.select(F.explode(band_keys(range(BANDS))).alias("cell"), "fp", "n_shingles")
    hubs = cells.groupBy("cell").agg(F.min(F.struct("fp", "n_shingles")).alias("hub"), F.count("*").alias("n")).filter("n > 1").select("cell", "hub")
    least, most = F.least("n_shingles", "hub.n_shingles"), F.greatest("n_shingles", "hub.n_shingles")
    fits = (F.col("fp") != F.col("hub.fp")) & (least / most >= similarity)
    return cells.join(hubs, "cell").select(F.col("hub.fp").alias("hub"), "fp", fits.alias("fits")).distinct()


def sets_of_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(fp, shingles): the ascending 64-bit hashes of the sets of rows (row_key, fp), from their texts. One row for each of rows, though
    documents repeat: repeated ones lie together and the first counts."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, before = minhash.fingerprinter(), None
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                fps, sets = [], []
                for fp, text in zip(*(batch.column(k).slice(first, 256) for k in range(2))):
                    if (fp := fp.as_py()) != before:
                        fps.append(fp)
                        sets.append(np.unique(made.shingles(made.words(text.as_py()))).tobytes())
                    before = fp
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.int64()), pa.array(sets, pa.binary())], ["fp", "shingles"])

    parts = planned_partitions(docs)
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text").select(row_key().alias("row_key"), "text")
    found = keyed.repartition(parts, "row_key").join(rows.repartition(parts, "row_key"), "row_key").sortWithinPartitions("row_key").select("fp", "text")
    return found.mapInArrow(compute, "fp long, shingles binary")


def confirmed(edges: DataFrame, sets: DataFrame, judge: Judge) -> DataFrame:
    """(a, b): the edges (hub, fp) whose sets (fp, shingles) are similar. A task holds one hub's set and streams its members'; a hub of
    more than STAR_ROWS members goes to as many tasks as it needs."""
    blocks = edges.groupBy("hub").agg(F.ceil(F.count("*") / STAR_ROWS).alias("blocks"))
    members = edges.join(blocks, "hub").select("hub", "fp", F.pmod(F.xxhash64("hub", "fp"), F.col("blocks")).alias("block"))
    hubs = blocks.select("hub", F.col("hub").alias("fp"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    rows = members.unionByName(hubs).join(sets, "fp").repartition("hub", "block").sortWithinPartitions("hub", "block", F.col("fp") != F.col("hub"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, at = None, None
        for batch in batches:
            a, b = [], []
            for hub, fp, shingles in zip(*(batch.column(k) for k in range(3))):
                hub, fp, held = hub.as_py(), fp.as_py(), np.frombuffer(shingles.as_py(), judge.kind)
                if fp == hub:
                    own, at = held, hub
                elif hub == at and jaccard_many(own, [held])[0] >= judge.similarity:
                    a.append(hub)
                    b.append(fp)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return rows.select("hub", "fp", "shingles").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of docs: documents whose sets of distinct five-word shingles (words are runs of
    other characters than ASCII white space, A-Z in lower case; fewer than five words are one shingle) have at least that Jaccard
    similarity are linked, and component_id is the smallest doc_id reachable over links, itself included.

    Null and empty texts, and those without a word, have no shingles and are linked with nothing. A row without a doc_id is grouped like
    any other; its component_id is the smallest doc_id of its group, null where there is none, and it is kept only then. Rows of one
    doc_id are each judged by their own text, repeated rows are each returned, an empty table gives an empty result, and other columns
    are not looked at.
    """
    judge = Judge(similarity, kind=np.uint64, confirm=True)
    found = stored(prints(docs), "prints")
    # of equal sets one text stands for all: which one does not matter
    distinct = found.filter("fp IS NOT NULL").groupBy("fp").agg(F.first("own").alias("own"), F.first("n_shingles").alias("n_shingles"), F.min("doc_id").alias("least"), F.min(row_key()).alias("row_key"))
    distinct = stored(distinct, "distinct")
    star = stored(stars(distinct, similarity), "stars")
    shared = stored(distinct.join(star.select("fp").distinct(), "fp", "left_semi"), "shared")
    sets = stored(sets_of_rows(docs, shared.select("row_key", "fp")), "sets")
    first = stored(confirmed(star.filter("fits").select("hub", "fp"), sets, judge), "confirmed")
    parts = shared.select("fp", "own", (F.col("n_shingles") * 8 + 256).alias("n_bytes")).join(components(first).toDF("fp", "part"), "fp", "left").withColumn("part", F.coalesce("part", "fp"))
    second = exact_links(stored(parts, "parts"), lambda needed: sets.join(needed, "fp", "left_semi"), judge)
    groups = named_groups(distinct.select("fp", "least"), first.unionByName(second))
    own = found.select("doc_id", "n_shingles", "fp")
    grouped = own.filter("fp IS NOT NULL").join(groups, "fp").select("doc_id", "n_shingles", "component_id")
    alone = own.filter("fp IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return grouped.unionByName(alone).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


#: All pairs that share a shingle, then reachability.
ORACLE_SQL = """
WITH RECURSIVE worded AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
  FROM worded),
shingles AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(x) AS h FROM (SELECT doc_id, s, unnest(s) AS x FROM sets)),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM shingles a JOIN shingles b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs WHERE 100 * common >= 85 * (na + nb - common)),
both_ways AS MATERIALIZED (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT a AS doc_id, a AS other FROM both_ways UNION
  SELECT r.doc_id, e.b FROM reach r JOIN both_ways e ON r.other = e.a),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component_id, s.doc_id) AS component_id, coalesce(l.component_id, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN least l USING (doc_id)
"""
