"""One-permutation MinHash fingerprints of documents, packed to low-order bits.

The hashes of a document's word shingles are thrown once into BINS bins; a bin keeps its smallest.  Empty bins are filled by
optimal densification: each bin has its own fixed pseudo-random order of the other bins and borrows from the first that is
full.  Of each bin's value, mixed with the bin's number (so that two short documents do not agree in all bins by one
chance), BITS low-order bits are stored.  Two fingerprints agree in a bin with probability J + (1 - J) / 2^BITS; the
estimate takes that bias out.

The digest of a fingerprint is hexadecimal: "00" for a document without words, else "01", and then the packed bins.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import order_bounds, part_of, planned_partitions

BINS, BITS, SHINGLE = 512, 4, 5
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: shifts and odd multipliers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: For each bin, all bins in a fixed pseudo-random order.
_ORDER = np.argsort(_mixed(np.arange(BINS * BINS, dtype=np.uint64) * _MIX + np.uint64(7)).reshape(BINS, BINS), axis=1).astype(np.int32)
_BIN_KEYS = _mixed(np.arange(BINS, dtype=np.uint64) * _MIX + np.uint64(11))


class Fingerprinter:
    """of(words(text)) -> packed bins as bytes, None for a text without words."""

    def __init__(self, table_size: int = 150_000):
        self.table: dict[bytes, int] = {}
        self.table_size = table_size

    def words(self, text: str | None) -> np.ndarray:
        """Hashes of the words (lower case of A-Z, cut at ASCII white space)."""
        from xxhash import xxh64_intdigest

        words = (text or "").encode("utf-8", "surrogatepass").lower().split()
        try:
            return np.fromiter(map(self.table.__getitem__, words), np.uint64, len(words))
        except KeyError:
            new = set(words).difference(self.table)
            if len(self.table) + len(new) > self.table_size:
                self.table.clear()
                new = set(words)
            self.table.update((w, xxh64_intdigest(w)) for w in new)
            found = np.fromiter(map(self.table.__getitem__, words), np.uint64, len(words))
            if len(self.table) > self.table_size:
                self.table.clear()
            return found

    def shingles(self, words: np.ndarray) -> np.ndarray:
        """Hashes of the shingles, repeats included: of all words where there are fewer than SHINGLE."""
        if not len(words):
            return np.zeros(0, np.uint64)
        width = min(SHINGLE, len(words))
        hashes = np.zeros(len(words) - width + 1, np.uint64)
        for k in range(width):  # a polynomial of the words' hashes, so that order counts
            hashes = hashes * _MIX + words[k : len(words) - width + 1 + k]
        return _mixed(hashes)

    def of(self, words: np.ndarray) -> bytes | None:
        return self.packed(self.shingles(words))

    def packed(self, hashes: np.ndarray) -> bytes | None:
        if not len(hashes):
            return None
        bins = np.full(BINS, np.iinfo(np.uint64).max, np.uint64)
        np.minimum.at(bins, (hashes >> np.uint64(55)).astype(np.int64), hashes)
        full = np.zeros(BINS, bool)
        full[(hashes >> np.uint64(55)).astype(np.int64)] = True
        empty, values = np.flatnonzero(~full), bins.copy()
        at, step = 0, max(8, min(BINS, 2 * BINS // int(full.sum())))
        while len(empty):
            tried = _ORDER[empty, at : at + step]
            hit = full[tried]
            found = hit.any(1)
            values[empty[found]] = bins[tried[found, hit[found].argmax(1)]]
            empty, at = empty[~found], at + step
        low = (_mixed(values ^ _BIN_KEYS) & np.uint64((1 << BITS) - 1)).astype(np.uint8)
        return (low[0::2] << BITS | low[1::2]).tobytes()


@lru_cache(maxsize=1)
def fingerprinter() -> Fingerprinter:
    """This process's own, with the words that its last tasks met."""
    return Fingerprinter()


def likeness(a: bytes | None, b: bytes | None) -> float:
    """The estimated Jaccard similarity of two documents' shingle sets: 1 of two empty ones, 0 of one with an empty one."""
    if a is None or b is None:
        return float(a is b)
    x = np.frombuffer(a, np.uint8) ^ np.frombuffer(b, np.uint8)
    equal = ((x >> BITS == 0).sum() + (x & ((1 << BITS) - 1) == 0).sum()) / BINS
    chance = 1 / (1 << BITS)
    return min(1.0, max(0.0, float(equal - chance) / (1 - chance)))


def digest(own: bytes | None) -> str:
    return "00" + "0" * (BINS * BITS // 4) if own is None else "01" + own.hex()


def undigest(text: str) -> bytes | None:
    return bytes.fromhex(text[2:]) if text.startswith("01") else None


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row of docs; null texts count as empty."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = fingerprinter()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([digest(made.of(made.words(t.as_py()))) for t in batch.column(1)], pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(compute, "doc_id long, fingerprint string")


def with_edits(docs: DataFrame) -> DataFrame:
    """Every document beside its edited text and the next document, by ascending doc_id (ties by text; nulls first).

    The edited text is the document with its last floor(n_chars / 2) code points replaced by the first as many (or all) of
    the next document; after the last comes the first, and a single document is its own next. Returns doc_id, n_chars,
    edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next. Null texts count as empty, repeated rows follow
    one another, an empty table gives an empty result, other columns are not looked at.

    One shuffle: rows go to the part of their doc_id's range. The first document of each part goes, besides, to the end of
    the part before it, so every task finds its last document's next one at hand.
    """
    bounds = order_bounds(docs, "doc_id", planned_partitions(docs))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), part_of("doc_id", bounds).alias("part"))
    heads = sorted((r["part"], r["first"], r["null"]) for r in rows.groupBy("part").agg(F.min("doc_id").alias("first"), F.max(F.col("doc_id").isNull()).alias("null")).collect())  # a row a part
    if not heads:
        heads = [(0, None, True)]
    table = docs.sparkSession.createDataFrame([(part, first, null, heads[k - 1][0]) for k, (part, first, null) in enumerate(heads)], "part int, first long, null boolean, before int")
    rows = rows.join(F.broadcast(table), "part")
    is_head = F.when(F.col("null"), F.col("doc_id").isNull()).otherwise(F.col("doc_id") == F.col("first"))
    own, to_next = F.struct("part", F.lit(False).alias("next")), F.struct(F.col("before").alias("part"), F.lit(True).alias("next"))
    rows = rows.select("doc_id", "text", F.explode(F.when(is_head, F.array(own, to_next)).otherwise(F.array(own))).alias("to")).select("doc_id", "text", "to.part", "to.next")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, before, ended = fingerprinter(), None, False
        for batch in batches:
            for first in range(0, batch.num_rows, 1024):  # so that little of the output stands in memory at once
                out: list[tuple] = []
                for doc_id, text, is_next in zip(*(batch.column(k).slice(first, 1024) for k in range(3))):
                    if ended:
                        break
                    text, ended = text.as_py(), is_next.as_py()
                    own = made.of(made.words(text))
                    if before is not None:
                        last_id, last, last_own = before
                        half = len(last) // 2
                        edited = last[: len(last) - half] + text[:half]
                        other = made.of(made.words(edited))
                        out.append((last_id, len(last), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), digest(last_own), digest(other), likeness(last_own, other), likeness(last_own, own)))
                    before = (doc_id.as_py(), text, own)
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    dealt = rows.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("next", "doc_id", "text").select("doc_id", "text", "next")
    return dealt.mapInArrow(compute, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
