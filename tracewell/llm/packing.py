"""Packing token sequences into windows of a fixed length by best-fit decreasing.

A document's ids (with the end id) are first cut into full windows; what is left over, shorter than a window, is a piece
to be packed.  Pieces are dealt out by a hash of their content, and each task packs its stream in chunks: longest piece
first, into the open sequence with the least room that still holds it.  Open sequences stand in a segment tree over
remaining capacity, so the tightest one is found in log2(window) steps.  The emptiest sequences that a chunk
leaves, half a chunk of pieces at most, are opened again for the next one; after the last, the emptiest are dissolved into the room of the others, cutting pieces
where they must be, so a task ends with about as many sequences as its ids need.

A task holds one chunk (``CHUNK_PIECES`` pieces of less than a window), however many rows its partition has.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm import tokenize

CHUNK_PIECES = 16_384
#: Characters of a block of texts, whose distinct words are looked up once.
BLOCK_CHARS = 1 << 20
#: Room (as a part of the window) above which a chunk's sequence is opened again.
REOPEN = 0.02
#: Shortest fragment that the end of a task cuts a piece into.
LEAST_CUT = 16


class CapacityTree:
    """Open sequences by remaining capacity 0..top: a segment tree of counts over stacks of sequence numbers."""

    def __init__(self, top: int):
        self.leaves = 1 << top.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.stacks: list[list[int]] = [[] for _ in range(top + 1)]

    def add(self, capacity: int, sequence: int) -> None:
        self.stacks[capacity].append(sequence)
        node = capacity + self.leaves
        while node:
            self.count[node] += 1
            node >>= 1

    def take(self, least: int) -> tuple[int, int] | None:
        """Removes and returns (sequence, its capacity) of the smallest capacity of at least ``least``."""
        node = least + self.leaves
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node + (not self.count[2 * node])
        capacity = node - self.leaves
        while node:
            self.count[node] -= 1
            node >>= 1
        return self.stacks[capacity].pop(), capacity


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Sequences as lists of indices of lengths (each 1..window)."""
    tree, out = CapacityTree(window), []
    for k in sorted(range(len(lengths)), key=lambda k: -lengths[k]):
        found = tree.take(lengths[k])
        if found is None:
            found = (len(out), window)
            out.append([])
        sequence, capacity = found
        out[sequence].append(k)
        if capacity > lengths[k]:
            tree.add(capacity - lengths[k], sequence)
    return out


Piece = tuple[int | None, int, bytes, int]  # doc_id, start, ids, doc_tokens


def dissolve(sequences: list[list[Piece]], window: int, width: int) -> list[list[Piece]]:
    """Empties the least full sequences into the room of the others, as far as the number needed allows."""
    fill = [sum(len(p[2]) for p in s) // width for s in sequences]
    needed = -(-sum(fill) // window)
    order = sorted(range(len(sequences)), key=lambda k: -fill[k])
    kept, donors = order[:needed], order[needed:]
    room = sorted(([window - fill[k], k] for k in kept if window - fill[k] >= LEAST_CUT), reverse=True)
    left: list[Piece] = []
    for piece in sorted((p for k in donors for p in sequences[k]), key=lambda p: -len(p[2])):
        doc, start, ids, total = piece
        while ids and room:
            space, k = room[0]
            n = min(space, len(ids) // width)
            if 0 < len(ids) // width - n < LEAST_CUT:
                n = max(1, n - LEAST_CUT)
            sequences[k].append((doc, start, ids[: n * width], total))
            start, ids = start + n, ids[n * width :]
            room[0][0] -= n
            if room[0][0] < LEAST_CUT:
                room.pop(0)
            else:
                room.sort(reverse=True)
        if ids:
            left.append((doc, start, ids, total))
    out = [sequences[k] for k in kept]
    return out + [[left[k] for k in s] for s in best_fit_decreasing([len(p[2]) // width for p in left], window)]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, window: int) -> DataFrame:
    """Tokenized documents cut into windows: doc_id, start, ids (little-endian unsigned, 16 bits where the vocabulary
    allows, else 32), doc_tokens, bits, and deal, a hash of the piece."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenize.tokenizer(vocabulary)
        kind = np.dtype("<u2" if max(tokenizer.n_vocab, end_id + 1) <= 1 << 16 else "<u4")
        for batch in batches:
            at = 0
            for block in tokenize.blocks((t.as_py() for t in batch.column(1)), BLOCK_CHARS):
                doc, start, data, total, deal = [], [], [], [], []
                for k, ids in enumerate(tokenizer.ids(block), at):
                    ids = np.append(ids, np.uint32(end_id)).astype(kind)
                    doc_id = batch.column(0)[k].as_py()
                    for s in range(0, len(ids), window):
                        raw = ids[s : s + window].tobytes()
                        doc.append(doc_id)
                        start.append(s)
                        data.append(raw)
                        total.append(len(ids))
                        deal.append(zlib.crc32(raw, hash((doc_id, s)) & 0xFFFFFFFF))
                at += len(block)
                yield pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(data, pa.binary()), pa.array(total, pa.int64()), pa.array([8 * kind.itemsize] * len(doc), pa.int32()), pa.array(deal, pa.int64())], ["doc_id", "start", "ids", "doc_tokens", "bits", "deal"])
        tokenizer.rest()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(cut, "doc_id long, start long, ids binary, doc_tokens long, bits int, deal long")


def pack(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", end_id: int = 1, window: int = 2048) -> DataFrame:
    """One row a piece: doc_id, start (its document's ids before it), length, ids (binary, little-endian unsigned of ``bits``
    bits), bits, doc_tokens, sequence_id, offset (its place in the sequence, gapless from 0).

    A null or empty text is one piece, the end id alone. A null doc_id stays null. Repeated rows are packed each for itself.
    An empty table gives no sequences. Other columns of docs are not looked at. Sequence numbers are unique, not gapless.
    """

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, bits, width = TaskContext.get().partitionId() << 32, 16, 2
        open_pieces: list[Piece] = []

        def emit(sequences: list[list[Piece]]) -> pa.RecordBatch:
            nonlocal number
            rows = []
            for sequence in sequences:
                offset = 0
                for doc, start, ids, total in sequence:
                    rows.append((doc, start, len(ids) // width, ids, bits, total, number, offset))
                    offset += len(ids) // width
                number += 1
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], ["doc_id", "start", "length", "ids", "bits", "doc_tokens", "sequence_id", "offset"])

        def packed(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal open_pieces
            found = [[open_pieces[k] for k in s] for s in best_fit_decreasing([len(p[2]) // width for p in open_pieces], window)]
            if last:
                open_pieces = []
                yield emit(dissolve(found, window, width))
            else:
                found.sort(key=lambda s: sum(len(p[2]) for p in s))  # the emptiest are opened again, as far as half a chunk of pieces goes
                again, keep = 0, 0
                while keep < len(found) and again + len(found[keep]) <= CHUNK_PIECES // 2 and sum(len(p[2]) for p in found[keep]) < window * width * (1 - REOPEN):
                    again, keep = again + len(found[keep]), keep + 1
                yield emit(found[keep:])
                open_pieces = [p for s in found[:keep] for p in s]

        for batch in batches:
            whole = []
            for doc, start, ids, total, bits in zip(*(batch.column(k).to_pylist() for k in range(5))):
                width = bits // 8
                if len(ids) == window * width:
                    whole.append([(doc, start, ids, total)])
                else:
                    open_pieces.append((doc, start, ids, total))
                if len(open_pieces) >= CHUNK_PIECES:
                    yield from packed(False)
            if whole:
                yield emit(whole)
        if open_pieces:
            yield from packed(True)

    cut = pieces(docs, vocabulary, end_id, window).repartition("deal").sortWithinPartitions("deal", "doc_id", "start").drop("deal")
    return cut.mapInArrow(fill, "doc_id long, start long, length long, ids binary, bits int, doc_tokens long, sequence_id long, offset long")


def digest(packed: DataFrame) -> DataFrame:
    """packed with ids_crc32 (of the ids as little-endian unsigned 32-bit integers) in place of ids and bits."""

    def crc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [zlib.crc32(np.frombuffer(ids, f"<u{bits // 8}").astype("<u4").tobytes()) for ids, bits in zip(batch.column(3).to_pylist(), batch.column(4).to_pylist())]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(found, pa.int64()), *(batch.column(k) for k in range(5, 8))], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    return packed.mapInArrow(crc, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
