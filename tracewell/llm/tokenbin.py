"""Token ids as flat binary files with document offsets, written in document order and read back memory-mapped.

A folder holds, for each part of the document order, ``NAME.ids`` (unsigned integers, 16 bits where the vocabulary allows,
else 32), ``NAME.offsets`` (64-bit: where each document's ids begin in the part, and the part's end) and ``NAME.docs`` (64-bit
document ids, with nulls as the smallest integer), and ``index.json``: width, and of each part its name, documents, ids and
*base*, the ids of all parts before it, a prefix sum of the parts' counts.  All are little-endian.

One shuffle: rows go to the part of their doc_id's range, sorted there; each task tokenizes its rows as a stream and
writes its own files under a name of its attempt.  The index names the files of the attempts whose results Spark took; files
of failed or speculative attempts stay unread and are never moved over others.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import tokenize
from tracewell.llm.common import fresh_path, order_bounds, part_of, planned_partitions

NULL_ID = np.iinfo(np.int64).min
#: Offsets that a reading task holds at once.
READ_DOCS = 1 << 16


def filesystem(uri: str):
    """(file system, path) of a folder's URI; a local path stands for itself."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def mapped(uri: str, name: str, kind: str) -> np.ndarray:
    """A file of the folder as an array: memory-mapped where the folder is a local or mounted one."""
    from pyarrow import fs

    system, path = filesystem(uri)
    if system.get_file_info(f"{path}/{name}").size == 0:
        return np.zeros(0, kind)
    if isinstance(system, fs.LocalFileSystem):
        return np.memmap(f"{path}/{name}", kind, "r")
    with system.open_input_file(f"{path}/{name}") as f:
        return np.frombuffer(f.read(), kind)


def write(docs: DataFrame, uri: str, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2) -> dict:
    """Writes docs in ascending doc_id order (ties by text, nulls first) to the folder and returns its index.

    A null text counts as empty: its ids are the end id alone. Rows repeating a doc_id are written each. An empty table
    gives a folder with an index of no parts. Other columns of docs are not looked at.
    """
    parts = planned_partitions(docs)
    bounds = order_bounds(docs, "doc_id", parts)

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, tokenizer = TaskContext.get(), tokenize.tokenizer(vocabulary)
        kind = "<u2" if max(tokenizer.n_vocab, end_id + 1) <= 1 << 16 else "<u4"
        system, path = filesystem(uri)
        name = f"part-{context.partitionId():06d}-{context.taskAttemptId()}"
        n_docs = n_ids = 0
        files: dict = {}
        for batch in batches:
            if not files:
                files = {x: system.open_output_stream(f"{path}/{name}.{x}") for x in ("ids", "offsets", "docs")}
                files["offsets"].write(np.zeros(1, "<u8").tobytes())
            for block in tokenize.blocks(t.as_py() for t in batch.column(1)):
                found = [np.append(ids, np.uint32(end_id)).astype(kind) for ids in tokenizer.ids(block)]
                files["ids"].write(np.concatenate(found).tobytes())
                files["offsets"].write((n_ids + np.cumsum([len(x) for x in found])).astype("<u8").tobytes())
                n_ids += sum(map(len, found))
            files["docs"].write(batch.column(0).fill_null(NULL_ID).to_numpy().astype("<i8").tobytes())
            n_docs += batch.num_rows
        for f in files.values():
            f.close()
        if n_docs:
            yield pa.RecordBatch.from_pylist([{"part": context.partitionId(), "name": name, "n_docs": n_docs, "n_ids": n_ids, "width": int(kind[2:])}])

    system, path = filesystem(uri)
    system.create_dir(path, recursive=True)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", part_of("doc_id", bounds).alias("part"))
    rows = rows.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("doc_id", "text").drop("part")
    done = sorted(rows.mapInArrow(put, "part long, name string, n_docs long, n_ids long, width long").collect())  # one row a part
    bases = np.concatenate([[0], np.cumsum([r["n_ids"] for r in done])]).astype(int).tolist()
    index = {"width": done[0]["width"] if done else 2, "parts": [{"name": r["name"], "base": b, "n_docs": r["n_docs"], "n_ids": r["n_ids"]} for r, b in zip(done, bases)]}
    with system.open_output_stream(f"{path}/index.json") as f:
        f.write(json.dumps(index).encode())
    return index


def documents(spark: SparkSession, uri: str) -> DataFrame:
    """The folder's documents, from its files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of its
    ids as little-endian unsigned 32-bit integers). A task reads one part, mapped, some documents at a time."""
    system, path = filesystem(uri)
    with system.open_input_file(f"{path}/index.json") as f:
        index = json.loads(f.read())
    parts, kind = index["parts"], f"<u{index['width']}"

    def get(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in batch.column(0).to_pylist():
                part = parts[k]
                ids, offsets, docs = (mapped(uri, f"{part['name']}.{x}", t) for x, t in (("ids", kind), ("offsets", "<u8"), ("docs", "<i8")))
                for a in range(0, part["n_docs"], READ_DOCS):
                    cuts = np.array(offsets[a : a + READ_DOCS + 1]).astype(np.int64)
                    crc = [zlib.crc32(ids[x:y].astype("<u4").tobytes()) for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist())]
                    own = np.array(docs[a : a + READ_DOCS])
                    yield pa.RecordBatch.from_arrays([pa.array(own, mask=own == NULL_ID), pa.array(cuts[:-1] + part["base"]), pa.array(np.diff(cuts)), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return spark.range(0, len(parts), 1, max(1, len(parts))).mapInArrow(get, "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2) -> DataFrame:
    """Writes docs to a new folder under the shared one and returns what its files say."""
    uri = fresh_path(docs.sparkSession, "token-files")
    write(docs, uri, vocabulary, end_id)
    return documents(docs.sparkSession, uri)
