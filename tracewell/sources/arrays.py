"""One JSON array out of many tasks: parts with byte counts, an index that makes them count, and the array's file by offsets.

Every task writes the elements of its partition to a file of its own attempt.  When all have ended, the driver writes ``_index.json``
in one move: it names the files that count, in the order of partitions, their rows and bytes, and the place of each in the array,
a prefix sum.  Until then, and after a failure, the folder holds what it held before; files of failed attempts are never named.
``assemble`` puts the parts into one file, each task copying its part to its place.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from tracewell.sources import files

INDEX, FORMAT = "_index.json", "tracewell_json_array"
OPENING, BETWEEN, CLOSING = b"[\n", b",\n", b"\n]\n"


@dataclass
class Part(WriterCommitMessage):
    partition: int
    name: str
    rows: int
    bytes: int


class ArrayWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite, self.run = path, overwrite, uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"part-{context.partitionId():06d}-{self.run}-{context.taskAttemptId()}.json"
        rows = size = 0
        system, path = files.filesystem(self.path)
        out = None
        for batch in iterator:
            for first in range(0, batch.num_rows, 1024):
                own = [t.encode("utf-8", "surrogatepass") for t in batch.column(0).slice(first, 1024).to_pylist()]
                if out is None:
                    system.create_dir(path, recursive=True)
                    out = system.open_output_stream(f"{path}/{name}")
                block = (BETWEEN if rows else b"") + BETWEEN.join(own)
                out.write(block)
                rows, size = rows + len(own), size + len(block)
        if out:
            out.close()
        return Part(context.partitionId(), name, rows, size)

    def commit(self, messages: list[Part | None]) -> None:
        before = index(self.path) if self.overwrite else None
        parts, at = [], len(OPENING)
        for m in sorted((m for m in messages if m and m.rows), key=lambda m: m.partition):
            at += len(BETWEEN) if parts else 0
            parts.append({"name": m.name, "rows": m.rows, "bytes": m.bytes, "offset": at})
            at += m.bytes
        system, path = files.filesystem(self.path)
        system.create_dir(path, recursive=True)
        files.put(self.path, INDEX, json.dumps({"form": "array", "rows": sum(p["rows"] for p in parts), "bytes": at + len(CLOSING), "parts": parts}).encode())
        files.delete(self.path, [p["name"] for p in (before or {"parts": []})["parts"]])

    def abort(self, messages: list[Part | None]) -> None:
        files.delete(self.path, [m.name for m in messages if m and m.rows])


class ArraySource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        if schema.simpleString() != "struct<value:string>":
            raise ValueError("the array's elements are one column of JSON text, value")
        if not overwrite and files.read(self.options["path"], INDEX) is not None:
            raise ValueError(f"{self.options['path']} holds an array already")
        return ArrayWriter(self.options["path"], overwrite)


def index(path: str) -> dict | None:
    """The index of a folder, null where no array has been written to it."""
    own = files.read(path, INDEX)
    return None if own is None else json.loads(own)


def write(df: DataFrame, path: str, order: list[Column | str] | None = None) -> None:
    """Writes df's rows to a folder as the elements of one array, nulls kept, in the order given (else that of partitions), in the place of
    what the folder held. Null rows and columns of any type stand as to_json writes them; an empty df gives an empty array."""
    spark = df.sparkSession
    spark.dataSource.register(ArraySource)
    rows = df.orderBy(*order) if order else df
    rows.select(F.to_json(F.struct(*(F.col(f"`{c}`") for c in df.columns)), {"ignoreNullFields": "false"}).alias("value")).write.format(FORMAT).mode("overwrite").option("path", path).save()


def scan(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The elements of an array folder, parts read line by line, so that they split."""
    own = index(path) or {"parts": []}
    if not own["parts"]:
        return spark.createDataFrame([], schema)
    return elements(spark.read.text([f"{path}/{p['name']}" for p in own["parts"]]), schema)


def elements(lines: DataFrame, schema: str) -> DataFrame:
    """lines (value): an element each, with or without the comma behind it."""
    return lines.select(F.from_json(F.regexp_replace("value", ",\\z", ""), schema).alias("r")).select("r.*")


def element_lines(spark: SparkSession, path: str) -> DataFrame | None:
    """The lines (value) that hold the elements of a file of one array, or of a folder of such files; null unless in every file all elements
    are objects in lines of their own, between a line that opens the array and one that closes it. JSON has no line break within a string,
    so each line tells by itself whether it is whole: outside its strings, its brackets are all closed once, at its end. The file is read once for that,
    by as many tasks as it splits into; a reader of whole arrays holds all rows of one in a task."""
    lines = spark.read.text(path)
    if lines.columns != ["value"]:  # folders by a column's values
        return None
    line = F.btrim("value", F.lit(" \t"))
    # what stands outside strings: every second piece between quotes, when escaped backslashes and quotes are gone
    pieces = F.split(F.replace(F.replace(line, F.lit("\\\\"), F.lit("")), F.lit('\\"'), F.lit("")), '"', -1)
    brackets = F.regexp_replace(F.array_join(F.filter(pieces, lambda _, k: k % 2 == 0), ""), "[^\\[\\]{}]", "")

    def deeper(a: Column, c: Column) -> Column:
        depth = a["depth"] + F.when(c.isin("{", "["), 1).otherwise(-1)
        return F.struct(depth.alias("depth"), (a["ends"] + F.when(depth == 0, 1).otherwise(0)).alias("ends"))

    once = F.aggregate(F.split(brackets, ""), F.struct(F.lit(0).alias("depth"), F.lit(0).alias("ends")), deeper, lambda a: (a["depth"] == 0) & (a["ends"] == 1))
    whole = F.startswith(line, F.lit("{")) & (F.endswith(line, F.lit("}")) | F.endswith(line, F.lit("},"))) & (F.size(pieces) % 2 == 1) & F.when(brackets == "{}", True).otherwise(once)
    kind = F.when(line == "[", "[").when(line == "]", "]").when(whole, F.when(F.endswith(line, F.lit(",")), "{,").otherwise("{"))
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    told = lines.select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"), kind.alias("kind")).filter(line != "")
    own = told.groupBy("file").agg(
        F.count_if(F.expr("kind IS NULL")).alias("other"), F.count_if(F.expr("kind = '['")).alias("opened"), F.count_if(F.expr("kind = ']'")).alias("closed"), F.count_if(F.expr("kind = '{'")).alias("last"), F.count_if(F.expr("kind = '{,'")).alias("rest"),
        F.min_by("kind", "place").alias("first"), F.max_by("kind", "place").alias("end"), F.max(F.when(F.expr("kind = '{'"), F.col("place"))).alias("at"), F.max(F.when(F.expr("kind = '{,'"), F.col("place"))).alias("before"),
    )
    fits = "other = 0 AND opened = 1 AND closed = 1 AND first = '[' AND end = ']' AND last = CASE WHEN rest > 0 THEN 1 ELSE last END AND last <= 1 AND (before IS NULL OR before < at)"
    files = own.agg(F.count("*").alias("n"), F.count_if(F.expr(fits)).alias("fit")).first()
    return lines.select(line.alias("value")).filter(F.startswith("value", F.lit("{"))) if files["n"] and files["n"] == files["fit"] else None


def assemble(spark: SparkSession, path: str, file: str) -> None:
    """Makes one file of the array, whole or not at all: each part is copied to its offset by a task of its own. Both the folder and the
    file must be on a disk that all executors have mounted, as other stores cannot be written in places."""
    from pyarrow import fs

    own = index(path)
    if own is None:
        raise FileNotFoundError(f"{path} holds no array")
    (system, target), parts = files.filesystem(file), own["parts"]
    if not isinstance(system, fs.LocalFileSystem):
        raise ValueError("an array's one file needs a mounted disk; elsewhere read its folder")
    unfinished = f"{target}.{uuid.uuid4().hex}.tmp"
    with open(unfinished, "wb") as f:
        f.write(OPENING)
        f.seek(own["bytes"] - len(CLOSING) if parts else len(OPENING))
        f.write(CLOSING if parts else CLOSING[1:])

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        source, folder = files.filesystem(path)
        for batch in batches:
            for k in batch.column(0).to_pylist():
                with source.open_input_file(f"{folder}/{parts[k]['name']}") as f, open(unfinished, "r+b") as out:
                    out.seek(parts[k]["offset"] - (len(BETWEEN) if k else 0))
                    if k:
                        out.write(BETWEEN)
                    while block := f.read(8 << 20):
                        out.write(block)
            yield batch

    done = spark.range(0, len(parts), 1, max(1, min(len(parts), 10_000))).mapInArrow(copy, "id long").count() if parts else 0
    if done != len(parts):
        raise OSError(f"{len(parts) - done} parts were not copied")
    os.replace(unfinished, target)
