"""What the operators of this subpackage share: the shared folder, written intermediate tables, ordered partitions."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where the session has none, a temporary one in local mode, as in
    tests; on a cluster an error, since executors cannot see a folder of the driver's machine."""
    there = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not there:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        there = f"file://{tempfile.mkdtemp(prefix='tracewell-')}"
        spark.sparkContext.setCheckpointDir(there)
    return there.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tracewell/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written as Parquet to the shared folder and read back: the plan behind it is cut, and a lost executor costs
    only what it was reading."""
    spark, path = df.sparkSession, fresh_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def planned_partitions(df: DataFrame, bytes_each: int = 64 << 20, most: int = 4096) -> int:
    """Partitions for a shuffle of df that keeps each to about bytes_each, no fewer than the session's number and, as their
    bounds stand in the plan, at most ``most`` beyond it. Their tasks read streams, so that larger ones only take longer."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, min(most, -(-size // bytes_each) if size < 1 << 60 else least))


def order_bounds(df: DataFrame, column: str, parts: int) -> list[int]:
    """At most parts - 1 ascending values of an integer column that cut its rows into nearly equal parts. One scan of that
    column; what reaches the driver is bounded by the number of partitions."""
    if parts < 2:
        return []
    at = F.percentile_approx(column, F.array(*(F.lit(k / parts) for k in range(1, parts))), max(10_000, 20 * parts))
    found = df.agg(at.alias("at")).first()["at"] or []
    return sorted(set(found))


def part_of(column: str, bounds: list[int]) -> Column:
    """The part of a row: how many bounds are at or below its value; nulls are in part 0."""
    value = F.col(column).cast("long")
    if not bounds:
        return F.lit(0)
    tree = lambda low, high: F.lit(low) if low == high else F.when(value < bounds[(low + high) // 2], tree(low, (low + high) // 2)).otherwise(tree((low + high) // 2 + 1, high))
    return F.when(value.isNull(), 0).otherwise(tree(0, len(bounds)))


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of these 64-bit hashes, 0 of none: their SimHash, unsigned."""
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def ascii_lower(text: Column) -> Column:
    """Lower case of A to Z only."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sweep(spark: SparkSession) -> None:
    """Deletes all intermediate tables and token files under the shared folder; results that read them must be written before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/tracewell")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
