"""Sinks: catalog CSV, id lists, JSON documents, snapshots of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.operators.selection import snapshot
from tracewell.sources import arrays


def catalog_csv(catalog: DataFrame, path: str) -> None:
    """Header, tags joined by bars, card data as JSON."""
    rows = catalog.withColumn("tags", F.array_join("tags", "|")).withColumn("card_data", F.to_json("card_data"))
    rows.select("id", "downloads", "likes", "pipeline_tag", "created_at", "last_modified", "tags", "card_data").write.mode("overwrite").options(header=True, escape='"').csv(path)


def id_list(ids: DataFrame, path: str) -> None:
    """An id a line, in order of pos. One file, as its readers expect: an id list is a selection's, not a corpus's."""
    ids.orderBy("pos").select("id").coalesce(1).write.mode("overwrite").text(path)


def json_documents(df: DataFrame, path: str, keep_nulls: bool = False) -> None:
    """JSON lines, null fields left out or kept."""
    df.write.mode("overwrite").option("ignoreNullFields", not keep_nulls).json(path)


def json_array(df: DataFrame, path: str, order: list[Column | str] | None = None, file: str | None = None) -> None:
    """One JSON array, nulls kept, in the order given: a folder of committed parts and, where a file is named, that file besides."""
    arrays.write(df, path, order)
    if file:
        arrays.assemble(df.sparkSession, path, file)


def run_snapshot(artifacts: dict[str, DataFrame], ids: DataFrame | None, path: str, suffix: str) -> None:
    """Each artifact's rows of the listed ids (all without a list) under run=suffix."""
    for name, df in artifacts.items():
        own = snapshot(df, ids) if ids is not None else df
        own.write.mode("overwrite").option("ignoreNullFields", True).json(f"{path}/{name}/run={suffix}")
