"""Verdicts of cards as they arrive: the map side of card verdicts runs on micro-batches, each written once under its number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tracewell.operators.verdicts import card_verdicts

CARD_STREAM = "id string, modelcard string"


def arriving(spark: SparkSession, path: str) -> DataFrame:
    """New Parquet files of (id, modelcard)."""
    return spark.readStream.schema(CARD_STREAM).parquet(path)


def verdict_stream(cards: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends verdicts of each micro-batch under batch=N; a batch that is run again overwrites its own folder, so results are
    written exactly once. No state: a card's verdict depends on the card alone."""

    def write(batch: DataFrame, number: int) -> None:
        card_verdicts(batch, with_text=False).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return cards.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
