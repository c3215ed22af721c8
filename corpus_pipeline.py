"""From raw documents to packed training sequences: five stages, each over all that the one before it kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of ``documents``, further ones
too, whatever their names. Every stage takes nulls in any column, texts of any length, repeated rows (each judged by its own text) and
empty tables, which stay empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import decontam, langid, linededup, packing, simhash
from tracewell.llm.common import stored


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter (null and empty texts too), or of no clear language, go. Learns from rows with a lang; without any, only
    what has no letter goes."""
    return langid.keep_known(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on ten sites or more stay in the document with the smallest doc_id only; a document that has nothing else goes. A null text
    stays null; a null source is a site of its own; rows without a doc_id lose such lines unless only they have them."""
    found = linededup.judged(docs, sites=10)
    left = found.filter((F.col("n_removed") == 0) | (F.trim(F.regexp_replace("text", "\\s+", " ")) != ""))
    new = {"text": F.col("text"), "n_chars": F.when(F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("row.n_chars"))}
    return left.select(*(new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest doc_id stays. Rows
    without a doc_id all stay; texts without a word are copies of one another."""
    return simhash.keep_one(docs, similarity=0.8, shingle=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage (ten words of an item in a row, or a whole shorter item) go. A null text has none."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 2048. A null text is its end id alone."""
    return packing.pack(docs, "word_bpe_49k.json", end_id=1, window=2048)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("packing", pack)]

#: Naive Bayes, linked components and tokenization have no SQL form: the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
