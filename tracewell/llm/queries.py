"""The queries of this subpackage: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import decontam, filteraudit, langid, linededup, lloyd, minhash, neardup, packing, pii, quality, simhash, tokenbin, urlfilter


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), radius=4, shingle=4, seed=42)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), "word_bpe_49k.json", end_id=1, window=2048))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenbin.round_trip(table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10).drop("text_hash")


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup(table(spark, sf_dir, "documents"), sites=10)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.with_edits(table(spark, sf_dir, "documents"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge(table(spark, sf_dir, "pages"))


def op11_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), similarity=0.85)


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lloyd.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed="3")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_simhash, op2_packing, op3_token_files, op4_decontamination, op5_line_dedup, op6_language, op7_quality, op8_pii, op9_minhash, op10_url_filter, op11_minhash_dedup, op12_filter_audit, op13_centroids)
}

ORACLE_SQL: dict[str, str] = {
    "op4_decontamination": decontam.ORACLE_SQL,
    "op5_line_dedup": linededup.ORACLE_SQL,
    "op10_url_filter": urlfilter.oracle_sql(),
    "op11_minhash_dedup": neardup.ORACLE_SQL,
    "op12_filter_audit": filteraudit.ORACLE_SQL,
    "op13_centroids": lloyd.oracle_sql(k=8, rounds=10, seed="3"),
}
