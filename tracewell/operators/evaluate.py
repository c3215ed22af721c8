"""Results against labels: correct flags, accuracy, outcome matrices, differences between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import fixed_values as V
from tracewell.functions.expr import py_round, table_of
from tracewell.functions.ordered import first_per_key
from tracewell.operators.text import py_strip


def label(provider: Column) -> Column:
    own = F.lower(py_strip(provider))
    return F.coalesce(table_of(V.PROVIDER_NAMES, own), own)


def ground_truth(rows: DataFrame) -> DataFrame:
    """rows (id, provider, method, file_pos, row_pos): expected and slice of each id; the last row of the last file wins."""
    own = rows.withColumn("id", py_strip(F.col("id")))
    last = first_per_key(own, ["id"], [F.desc("file_pos"), F.desc("row_pos")])
    method = py_strip(F.coalesce("method", F.lit("")))
    return last.select("id", label(F.col("provider")).alias("expected"), F.when(method == "", F.lit("unscoped")).otherwise(method).alias("slice"))


def flag(results: DataFrame, truth: DataFrame) -> DataFrame:
    """results (id, chip_provider) with expected_provider and correct: 1, 0, or -1 without a label."""
    rows = results.join(truth.select("id", F.col("expected").alias("expected_provider")), "id", "left")
    return rows.withColumn("correct", F.when(F.col("expected_provider").isNull(), -1).when(F.col("chip_provider") == F.col("expected_provider"), 1).otherwise(0))


def accuracy(flagged: DataFrame) -> DataFrame:
    n, good = F.count_if(F.col("correct") >= 0), F.count_if(F.col("correct") == 1)
    return flagged.agg(n.alias("evaluated"), F.count_if(F.col("correct") < 0).alias("not_labelled"), good.alias("correct"), (n - good).alias("incorrect"), F.when(n > 0, good / n * 100).alias("percent"))


def mismatches(flagged: DataFrame) -> DataFrame:
    return flagged.filter("correct = 0").select("id", F.col("expected_provider").alias("expected"), F.col("chip_provider").alias("got"), F.col("chip_provider_source").alias("source"))


def outcome(pred: Column, expected: Column) -> Column:
    return F.when(pred == expected, "correct").when((pred == "unknown") & (expected != "unknown"), "missed").when((pred != "unknown") & (expected == "unknown"), "false_positive").otherwise("confused")


def scored(results: DataFrame, truth: DataFrame) -> DataFrame:
    """id, slice, expected, pred, outcome, src, conf of the labelled results."""
    rows = results.join(truth, "id")
    return rows.select("id", "slice", "expected", F.col("chip_provider").alias("pred"), outcome(F.col("chip_provider"), F.col("expected")).alias("outcome"), F.coalesce("chip_provider_source", F.lit("—")).alias("src"), F.col("chip_provider_confidence").alias("conf"))


def outcome_matrix(rows: DataFrame) -> DataFrame:
    """Counts of outcomes by slice and for __ALL__, in one pass."""
    kinds = ("correct", "missed", "false_positive", "confused")
    out = rows.groupingSets([["slice"], []], "slice").agg(F.grouping("slice").alias("g"), *(F.count_if(F.col("outcome") == k).alias(k) for k in kinds), F.count("*").alias("total"))
    return out.withColumn("slice", F.when(F.col("g") == 1, F.lit("__ALL__")).otherwise(F.col("slice"))).drop("g").filter("total > 0")


def share(n: Column, d: Column) -> Column:
    return F.when(d > 0, F.format_string("%d/%d (%.1f%%)", n, d, py_round(100 * n / d, 1))).otherwise(F.format_string("%d/0 (—)", n))


def run_diff(a: DataFrame, b: DataFrame) -> DataFrame:
    """Ids of both runs whose outcome or prediction changed, by id."""
    left, right = (x.select("id", "expected", F.col("pred").alias(f"pred_{n}"), F.col("outcome").alias(f"outcome_{n}")) for x, n in ((a, "a"), (b, "b")))
    rows = left.join(right.drop("expected"), "id")
    return rows.filter((F.col("pred_a") != F.col("pred_b")) | (F.col("outcome_a") != F.col("outcome_b"))).orderBy("id")


def failures(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("outcome").isin("false_positive", "confused"))


def misses(rows: DataFrame) -> DataFrame:
    return rows.filter("outcome = 'missed'")
