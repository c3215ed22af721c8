"""How quality filters interact: what each removes alone, after the others, and on average over all orders.

A relational word pipeline.  Texts go to tasks by their row once; there, words are exploded, counted by (row, word) and then by row, so a
word never crosses a shuffle and a long text's words never stand in one place.  The filters that need no words are columns of the
rows; the copies filter compares a row with the smallest doc_id of its text.  All flags meet in an outer join, and each part of the
table is brought down to 32 conditional counts (one for every set of filters that a document fails), and as many of its good and
toxic documents.  Every order of the filters is arithmetic on these counts.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import planned_partitions

FILTERS = "ABCDE"
MASKS = range(1 << len(FILTERS))
#: Thresholds: words at least, distinct words in a hundred, capital letters in a hundred code points, and the characters of filter D.
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, ODD = 200, 50, 2, "[#$%&*|]"
COUNTS = ("n", "good", "toxic")


def word_counts(rows: DataFrame) -> DataFrame:
    """(id, text_hash, words, distinct_words) of the rows (id, text_hash, text) that have words: both counts of one copy of the row."""
    words = rows.select("id", "text_hash", F.posexplode(F.split("text", "[\\x20\\x09-\\x0D]+")).alias("at", "word"))
    # behind every text's first place stands its first word, or nothing where white space leads: copies are counted there
    by_word = words.groupBy("id", "text_hash", "word").agg(F.count("*").alias("n"), F.sum(F.when(F.col("at") == 0, 1).otherwise(0)).alias("copies"))
    word = F.col("word") != ""
    by_row = by_word.groupBy("id", "text_hash").agg(F.sum(F.when(word, F.col("n")).otherwise(0)).alias("words"), F.count_if(word).alias("distinct_words"), F.sum("copies").alias("copies"))
    return by_row.select("id", "text_hash", F.expr("words div copies").alias("words"), "distinct_words")


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, good, toxic, and a boolean a filter, named by its letter: it fails) of every row of docs."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("source", F.lit("")).alias("part"), text.alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(0).cast("long"))).withColumn("text_hash", F.xxhash64("text"))
    words = word_counts(rows.select("id", "text_hash", "text").repartition(planned_partitions(docs, bytes_each=8 << 20, most=1 << 16), "id", "text_hash"))
    capitals = F.length("text") - F.length(F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    other_hash = F.xxhash64(F.lit(1), F.reverse("text"), "text")  # with the first, 128 bits
    own = rows.select("doc_id", "id", "part", "text_hash", other_hash.alias("other_hash"), (100 * capitals > MOST_CAPITALS * F.length("text")).alias("C"), F.col("text").rlike(ODD).alias("D"))
    texts = own.groupBy("text_hash", "other_hash").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")).filter("n > 1").drop("n")
    known = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.coalesce(F.max(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.max(F.col("toxic") == 1), F.lit(False)).alias("toxic"))
    every = own.join(words, ["id", "text_hash"], "left").join(texts, ["text_hash", "other_hash"], "left").join(known, "doc_id", "left")
    n, distinct = F.coalesce("words", F.lit(0)), F.coalesce("distinct_words", F.lit(0))
    flags = {"A": n < LEAST_WORDS, "B": 100 * distinct < LEAST_DISTINCT * n, "C": F.col("C"), "D": F.col("D"), "E": F.coalesce(F.col("least") < F.col("doc_id"), F.lit(False))}
    return every.select("part", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"), *(c.alias(name) for name, c in flags.items()))


def conditional_counts(rows: DataFrame) -> DataFrame:
    """(part, n, good, toxic): for each part of flagged rows, how many documents fail exactly each set of filters (an array with a place
    for every set, as the number of its bits), all of them, the good and the toxic ones."""
    mask = sum((F.when(F.col(name), 1 << k).otherwise(0) for k, name in enumerate(FILTERS)), F.lit(0))
    counts = rows.withColumn("mask", mask).groupBy("part").agg(*(F.count_if((F.col("mask") == m) & (F.col(of) if of != "n" else F.lit(True))).alias(f"{of}_{m}") for of in COUNTS for m in MASKS))
    return counts.select("part", *(F.array(*(f"{of}_{m}" for m in MASKS)).alias(of) for of in COUNTS))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For every part of docs (its source; null: empty string), order of the filters and step, what the step's filter does: kept, removed,
    redundant (fails it, but went before), unique_fails (fails nothing else), good_lost, toxic_lost (removed here, by labels), shapley
    (its removals at any step, summed over all orders).

    A document fails A with under 200 words, B if 100 times its distinct words are under 50 times its words, C with over two capital
    letters A-Z in a hundred code points, D with any of # $ % & * |, E if a smaller doc_id has the same text. Null texts are empty, and so
    fail A. A null doc_id is never smaller or larger. Repeated rows count as often as they stand there and are not copies of one
    another; several labels of one doc_id count as 1 where any does; null labels are none. An empty table gives an empty result; columns
    other than doc_id, text and source are not looked at.
    """
    counts = conditional_counts(flagged(docs, labels))
    orders = F.explode(F.array(*(F.lit("".join(p)) for p in permutations(FILTERS))))
    steps = counts.select("*", orders.alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letters = F.split("filter_order", "")
    before = F.aggregate(F.slice(letters, F.lit(1), F.col("step") - 1), F.lit(0), lambda acc, x: acc.bitwiseOR(_bit(x)))
    steps = steps.withColumn("bit", _bit(F.element_at(letters, F.col("step")))).withColumn("before", before)
    has, gone = lambda m: m.bitwiseAND(F.col("bit")) != 0, lambda m: m.bitwiseAND(F.col("before")) != 0

    def total(of: str, counts_in, weight=lambda m: F.lit(1)) -> Column:
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(MASKS) - 1)), F.lit(0).cast("long"), lambda acc, m: acc + F.when(counts_in(m), F.element_at(of, m + 1) * weight(m)).otherwise(0))

    orders_first = F.array(*(F.lit(120 // max(1, m.bit_count())) for m in MASKS))  # orders in which one filter of a set comes before the set's others
    return steps.select(
        "part", "filter_order", "step",
        total("n", lambda m: ~gone(m) & ~has(m)).alias("kept"),
        total("n", lambda m: has(m) & ~gone(m)).alias("removed"),
        total("n", lambda m: has(m) & gone(m)).alias("redundant"),
        F.element_at("n", F.col("bit") + 1).alias("unique_fails"),
        total("good", lambda m: has(m) & ~gone(m)).alias("good_lost"),
        total("toxic", lambda m: has(m) & ~gone(m)).alias("toxic_lost"),
        total("n", has, lambda m: F.element_at(orders_first, m + 1)).alias("shapley"),
    )


def _bit(letter: Column) -> Column:
    """The bit of a filter."""
    return F.element_at(F.create_map(*(F.lit(x) for k, name in enumerate(FILTERS) for x in (name, 1 << k))), letter)


ORACLE_SQL = r"""
WITH base AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
flags AS (
  SELECT b.part, coalesce(l.quality = 1, false) AS good, coalesce(l.toxic = 1, false) AS toxic,
    len(w) < 200 AS "A", 100 * len(list_distinct(w)) < 50 * len(w) AS "B",
    100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS "C", regexp_matches(t, '[#$%&*|]') AS "D",
    b.doc_id > min(b.doc_id) OVER (PARTITION BY t) AS "E"
  FROM base b LEFT JOIN labels l ON b.doc_id = l.doc_id),
masks AS (
  SELECT part, good, toxic, "A"::INT + 2 * "B"::INT + 4 * "C"::INT + 8 * "D"::INT + 16 * "E"::INT AS m FROM flags),
counts AS (SELECT part, m, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM masks GROUP BY 1, 2),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(x, b)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
  FROM f a, f b, f c, f d, f e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31),
steps AS (
  SELECT filter_order, CAST(k AS INT) AS step, bits[k] AS bit, coalesce(list_sum(bits[1 : k - 1]), 0)::INT AS before
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS k)),
told AS (
  SELECT p.part, s.filter_order, s.step, s.bit,
    coalesce(sum(c.n) FILTER ((c.m & s.before) = 0 AND (c.m & s.bit) = 0), 0) AS kept,
    coalesce(sum(c.n) FILTER ((c.m & s.before) = 0 AND (c.m & s.bit) <> 0), 0) AS removed,
    coalesce(sum(c.n) FILTER ((c.m & s.before) <> 0 AND (c.m & s.bit) <> 0), 0) AS redundant,
    coalesce(sum(c.n) FILTER (c.m = s.bit), 0) AS unique_fails,
    coalesce(sum(c.good) FILTER ((c.m & s.before) = 0 AND (c.m & s.bit) <> 0), 0) AS good_lost,
    coalesce(sum(c.toxic) FILTER ((c.m & s.before) = 0 AND (c.m & s.bit) <> 0), 0) AS toxic_lost
  FROM (SELECT DISTINCT part FROM masks) p CROSS JOIN steps s LEFT JOIN counts c ON c.part = p.part GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
  unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told
"""
