"""Benchmark decontamination as a prefix-filtered set join, in DataFrame functions only.

An item is a set of windows of consecutive words, and a document is contaminated where one of them occurs.  A window's
word shingles are ordered by rarity in the corpus.  All of a window's shingles must be there for it to occur, so the
*necessary prefix* of that order is one shingle, the rarest; only it is joined with the documents' shingles.  A candidate
then passes the positional and length bounds (the window must lie inside the document around the shingle's place), and
exact containment is verified, word by word, on a slice of the document as long as the window.

Documents are read twice: to count the shingles that the benchmark has, over all documents, and to join.  A document's
words never leave its row: shingles are hashed as rows pass, and the index of prefixes, a table whose size is that of the
benchmark, goes to every task in blocks of at most ``INDEX_ROWS`` rows; a larger index takes more passes, none of them
shuffling text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import ascii_lower, stored

#: Not letters or digits of ASCII, and not beyond ASCII.
NO_WORD = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
#: Words of a shingle; shorter windows are one shingle.
SHINGLE = 3
#: Rows of the index that are broadcast at once, about 200 bytes each.
INDEX_ROWS = 200_000


def words(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text, F.lit(""))), NO_WORD), "")


def shingle_hash(own: Column, at: Column, width: int) -> Column:
    return F.xxhash64(*(own[at + k] for k in range(width)))


def windows(benchmark: DataFrame, window: int) -> DataFrame:
    """Distinct windows: own (its words), items (the ids that have it, as strings)."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("all")).filter(F.size("all") > 0)
    at = F.explode(F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0))))
    return rows.select("item", "all", at.alias("at")).select("item", F.slice("all", F.col("at") + 1, window).alias("own")).groupBy("own").agg(F.collect_set("item").alias("items"))


def shingles(own: DataFrame, widths: list[int], *keep: str, sentinel: bool = False) -> DataFrame:
    """The rows of own (words: all) exploded to their shingles: at, width, key; with a sentinel, also a row of at = -1."""
    n = F.size("all")
    codes = [F.when(n >= w, F.sequence(F.lit(w), (n - w) * 4 + w, F.lit(4))).otherwise(F.array().cast("array<int>")) for w in widths]  # 4 at + width
    codes = F.concat(F.array(F.lit(-1)), *codes) if sentinel else F.concat(*codes)
    rows = own.select(*keep, "all", F.explode(codes).alias("code"))
    at = F.shiftright("code", 2)
    key = F.lit(None).cast("long")
    for w in widths:
        key = F.when((F.col("code") >= 0) & (F.col("code").bitwiseAND(3) == w), shingle_hash(F.col("all"), at, w)).otherwise(key)
    return rows.select(*keep, "all", at.alias("at"), key.alias("key"))


def prefix_index(docs: DataFrame, benchmark: DataFrame, window: int) -> tuple[DataFrame, list[int]]:
    """(key, lead, own, items): each window under its shingle that is rarest in docs (ties: the smaller hash), lead being
    the shingle's place in it; and the widths of shingles there are."""
    found = stored(windows(benchmark, window).withColumn("window", F.xxhash64("own")), "windows")
    widths = sorted(r[0] for r in found.select(F.least(F.size("own"), F.lit(SHINGLE))).distinct().collect())
    parts = []
    for w in widths:
        own = found.filter(F.size("own") == w) if w < SHINGLE else found.filter(F.size("own") >= SHINGLE)
        parts.append(shingles(own.withColumn("all", F.col("own")), [w], "own", "items").select("own", "items", F.col("at").alias("lead"), "key"))
    if not parts:
        return found.select(F.lit(0).cast("long").alias("key"), F.lit(0).alias("lead"), "own", "items"), []
    rows = parts[0]
    for more in parts[1:]:
        rows = rows.unionByName(more)
    rows = stored(rows, "window-shingles")
    keys = rows.select("key").distinct()
    n_keys = keys.count()
    text = docs.select(words(F.col("text")).alias("all"))
    counts = None
    for keys_block in in_blocks(keys, n_keys):
        own = shingles(text, widths).select("key").join(F.broadcast(keys_block), "key").groupBy("key").count()
        counts = own if counts is None else counts.unionByName(own)
    rows = rows.join(stored(counts, "shingle-counts"), "key", "left").withColumn("count", F.coalesce("count", F.lit(0)))
    rarest = rows.groupBy("own").agg(F.min(F.struct("count", "key", "lead")).alias("best"), F.first("items").alias("items"))
    # a shingle that no document has can't lead anywhere
    return stored(rarest.filter("best.count > 0").select("best.key", "best.lead", "own", "items"), "prefix-index"), widths


def in_blocks(rows: DataFrame, n: int, most: int = INDEX_ROWS) -> list[DataFrame]:
    """rows, n in number, cut by key into blocks of about most rows."""
    blocks = max(1, -(-n // most))
    return [rows] if blocks == 1 else [rows.filter(F.pmod(F.xxhash64("key"), F.lit(blocks)) == k) for k in range(blocks)]


def find(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated for every row of docs: its words, the words
    inside any occurrence of a window, the items with occurring windows, and the SHA-256 of their sorted ids.

    Null texts have no words. A null doc_id stays null; rows repeating a doc_id are judged each for itself. Items without
    words have no windows; an item with a null item_id marks words as hit but is not counted. Empty tables: no rows, or
    rows without hits. Other columns are not looked at.
    """
    index, widths = prefix_index(docs, benchmark, window)
    rows = docs.select(F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash"), words(F.col("text")).alias("all"))
    parts = []
    blocks = in_blocks(index, index.count())
    for k, block in enumerate(blocks):
        own = shingles(rows, widths, "doc_id", "text_hash", sentinel=k == 0).join(F.broadcast(block), "key", "left" if k == 0 else "inner")
        start = F.col("at") - F.col("lead")
        there = F.col("own").isNotNull() & (start >= 0) & (start + F.size("own") <= F.size("all"))
        there = there & (F.slice("all", F.greatest(start, F.lit(0)) + 1, F.greatest(F.size("own"), F.lit(0))) == F.col("own"))
        there = F.coalesce(there, F.lit(False))
        own = own.filter((F.col("at") == -1) | there) if k == 0 else own.filter(there)
        hit = F.when(there, F.struct(start.alias("start"), F.size("own").alias("length")))
        parts.append(own.select("doc_id", "text_hash", (F.col("at") == -1).cast("long").alias("rows"), F.size("all").cast("long").alias("n_words"), hit.alias("hit"), F.when(there, F.col("items")).alias("items")))
    found = parts[0]
    for more in parts[1:]:
        found = found.unionByName(more)
    # rows of equal id and text are judged once, and given back as many times as there are
    found = found.groupBy("doc_id", "text_hash").agg(F.sum("rows").alias("rows"), F.max("n_words").alias("n_words"), F.collect_set("hit").alias("hits"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    n_hit = F.size(F.array_distinct(F.flatten(F.transform("hits", lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1)))))
    found = found.select("doc_id", "text_hash", "rows", "n_words", F.when(F.size("hits") > 0, n_hit).otherwise(0).cast("long").alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    found = found.withColumn("contaminated", F.col("n_hit") > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
    return found.select("doc_id", "text_hash", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """docs without the rows that have an occurrence of a window, all columns as they are.

    A null text has none. Each row is judged by its own text, whatever rows repeat its doc_id or have none; repeated rows go or stay
    together. Empty tables: no rows, or all of docs.
    """
    bad = find(docs, benchmark, window).filter("contaminated").select(F.col("doc_id").alias("__bad_id"), F.col("text_hash").alias("__bad_hash")).distinct()
    own = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad_id"]) & (own == bad["__bad_hash"]), "left_anti")


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS row, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, w[i + 1 : i + least(len(w), 10)] AS own FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 10, 0) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT row, i, n, w[i + 1 : i + n] AS own FROM (SELECT row, w, n, unnest(range(len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT row, i, bw.n AS n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.own = bw.own),
spots AS (SELECT row, count(DISTINCT p) AS n_hit FROM (SELECT row, unnest(range(i, i + n)) AS p FROM hits) GROUP BY row),
items AS (SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT row, item_id::VARCHAR AS item FROM hits) GROUP BY row)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN spots USING (row) LEFT JOIN items USING (row)
"""
