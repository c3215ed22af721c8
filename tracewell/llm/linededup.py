"""Cross-site boilerplate lines, found by the number of distinct sites that show them, in DataFrame functions only.

Every line's hash gets a HyperLogLog sketch of the sites it stands on; partial sketches merge by aggregation, so a line
that a third of all documents share still shuffles one small sketch a task.  A sketch far from the threshold decides by
itself; the lines near it (from half to twice) get exact distinct counts.  A line on ``sites`` sites or more is boilerplate:
it goes from every document but the one with the smallest doc_id, so that no content, not even that of widely copied
documents, is lost altogether.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored

#: Relative error of the sketches: 128 registers, about 100 bytes.
SKETCH_ERROR = 0.1


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.trim(F.regexp_replace(line, "\r$", "")))


def lines(docs: DataFrame, site: str, *keep: str) -> DataFrame:
    """One row per line that is not blank: site (null counts as one site), doc_id, at, h."""
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col(site).cast("string"), F.lit("")).alias("site"), *keep, F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n", -1)).alias("at", "line"))
    return rows.filter(F.trim(F.regexp_replace("line", "\r$", "")) != "").select("doc_id", "site", *keep, "at", line_hash(F.col("line")).alias("h"))


def boilerplate(docs: DataFrame, sites: int, site: str) -> DataFrame:
    """(h, first): hashes of lines on at least sites sites, and the smallest doc_id that has each."""
    rows = lines(docs, site)
    spread = rows.groupBy("h").agg(F.approx_count_distinct("site", SKETCH_ERROR).alias("about"), F.min("doc_id").alias("first"))
    likely = stored(spread.filter(F.col("about") >= sites / 2), "line-sketches")
    near = likely.filter(F.col("about") <= 2 * sites).select("h")
    exact = rows.select("h", "site").join(near, "h", "left_semi").distinct().groupBy("h").count().filter(F.col("count") >= sites).select("h")
    return stored(likely.filter(F.col("about") > 2 * sites).select("h", "first").unionByName(likely.join(exact, "h", "left_semi").select("h", "first")), "boilerplate")


def judged(docs: DataFrame, sites: int = 10, site: str = "source") -> DataFrame:
    """One row per row of docs: row (its columns as a struct), text (without its boilerplate lines), n_lines and n_removed.

    Lines are cut at LF and compared without white space around them; blank lines always stay. A null text stays null and
    has no lines; a null site counts as one site of its own; a null doc_id counts as no smallest one, so such rows lose
    their boilerplate lines unless only they have them. Rows repeating a doc_id are handled alike. An empty table gives an
    empty result. No name of a column of docs can clash.
    """
    own = F.xxhash64(F.coalesce("text", F.lit(""))).alias("own")
    keyed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), own)
    plain = docs.select("doc_id", "text", F.col(f"`{site}`").alias("site"), own)
    marks = boilerplate(plain, sites, "site")
    rows = lines(plain, "site", "own").join(marks, "h").filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    drops = rows.groupBy(F.col("doc_id").alias("drop_id"), F.col("own").alias("drop_own")).agg(F.array_sort(F.collect_set("at")).alias("drops"))
    joined = keyed.join(drops, F.col("row.doc_id").eqNullSafe(F.col("drop_id")) & (F.col("own") == F.col("drop_own")), "left").select("row", F.col("row.text").alias("text"), "drops", F.split("row.text", "\n", -1).alias("all"))
    # between two dropped lines the ones that stay are a slice, so a text's work is that of its lines
    joined = joined.withColumn("before", F.concat(F.array(F.lit(-1)), F.col("drops"))).withColumn("until", F.concat(F.col("drops"), F.array(F.size("all"))))
    kept = F.flatten(F.zip_with("before", "until", lambda x, y: F.slice("all", x + 2, y - x - 1)))
    return joined.select(
        "row", F.when(F.col("drops").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"), F.when(F.col("text").isNull(), 0).otherwise(F.size("all")).cast("long").alias("n_lines"), F.coalesce(F.size("drops"), F.lit(0)).cast("long").alias("n_removed")
    )


def dedup(docs: DataFrame, sites: int = 10, site: str = "source") -> DataFrame:
    """docs with boilerplate lines taken out of text, and n_lines and n_removed besides (instead of columns of docs so named).

    Nulls, repeated rows and empty tables: as in ``judged``. Other columns pass through.
    """
    added = ("n_lines", "n_removed")
    own = [F.col("text") if c.lower() == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns if c.lower() not in added]
    return judged(docs, sites, site).select(*own, *added)


ORACLE_SQL = r"""
WITH l AS (SELECT row, doc_id, source, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM (SELECT row_number() OVER () AS row, doc_id, coalesce(source, '') AS source, string_split(text, chr(10)) AS lines FROM documents)),
k AS (SELECT *, trim(regexp_replace(line, '\r$', ''), ' ') AS own FROM l),
marks AS (SELECT own, min(doc_id) AS first FROM k WHERE own <> '' GROUP BY own HAVING count(DISTINCT source) >= 10),
judged AS (SELECT k.*, first IS NOT NULL AND doc_id IS DISTINCT FROM first AS gone FROM k LEFT JOIN marks USING (own))
SELECT doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed, sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS text_sha256
FROM judged GROUP BY row, doc_id
"""
