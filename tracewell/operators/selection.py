"""Choosing ids: ranked catalogs, dates, buckets, families, id lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.functions import fixed_values as V
from tracewell.functions.expr import rx
from tracewell.functions.ordered import first_per_key, top_n_per_bucket

#: Times that each suffix class is stripped. A pass takes all matches out; a pattern that ends at a word boundary takes a whole chain of
#: suffixes joined by "_" at once, as only its last one ends there, so that nothing of a chain of any length is left.
STRIPS = 2


def parse_years(text: str) -> set[int]:
    """"2021,2023-2025": single years and ranges."""
    out: set[int] = set()
    for part in (p.strip() for p in text.split(",")):
        low, _, high = part.partition("-")
        out |= set(range(int(low), int(high or low) + 1))
    return out


def year_month(created: Column, modified: Column) -> tuple[Column, Column]:
    """Year and month of the first of two timestamps that has both; null where neither has."""

    def pair(value: Column) -> Column:
        own = F.trim(value)
        year = F.substring(own, 1, 4).try_cast("int")
        month = F.substring(own, 6, 2).try_cast("int")
        good = own.isNotNull() & (own != "") & (own != "None") & year.isNotNull() & month.between(1, 12)
        return F.when(good, F.struct(year.alias("year"), month.alias("month")))

    both = F.coalesce(pair(created), pair(modified))
    return both["year"], both["month"]


def year_only(created: Column, modified: Column) -> Column:
    """The year of the first of two timestamps that has one; null where neither has."""

    def own(value: Column) -> Column:
        text = F.trim(value)
        return F.when((text != "") & (text != "None"), F.substring(text, 1, 4).try_cast("int"))

    return F.coalesce(own(created), own(modified))


def requested_order(chosen: DataFrame) -> DataFrame:
    """chosen (year, month, perhaps quarter, rank) with pos, the order in which a run handles ids: by bucket, then rank.

    pos is the ordering itself, a struct, so that no partition of the table decides on it and no row needs a number."""
    bucket = F.coalesce(F.col("quarter") if "quarter" in chosen.columns else F.col("month"), F.lit(0))
    return chosen.withColumn("pos", F.struct(F.coalesce("year", F.lit(0)).alias("year"), bucket.cast("int").alias("bucket"), F.col("rank").alias("rank")))


def quarter(month: Column) -> Column:
    return F.floor((month - 1) / 3).cast("int") + 1


def family_stem(model_id: Column) -> Column:
    """The id without precision, variant, version, date, size and rate suffixes of its name; ids without "/" stay."""
    name = F.regexp_extract(model_id, rx("\\A[^/]*/(.*)\\z", "sd"), 1)
    for pattern, flags in ((V.PRECISION_SUFFIX, "iUd"), (V.VARIANT_SUFFIX, "iUd"), (V.VERSION_SUFFIX, "Ud"), (V.DATE_SUFFIX, "Ud"), (V.SIZE_SUFFIX, "Ud"), (V.RATE_SUFFIX, "iUd")):
        pattern = f"(?:{pattern[:-2]})+\\b" if pattern.endswith("\\b") else pattern
        for _ in range(STRIPS):
            name = F.regexp_replace(name, rx(pattern, flags), "")
    name = F.regexp_replace(name, rx("[-_.\\s]+$", "Ud"), "")
    return F.when(F.contains(model_id, F.lit("/")), F.concat(F.substring_index(model_id, "/", 1), F.lit("/"), name)).otherwise(model_id)


def dedup_by_family(catalog: DataFrame, id_column: str = "id", rank: str = "rank") -> DataFrame:
    """The most popular row (smallest rank) of each family."""
    return first_per_key(catalog.withColumn("stem", family_stem(F.col(id_column))), ["stem"], [rank])


def top_per_month(catalog: DataFrame, n: int, years: set[int] | None = None) -> DataFrame:
    """n rows of each (year, month) by rank; n of 0 means no cap."""
    rows = catalog.filter(F.col("month").isNotNull() & (F.col("year").isin(sorted(years)) if years else F.lit(True)))
    return top_n_per_bucket(rows, ["year", "month"], ["rank"], n) if n else rows


def top_per_quarter(catalog: DataFrame, n: int, years: set[int] | None = None) -> DataFrame:
    rows = catalog.filter(F.col("month").isNotNull() & (F.col("year").isin(sorted(years)) if years else F.lit(True))).withColumn("quarter", quarter(F.col("month")))
    return top_n_per_bucket(rows, ["year", "quarter"], ["rank"], n) if n else rows


def top_overall(catalog: DataFrame, n: int) -> DataFrame:
    return catalog.orderBy("rank").limit(n) if n else catalog


def bucket_summary(selected: DataFrame) -> DataFrame:
    """Rows and non-empty months of each year."""
    return selected.groupBy("year").agg(F.count("*").alias("n_rows"), F.countDistinct("month").alias("n_months"))


def by_ids(ids: DataFrame, catalog: DataFrame) -> DataFrame:
    """Exactly the ids, in their order (pos), with what the catalog knows of them."""
    return ids.join(catalog, "id", "left")


def ordered_distinct(df: DataFrame, key: str, position: str) -> DataFrame:
    return first_per_key(df, [key], [position])


def union_ids(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.select("id").union(b.select("id")).distinct()


def overlap(a: DataFrame, b: DataFrame) -> DataFrame:
    """n_a, n_b, n_union and n_both = n_a + n_b - n_union of two lists of distinct ids, in one aggregation."""
    sides = a.select("id", F.lit(1).alias("in_a"), F.lit(0).alias("in_b")).unionByName(b.select("id", F.lit(0).alias("in_a"), F.lit(1).alias("in_b")))
    per_id = sides.groupBy("id").agg(F.max("in_a").alias("in_a"), F.max("in_b").alias("in_b"))
    return per_id.agg(F.coalesce(F.sum("in_a"), F.lit(0)).alias("n_a"), F.coalesce(F.sum("in_b"), F.lit(0)).alias("n_b"), F.count("*").alias("n_union"), F.coalesce(F.sum(F.col("in_a") * F.col("in_b")), F.lit(0)).alias("n_both"))


def drop_blank(cards: DataFrame, column: str = "modelcard") -> DataFrame:
    return cards.filter(F.rlike(column, F.lit(rx("\\S", "U"))))


def snapshot(artifact: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """The artifact's rows whose id is listed."""
    return artifact.join(ids.select(F.col("id").alias(key)).distinct(), key, "left_semi")
