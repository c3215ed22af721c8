"""Scans of snapshots: catalogs, id lists, cards, repositories, papers, collections, labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracewell.functions.expr import rx
from tracewell.functions.ordered import first_per_key
from tracewell.operators.selection import year_month
from tracewell.sources import arrays
from tracewell.sources import schemas as S

_CSV = {"header": True, "multiLine": True, "escape": '"', "quote": '"', "maxCharsPerColumn": -1, "encoding": "UTF-8"}


def catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalog CSV, sorted by downloads as it is: rank (ties by id), tags as an array, card_data as a variant, year and month."""
    rows = spark.read.options(**_CSV).schema(S.CATALOG).csv(path)
    year, month = year_month(F.col("created_at"), F.col("last_modified"))
    rows = rows.withColumns({"year": year, "month": month, "tags": F.split(F.coalesce("tags", F.lit("")), "\\|"), "card_data": F.try_parse_json("card_data")})
    return rows.withColumn("rank", F.struct((-F.coalesce("downloads", F.lit(0))).alias("minus_downloads"), "id"))


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """(id, pos) of a text file with an id a line; blank lines and # comments are skipped, the first of repeated ids counts."""
    rows = spark.read.text(path).select(F.regexp_replace("value", rx("\\A\\s+|\\s+\\z", "U"), "").alias("id"), F.monotonically_increasing_id().alias("pos"))
    return first_per_key(rows.filter("id <> '' AND NOT startswith(id, '#')"), ["id"], ["pos"])


def _first_file(system, status):
    """The first file, by name, with any content at or under a path; names that begin with a dot or an underscore don't count."""
    if status.isFile():
        return status if status.getLen() else None
    below = sorted((x for x in system.listStatus(status.getPath()) if x.getPath().getName()[0] not in "._"), key=lambda x: x.getPath().getName())
    return next((f for x in below if (f := _first_file(system, x)) is not None), None)


def json_form(spark: SparkSession, path: str) -> str | None:
    """How a file or folder holds its documents: "indexed" (an array folder of ``arrays``), "array", "lines", or null where the path is
    missing. What a file's first character is tells, of a folder that of its first file: a writer's files are of one form."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(conf)
    if not system.exists(place):
        return None
    status = system.getFileStatus(place)
    if status.isDirectory() and system.exists(jvm.org.apache.hadoop.fs.Path(place, arrays.INDEX)):
        return "indexed"
    first = _first_file(system, status)
    if first is None:
        return "lines"
    stream = system.open(first.getPath())
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(first.getPath())
        own = stream if codec is None else codec.createInputStream(stream)
        byte = own.read()
        while byte in b" \t\r\n\xef\xbb\xbf":  # white space and a mark of byte order
            byte = own.read()
        return "array" if byte == ord("[") else "lines"
    finally:
        stream.close()


def json_documents(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of a file or folder, in whichever of three forms it holds them: JSON lines, JSON arrays (a file each), or an array that
    ``arrays.write`` has left in parts. Files of one array split where every element stands in a line of its own; if any does not, they are
    read whole by one task each. The other forms split. A missing path is an error."""
    form = json_form(spark, path)
    if form == "indexed":
        return arrays.scan(spark, path, schema)
    if form == "array" and (lines := arrays.element_lines(spark, path)) is not None:
        return arrays.elements(lines, schema)
    return spark.read.schema(schema).option("multiLine", form == "array").json(path)


def optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """json_documents, or no rows where the path is missing."""
    return json_documents(spark, path, schema) if json_form(spark, path) else spark.createDataFrame([], schema)


def cards(spark: SparkSession, path: str) -> DataFrame:
    """Cards whose text is not blank; of repeated ids the last record at the place of the first."""
    rows = json_documents(spark, path, S.CARDS)
    place = Window.partitionBy("id")
    rows = rows.withColumn("__first", F.min("pos").over(place))
    return first_per_key(rows, ["id"], [F.desc("pos")]).withColumn("pos", F.col("__first")).drop("__first").filter(F.rlike("modelcard", F.lit(rx("\\S", "U"))))


def ground_truth(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Label rows of CSV files in the order given, with file_pos and row_pos."""
    out = None
    for k, path in enumerate(paths):
        own = spark.read.options(**_CSV).schema(S.GROUND_TRUTH).csv(path).withColumn("file_pos", F.lit(k)).withColumn("row_pos", F.monotonically_increasing_id())
        out = own if out is None else out.unionByName(own)
    return spark.createDataFrame([], f"{S.GROUND_TRUTH}, file_pos int, row_pos long") if out is None else out


def repo_metadata(rows: DataFrame, column: str = "json") -> DataFrame:
    """(url, description, topics, language, fork, size_kb) of rows (url, and the repository's JSON object); what is no object gives no
    row, and what an object lacks is null."""
    own = rows.select("url", F.from_json(column, "description string, topics array<string>, language string, fork boolean, size long, bad string", {"columnNameOfCorruptRecord": "bad"}).alias("own"))
    return own.filter("own IS NOT NULL AND own.bad IS NULL").select("url", "own.description", "own.topics", "own.language", "own.fork", F.col("own.size").alias("size_kb"))


def paper_metadata(feeds: DataFrame, column: str = "xml") -> DataFrame:
    """feeds with title, abstract (500 characters), authors (10), categories (5) of an Atom entry."""
    text = lambda path: F.xpath_string(column, F.lit(path))
    squeezed = lambda c: F.trim(F.regexp_replace(c, rx("\\s+", "U"), " "))
    entry = "//*[local-name()='entry']"
    return feeds.withColumns({
        "title": squeezed(text(f"{entry}/*[local-name()='title']")), "abstract": F.substring(squeezed(text(f"{entry}/*[local-name()='summary']")), 1, 500),
        "authors": F.slice(F.xpath(column, F.lit(f"{entry}/*[local-name()='author']/*[local-name()='name']/text()")), 1, 10),
        "categories": F.slice(F.xpath(column, F.lit(f"{entry}/*[local-name()='category']/@term")), 1, 5),
    })
