"""JSON lines and arrays: written, committed, read back, also after failures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tracewell.sources import arrays, readers, sinks

SCHEMA = "id long, text string, tags array<string>, inner struct<a:int,b:string>"
ROWS = [(k, None if k % 5 == 0 else f'line {k}\n"quoted", [x] é\U0001f600,', [f"t{k}", None] if k % 3 else None, (k, None) if k % 4 else None) for k in range(200)]


def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(7)


def rows(df):
    return sorted(df.collect(), key=lambda r: r["id"])


def test_lines_and_arrays(spark, tmp_path):
    df = table(spark)
    sinks.json_documents(df, f"{tmp_path}/lines")
    sinks.json_documents(df, f"{tmp_path}/kept", keep_nulls=True)
    sinks.json_array(df, f"{tmp_path}/array", ["id"], f"{tmp_path}/one.json")
    for name, form in (("lines", "lines"), ("kept", "lines"), ("array", "indexed"), ("one.json", "array")):
        assert readers.json_form(spark, f"{tmp_path}/{name}") == form
        assert rows(readers.json_documents(spark, f"{tmp_path}/{name}", SCHEMA)) == rows(df)
    own = json.load(open(f"{tmp_path}/one.json"))
    assert [x["id"] for x in own] == list(range(200)) and own[0] == {"id": 0, "text": None, "tags": None, "inner": None}
    assert os.path.getsize(f"{tmp_path}/one.json") == arrays.index(f"{tmp_path}/array")["bytes"]
    assert '"text":null' in "".join(open(f"{tmp_path}/kept/{f}").read() for f in os.listdir(f"{tmp_path}/kept") if f.startswith("part"))


@pytest.mark.parametrize("text, form", [("[]", "array"), (" \n﻿ [\n {\n \"id\": 1\n },\n {\"id\": 2}]", "array"), ('{"id": 1}\n{"id": 2}\n', "lines"), ("", "lines")])
def test_other_writers_files(spark, tmp_path, text, form):
    path = f"{tmp_path}/x.json"
    open(path, "w", encoding="utf-8").write(text.replace("﻿", ""))
    assert readers.json_form(spark, path) == form
    assert [r["id"] for r in rows(readers.json_documents(spark, path, "id long"))] == ([1, 2] if "id" in text else [])


def test_optional_and_compressed(spark, tmp_path):
    import gzip

    assert readers.optional(spark, f"{tmp_path}/none", "id long").count() == 0
    with gzip.open(f"{tmp_path}/x.json.gz", "wt") as f:
        f.write('[{"id": 1},\n{"id": 2}]')
    assert readers.optional(spark, f"{tmp_path}/x.json.gz", "id long").count() == 2
    spark.range(10).write.json(f"{tmp_path}/runs/run=a")
    assert readers.optional(spark, f"{tmp_path}/runs", "id long, run string").filter("run = 'a'").count() == 10


def test_cards_of_lines(spark, tmp_path):
    own = spark.createDataFrame([("a", "x", 0), ("b", " ", 1), ("a", "y", 2)], "id string, modelcard string, pos long")
    sinks.json_documents(own, f"{tmp_path}/cards")
    sinks.json_array(own, f"{tmp_path}/array")
    for name in ("cards", "array"):
        assert [(r["id"], r["modelcard"], r["pos"]) for r in readers.cards(spark, f"{tmp_path}/{name}").collect()] == [("a", "y", 0)]


def test_failed_attempt_leaves_the_old_array(spark, tmp_path):
    path = f"{tmp_path}/array"
    sinks.json_array(spark.range(10), path)
    before = arrays.index(path)
    broken = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception):
        sinks.json_array(broken, path)
    assert arrays.index(path) == before and readers.json_documents(spark, path, "id long").count() == 10
    open(f"{path}/part-000000-dead-attempt.json", "w").write('{"id": 99},\n{"id"')  # what a killed task leaves
    assert [r["id"] for r in rows(readers.json_documents(spark, path, "id long"))] == list(range(10))
    sinks.json_array(spark.range(3), path, file=f"{tmp_path}/one.json")
    assert json.load(open(f"{tmp_path}/one.json")) == [{"id": 0}, {"id": 1}, {"id": 2}]
    assert not {p["name"] for p in before["parts"]} & set(os.listdir(path))


def test_empty_array(spark, tmp_path):
    sinks.json_array(spark.createDataFrame([], SCHEMA), f"{tmp_path}/a", ["id"], f"{tmp_path}/one.json")
    assert json.load(open(f"{tmp_path}/one.json")) == [] and readers.json_documents(spark, f"{tmp_path}/a", SCHEMA).count() == 0


def test_one_file_of_an_array_splits(spark, tmp_path):
    """A file of one array is read by several tasks, none of which holds the array; arrays whose lines are no whole elements are read as before."""
    df = table(spark).withColumn("text", F.concat(F.col("text"), F.lit('\\"{[}]\\\\ },{ "')))
    sinks.json_array(df, f"{tmp_path}/array", ["id"], f"{tmp_path}/one.json")
    most = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        own = readers.json_documents(spark, f"{tmp_path}/one.json", SCHEMA)
        assert own.rdd.getNumPartitions() > 2 and rows(own) == rows(df)
        (tmp_path / "folder").mkdir()
        for k in range(2):
            open(f"{tmp_path}/folder/{k}.json", "w").write(open(f"{tmp_path}/one.json").read().replace("\n", "\r\n\n"))
        assert arrays.element_lines(spark, f"{tmp_path}/folder") is not None
        assert rows(readers.json_documents(spark, f"{tmp_path}/folder", SCHEMA)) == rows(df.unionByName(df))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)


@pytest.mark.parametrize("text", [
    '[\n{"id": 1, "in": [{"a": 1},\n{"a": 2}]},\n{"id": 2}\n]', '[\n{"id": 1}, {"id": 2}\n]', '[{"id": 1},\n{"id": 2}]', '[\n{"id": 1\n},\n{"id": 2}\n]', '[{"id": 1}, {"id": 2}]', '[\n{"id": 1, "in": {"a": 1}},\n{"id": 2, "in": {\n"a": "}"}}\n]',
    '[\n{"id": 1, "in": "\\\\\\"}"},\n{"id": 2,\n"in": "{"}\n]', '[\n{"id": 1},\n{"id": 2}\n]\n[\n{"id": 3}\n]', '[\n{"id": 1}\n,\n{"id": 2}\n]', '\n[\n\t{"id": 1, "in": [[{}, {}], {}]},\n {"id": 2}\n]\n\n',
])
def test_arrays_in_any_lines(spark, tmp_path, text):
    path = f"{tmp_path}/x.json"
    open(path, "w").write(text)
    assert [r["id"] for r in rows(readers.json_documents(spark, path, "id long"))] == [1, 2]
