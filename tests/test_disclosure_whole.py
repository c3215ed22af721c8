"""Disclosures are seen wherever they stand in a card."""

from tracewell import queries


def test_late_disclosure(spark, tmp_path):
    text = "plain words " * 400 + "\n## Hardware\nWe trained the model on 8 A100 GPUs.\n## Other\nplain words\n"
    spark.createDataFrame([(5, text), (12, "plain words")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.QUERIES["disclosure_flags_whole"](spark, str(tmp_path)).collect()
    late = sorted((r for r in rows if r["doc_id"] == 5), key=lambda r: r["pos"])[-2:]
    assert [r["disclosure"] for r in late] == [True, False]
