"""The registered queries over repositories and papers read every document."""

from pyspark.sql import functions as F

from tracewell import queries


def test_every_document(spark, tmp_path):
    texts = {k: f"Words of {k}." for k in (0, 1, 59, 60, 520, 1040, 123_456, 1_123_456)}
    rows = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    rows.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, f"http://x/{k}", "<p>" + "word " * 300 + "</p>") for k in (0, 1, 2, 3)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    models, tree, files, papers = queries._snapshots(spark, str(tmp_path))
    own = papers.select("arxiv_id", "text").collect()
    assert len({r["arxiv_id"] for r in own}) == len(own) == len(texts)
    assert all(any(t in r["text"] for r in own) for t in texts.values())
    readme = files.filter("path = 'README.md'").collect()
    assert len({(r["owner"], r["repo"]) for r in readme}) == len(readme) == len(texts)
    assert all(any(t in r["content"] for r in readme) for t in texts.values())
    assert models.count() == len(texts) + 4
    for name in ("paper_verdicts", "code_verdicts"):
        out = queries.QUERIES[name](spark, str(tmp_path))
        assert out.filter(F.col("error").isNull()).count() == len(texts) + 4
    # one chain: the links chosen are those that the verdicts read, mirrors stay, papers come in both forms
    html = queries.QUERIES["paper_verdicts"](spark, str(tmp_path)).groupBy("source_render").count().collect()
    assert {r["source_render"] for r in html} == {"html", "pdf"}
    out = queries.QUERIES["end_to_end"](spark, str(tmp_path)).collect()
    assert len(out) == len({r["id"] for r in out}) == len(texts) + 4
    for r in out:
        k = int(r["id"].split("-")[1])
        assert r["main_github"] == f"https://github.com/org{k % 13}/repo{k}" and r["main_arxiv"] == f"https://arxiv.org/abs/2401.{k:05d}"[: len(r["main_arxiv"])]
    by_id = {r["id"]: r for r in out}
    mirrored = [i for i in by_id if f"{i}-mirror" in by_id]
    assert len(mirrored) == 4 and all(by_id[i]["gh_chip_provider"] == by_id[f"{i}-mirror"]["gh_chip_provider"] for i in mirrored)
    assert {r["chip_provider_source"] for r in out} - {None} and any(r["gh_chip_provider"] != "unknown" for r in out)
