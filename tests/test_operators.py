"""Selection, links, ranking, sections, inheritance, evaluation, sources and the whole run, on small tables."""

import pytest
from pyspark.sql import functions as F

from tracewell.functions.ordered import append_new
from tracewell.operators import evaluate, links, ranking, selection
from tracewell.operators import text as T
from tracewell.operators.inherit import inherit
from tracewell.plans import pipeline
from tracewell.sources import readers, remote, sinks
from tracewell.streaming import cards as streaming


@pytest.mark.parametrize("model, stem", [
    ("Qwen/Qwen3-7B-Instruct", "Qwen/Qwen3"), ("Qwen/Qwen3-14B-Instruct-AWQ", "Qwen/Qwen3"), ("Qwen/Qwen3-0.5B-Base", "Qwen/Qwen3"), ("Qwen/Qwen3-VL", "Qwen/Qwen3-VL"), ("mistralai/Mistral-7B-v0.1", "mistralai/Mistral"),
    ("deepseek-ai/DeepSeek-V2", "deepseek-ai/DeepSeek-V2"), ("a/b-2407", "a/b"), ("a/b-20240715", "a/b"), ("bert-base-uncased", "bert-base-uncased"), ("x/codec-24kHz", "x/codec"), ("x/m-Chat-Chat-FP8", "x/m"), ("x/a-Instruct-2507-FP8-7b", "x/a"),
])
def test_family_stem(spark, model, stem):
    once = selection.family_stem(F.lit(model))
    r = spark.range(1).select(once.alias("a"), selection.family_stem(once).alias("b")).first()
    assert r["a"] == stem == r["b"]


def test_years_and_quarters(spark):
    assert selection.parse_years("2021, 2023-2025") == {2021, 2023, 2024, 2025}
    rows = [("2024-07-15T00:00:00Z", None), ("None", "2023-02-01"), ("", ""), ("2024-13-01", "2022-12-31"), ("junk", "also"), (None, "2020-01")]
    year, month = selection.year_month(F.col("a"), F.col("b"))
    found = [tuple(r) for r in spark.createDataFrame(rows, "a string, b string").coalesce(1).select(year, month, selection.quarter(month)).collect()]
    assert found == [(2024, 7, 3), (2023, 2, 1), (None, None, None), (2022, 12, 4), (None, None, None), (2020, 1, 1)]


def test_top_of_zero_is_no_cap(spark):
    df = spark.createDataFrame([(k, k, 2024, 1) for k in range(5)], "id int, rank int, year int, month int")
    assert selection.top_per_month(df, 0).count() == 5 == selection.top_overall(df, 0).count()
    assert selection.top_per_month(df, 2).count() == 2 == selection.top_per_quarter(df, 2).count()


def test_links(spark):
    text = "See https://github.com/Org/Repo.git, [x](https://github.com/org/r2/blob/main/a.py) https://github.com/sponsors/a https://github.com/o/r3#readme https://github.com/Org/Repo\nhttps://arxiv.org/pdf/2401.00001v2.pdf url={https://arxiv.org/abs/2302.1234} eprint = {2407.20750v1} eprint={2302.1234}"
    r = spark.createDataFrame([(text,), (None,)], "t string").coalesce(1).select(links.repo_links(F.col("t")).alias("r"), links.paper_links(F.col("t")).alias("p")).collect()
    assert r[0]["r"] == ["https://github.com/Org/Repo", "https://github.com/o/r3"] and r[1]["r"] == [] == r[1]["p"]
    assert r[0]["p"] == [f"https://arxiv.org/abs/{x}" for x in ("2401.00001", "2302.1234", "2407.20750")]
    urls = ["https://github.com/a/b.git/", "http://github.com/a/b.", "https://github.com/a", "https://gitlab.com/a/b"]
    found = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "u string").coalesce(1).select(links.repo_of_url(F.col("u"))).collect()]
    assert [f and tuple(f) for f in found] == [("a", "b"), ("a", "b"), None, None]
    assert spark.range(1).select(append_new(F.array(F.lit("b"), F.lit("a")), F.array(F.lit("a"), F.lit("c"))).alias("x")).first()["x"] == ["b", "a", "c"]


def test_link_ranking(spark):
    card = "# Whisper\nThe code of this repository: https://github.com/openai/whisper\n\n" + "text " * 60 + "\n| [t](https://github.com/huggingface/transformers) | x |\npip install git+https://github.com/other/thing\n```bibtex\nhttps://github.com/cited/one\n```\n" + "tail " * 200
    own = ["https://github.com/openai/whisper", "https://github.com/huggingface/transformers", "https://github.com/other/thing", "https://github.com/cited/one"]
    cards = spark.createDataFrame([("openai/whisper-large", card, own, ["https://arxiv.org/abs/2212.04356"]), ("a/b", "", [], [])], "id string, modelcard string, github_links array<string>, arxiv_links array<string>")
    reasons = {r["link"]: r["reasons"] for r in ranking.repo_candidates(cards).collect()}
    assert {"model name in repo name", "org exact match", "very early in card", "intro keyword context"} == set(reasons[own[0]])
    assert "inside table row" in reasons[own[1]] and "only in pip install context" in reasons[own[2]] and "inside bibtex" in reasons[own[3]]
    rows = {r["id"]: r for r in ranking.choose(cards, "github").collect()}
    assert (rows["openai/whisper-large"]["main_github"], rows["openai/whisper-large"]["main_github_confidence"]) == (own[0], 0.95)
    assert (rows["a/b"]["main_github"], rows["a/b"]["main_github_confidence"]) == (None, 0.0)
    papers = ranking.choose(cards, "arxiv").filter("id <> 'a/b'").first()
    assert papers["main_arxiv"] == "https://arxiv.org/abs/2212.04356" and papers["main_arxiv_confidence"] >= 0.7
    taken = ranking.take_answers(ranking.choose(cards, "github"), spark.createDataFrame([("openai/whisper-large", own[2])], "id string, answer string"), "github")
    assert taken.filter("main_github_source = 'llm'").count() == 1


def test_sections(spark):
    html = "<p>front</p><h2>Abstract</h2>short &amp; sweet<h2>3 Training <b>Setup</b></h2>" + "x " * 9000 + "<h4>minor</h4>more<h3>References</h3>[1]"
    plain = "A" * 250 + "\n1 Introduction\nintro\n2 Method\nhow\n3.1 Training Setup\nGPUs\nReferences\n[1] x"
    r = spark.createDataFrame([(html, plain, "few words\n1 Introduction\nx")], "h string, p string, q string").select(T.html_sections(F.col("h")).alias("h"), T.render_ok(F.col("h")).alias("ok"), T.plain_sections(F.col("p")).alias("p"), T.plain_sections(F.col("q")).alias("q")).first()
    assert [s["section_type"] for s in r["h"]] == ["abstract", "body", "abstract", "training", "references"] and r["h"][0]["text"] == "short & sweet" and len(r["h"][3]["text"]) == 15000 and r["ok"]
    assert [s["section_type"] for s in r["p"]] == ["abstract", "body", "method", "training", "references"] and [s["section_type"] for s in r["q"]] == ["training"]


def brute_inherit(rows):
    state = {r[0]: [r[2], r[3]] for r in rows}
    for node, _, chip, _, _, derived, base, runtime in sorted(rows, key=lambda r: r[1]):
        if not derived:
            continue
        if base in state and state[base][0] != "unknown" and state[base][1] >= 0.3:
            state[node] = [state[base][0], min(state[base][1], 0.7)]
        elif runtime == "mlx" and chip == "apple":
            state[node] = ["unknown", 0.0]
    return {k: tuple(v) for k, v in state.items()}


def test_inheritance_in_order(spark, tmp_path):
    rows = [("a", 5, "nvidia", 0.9, "modelcard", False, None, None), ("b", 1, "unknown", 0.0, None, True, "a", None), ("c", 2, "unknown", 0.0, None, True, "b", None), ("d", 6, "apple", 0.5, "x", True, "c", "mlx"), ("e", 7, "apple", 0.5, "x", True, "gone", "mlx"), ("f", 8, "unknown", 0.0, None, True, "d", None), ("g", 9, "amd", 0.5, "x", True, "f", None), ("h", 10, "apple", 0.2, "x", True, "h", "mlx"), ("i", 3, "amd", 0.5, "x", True, "g", None)]
    n = iter(range(99))

    def keep(df):
        path = f"{tmp_path}/{next(n)}"
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    df = spark.createDataFrame(rows, "id string, pos int, chip_provider string, chip_provider_confidence double, chip_provider_source string, is_derivative boolean, base_model string, runtime_library string")
    found = {r["id"]: (r["chip_provider"], r["chip_provider_confidence"]) for r in inherit(df, keep).collect()}
    assert found == brute_inherit(rows)


def test_labels_and_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text('who,id,position,method,provider,chip,source note\nx, m/1 ,1,top,Nvidia,A100,"two\nlines, ""quoted"""\ny,m/2,2,,unknown,,\n')
    (tmp_path / "b.csv").write_text("who,id,position,method,provider,chip,source note\nz,m/1,1,random,Huawei,910B,\n")
    truth = evaluate.ground_truth(readers.ground_truth(spark, [f"{tmp_path}/a.csv", f"{tmp_path}/b.csv"]))
    assert sorted(tuple(r) for r in truth.collect()) == [("m/1", "huawei_ascend", "random"), ("m/2", "unknown", "unscoped")]
    (tmp_path / "ids.txt").write_text("# ids\n\nb/1\na/1\nb/1\n")
    ids = readers.id_list(spark, f"{tmp_path}/ids.txt").orderBy("pos")
    assert [r["id"] for r in ids.collect()] == ["b/1", "a/1"]
    sinks.id_list(ids, f"{tmp_path}/out")
    assert [r["value"] for r in spark.read.text(f"{tmp_path}/out").collect()] == ["b/1", "a/1"]
    assert readers.optional(spark, f"{tmp_path}/none.json", "id string").count() == 0
    feed = "<feed xmlns='http://www.w3.org/2005/Atom'><entry><title>A  b</title><summary>words</summary><author><name>X</name></author><category term='cs.CL'/></entry></feed>"
    r = readers.paper_metadata(spark.createDataFrame([(feed,)], "xml string")).first()
    assert (r["title"], r["abstract"], r["authors"], r["categories"]) == ("A b", "words", ["X"], ["cs.CL"])


def test_retries():
    calls, waits = [], []

    def fetch(key):
        calls.append(key)
        if len(calls) < 3:
            raise remote.Retryable(429)
        return "ok"

    assert remote.with_retries(fetch, "k", waits.append) == "ok" and waits == [1.0, 2.0]

    def gone(key):
        raise remote.Retryable(404)

    assert remote.with_retries(gone, "k", waits.append) is None


def test_keyed_source(spark):
    spark.dataSource.register(remote.keyed_source("kept", lambda k: f"text of {k}", ["a", "b", "c"], 2))
    assert {r["key"]: r["content"] for r in spark.read.format("kept").load().collect()} == {k: f"text of {k}" for k in "abc"}


def test_card_stream(spark, tmp_path):
    spark.createDataFrame([("a/b", "# x\n## Training\nWe trained it on 64 A100 GPUs with CUDA and NCCL for 20 days.")], "id string, modelcard string").write.parquet(f"{tmp_path}/in")
    streaming.verdict_stream(streaming.arriving(spark, f"{tmp_path}/in"), f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    assert [r["chip_provider"] for r in spark.read.parquet(f"{tmp_path}/out").collect()] == ["nvidia"]


def test_whole_run(spark, tmp_path):
    card = "---\nlicense: mit\n---\n# M\nCode in this repository: https://github.com/o/m. Our paper: https://arxiv.org/abs/2401.00001\n## Training\nWe trained it on 64 A100 GPUs with NCCL for 20 days of training.\n"
    catalog = "id,downloads,likes,pipeline_tag,created_at,last_modified,tags,card_data\no/m,50,1,t,2024-07-15,2024-08-01,a|b,\"{\"\"x\"\": 1}\"\no/m-AWQ,40,1,t,2024-07-16,,,\nq/n,30,1,t,None,2024-03-01,,\n"
    (tmp_path / "catalog.csv").write_text(catalog)
    make = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}")
    make([("o/m", card), ("o/m-AWQ", "---\nbase_model: o/m\n---\n# quantized"), ("q/n", "# n\nnothing")], "id string, modelcard string", "cards")
    make([("o", "m", "train.py", 0), ("o", "m", "README.md", 1)], "owner string, repo string, path string, path_pos int", "repo_tree")
    make([("o", "m", "train.py", "import torch.distributed\nmodel.cuda()\ntorch.cuda.set_device(0)\ninit_process_group('nccl')\n")], "owner string, repo string, path string, content string", "repo_file")
    make([], "arxiv_id string, html string", "paper_html")
    make([("2401.00001", "We trained the model on 64 A100 GPUs for 20 days of training, using CUDA and NCCL.")], "arxiv_id string, text string", "paper_text")
    make([], "owner string, slug string, owner_pos int, item_type string, item_id string", "collection_item")
    found = {r["id"]: r for r in pipeline.run(spark, str(tmp_path), f"{tmp_path}/out", top=5, years="2024").collect()}
    assert {k: r["chip_provider"] for k, r in found.items()} == {"o/m": "nvidia", "o/m-AWQ": "nvidia", "q/n": "unknown"}
    assert found["o/m-AWQ"]["chip_provider_source"] == "base_model" and found["o/m-AWQ"]["chip_provider_confidence"] == 0.7
    written = {r["id"]: r for r in spark.read.json(f"{tmp_path}/out/results").collect()}
    assert written["o/m"]["conclusion"]["chip_provider"] == "nvidia" and written["o/m"]["github_resolution"]["selected_link"] == "https://github.com/o/m" and written["o/m"]["year"] == 2024


def test_share_rounds_half_to_even(spark):
    rows = spark.createDataFrame([(1, 16), (3, 16), (0, 0)], "n long, d long").select(evaluate.share(F.col("n"), F.col("d")).alias("s"))
    assert [r["s"] for r in rows.collect()] == [f"1/16 ({100 / 16:.1f}%)", f"3/16 ({300 / 16:.1f}%)", "0/0 (—)"]
