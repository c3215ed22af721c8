"""Each stage of the command line by itself, over a small snapshot folder."""

import pytest

from tracewell.plans import commands
from tracewell.sources import readers

CARD = "# M\nCode: https://github.com/o/m and our paper https://arxiv.org/abs/2401.00001 tell.\n## Training\nWe trained it on 64 A100 GPUs with NCCL for 20 days of training.\n"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("stages")
    make = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}")
    make([("o/m", CARD), ("q/n", "# n\nnothing"), ("r/blank", " \n"), ("r/null", None)], "id string, modelcard string", "cards")
    make([("o", "m", "train.py", 0)], "owner string, repo string, path string, path_pos int", "repo_tree")
    make([("o", "m", "train.py", "torchrun --nproc 8 # CUDA_VISIBLE_DEVICES, nccl, A100 and H100 training run\nimport flash_attn")], "owner string, repo string, path string, content string", "repo_file")
    make([], "arxiv_id string, html string", "paper_html")
    make([("2401.00001", "Abstract\nWe train.\n1 Introduction\nwords\n2 Training\nThe model was trained on 512 TPU v4 chips for 12 days of pretraining.\nReferences\n")], "arxiv_id string, text string", "paper_text")
    make([("o", "o/all", 0, "model", "q/n"), ("o", "o/all", 0, "paper", "2402.00002")], "owner string, slug string, owner_pos int, item_type string, item_id string", "collection_item")
    (path / "list.txt").write_text("q/n\n")
    return str(path)


def run(spark, folder, out, name, *more):
    commands.main(["stage", name, folder, out, *more])
    return {r["id"]: r for r in readers.json_documents(spark, f"{out}/{name}", "id string, chip_provider string, chip_providers_all map<string,double>, main_github string, main_arxiv string, collection_paper_ids array<string>, error string").collect()}


def test_stages(spark, folder, tmp_path, capsys):
    links = run(spark, folder, str(tmp_path), "links")
    assert set(links) == {"o/m", "q/n"} and links["o/m"]["main_github"] == "https://github.com/o/m"
    assert (links["o/m"]["main_arxiv"], links["q/n"]["main_arxiv"]) == ("https://arxiv.org/abs/2401.00001", "https://arxiv.org/abs/2402.00002")
    card = run(spark, folder, str(tmp_path), "card")
    assert (card["o/m"]["chip_provider"], card["q/n"]["chip_provider"]) == ("nvidia", "unknown") and card["o/m"]["chip_providers_all"]["nvidia"] > 0
    code = run(spark, folder, str(tmp_path), "code")
    assert (code["o/m"]["chip_provider"], code["q/n"]["chip_provider"]) == ("nvidia", "unknown")
    paper = run(spark, folder, str(tmp_path), "paper")
    assert paper["o/m"]["chip_provider"] == "google_tpu" and paper["q/n"]["error"] == "fetch_failed"
    assert {i: r["collection_paper_ids"] for i, r in run(spark, folder, str(tmp_path), "collections").items()} == {"q/n": ["2402.00002"]}
    assert "google_tpu" in capsys.readouterr().out
    assert set(run(spark, folder, str(tmp_path / "few"), "card", "--ids-file", f"{folder}/list.txt")) == {"q/n"}
    with pytest.raises(SystemExit):
        commands.main(["stage", "nothing", folder, str(tmp_path)])
