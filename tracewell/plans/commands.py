"""The command line: run, ids, both, snapshot, report, stage."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.operators import evaluate, links, selection, verdicts
from tracewell.plans import pipeline
from tracewell.sources import readers, sinks
from tracewell.sources import schemas as S


def truth_of(spark: SparkSession, paths: list[str]) -> DataFrame | None:
    return evaluate.ground_truth(readers.ground_truth(spark, paths)) if paths else None


def list_ids(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The ids that a selection asks for, in the order of a run."""
    return pipeline.choose_ids(readers.catalog(spark, a.catalog), a.top, a.years, a.quarters, a.deduplicate)


def both(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """The monthly and the all-time selection as one run over their union, and a snapshot of each one's results. Returns the sizes of the
    lists, their union and overlap."""
    catalog = readers.catalog(spark, f"{a.snapshots}/catalog.csv")
    monthly = pipeline.choose_ids(catalog, a.monthly_top, a.years, None, a.deduplicate)
    alltime = pipeline.choose_ids(catalog, a.alltime_top, None, None, a.deduplicate)
    ids = selection.union_ids(monthly, alltime).withColumn("pos", F.col("id"))  # a union is sorted by id
    rows = pipeline.run(spark, a.snapshots, a.out, ids=ids, answers=spark.read.parquet(a.answers) if a.answers else None, truth=truth_of(spark, a.ground_truth))
    record = readers.json_documents(spark, f"{a.out}/results", S.RESULTS)
    sinks.run_snapshot({"results": record}, monthly, f"{a.out}/runs", f"top{a.monthly_top}_per_month")
    sinks.run_snapshot({"results": record}, alltime, f"{a.out}/runs", f"top{a.alltime_top}")
    return selection.overlap(monthly, alltime)


def scored(spark: SparkSession, results: str, truth: DataFrame) -> DataFrame:
    """Written results against labels."""
    rows = readers.json_documents(spark, results, S.RESULTS).select("id", "conclusion.*")
    return evaluate.scored(rows.select("id", "chip_provider", "chip_provider_source", "chip_provider_confidence"), truth)


def report(spark: SparkSession, a: argparse.Namespace) -> dict[str, DataFrame]:
    """The outcome matrix, failures and misses of each result, and of two the rows that changed between them."""
    truth, out, runs = truth_of(spark, a.ground_truth), {}, []
    for path in a.results:
        rows = scored(spark, path, truth)
        runs.append(rows)
        out |= {f"{path}: outcomes": evaluate.outcome_matrix(rows), f"{path}: failures": evaluate.failures(rows), f"{path}: misses": evaluate.misses(rows)}
    if len(runs) == 2:
        out["changed"] = evaluate.run_diff(*runs)
    return out


STAGES = ("links", "collections", "card", "code", "paper")


def stage(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    """One stage by itself over a snapshot folder, of listed ids only where a list is given: the choice of links, the papers that trusted
    collections tell of, or the verdict of one kind of text (of code and papers: those that the card's own links lead to). Written as
    one JSON array in order of id."""
    table = lambda name: spark.read.parquet(f"{a.snapshots}/{name}")
    n = iter(range(1 << 30))

    def keep(df: DataFrame) -> DataFrame:
        path = f"{a.out}/work/{next(n)}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    cards = table("cards").select("id", "modelcard")
    cards = cards.join(readers.id_list(spark, a.ids_file).select("id"), "id", "left_semi") if a.ids_file else cards
    if a.name == "collections":
        out = links.propagate(table("collection_item"), cards)
    elif a.name == "card":
        out = verdicts.card_verdicts(selection.drop_blank(cards))
    else:
        out = pipeline.link_and_rank(selection.drop_blank(cards), table("collection_item"))
        if a.name == "code":
            out = verdicts.code_verdicts(keep(out), table("repo_tree"), table("repo_file"), keep)
        elif a.name == "paper":
            out = verdicts.paper_verdicts(keep(out), table("paper_html"), table("paper_text"), keep)
        else:
            out = out.drop("modelcard")
    if "chip_providers_all" in out.columns:
        out = out.withColumn("chip_providers_all", F.map_from_entries("chip_providers_all"))
    out = keep(out)
    sinks.json_array(out, f"{a.out}/{a.name}", ["id"])
    return out


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tracewell")
    commands = p.add_subparsers(dest="command", required=True)

    def chooses(c: argparse.ArgumentParser) -> None:
        c.add_argument("--top", type=int, default=0)
        bucket = c.add_mutually_exclusive_group()
        bucket.add_argument("--years")
        bucket.add_argument("--quarters")
        c.add_argument("--deduplicate", action="store_true")

    def judges(c: argparse.ArgumentParser) -> None:
        c.add_argument("--answers", help="Parquet table (id, answer) of reviewers' texts")
        c.add_argument("--ground-truth", nargs="*", default=[])

    c = commands.add_parser("run", help="the whole run over a snapshot folder")
    c.add_argument("snapshots")
    c.add_argument("out")
    chooses(c)
    judges(c)
    c.add_argument("--ids-file")
    c = commands.add_parser("ids", help="write the ids that a selection asks for")
    c.add_argument("catalog")
    c.add_argument("out")
    chooses(c)
    c = commands.add_parser("both", help="the monthly and the all-time selection in one run")
    c.add_argument("snapshots")
    c.add_argument("out")
    c.add_argument("--monthly-top", type=int, default=50)
    c.add_argument("--years", required=True)
    c.add_argument("--alltime-top", type=int, default=10_000)
    c.add_argument("--deduplicate", action="store_true")
    judges(c)
    c = commands.add_parser("snapshot", help="copy results, of listed ids only where a list is given")
    c.add_argument("results")
    c.add_argument("out")
    c.add_argument("--suffix", required=True)
    c.add_argument("--ids-file")
    c = commands.add_parser("report", help="score results against labels; two are compared")
    c.add_argument("results", nargs="+")
    c.add_argument("--ground-truth", nargs="+", required=True)
    c = commands.add_parser("stage", help="one stage by itself over a snapshot folder")
    c.add_argument("name", choices=STAGES)
    c.add_argument("snapshots")
    c.add_argument("out")
    c.add_argument("--ids-file")
    return p


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    spark = SparkSession.builder.appName("tracewell").getOrCreate()
    if a.command == "ids":
        sinks.id_list(list_ids(spark, a), a.out)
    elif a.command == "both":
        both(spark, a).show()
    elif a.command == "snapshot":
        sinks.run_snapshot({"results": readers.json_documents(spark, a.results, S.RESULTS)}, readers.id_list(spark, a.ids_file) if a.ids_file else None, a.out, a.suffix)
    elif a.command == "stage":
        out = stage(spark, a)
        told = [c for c in ("chip_provider", "chip_provider_confidence", "chip_providers_all", "main_github", "main_github_confidence", "main_arxiv", "main_arxiv_confidence", "collection_paper_ids") if c in out.columns]
        out.select("id", *told).orderBy("id").show(20, truncate=False)
    elif a.command == "report":
        for name, rows in report(spark, a).items():
            print(name)
            rows.show(1000, truncate=False)
    else:
        truth = truth_of(spark, a.ground_truth)
        ids = readers.id_list(spark, a.ids_file) if a.ids_file else None
        rows = pipeline.run(spark, a.snapshots, a.out, a.top, a.years, a.quarters, a.deduplicate, ids, spark.read.parquet(a.answers) if a.answers else None, truth)
        if truth is not None:
            evaluate.accuracy(rows).show()
            evaluate.mismatches(rows).show(1000, truncate=False)
            evaluate.outcome_matrix(evaluate.scored(rows, truth)).show(1000)


if __name__ == "__main__":
    main()
