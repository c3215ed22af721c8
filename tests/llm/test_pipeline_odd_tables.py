"""Every stage on nulls, repeats, empty tables and columns with clashing names."""

import pytest

import corpus_pipeline

NAMES = ("n_lines", "n_removed", "__h", "first", "fp", "own", "row", "score", "lang_pred", "drops", "contaminated", "text_hash", "__id", "bad_id", "at", "a.b")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` int" for n in NAMES)
LONG = " ".join(f"word{'abcdefghij'[k % 10]}{'klmnop'[k % 6]} of the" for k in range(400))
ROWS = [(1, "The only text of the first document here", "en", "a", 10), (1, "The second text of that very same identifier", "en", "b", 20), (1, "The second text of that very same identifier", "en", "b", 20), (None, "A text of no identifier at all", "en", None, None), (None, None, None, None, None), (2, None, "en", "a", 0), (3, "", None, "a", 0), (4, "12 -- 34", "en", "a", 0), (5, LONG, "en", "a", 0), (6, LONG + " changed", "en", "a", 0), (7, "A null source and a lang of null", None, None, None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    spark.createDataFrame([(1, "An item of the benchmark with more than ten words in a row of it"), (None, None), (2, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def table(spark, rows):
    return spark.createDataFrame([(*r, *range(len(NAMES))) for r in rows], SCHEMA)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_odd_rows(spark, folder, name, stage):
    docs = table(spark, ROWS)
    out = stage(spark, docs, folder)
    rows = out.collect()
    if name == "packing":
        assert len({r["doc_id"] for r in rows}) == 8 and len(rows) >= len(ROWS)
        return
    assert out.columns == docs.columns
    assert all(tuple(r[n] for n in NAMES[:-1]) == tuple(range(len(NAMES) - 1)) for r in rows)
    found = sorted(((r["doc_id"], r["text"]) for r in rows), key=str)
    want = {
        "language": [r[:2] for r in ROWS if r[1] and any(c.isalpha() for c in r[1])],
        "line_dedup": [r[:2] for r in ROWS],
        "near_duplicates": [r[:2] for r in ROWS if r[0] != 6 and r[:2] not in ((3, ""), (4, "12 -- 34"))][:2] + [r[:2] for r in ROWS[3:] if r[0] not in (3, 6)],
        "decontamination": [r[:2] for r in ROWS],
    }[name]
    assert found == sorted(want, key=str)


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_empty_table(spark, folder, name, stage):
    assert stage(spark, table(spark, []), folder).count() == 0
