"""Language identification by multinomial naive Bayes over hashed character n-grams.

Features are the 1-, 2- and 3-grams of a text's letters in lower case, every run of other characters as one space, hashed
to BUCKETS.  Training sums n-gram counts by language over a sample of labelled rows, bounded for each language by itself so
that rare ones are learnt too, with the sums made by aggregation; the priors are the shares of all labelled rows.  Every label is
learnt: the log-probability matrix is cut into blocks of BLOCK_LANGUAGES columns, of which the driver holds one at a time; each is
broadcast, and scoring passes a document from block to block with its best language so far and the sum of all.
A text above a million characters is cut at white space near every million, and no n-gram crosses a cut.
Scoring takes a batch as one array of code points: n-gram hashes, a gather from the matrix, and sums by document.

The score is the posterior of the best language, with log-likelihoods scaled to that of EVIDENCE n-grams at most: n-grams of
a text depend on one another, and plain naive Bayes would call every long text certain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.llm.common import stored

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
#: Rows that training reads, about, shared out evenly among languages (each LEAST_ROWS, or all it has): a hash of doc_id picks them.
TRAIN_ROWS, LEAST_ROWS = 12_000, 100
#: Languages of one broadcast block, 256 KB each.
BLOCK_LANGUAGES = 128
EVIDENCE = 60
UNKNOWN = "und"
#: The pipeline rejects documents with a score under this, and those of no language.
LEAST_SCORE = 0.5
_CHARS = 1 << 20


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each n-gram, its text, letters of each text). N-grams do not cross texts."""
    joined = "\n".join(t.replace("\n", " ") for t in texts).lower()  # the line feeds left part the texts
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters(points)
    cut = points == 10
    keep = letter | cut
    gap = ~keep
    gap[1:] &= keep[:-1]  # of a run of other characters the first stays, as a space
    at = np.flatnonzero(keep | gap)
    owner = np.cumsum(cut)[at]
    own = np.where(gap[at], np.uint32(32), points[at])
    part = cut[at]
    n_letters = np.bincount(owner[letter[at]], minlength=len(texts))
    buckets, owners = [], []
    hashed = np.zeros(len(own), np.uint64)
    broken = np.zeros(len(own), bool)
    for k in range(max(ORDERS)):
        n = len(own) - k
        if n <= 0:
            break
        hashed = (hashed[:n] + own[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        broken = broken[:n] | part[k : k + n]
        if k + 1 in ORDERS:
            good = ~broken
            buckets.append(((hashed[good] ^ (hashed[good] >> np.uint64(29))) >> np.uint64(16)).astype(np.int64) % BUCKETS)
            owners.append(owner[:n][good])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *buckets]), np.concatenate([none, *owners]), n_letters


_TABLE: dict[str, np.ndarray] = {}


def _letters(points: np.ndarray) -> np.ndarray:
    """Which code points are letters, by Python's Unicode tables."""
    if "letter" not in _TABLE:
        _TABLE["letter"] = np.array([chr(c).isalpha() for c in range(1 << 16)])
    table = _TABLE["letter"]
    out = table[np.minimum(points, (1 << 16) - 1)]
    high = np.flatnonzero(points >= 1 << 16)
    if len(high):
        out[high] = [chr(c).isalpha() for c in points[high].tolist()]
    return out


def pieces(text: str, most: int = _CHARS) -> Iterator[str]:
    """The text, cut behind the last white space of every most characters (or there, where these have none)."""
    at = 0
    while len(text) - at > most:
        cut = max(text.rfind(" ", at, at + most), text.rfind("\n", at, at + most)) + 1
        cut = cut if cut > at else at + most
        yield text[at:cut]
        at = cut
    yield text[at:] if at else text


def chunks(texts: list[str], most: int = _CHARS) -> Iterator[tuple[list[int], list[str]]]:
    """Pieces of texts, of about most characters together, and the place of each one's text."""
    places, part, size = [], [], 0
    for k, t in enumerate(texts):
        for piece in pieces(t, most):
            places.append(k)
            part.append(piece)
            size += len(piece)
            if size >= most:
                yield places, part
                places, part, size = [], [], 0
    if part:
        yield places, part


#: Languages, their log-probabilities (BUCKETS x languages, float32) and the logarithms of their shares.
Block = tuple[list[str], np.ndarray, np.ndarray]


def rated(texts: list[str | None], block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Scaled log-likelihoods with priors of texts in a block's languages, and which texts have letters."""
    languages, logs, priors = block
    sums, n, letters = np.zeros((len(texts), len(languages))), np.zeros(len(texts)), np.zeros(len(texts), np.int64)
    for places, part in chunks([t or "" for t in texts]):
        bucket, owner, own = grams(part)
        at = np.array(places)
        for k in range(len(languages)):
            np.add.at(sums[:, k], at, np.bincount(owner, logs[:, k][bucket], minlength=len(part)))
        np.add.at(n, at, np.bincount(owner, minlength=len(part)))
        np.add.at(letters, at, own)
    return sums * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None] + priors, letters > 0


#: What a document takes from block to block: its best value, whose it is, and the sum of all, as a share of the best.
State = tuple[np.ndarray, np.ndarray, np.ndarray]


def fresh(n: int) -> State:
    return np.full(n, -np.inf), np.full(n, UNKNOWN, object), np.zeros(n)


def merged(state: State, languages: list[str], values: np.ndarray) -> State:
    """The state after a block; of equal values the earlier language counts."""
    best, name, total = state
    if not len(best):
        return state
    own, high = values.max(1), np.maximum(best, values.max(1))
    total = total * np.exp(best - high) + np.exp(values - high[:, None]).sum(1)
    return high, np.where(own > best, np.array(languages, object)[values.argmax(1)], name), total


class Model:
    """blocks: broadcasts of the model's blocks, languages in ascending order."""

    def __init__(self, blocks: list):
        self.blocks = blocks

    @property
    def languages(self) -> list[str]:
        return [x for block in self.blocks for x in block.value[0]]

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        state = fresh(len(texts))
        for block in self.blocks:
            values, known = rated(texts, block.value)
            state = merged(state, block.value[0], values)
        return told(state, known)


def told(state: State, known: np.ndarray) -> tuple[list[str], list[float]]:
    return [x if k else UNKNOWN for x, k in zip(state[1].tolist(), known)], np.where(known, 1 / np.maximum(state[2], 1), 0.0).tolist()


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of docs' labelled texts. docs must be the rows that may be learnt from; rows without lang are left out."""
    spark = docs.sparkSession
    labelled = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").select("doc_id", "lang", "text")
    there = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    if not there:
        return Model([spark.sparkContext.broadcast(([UNKNOWN], np.zeros((BUCKETS, 1), np.float32), np.zeros(1)))])
    each = max(LEAST_ROWS, rows // len(there))
    shares = spark.createDataFrame([(lang, min(1 << 20, -(-(1 << 20) * each // n))) for lang, n in there.items()], "lang string, share long")
    labelled = labelled.join(F.broadcast(shares), "lang").filter(F.pmod(F.xxhash64("doc_id", F.lit("langid")), F.lit(1 << 20)) < F.col("share"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}

        def rows_of() -> Iterator[pa.RecordBatch]:
            for lang, own in sums.items():
                some = np.flatnonzero(own)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(some), pa.string()), pa.array(some), pa.array(own[some].astype(np.int64))], ["lang", "bucket", "n"])
            sums.clear()

        for batch in batches:
            langs = batch.column(0).to_pylist()
            for places, part in chunks(batch.column(1).to_pylist()):
                bucket, owner, _ = grams(part)
                own = [langs[k] for k in places]
                for lang in dict.fromkeys(own):
                    mine = np.array([x == lang for x in own])
                    sums[lang] = sums.get(lang, 0) + np.bincount(bucket[mine[owner]], minlength=BUCKETS)
                    if len(sums) >= BLOCK_LANGUAGES:
                        yield from rows_of()
        yield from rows_of()

    def column(table: pa.Table) -> pa.Table:
        """One language's log-probabilities; its counts are BUCKETS rows at most."""
        own = np.full(BUCKETS, 0.5)
        own[table.column("bucket").to_numpy()] += table.column("n").to_numpy()
        return pa.table({"lang": table.column("lang")[:1], "logs": pa.array([np.log(own / own.sum()).astype(np.float32).tobytes()], pa.binary())})

    counts = labelled.select("lang", "text").mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    columns = counts.groupBy("lang").applyInArrow(column, "lang string, logs binary")
    languages, total, blocks = sorted(there), sum(there.values()), []
    columns = stored(columns, "languages") if len(languages) > BLOCK_LANGUAGES else columns
    for k in range(0, len(languages), BLOCK_LANGUAGES):
        own = languages[k : k + BLOCK_LANGUAGES]
        logs = np.full((BUCKETS, len(own)), -np.log(BUCKETS), np.float32)  # of a language none of whose rows was picked
        for r in columns.filter(F.col("lang").isin(own)).collect():  # BLOCK_LANGUAGES rows at most
            logs[:, own.index(r["lang"])] = np.frombuffer(r["logs"], np.float32)
        blocks.append(spark.sparkContext.broadcast((own, logs, np.log(np.array([there[x] for x in own], float) / total))))
    return Model(blocks)


def scored(docs: DataFrame, model: Model, least: float | None = None) -> DataFrame:
    """docs with lang_pred and score, only rows with a score of least or more where that is given. A text that is null or has no letter:
    "und", score 0. docs' columns keep their names, whatever these are."""
    names, at = docs.columns, docs.columns.index("text")
    rows = docs.toDF(*(f"c{k}" for k in range(len(names))))  # names with dots don't pass
    own, n = [f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema.fields)], len(names)

    def a_pass(shared, first: bool, last: bool):
        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values, known = rated(batch.column(at).to_pylist(), shared.value)
                before = fresh(batch.num_rows) if first else tuple(batch.column(n + k).to_numpy(zero_copy_only=False) for k in range(3))
                best, name, total = merged(before, shared.value[0], values)
                columns = [batch.column(k) for k in range(n)]
                if not last:
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.float64()), pa.array(name.tolist(), pa.string()), pa.array(total, pa.float64())], [*(f"c{k}" for k in range(n)), "best", "name", "total"])
                    continue
                labels, scores = told((best, name, total), known)
                out = pa.RecordBatch.from_arrays([*columns, pa.array(labels, pa.string()), pa.array(scores, pa.float64())], [*(f"c{k}" for k in range(n)), "lang_pred", "score"])
                yield out if least is None else out.filter(pa.array([s >= least for s in scores], pa.bool_()))

        return score

    for k, shared in enumerate(model.blocks):
        last = k == len(model.blocks) - 1
        rows = rows.mapInArrow(a_pass(shared, not k, last), ", ".join([*own, *(("lang_pred string", "score double") if last else ("best double", "name string", "total double"))]))
    return rows.toDF(*names, "lang_pred", "score")


def identify(docs: DataFrame) -> DataFrame:
    """doc_id, held_out (the crc32 of the doc_id's text divides by 5), lang_pred, score of every row of docs.

    Learns from rows that are not held out and whose lang is not null. A null doc_id is not held out and not learnt from.
    Repeated rows are each scored; an empty table, or one without a label, predicts "und" only. Other columns are not
    looked at.
    """
    model = train(docs.filter(~held_out()))
    rows = scored(docs.select("doc_id", held_out().alias("held_out"), "text"), model)
    return rows.select("doc_id", "held_out", "lang_pred", "score")


def keep_known(docs: DataFrame, least: float = LEAST_SCORE) -> DataFrame:
    """docs without the rows that have no language: no letter (null and empty texts too), or a score under least. All columns stay as they
    are. Each row is judged by its own text, repeated ones alike; an empty table gives an empty result, and one without any lang nothing
    but what has no letter: its one answer has a score of 1.
    """
    found = scored(docs, train(docs.filter(~held_out())), least)  # a score is 0 without a letter
    n = len(docs.columns)
    return found.toDF(*(f"c{k}" for k in range(n + 2))).select(*(f"c{k}" for k in range(n))).toDF(*docs.columns)
