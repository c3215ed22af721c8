"""Quality scores from supervised subword embeddings, in the manner of a linear bag of hashed n-grams.

A word (cut at white space, case kept) stands for itself and its character 3- to 5-grams, hashed to BUCKETS rows of an
embedding; pairs of equal words at each distance up to LAGS share one more row a distance, whatever the word.  A document is the average over all of them, and a softmax layer scores it.  Embedding and layer are learnt by
stochastic gradient descent in numpy on the driver, from a bounded sample of labelled rows.  As averaging and the layer are
linear, scoring needs only each bucket's contribution to the difference of the two classes: that vector is broadcast, and
a worker keeps a bounded table of words it has met with their sums.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUCKETS, DIMENSIONS, ORDERS, LAGS = 1 << 17, 12, (3, 4, 5), 8
#: Labelled documents that training reads at most, about, and their characters; a hash of doc_id picks them.
TRAIN_ROWS, TRAIN_CHARS = 5_000, 60_000_000
EPOCHS, BATCH, RATE, SEED = 6, 16, 0.8, 5
#: Letters whose n-grams are hashed at once.
LETTERS = 1 << 19
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SPACE = re.compile("\\s")


def word_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, number of the word) of each feature of words, none of which has white space."""
    from xxhash import xxh64_intdigest

    points = np.frombuffer("".join(f"<{w}>\n" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32)
    cut = points == 10
    owner = np.cumsum(cut) - cut
    buckets = [np.array([xxh64_intdigest(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in words], np.int64)]
    owners = [np.arange(len(words))]
    hashed, broken = np.zeros(len(points), np.uint64), np.zeros(len(points), bool)
    for k in range(max(ORDERS)):
        n = len(points) - k
        if n <= 0:
            break
        hashed = (hashed[:n] + points[k : k + n]) * _MIX
        broken = broken[:n] | cut[k : k + n]
        if k + 1 in ORDERS:
            good = ~broken
            buckets.append(((hashed[good] >> np.uint64(40)).astype(np.int64)) % BUCKETS)
            owners.append(owner[:n][good])
    return np.concatenate(buckets), np.concatenate(owners)


def repeats(numbers: np.ndarray) -> np.ndarray:
    """How many words equal the one k before, for k from 1 to LAGS."""
    return np.array([np.count_nonzero(numbers[k:] == numbers[:-k]) for k in range(1, LAGS + 1)])


def parts(text: str, most: int) -> Iterator[list[str]]:
    """The words of text in order, in lists of at most ``most``, some letters at a time."""
    at = 0
    while at < len(text):
        cut = _SPACE.search(text, at + LETTERS)
        end = cut.end() if cut else len(text)
        words = text[at:end].split()
        for k in range(0, len(words), most):
            yield words[k : k + most]
        at = end


class Scorer:
    """weight: each row's part in the class difference; bias. table_size: words whose sums a worker keeps."""

    def __init__(self, weight: np.ndarray, bias: float, table_size: int = 500_000):
        self.weight, self.bias, self.table_size = weight, bias, table_size
        self.at: dict[str, int] = {}
        self.sums, self.counts = np.zeros(0), np.zeros(0)

    def learn(self, words: list[str]) -> None:
        """Puts words that the table does not have into it, some letters at a time, as each takes some hundred bytes meanwhile."""
        n, end, cut, size = len(self.at), len(self.at) + len(words), [0], 0
        if end > len(self.sums):
            more = np.zeros(max(len(self.sums), end - len(self.sums), 4096))
            self.sums, self.counts = np.concatenate([self.sums, more]), np.concatenate([self.counts, more])
        for k, w in enumerate(words):
            if size and size + len(w) + 3 > LETTERS:  # a longer word stands alone
                cut.append(k)
                size = 0
            size += len(w) + 3
        for a, b in zip(cut, [*cut[1:], len(words)]):
            if b - a == 1 and len(words[a]) + 3 > LETTERS:
                self.sums[n + a], self.counts[n + a] = self.of_long(words[a])
            elif b > a:
                bucket, owner = word_features(words[a:b])
                self.sums[n + a : n + b] = np.bincount(owner, self.weight[bucket], minlength=b - a)
                self.counts[n + a : n + b] = np.bincount(owner, minlength=b - a)
        self.at.update(zip(words, range(n, end)))

    def of_long(self, word: str) -> tuple[float, int]:
        """(sum, count) of one word's features, its n-grams taken from pieces that overlap."""
        from xxhash import xxh64_intdigest

        total, n = float(self.weight[xxh64_intdigest(word.encode("utf-8", "surrogatepass")) % BUCKETS]), 1
        marked, most = f"<{word}>", max(ORDERS)
        for first in range(0, len(marked), LETTERS):
            points = np.frombuffer(marked[first : first + LETTERS + most - 1].encode("utf-32-le", "surrogatepass"), np.uint32)
            hashed, own = np.zeros(len(points), np.uint64), min(LETTERS, len(marked) - first)
            for k in range(min(most, len(points))):
                hashed = (hashed[: len(points) - k] + points[k:]) * _MIX
                if k + 1 in ORDERS:  # those that begin in this piece
                    total += float(self.weight[((hashed[:own] >> np.uint64(40)).astype(np.int64)) % BUCKETS].sum())
                    n += len(hashed[:own])
        return total, n

    def score(self, text: str | None) -> float:
        """The share of class 1, added up over parts of the text."""
        total, n, same, tail = 0.0, 0, np.zeros(LAGS, np.int64), []
        for part in parts(text or "", self.table_size):
            try:
                where = np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))
            except KeyError:
                new = [w for w in dict.fromkeys(part) if w not in self.at]
                if len(self.at) + len(new) > self.table_size:
                    self.at = {}
                    new = list(dict.fromkeys(part))
                self.learn(new)
                where = np.fromiter(map(self.at.__getitem__, part), np.int64, len(part))
            total += float(self.sums[where].sum())
            n += int(self.counts[where].sum())
            same += repeats(where)
            for k in range(1, LAGS + 1):  # equal words on both sides of a cut
                same[k - 1] += sum(tail[len(tail) - k + j] == part[j] for j in range(max(0, k - len(tail)), min(k, len(part))))
            tail = (tail + part[-LAGS:])[-LAGS:]
        if not n:
            return float(1 / (1 + np.exp(-self.bias)))
        margin = (total + self.weight[BUCKETS:] @ same) / (n + same.sum()) + self.bias
        return float(1 / (1 + np.exp(-np.clip(margin, -500, 500))))


def fit(texts: list[str | None], labels: list[int]) -> Scorer:
    """Stochastic gradient descent over averaged embeddings and a softmax layer, in a fixed order of shuffles."""
    rng = np.random.default_rng(SEED)
    vocabulary: dict[str, int] = {}
    docs = []
    for text in texts:
        words = (text or "").split()
        own = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in words), np.int64, len(words))
        docs.append((*np.unique(own, return_counts=True), repeats(own)))
    if not docs:
        return Scorer(np.zeros(BUCKETS + LAGS), 0.0)
    names, parts, per_word = list(vocabulary), [np.zeros(0, np.int32)], np.zeros(len(vocabulary), np.int64)
    for k in range(0, len(names), 20_000):  # in blocks, as each letter of a block takes some hundred bytes meanwhile
        bucket, owner = word_features(names[k : k + 20_000])
        parts.append(bucket[np.argsort(owner, kind="stable")].astype(np.int32))
        per_word[k : k + 20_000] = np.bincount(owner, minlength=len(names[k : k + 20_000]))
    bucket, first = np.concatenate(parts), np.cumsum(per_word) - per_word
    del names, parts, vocabulary
    rows = []
    for words, n, same in docs:  # buckets of a document, each once, and the weight of each in its average
        counts = per_word[words]
        at = np.arange(counts.sum()) + np.repeat(first[words] - np.cumsum(counts) + counts, counts)
        own, place = np.unique(np.concatenate([bucket[at], BUCKETS + np.flatnonzero(same)]).astype(np.int32), return_inverse=True)
        weight = np.bincount(place, np.concatenate([np.repeat(n, counts), same[same > 0]]), minlength=len(own))
        rows.append((own, (weight / max(1.0, weight.sum())).astype(np.float32)))
    del docs
    embedding = rng.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS + LAGS, DIMENSIONS)).astype(np.float32)
    layer, bias = np.zeros((DIMENSIONS, 2), np.float32), np.zeros(2, np.float32)
    target, total, done = np.eye(2, dtype=np.float32)[labels], EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        shuffled = rng.permutation(len(rows))
        for k in range(0, len(rows), BATCH):
            chosen = shuffled[k : k + BATCH]
            rate = RATE * (1 - done / total)
            means = np.stack([rows[d][1] @ embedding[rows[d][0]] for d in chosen])
            logits = means @ layer + bias
            odds = np.exp(logits - logits.max(1, keepdims=True))
            gradient = odds / odds.sum(1, keepdims=True) - target[chosen]
            back = gradient @ layer.T
            layer -= rate * means.T @ gradient
            bias -= rate / len(chosen) * gradient.sum(0)
            for d, g in zip(chosen, back):
                own, weight = rows[d]
                embedding[own] -= (rate * DIMENSIONS) * weight[:, None] * g[None, :]
            done += len(chosen)
    return Scorer((embedding @ (layer[:, 1] - layer[:, 0])).astype(np.float64), float(bias[1] - bias[0]))


def held_out(column: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, chars: int = TRAIN_CHARS) -> Scorer:
    """A scorer from about rows labelled documents outside the held-out third, chars characters together at most; ids with differing
    labels are left out, and of rows that repeat an id one is taken."""
    known = labels.filter("doc_id IS NOT NULL AND quality IN (0, 1)").filter(~held_out()).groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("low"), F.max("quality").alias("high")).filter("low = high").select("doc_id", F.col("low").alias("label"))
    n = known.count()
    if n > rows:
        known = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("quality")), F.lit(1 << 20)) < int((1 << 20) * rows / n))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(known), "doc_id")
    own = own.select("doc_id", "label", F.xxhash64(F.coalesce("text", F.lit(""))).alias("own"), F.coalesce(F.length("text"), F.lit(0)).alias("size"), "text")
    least = own.groupBy("doc_id").agg(F.min(F.struct("own", "size")).alias("least"), F.min(F.xxhash64("doc_id", F.lit("order"))).alias("turn")).collect()  # about rows rows
    chosen, total = [], 0
    for r in sorted(least, key=lambda r: (r["turn"], r["doc_id"])):
        if total + r["least"]["size"] <= chars:
            chosen.append((r["doc_id"], r["least"]["own"]))
            total += r["least"]["size"]
    if not chosen:
        return fit([], [])
    taken = docs.sparkSession.createDataFrame(chosen, "doc_id long, own long")
    sample = own.join(F.broadcast(taken), ["doc_id", "own"]).dropDuplicates(["doc_id", "own"]).select("doc_id", "text", "label").toArrow().sort_by("doc_id")
    return fit(sample.column("text").to_pylist(), sample.column("label").to_pylist())


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out (crc32 of the doc_id's text leaves 1 by 3), score, predicted of every row of docs.

    Null, empty and blank texts get the score of the bias alone. A null doc_id is not held out and not learnt from. Repeated
    rows are each scored. Without labels every score is 0.5; an empty table gives an empty result. Other columns, lang and
    source among them, are not looked at.
    """
    model = train(docs, labels)
    shared = docs.sparkSession.sparkContext.broadcast((model.weight.astype(np.float32), model.bias))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Scorer(*shared.value)
        for batch in batches:
            found = np.array([own.score(t.as_py()) for t in batch.column(2)], np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found), pa.array((found >= 0.5).astype(np.int64))], ["doc_id", "held_out", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), "text")
    return rows.mapInArrow(compute, "doc_id long, held_out boolean, score double, predicted long").withColumn("predicted", F.col("predicted").cast("int"))
