"""Inheritance of results that arrive in any order: a late base releases the derivatives that wait for it.

A row goes to the state of its base, where it stays, and is answered at once with what is known of that base by then: nothing, or the
value that ``inherit`` would read.  When the base comes, or its own value changes as its base has come, those of its derivatives
for which that makes a difference are answered anew.  Answers are appended by micro-batch; the newest of an id counts, and these
are at any time those of ``inherit`` over the rows that have arrived, once no answer is on its way.

A derivative's answer is news to its own derivatives, whose state is under another key.  So answers are an input of the stream as
well: one micro-batch takes them one link down a chain.  Reading one again changes nothing, as they carry their micro-batch's number.

A base's derivatives are dealt out over ``shards`` states, each told of the base, so that a base which a third of all rows name is
not one task's.  State grows with the rows: any of them may be answered anew.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tracewell.operators.inherit import settled_by

ROWS = "id string, pos long, chip_provider string, chip_provider_confidence double, chip_provider_source string, is_derivative boolean, base_model string, runtime_library string"
ANSWERS = "id string, pos long, chip_provider string, chip_provider_confidence double, chip_provider_source string, based boolean, batch long"
#: States that the derivatives of one base are dealt out over.
SHARDS = 8

#: What a state keeps of a derivative's own columns.
OWN = ("pos", "chip_provider", "chip_provider_confidence", "chip_provider_source", "is_derivative", "runtime_library")
_BASE = "pos long, chip string, conf double, last_chip string, last_conf double, version long"
_CHILD = "pos long, chip_provider string, chip_provider_confidence double, chip_provider_source string, is_derivative boolean, runtime_library string, based boolean, chip string, conf double"
_PAIRED = "id string, pos long, chip_provider string, chip_provider_confidence double, chip_provider_source string, is_derivative boolean, runtime_library string, based boolean, __chip string, __conf double"
_Paired = Row(*(c.split()[0] for c in _PAIRED.split(", ")))
#: Answers are numbered from 0, and a row's own value comes before them.
FIRST = -1


class Bases(StatefulProcessor):
    """The state of (base, shard): the base's own and newest value, and the derivatives of the shard with the value they were given."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.base = handle.getValueState("base", _BASE)
        self.children = handle.getMapState("children", "id string", _CHILD)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        base, arrived, news = self.base.get() if self.base.exists() else None, [], []
        for r in rows:
            (arrived if r["row"] is not None else news).append(r)
        before = base
        # a base's own row comes before its answers, and older answers before newer ones
        for r in sorted(news, key=lambda r: r["version"]):
            if r["version"] == FIRST:
                base = base or (r["pos"], r["chip"], r["conf"], r["last_chip"], r["last_conf"], FIRST)
            elif base is not None and r["version"] > base[5]:
                base = (*base[:3], r["last_chip"], r["last_conf"], r["version"])
        if base is not None and base != before:
            self.base.update(tuple(base))
        if base is not None and (before is None or tuple(base)[:5] != tuple(before)[:5]):
            for (own,), child in self.children.iterator():
                given = self.given(base, child[0])
                if given != tuple(child[6:9]):
                    self.children.updateValue((own,), (*child[:6], *given))
                    yield _Paired(own, *child[:6], *given)
        for r in arrived:
            own = r["row"]
            # a row that comes again has its answer
            if self.children.containsKey((own["id"],)):
                continue
            mine, given = tuple(own[c] for c in OWN), self.given(base, own["pos"])
            self.children.updateValue((own["id"],), (*mine, *given))
            yield _Paired(own["id"], *mine, *given)

    @staticmethod
    def given(base: tuple | None, pos: int | None) -> tuple:
        """What a derivative at pos reads of its base: the newest value of one that stands earlier, the own value of a later one."""
        if base is None:
            return False, None, None
        earlier = base[0] is not None and pos is not None and base[0] < pos
        return (True, *(base[3:5] if earlier else base[1:3]))

    def close(self) -> None:
        pass


def waits() -> Column:
    return F.coalesce("is_derivative", F.lit(False)) & F.col("base_model").isNotNull()


def messages(rows: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """What states are told: of rows (ROWS) that wait (column row), to one shard of their base, and of bases (the others), to each shard."""
    shard = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))
    row = F.struct("id", *OWN)
    none = {"version": "long", "pos": "long", "chip": "string", "conf": "double", "last_chip": "string", "last_conf": "double"}
    waiting = rows.filter(waits()).select(F.col("base_model").alias("key"), shard.alias("shard"), row.alias("row"), *(F.lit(None).cast(t).alias(c) for c, t in none.items()))
    # without a base a row's value is what it falls back to
    alone = settled_by(rows.withColumns({"chip": F.col("chip_provider"), "conf": F.col("chip_provider_confidence"), "__chip": F.lit(None).cast("string"), "__conf": F.lit(None).cast("double")}))
    told = lambda df, version, pos, chip, conf: df.select(F.col("id").alias("key"), every.alias("shard"), F.lit(None).cast(waiting.schema["row"].dataType).alias("row"), version.cast("long").alias("version"), pos.alias("pos"), chip.alias("chip"), conf.alias("conf"), F.col("chip_provider").alias("last_chip"), F.col("chip_provider_confidence").alias("last_conf"))
    firsts = told(alone, F.lit(FIRST), F.col("pos"), F.col("chip"), F.col("conf"))
    later = told(answers.filter("based"), F.col("batch"), F.lit(None).cast("long"), F.lit(None).cast("string"), F.lit(None).cast("double"))
    return waiting.unionByName(firsts).unionByName(later)


def arriving_inheritance(rows: DataFrame, out: str, checkpoint: str, shards: int = SHARDS, once: bool = True) -> StreamingQuery:
    """A query that answers the stream rows (ROWS) into out, a folder by micro-batch; a micro-batch that is run again overwrites its own.
    once: takes what is there at its start (answers of this run are for the next); otherwise goes on.

    One row an id; the same one again changes no answer. Rows of a null id have none, as in ``inherit``; other nulls are as there. The
    session's state store must be RocksDB's, as Spark asks of such states. A checkpoint stays with its number of shards."""
    spark, rows = rows.sparkSession, rows.filter("id IS NOT NULL")
    if not _there(spark, out):
        spark.createDataFrame([], ANSWERS).drop("batch").write.parquet(f"{out}/batch=-1")
    told = messages(rows, spark.readStream.schema(ANSWERS).parquet(out), shards)
    paired = told.groupBy("key", "shard").transformWithState(Bases(), _PAIRED, "Append", "None")
    # a row without a base waits for none, and no state need know of it
    nothing = {"based": F.lit(False), "__chip": F.lit(None).cast("string"), "__conf": F.lit(None).cast("double")}
    paired = paired.unionByName(rows.filter(~waits()).withColumns(nothing).select(paired.columns))

    def write(batch: DataFrame, number: int) -> None:
        settled_by(batch).select("id", "pos", "chip_provider", "chip_provider_confidence", "chip_provider_source", "based").write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = paired.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def caught_up(rows: DataFrame, out: str, checkpoint: str, shards: int = SHARDS) -> DataFrame:
    """Runs until no answer is on its way, as often as the longest chain of arrived rows has links and once more, and returns the
    newest answers."""
    spark, news = rows.sparkSession, True
    while news:
        query = arriving_inheritance(rows, out, checkpoint, shards)
        query.awaitTermination()
        done = [p["batchId"] for p in query.recentProgress]
        answered = spark.read.schema(ANSWERS).parquet(out)
        news = bool(done) and not answered.filter(F.col("based") & (F.col("batch") >= min(done))).isEmpty()
    return newest(spark, out)


def newest(spark: SparkSession, out: str) -> DataFrame:
    """The newest answer of each id: id, pos, chip_provider, chip_provider_confidence, chip_provider_source."""
    cols = ("pos", "chip_provider", "chip_provider_confidence", "chip_provider_source")
    answers = spark.read.schema(ANSWERS).parquet(out)
    return answers.groupBy("id").agg(F.max_by(F.struct(*cols), "batch").alias("own")).select("id", *(f"own.{c}" for c in cols))


def _there(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
