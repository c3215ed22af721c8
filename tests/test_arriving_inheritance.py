"""Inheritance of rows that arrive in any order, held against the batch operator over all rows and over those that have arrived."""

import random

import pytest

from tracewell.operators.inherit import inherit
from tracewell.streaming import inherit as arriving

VENDORS = ("nvidia", "amd", "unknown")
RESULT = ("id", "chip_provider", "chip_provider_confidence", "chip_provider_source")


@pytest.fixture()
def states(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(name, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(name)


def some_rows(n, seed):
    """Bases before and after, absent, own and null ones; chains; a base that a third of all rows name; nulls in any column."""
    r = random.Random(seed)
    rows = []
    for k in range(n):
        base = r.choice([f"m{r.randrange(n)}", f"m{max(0, k - 1)}", "m0", "gone", f"m{k}", None])
        rows.append((f"m{k}", r.choice([k, k, k, None]), r.choice([*VENDORS, None]), r.choice([0.1, 0.3, 0.5, 0.9, None]), r.choice(["card", None]), r.choice([True, True, True, False, None]), base, r.choice(["cuda", "rocm", "mlx", None])))
    return rows


def found(df):
    return sorted((tuple(r[c] for c in RESULT) for r in df.collect()), key=str)


def batch(spark, rows):
    return found(inherit(spark.createDataFrame(rows, arriving.ROWS), lambda d: spark.createDataFrame(d.collect(), d.schema)))


def put(spark, rows, folder, number):
    spark.createDataFrame(rows, arriving.ROWS).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("order", ["forward", "backward", "shuffled"])
def test_any_order_ends_in_the_batch_result(states, tmp_path, order):
    rows = some_rows(40, 7)
    ordered = {"forward": rows, "backward": rows[::-1], "shuffled": random.Random(3).sample(rows, len(rows))}[order]
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    for number, cut in enumerate((slice(0, 15), slice(15, 40))):
        put(states, ordered[cut], source, number)
        stream = states.readStream.schema(arriving.ROWS).parquet(source)
        answers = found(arriving.caught_up(stream, out, state, shards=3))
        # each stop, restart from the checkpoint and further arrival: as the batch over what has arrived
        assert answers == batch(states, ordered[: cut.stop])


def test_a_late_base_releases_the_chain_below_it_and_nothing_else(states, tmp_path):
    rows = [(f"m{k}", k, "unknown", 0.0, None, True, f"m{k - 1}", None) for k in range(1, 4)] + [("other", 9, "amd", 0.9, "card", False, None, None)]
    source, out, state = (f"{tmp_path}/{x}" for x in ("in", "out", "state"))
    stream = lambda: states.readStream.schema(arriving.ROWS).parquet(source)
    put(states, rows, source, 0)
    arriving.caught_up(stream(), out, state)
    before = {r["id"]: r["chip_provider"] for r in arriving.newest(states, out).collect()}
    assert before == {"m1": "unknown", "m2": "unknown", "m3": "unknown", "other": "amd"}
    n = states.read.schema(arriving.ANSWERS).parquet(out).count()
    put(states, [("m0", 0, "nvidia", 0.95, "card", False, None, None), rows[0]], source, 1)
    after = {r["id"]: (r["chip_provider"], r["chip_provider_confidence"]) for r in arriving.caught_up(stream(), out, state).collect()}
    assert after == {"m0": ("nvidia", 0.95), **{f"m{k}": ("nvidia", 0.7) for k in (1, 2, 3)}, "other": ("amd", 0.9)}
    # m0 and, one link a micro-batch, the three below it; the row that came again has none
    assert states.read.schema(arriving.ANSWERS).parquet(out).count() == n + 4
