"""Streams that keep state or a table: order of arrival, late and repeated rows, replays, bytes written."""

import datetime as dt
import glob
import os
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators import logs
from tidemark.streaming import jobs, runs

BATCHES = "iso long, batch long, yield long"


def _arriving(spark, slices, schema, at=None):
    """Each slice is a micro-batch."""
    at = at or jobs.scratch(spark)
    for part in slices:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(at)


def _stop(yields, n_low, least):
    """The rule, said plainly: yields in order of batch."""
    streak = 0
    for k, (b, low) in enumerate(sorted(yields), 1):
        streak = streak + 1 if low else 0
        if streak >= n_low and k >= least:
            return b
    return None


@pytest.mark.parametrize("seed", range(6))
def test_runs_merge_in_any_order(seed):
    rng = random.Random(seed)
    for _ in range(300):
        n_low, least = rng.randint(1, 4), rng.randint(1, 9)
        rows = [(b, rng.random() < 0.6) for b in rng.sample(range(30), rng.randint(0, 25))]
        held: dict = {}
        for i, (b, low) in enumerate(rows, 1):
            assert runs.add(held, b, low, n_low, least) and not runs.add(held, b, not low, n_low, least)
            assert runs.stop(held, n_low, least) == _stop(rows[:i], n_low, least)
            assert len(held) == sum(b - 1 not in {x for x, _ in rows[:i]} for b, _ in rows[:i])
            assert all(len(r.streaks) <= least / n_low + 1 for r in held.values())


def test_a_long_key_is_one_small_run():
    held: dict = {}
    for b in range(20_000):
        runs.add(held, b, b % 7 == 0, 2, 5)
    assert len(held) == 1 and held[0].rows == 20_000 and len(held[0].streaks) == 0


def test_stop_rule_holds_over_micro_batches(spark):
    rows = [(i, b, (i * 7 + b * b * (i + 3)) % 20) for i in range(25) for b in range(12) if (i + b) % 11]
    slices = [[r for r in rows if (r[0] + r[1]) % 4 == 3 - late] for late in range(4)]
    slices[2] = slices[2] + slices[0][:5] + [(3, None, 1), (99, 4, None)]
    got = jobs.stream_stop_rule(_arriving(spark, slices, BATCHES), 10, 2, 2)
    want = logs.stop_batches(spark.createDataFrame(rows, BATCHES), 10, 2, 2)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) != []


def test_week_counts_drop_late_and_repeated_rows(spark):
    day = lambda k: dt.datetime(2020, 1, 1, 12) + dt.timedelta(k)
    slices = [[("a", "s", day(0)), ("a", "s", day(1)), ("a", "s", None)], [("a", "s", day(0)), ("a", "s", day(60)), (None, "s", day(60))], [("a", "s", day(60))], [("a", "s", day(20)), ("a", "s", day(40))], [("a", "s", day(41)), ("b", "s", day(200))]]
    got = jobs.stream_week_counts(_arriving(spark, slices, "iso string, source string, ts timestamp"), "iso", "source", "ts", late="30 days")
    # day 20 is more than 30 days behind day 60, which two batches before told, and is dropped; day 40 is in time; nothing waits for its window to close
    assert {r.iso: r.weeks for r in got.collect()} == {"a": 3, None: 1, "b": 1}


SCHEMA = "iso string, n long, notes string"


def _kinds(at):
    """Rows of each (batch, kind) that was written."""
    import pyarrow.parquet as pq

    out: dict = {}
    for f in glob.glob(f"{at}/out/part=*/batch=*/kind=*/*.parquet"):
        k = tuple(x.split("=")[1] for x in f.split("/")[-3:-1])
        out[k] = out.get(k, 0) + pq.read_table(f).num_rows
    return out


def test_refresh_writes_what_changes(spark):
    at, source = jobs.scratch(spark), jobs.scratch(spark)
    table = [(f"k{i}", 1, "auto") for i in range(3000)]
    jobs.stream_refresh(_arriving(spark, [table], SCHEMA, source), "iso", "n", at=at)
    assert _kinds(at) == {("0", "delta"): 3000, ("0", "base"): 3000}
    jobs.stream_refresh(_arriving(spark, [table, [("k1", 2, "auto"), ("k2", 0, "auto"), ("k1", 1, "auto")], [("k9", 5, "auto")]], SCHEMA, source), "iso", "n", at=at)
    later = {k: n for k, n in _kinds(at).items() if k[0] != "0"}
    # the table came again unchanged, the second batch changes one row, the third one
    assert all(kind == "delta" for _, kind in later) and sum(later.values()) == 2
    schema = spark.createDataFrame([], SCHEMA).schema
    now = {r.iso: (r.n, r.notes) for r in jobs.read_merged(spark, at, schema, ["iso"]).collect()}
    assert len(now) == 3000 and now["k1"] == (2, "auto") and now["k2"] == (1, "auto") and now["k9"] == (5, "auto")


def _note(auto, old):
    """The rule of the notes: an old one is carried on as manual unless it starts with the new automatic one."""
    part = old.split("| Manual:")[-1].strip()
    return f"{auto} | Manual: {part}" if old and not old.startswith(auto) and part != auto else auto


def test_refresh_compacts_and_replays(spark):
    at, schema = jobs.scratch(spark), StructType().add("iso", "string").add("n", "long").add("notes", "string")
    slices = [[(f"k{i}", v, f"auto {v // 4}") for i in range(v % 3, 40, 3)] for v in range(1, 7)]
    previous = spark.createDataFrame([("k1", "x | Manual: mine")], "iso string, notes string")
    source = _arriving(spark, slices, SCHEMA)
    got = sorted(map(tuple, jobs.stream_refresh(source, "iso", "n", previous, at).collect()))
    want: dict = {}
    for part in slices:
        for k, n, t in part:
            want[k] = (k, n, _note(t, want[k][2] if k in want else "x | Manual: mine" if k == "k1" else ""))
    assert want["k1"][2] == "auto 1 | Manual: mine"
    assert got == sorted(want.values()) and len({b for b, kind in _kinds(at) if kind == "base"}) > 1
    # the last batch runs again, as after a failure between its writes and its commit
    before = _kinds(at)
    newest = max(glob.glob(f"{at}/check/commits/*"), key=os.path.getmtime)
    os.remove(newest)
    for crc in glob.glob(f"{at}/check/commits/.*.crc"):
        os.remove(crc)
    again = jobs.stream_refresh(source, "iso", "n", previous, at)
    assert sorted(map(tuple, again.collect())) == got and _kinds(at) == before
    # what a base covers isn't needed any more
    held = jobs._layers(spark, at, schema).groupBy("part").agg(F.count_if(F.col("kind") == "base").alias("b"), F.count_if(F.col("kind") == "delta").alias("d"))
    assert held.where("b = 0 or d > b * 0.5").count() == 0
