"""Running values over keys that span tasks."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import logs, quality, scan


@pytest.fixture(scope="module")
def skewed(spark):
    """One place with 90 % of the rows; ties, nulls and repeated rows."""
    rng = random.Random(4)
    rows = [("hot" if i % 10 else f"p{i % 7}", rng.randrange(3000), rng.choice([None, 1, 5, 12])) for i in range(5000)] + [(None, 1, 1), (None, 2, 5), ("x", None, 3)]
    return rows, spark.createDataFrame(rows, "iso string, idx long, v long")


def test_running_values_equal_a_loop(skewed):
    rows, df = skewed
    x = scan.ordered(df, "iso", ["idx", "v"]).numbered("k").running("total", F.col("v")).running("most", F.col("v"), "max")
    got = sorted(map(tuple, x.done().select("iso", "idx", "v", "k", "total", "most").collect()), key=repr)
    want, seen = [], {}
    low = lambda v: (v is not None, v or 0)
    for iso, idx, v in sorted(rows, key=lambda r: (low(r[1]), low(r[2]))):
        k, total, most = seen.get(iso, (0, None, None))
        if v is not None:
            total, most = (total or 0) + v, max(most or v, v)
        seen[iso] = (k + 1, total, most)
        want.append((iso, idx, v, *seen[iso]))
    assert got == sorted(want, key=repr)


def test_a_hot_place_spreads_over_tasks(spark, skewed):
    names = {"spark.sql.shuffle.partitions": "16", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        held = scan.ordered(skewed[1], "iso", ["idx"])
        parts = [r["n"] for r in held.rows.groupBy("__part").agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(parts) >= 8 and max(parts) < 0.2 * 5003


def test_exchange_equals_broadcast(skewed, monkeypatch):
    one = scan.ordered(skewed[1], "iso", ["idx"]).running("t", F.col("v")).done().groupBy("iso").agg(F.max("t").alias("t")).collect()
    monkeypatch.setattr(scan, "FEW", 0)
    two = scan.ordered(skewed[1], "iso", ["idx"]).running("t", F.col("v")).done().groupBy("iso").agg(F.max("t").alias("t")).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)


def test_stops_and_gaps_on_a_hot_place(spark):
    rng = random.Random(6)
    rows = [("hot", i, rng.choice([1, 20, 20])) for i in range(4000)] + [("a", 1, 1), ("a", 2, None), ("a", 3, 1), ("a", 5, 1), ("b", 1, 1)]
    got = dict(map(tuple, logs.stop_batches(spark.createDataFrame(rows, "iso string, batch long, yield long"), 10, 2, 3).collect()))
    streak, stop = 0, None
    for k, (_, b, y) in enumerate(rows[:4000], 1):
        streak = streak + 1 if y < 10 else 0
        if streak >= 2 and k >= 3:
            stop = b
            break
    assert got == {"hot": stop, "a": 5}
    gaps = quality.index_sequence_gaps(spark.createDataFrame([("hot", i + (i > 3990)) for i in range(1, 4001)] + [("a", 2)], "iso string, idx long"))
    assert sorted(map(tuple, gaps.collect())) == [("a", 2, 1), *[("hot", i + 1, i) for i in range(3991, 4001)]]


def test_empty_tables(spark):
    e = spark.createDataFrame([], "iso string, batch long, yield long")
    assert logs.cumulative_yield(e).count() == 0 and logs.stop_batches(e, 1, 2, 2).count() == 0
