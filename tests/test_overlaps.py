"""Interval overlaps by dyadic covers, and domain tiers."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import joins, quality

D = dt.date(1969, 6, 1)


def _intervals(n, seed, longest):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        s = D + dt.timedelta(rng.randrange(-4000, 9000))
        rows.append((rng.choice(["hot", "hot", "hot", "a", "b"]), i, s, s + dt.timedelta(rng.choice([0, 1, 5, 60, 64, 700, longest]))))
    return rows


@pytest.mark.parametrize(("longest", "hot"), [(36525, joins.HOT), (3000, 20)])
def test_pairs_equal_brute_force(spark, longest, hot):
    a, b = _intervals(150, 1, longest), _intervals(170, 2, longest)
    a += [("a", 900, D, None), ("a", 901, None, D), (None, 902, D, D), ("b", 903, D, D - dt.timedelta(1))]
    x = spark.createDataFrame(a, "iso string, i long, s date, e date")
    y = spark.createDataFrame(b, "iso string, j long, t date, u date")
    got = joins.overlap_join(x, y, "iso", ("s", "e"), ("t", "u"), hot).select("i", "j").collect()
    want = [(p[1], q[1]) for p in a for q in b if p[0] and p[0] == q[0] and p[2] and p[3] and p[2] <= p[3] and p[2] <= q[3] and q[2] <= p[3]]
    assert sorted(map(tuple, got)) == sorted(want) and len(want) > 500


def test_a_century_makes_few_rows(spark):
    rng = random.Random(3)
    starts = [D + dt.timedelta(rng.randrange(-9000, 9000)) for _ in range(300)]
    df = spark.createDataFrame([(s, s + dt.timedelta(36525)) for s in starts], "s date, e date")
    x = df.withColumn("c", joins.dyadic_cover(joins._unit("s"), joins._unit("e"), 12))
    for r in x.select("c", joins._unit("s").alias("a"), joins._unit("e").alias("z")).collect():
        assert len(r.c) < 20
        units = sorted(u for level, block in r.c for u in range(block << level, (block + 1) << level))
        assert units == list(range(r.a, r.z + 1))


def test_gaps_are_filled_over_long_intervals(spark):
    gaps = spark.createDataFrame([("a", D, D + dt.timedelta(99), 100), ("b", D, D + dt.timedelta(9), 10)], "iso string, gap_start date, gap_end date, gap_days int")
    fill = spark.createDataFrame([("a", D - dt.timedelta(30000), D + dt.timedelta(9)), ("a", D + dt.timedelta(5), D + dt.timedelta(19)), ("a", D + dt.timedelta(99), D + dt.timedelta(30000)), ("a", D + dt.timedelta(100), D + dt.timedelta(101))], "iso string, tl date, tr date")
    got = {r.iso: (r.intervals, r.filled_days, r.filled_pct) for r in joins.gap_fill(gaps, fill).collect()}
    assert got == {"a": (3, 21, 21.0), "b": (0, 0, 0.0)}


def test_a_hot_place_is_split(spark):
    rows = [("hot", i, D + dt.timedelta(i % 50), D + dt.timedelta(i % 50)) for i in range(2000)]
    x = spark.createDataFrame([("hot", 1, D, D + dt.timedelta(49))], "iso string, i long, s date, e date")
    y = spark.createDataFrame(rows, "iso string, j long, t date, u date")
    got = joins.overlap_join(x, y, "iso", ("s", "e"), ("t", "u"), hot=100)
    assert got.count() == 2000 and got.agg(F.count_distinct("j")).first()[0] == 2000


def test_the_longest_domain_wins(spark):
    urls = ["https://www.who.int/x", "http://apps.WHO.int./y", "https://notwho.int", "https://who.int.evil.org/", "https://int/", "no url", None, "https://data.apps.who.int"]
    tiers = spark.createDataFrame([("who.int", 1), ("Apps.who.int", 2)], "host string, tier int")
    got = quality.domain_tier(spark.createDataFrame(list(enumerate(urls)), "idx long, url string"), tiers)
    assert [r.tier for r in got.orderBy("idx").collect()] == [1, 2, 0, 0, 0, 0, 0, 2]


def test_sources_are_counted_without_listing_pairs(spark, monkeypatch):
    def pairs(*_):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(joins, "overlap_join", pairs)
    rng = random.Random(5)
    rows = []
    for i in range(1500):  # long outbreaks hold many periods of a source; places and sources may be null
        s = D + dt.timedelta(rng.randrange(-400, 800))
        days = rng.choice([None, 0, 1, 3, rng.randrange(400) if i % 10 == 0 else 8])
        rows.append((i, rng.choice(["a", "a", "b", "c", None]), rng.choice([*"STUVWXYZ", None]), rng.randrange(100), s, None if days is None else s + dt.timedelta(days)))
    obs = spark.createDataFrame(rows, "idx long, location string, source string, scases long, tl date, tr date")
    meet = lambda p, q: q[4] <= (p[5] or p[4]) and p[4] <= (q[5] or q[4])
    want = {p[0]: len({q[2] for q in rows if p[1] and q[1] == p[1] and p[2] and q[2] and q[2] != p[2] and meet(p, q)}) for p in rows if p[3] > 50}
    assert {r.idx: r.others for r in joins.confirm_major(obs, 50).collect()} == want and max(want.values()) == 7


def test_dates_of_intervals_need_no_parsing(spark):
    df = spark.createDataFrame([(1, D, None), (2, D, D), (3, D, D - dt.timedelta(1)), (4, None, D)], "i long, tl date, tr date")
    got = scalars.parse_interval(df)
    assert sorted((r.i, r.tl, r.tr) for r in got.collect()) == [(1, D, D), (2, D, D)]
    assert "to_date" not in got._jdf.queryExecution().executedPlan().toString().lower() and "cast" not in got._jdf.queryExecution().executedPlan().toString().lower()


def test_gaps_are_filled_without_listing_pairs(spark, monkeypatch):
    def pairs(*_):
        raise AssertionError("pairs are listed")

    monkeypatch.setattr(joins, "overlap_join", pairs)
    rng = random.Random(7)
    day = dt.timedelta(1)
    starts = {iso: [D + day * (k * 30 - 400) for k in range(40)] for iso in ("a", "b", "c", "without", None)}
    gaps = [(iso, s, s + day * n, n + 1) for iso, of in starts.items() for s in of for n in [rng.randrange(50)]]  # they overlap
    fill = [(iso, s, s + day * rng.choice([0, 1, 2, 9, 40, 300 if iso == "c" else 3])) for iso, n in (("a", 400), ("b", 40), ("c", 5), (None, 20)) for _ in range(n) for s in [D + day * rng.randrange(-500, 900)]]
    fill += [*fill[::3], ("a", D, D - day), ("a", None, D), ("a", D, None)]
    got = joins.gap_fill(spark.createDataFrame(gaps, "iso string, gap_start date, gap_end date, gap_days int"), spark.createDataFrame(fill, "iso string, tl date, tr date"))
    want = []
    for iso, s, e, n in gaps:
        met = {f for f in fill if iso and f[0] == iso and f[1] and f[2] and f[1] <= f[2] and f[1] <= e and f[2] >= s}
        days = {x for f in met for x in range(max(f[1], s).toordinal(), min(f[2], e).toordinal() + 1)}
        want.append((iso, s, n, len(met), len(days), round(len(days) * 100 / n, 1)))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)
