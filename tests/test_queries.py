"""Every query with SQL against DuckDB on the smallest tables; boundary rows by hand."""

import datetime as dt

import pytest

from tests.oracle import connect, same
from tidemark.functions import scalars as S
from tidemark.operators import joins, logs, periods, quality
from tidemark.plans import registry
from tidemark.sources import io
from tidemark.streaming import jobs

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, con, name):
    assert same(registry.queries()[name](spark, SF), con, registry.oracle_sql()[name]) == ""


def _days(spark, *pairs):
    d = dt.date(2020, 1, 1)
    return spark.createDataFrame([("X", d + dt.timedelta(a), d + dt.timedelta(b)) for a, b in pairs], "iso string, date_start date, date_stop date")


@pytest.mark.parametrize(("step", "n"), [(56, 1), (57, 2)])
def test_periods_merge_up_to_56_days(spark, step, n):
    assert periods.coverage_periods(_days(spark, (0, 6), (6 + step, 70 + step))).count() == n


def test_periods_use_the_running_maximum(spark):
    assert periods.coverage_periods(_days(spark, (0, 300), (10, 12), (320, 330))).count() == 1


@pytest.mark.parametrize(("gap", "n"), [(91, 0), (92, 1)])
def test_major_gaps_need_more_than_90_uncovered_days(spark, gap, n):
    assert periods.major_gaps(periods.coverage_periods(_days(spark, (0, 1), (1 + gap, 200)))).count() == n


@pytest.mark.parametrize(("step", "n"), [(14, 1), (15, 2)])
def test_blocks_split_above_14_days(spark, step, n):
    assert periods.data_blocks(_days(spark, (0, 0), (step, step)), ["iso"], "date_start").count() == n


def test_merging_twice_is_merging_once(spark):
    one = periods.coverage_periods(_days(spark, (0, 6), (30, 31), (200, 201), (201, 400)))
    two = periods.coverage_periods(one, "iso", "first_date", "last_date")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_intervals_default_their_end_and_drop_bad_ones(spark):
    df = spark.createDataFrame([("2020-01-01", ""), ("2020-01-05", "2020-01-01"), ("no", "2020-01-01"), ("2018-12-31", None)], "tl string, tr string")
    got = S.expand_weeks(S.parse_interval(df), 7).select("year", "week").collect()
    assert sorted(map(tuple, got)) == [(2018, 1), (2020, 1)]


def test_notes_keep_the_manual_part(spark):
    new = spark.createDataFrame([("a", "auto"), ("b", "auto"), ("c", "auto")], "iso string, notes string")
    old = spark.createDataFrame([("a", "x | Manual: y | Manual: by hand"), ("b", "auto"), ("c", None)], "iso string, notes string")
    assert dict(map(tuple, joins.merge_manual_notes(new, old).collect())) == {"a": "auto | Manual: by hand", "b": "auto", "c": "auto"}


def test_empty_tables(spark):
    e = _days(spark)
    assert periods.coverage_summary(periods.coverage_periods(e)).count() == 0
    assert logs.stop_batches(spark.createDataFrame([], "iso string, batch int, yield int"), 1, 2, 2).count() == 0


def _slices(spark, at, slices, schema):
    """Each slice is a file of its own, in order."""
    for part in slices:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(at)
    return spark.readStream.schema(spark.createDataFrame([], schema).schema).option("maxFilesPerTrigger", 1).parquet(at)


def _at(day, k=1):
    return dt.datetime(2020, 1, 1, 12) + dt.timedelta(day), k


def test_late_rows_are_dropped_and_open_windows_wait(spark):
    rows = [[(*_at(0), "a"), (*_at(40, 2), "a")], [(*_at(35, 3), "a"), (*_at(100), "a")], [(*_at(1, 5), "a")], [(*_at(200), "a")]]
    at = jobs.scratch(spark)
    got = jobs.stream_weekly_totals(_slices(spark, at, rows, "ts timestamp, n long, s string"), "ts", "n", late="7 days")
    # the row of day 1 comes when its week is closed and is dropped; day 35 is in time; the last week stays open
    assert sorted((str(r.week_start), r.n, r.total) for r in got.collect()) == [("2019-12-30", 1, 1), ("2020-02-03", 1, 3), ("2020-02-10", 1, 2), ("2020-04-06", 1, 1)]


def test_refresh_goes_on_from_its_folder(spark):
    source, at = jobs.scratch(spark), jobs.scratch(spark)
    schema = "iso string, n long, notes string"
    old = spark.createDataFrame([("a", "old | Manual: by hand")], "iso string, notes string")
    stream = _slices(spark, source, [[("a", 1, "auto 1"), ("b", 5, "auto 5")]], schema)
    first = jobs.stream_refresh(stream, "iso", "n", old, at)
    assert sorted(map(tuple, first.collect())) == [("a", 1, "auto 1 | Manual: by hand"), ("b", 5, "auto 5")]
    stream = _slices(spark, source, [[("a", 3, "new 3"), ("b", 4, "late 4"), ("c", 1, "auto 1")], [("a", 2, "late 2")]], schema)
    again = jobs.stream_refresh(stream, "iso", "n", old, at)
    assert sorted(map(tuple, again.collect())) == [("a", 3, "new 3 | Manual: by hand"), ("b", 5, "auto 5"), ("c", 1, "auto 1")]
    # the table before a batch is what that batch read, so it may run again
    assert sorted(map(tuple, jobs.read_merged(spark, at, spark.createDataFrame([], schema).schema, ["iso"], 1).collect())) == sorted(map(tuple, first.collect()))


def test_malformed_lines_are_kept_apart(spark):
    lines = ['1,"a, b",x', "2,a,b,c", "3,a", "", None, '4,"say ""so""",y']
    good, bad = quality.split_malformed(spark.createDataFrame([(x,) for x in lines], "value string"), ["i", "t", "u"])
    assert sorted(map(tuple, good.collect())) == [("1", "a, b", "x"), ("4", 'say "so"', "y")]
    assert sorted((r.value or "" for r in bad.collect())) == ["", "", "2,a,b,c", "3,a"] and good.count() == 2 and bad.count() == 4


def test_yields_in_three_spellings(spark):
    text = """=== BATCH 1: PRIORITY (1/20 - 20/20) ===
BATCH 1 YIELD CALCULATION:
- Queries resulting in NEW rows: 8/20
=== BATCH 2 START ===
BATCH 2 YIELD: 0 new data observations found, 3/20 queries successful = 15% yield
# BATCH 3 (Queries 1-25): COMPLETED
# Data Observation Yield: 0% (0 successful queries / 25 total queries)"""
    got = logs.batch_yields(spark.createDataFrame([("X", 1, text)], "iso string, agent int, content string"))
    assert sorted((r.batch, r.ok, r.asked, r.yield_pct) for r in got.collect()) == [(1, 8, 20, 40.0), (2, 3, 20, 15.0), (3, 0, 25, 0.0)]


def test_overlaps_are_counted_as_pairs_would_be(spark):
    rows = [(i, f"P{i % 3}", f"L{i % 2}", f"S{i % 5}", i % 7 * 20, dt.date(2020, 1, 1) + dt.timedelta(i * 37 % 400), dt.date(2020, 1, 1) + dt.timedelta(i * 37 % 400 + i % 60)) for i in range(120)]
    obs = spark.createDataFrame(rows, "idx long, iso string, location string, source string, scases long, tl date, tr date")
    near = spark.createDataFrame([("P0", ["P1", "P2"]), ("P1", ["P0"])], "iso string, neighbours array<string>")
    meet = lambda a, b: a[5] <= b[6] and b[5] <= a[6]
    want = {a[0]: n for a in rows if (n := sum(meet(a, b) for b in rows if b[1] in {"P0": ("P1", "P2"), "P1": ("P0",)}.get(a[1], ())))}
    assert {r.idx: r.overlaps for r in joins.neighbour_overlap(obs, near).collect()} == want
    want = {a[0]: len({b[3] for b in rows if b[2] == a[2] and b[3] != a[3] and meet(a, b)}) for a in rows if a[4] > 60}
    assert {r.idx: r.others for r in joins.confirm_major(obs, 60).collect()} == want


def test_latin_1_files_are_read(spark):
    at = jobs.scratch(spark)
    spark.createDataFrame([("caf\u00e9",)], "t string").coalesce(1).write.option("encoding", "ISO-8859-1").csv(at)
    assert [r.text for r in io.read_text_safe(spark, at).where("length(text) > 0").collect()] == ["caf\u00e9\n"]


def test_headers_of_missing_and_empty_files(spark):
    files = spark.createDataFrame([("A", "data", ",".join(["Index", "source_index", *"abcdefghijk"])), ("A", "meta", ",".join(["Index", *"abcdefghijklm"])), ("B", "data", None)], "iso string, kind string, header string")
    got = {r.iso: (r.compliant, r.issues) for r in quality.header_compliance(files).collect()}
    assert got == {"A": (True, ""), "B": (False, "data: 1 columns, 13 needed | data: no Index column | data: no source_index column | meta: no file")}
    assert tuple(quality.compliance_rate(quality.header_compliance(files)).first()) == (2, 1, 50.0)
