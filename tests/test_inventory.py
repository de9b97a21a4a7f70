"""The file inventory, the status rule and the last update."""

import datetime as dt
import os

import pytest

from tidemark.operators import metrics
from tidemark.plans import workspace
from tidemark.plans.views import Views
from tidemark.sources import io
from tidemark.streaming import jobs


def _tree(spark, places):
    """Files of places: {place: {name: (text, day of modification)}}."""
    at = jobs.scratch(spark)
    for place, files in places.items():
        os.makedirs(f"{at}/{place}")
        for name, (text, day) in files.items():
            with open(f"{at}/{place}/{name}", "w") as f:
                f.write(text)
            when = dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc).timestamp()
            os.utime(f"{at}/{place}/{name}", (when, when))
    return at


TABLES = {"observations.csv": ("h\n1\n", 3), "metadata.csv": ("h\n1\n", 2)}


@pytest.mark.parametrize(
    ("files", "rows", "status"),
    [
        (TABLES | {"search_log_agent_6.txt": ("x", 1)}, 1, "PENDING"),  # an agent's log is no audit report
        (TABLES | {"quality_audit_report_agent_6.txt": ("x", 1)}, 1, "COMPLETED"),
        ({"metadata.csv": ("h", 1), "quality_audit_report_agent_6.txt": ("x", 1)}, 0, "NOT_STARTED"),
        (TABLES | {f"search_log_agent_{i}.txt": ("x", 1) for i in range(1, 7)}, 1, "COMPLETED"),
        (TABLES | {f"search_log_agent_{i}.txt": ("x", 1) for i in range(1, 7)}, 0, "PENDING"),
        (TABLES | {f"search_log_agent_{i}.txt": ("x", 1) for i in range(1, 6)}, 1, "PENDING"),
        ({"search_protocol_X.txt": ("x", 1)}, 0, "NOT_STARTED"),
        ({"observations.csv": ("h", 1)}, 0, "PENDING"),
        ({"search_log_agent_2.txt": ("x", 1)}, 0, "PENDING"),
    ],
)
def test_status(spark, files, rows, status):
    counts = spark.createDataFrame([("X", rows)] if rows else [], "iso string, row_count long")
    found = metrics.status_from_files(io.read_inventory(spark, _tree(spark, {"X": files})), counts)
    assert [tuple(r) for r in found.collect()] == [("X", status)]


def test_only_key_files_are_updates(spark):
    at = _tree(spark, {"X": TABLES | {"notes.txt": ("x", 9), "search_log_agent_7.txt": ("x", 8), "search_log_agent_4.txt": ("x", 5)}, "Y": {"notes.txt": ("x", 9)}})
    found = metrics.latest_update(io.read_inventory(spark, at)).collect()
    assert [(r.iso, r.latest.day) for r in found] == [("X", 5)]


def test_inventory_lists_without_reading(spark):
    at = _tree(spark, {"X": TABLES, "Y": {"a b.txt": ("xyz", 4)}})
    spark.createDataFrame([("Z", "metadata.csv", c) for c in "abcd"], "iso string, name string, value string").repartition(2).write.partitionBy("iso", "name").mode("append").text(at)
    found = io.read_inventory(spark, at)
    got = {(r.iso, r.name): r.bytes for r in found.collect()}
    assert {k: v for k, v in got.items() if k[0] != "Y"} == {("X", "observations.csv"): 4, ("X", "metadata.csv"): 4, ("Z", "metadata.csv"): 8}
    assert sum(b for (iso, _), b in got.items() if iso == "Y") == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def _lines(v):
    """What the containers of a workspace hold, and the workspace."""
    w = workspace.Workspace(v)
    return w, io.read_packed(v.spark, w.path)


@pytest.fixture(scope="module")
def packed(spark):
    return _lines(Views(spark, "/root/testdata/sf0.001"))


def test_files_of_many_places_share_containers(spark, packed):
    w, lines = packed
    files, held = w.files().count(), lines.select("_metadata.file_path").distinct().count()
    assert files > 2 * held  # 6,220 files, each in a folder of its own, took 55 s and more on sf0.1


def test_packed_files_equal_a_tree_of_folders(spark, packed):
    w, lines = packed
    at = jobs.scratch(spark)
    lines.repartition("iso", "name").sortWithinPartitions("iso", "name", "at").select("iso", "name", "value").write.partitionBy("iso", "name").text(at)
    rows = lambda df, *c: sorted(map(tuple, df.select(*c).collect()), key=repr)
    assert rows(w.files(), "iso", "name", "bytes") == rows(io.read_inventory(spark, at), "iso", "name", "bytes")
    for mine, other in (
        (io.packed_observations(spark, w.path), io.read_observations(spark, f"{at}/*/name=observations.csv")),
        (io.packed_sources(spark, w.path), io.read_sources(spark, f"{at}/*/name=metadata.csv")),
    ):
        assert mine.columns == other.columns and rows(mine, *mine.columns) == rows(other, *mine.columns) and mine.count() > 5
    logs = io.read_logs(spark, f"{at}/*/name=search_log_agent_*")
    sizes = ["iso", "agent", "length(content)"]
    assert rows(io.packed_logs(spark, w.path).selectExpr(*sizes), *sizes) == rows(logs.selectExpr(*sizes), *sizes)


def test_a_packed_inventory_reads_no_contents(spark, packed):
    plan = packed[0].files()._jdf.queryExecution().executedPlan().toString()
    assert "value" not in plan and "bytes" in plan


def test_waves_are_told_apart_by_containers(spark, packed):
    w, _ = packed
    late = {(r.iso, r.name) for r in w.files().collect() if r.modified > w.first}
    assert {n for _, n in late} >= {"notes.txt"} and not {n for _, n in late} & {"observations.csv", "metadata.csv", metrics.AUDIT}
