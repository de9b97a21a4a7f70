"""Payloads in parts of bounded bytes."""

import json

from pyspark.sql import functions as F

from tidemark.operators import metrics
from tidemark.sources import io

PLACES = "iso string, subregion string, flag boolean, big boolean"


def test_parts_join_up_to_the_whole_text(spark):
    rows = [("hot", i, f"größe {i} `x` ${{y}} \\z, \"q\"") for i in range(2000)] + [("a", 1, None), ("b", 1, "x"), ("b", 1, "x"), ("b", None, "")]
    df = spark.createDataFrame(rows, "iso string, idx long, t string")
    one = {r.iso: r.payload for r in io.csv_payload_per_key(df, "iso", ["idx"]).groupBy("iso").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "payload"))), lambda p: p["payload"]), "").alias("payload")).collect()}
    parts = io.csv_payload_per_key(df, "iso", ["idx"], bound=300).collect()
    for key in ("hot", "a", "b"):
        mine = sorted((r.part, r.payload) for r in parts if r.iso == key)
        assert "".join(t for _, t in mine) == one[key] and [p for p, _ in mine][:2] == [-1, 0]
    assert len(parts) > 200 and max(len(r.payload.encode()) for r in parts) < 300 + 60
    assert one["b"] == 'idx,t\n"",""\n1,x\n1,x'.replace('"",""', ',""') and one["hot"].count("\\`x\\`") == 2000 and one["hot"].count("\\${y}") == 2000


def test_groups_are_lists_in_parts(spark):
    rows = [(f"P{i:04}", "S" if i % 10 else 'T "t"', i % 3 == 0, None) for i in range(1000)]
    got = io.place_groups_json(spark.createDataFrame(rows, PLACES), ["flag", "big"], ["subregion", "big"], bound=200).collect()
    groups: dict = {}
    for r in sorted((r for r in got if r.section == "groups"), key=lambda r: r.part):
        assert len(r.json) < 220
        groups[r.name] = groups.get(r.name, "") + r.json
    lists = {k: json.loads(v) for k, v in groups.items()}
    assert lists == {"all": [r[0] for r in rows], "flag": [r[0] for r in rows if r[2]], "S": [r[0] for r in rows if r[1] == "S"], 'T "t"': [r[0] for r in rows if r[1] != "S"]}
    assert {r.name: json.loads(r.json) for r in got if r.section == "breakdown"} == {"S": {"count": 900, "main": 300}, 'T "t"': {"count": 100, "main": 34}}
    assert sum(r.section == "places" for r in got) == 1000


def test_members_in_parts(spark):
    rows = [(f"P{i:03}", None if i % 5 == 0 else "S", i % 2 == 0, True) for i in range(100)]
    got = metrics.subregion_breakdown(spark.createDataFrame(rows, PLACES), most=30).collect()
    assert sorted((r.subregion or "", r.part, len(r.members.split(",")), r.places, r.framework) for r in got) == [("", 0, 20, 20, 10), ("S", 0, 30, 80, 40), ("S", 1, 30, 80, 40), ("S", 2, 20, 80, 40)]


def test_empty_tables(spark):
    assert io.csv_payload_per_key(spark.createDataFrame([], "iso string, idx long"), "iso", ["idx"]).count() == 0
    assert io.place_groups_json(spark.createDataFrame([], PLACES), ["flag"], ["big"]).count() == 0
