from __future__ import annotations

import json
from datetime import date, datetime

from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.sources import ingest
from tidewright.sources.tables import half_open, push_sheet, read_csv, read_seed

c = F.col


def test_crm_results_and_links(spark):
    results = [
        {"id": "1", "properties": {"hs_object_id": "1", "name": "a", "id": "own"}},
        {
            "id": "2",
            "properties": {"hs_object_id": "2", "name": None},
            "associations": {"deals": {"results": [{"id": "d1"}, {"id": "d1"}, {"id": "d2"}]}},
        },
        {"id": "3", "name": "flat"},
    ]
    pages = spark.createDataFrame([([json.dumps(r) for r in results],)], "results array<string>")
    found = ingest.crm_results(pages)
    assert rows(ingest.crm_table(found, ["name"])) == [("2", None), ("3", "flat"), ("own", "a")]
    assert rows(ingest.association_links(found)) == [("deals", "2", "d1"), ("deals", "2", "d2")]


def test_history_goes_on_after_an_object_without_any(spark):
    def entry(value):
        return {"value": value, "timestamp": "t", "sourceType": "CRM"}

    objects = [
        {"id": "1"},
        {"id": "2", "propertiesWithHistory": {"stage": [entry("a"), entry("b")], "owner": []}},
    ]
    raw = spark.createDataFrame([(json.dumps(o),) for o in objects], "raw string")
    found = ingest.property_history(raw)
    assert rows(found.select("object_id", "property_name", "value", "timestamp", "sourceType")) == [("2", "stage", "a", "t", "CRM"), ("2", "stage", "b", "t", "CRM")]
    assert {r.sourceId for r in found.collect()} == {None}


def test_crm_columns():
    assert ingest.crm_columns(["name", "id"], ["hs_x", "custom", "name"]) == ["custom", "id", "name"]
    assert ingest.crm_columns(["name", "id"], ["custom"], include_custom=False) == ["id", "name"]


def test_headers_and_kinds():
    assert ingest.header_names(["a", None, "c d"]) == (["a", "col_2", "c d"], True)
    assert ingest.header_names(["a", "A "]) == (["a", "A "], True)
    assert ingest.header_names(["a b", "a-b"]) == (["col_1", "col_2"], False)
    assert ingest.header_names(["a", 5]) == (["col_1", "col_2"], False)
    assert ingest.column_kinds(["DATE_TIME", "TIME", "DATE", "NUMBER", None]) == ["timestamp", "timestamp", "date", None, None]


def test_typed_rows(spark):
    raw = ['["x", 43831.5, 43831, true, "extra"]', "[]", '["", "", "later"]', '["y", false, 43832]']
    grid = ingest.grid_cells(spark.createDataFrame([(r,) for r in raw], "row_json string"))
    made = ingest.typed_rows(grid, ["name", "at", "day", "flag"], ["", "timestamp", "date"][:0] + [None, "timestamp", "date"])
    assert sorted(rows(made), key=str) == sorted(
        [
            ("x", datetime(2020, 1, 1, 12), date(2020, 1, 1), "true"),
            (None, None, None, None),
            ("y", None, date(2020, 1, 2), None),
        ],
        key=str,
    )


def test_trim(spark):
    raw = [("s", 0, "[]"), ("s", 1, '["", "", "a", "b"]'), ("s", 2, '["q", "", "c"]'), ("s", 3, "[]"), ("t", 0, '["z"]')]
    grid = ingest.grid_cells(spark.createDataFrame(raw, "sheet string, row_index int, row_json string"))
    made = ingest.trim_top_left(grid).select("sheet", "row_index", "start_row", "start_col", c("cells").cast("array<string>"))
    assert rows(made) == [("s", 1, 1, 2, ["a", "b"]), ("s", 2, 1, 2, ["c"]), ("s", 3, 1, 2, []), ("t", 0, 0, 0, ["z"])]


def test_range_metadata(spark):
    raw = [("one", 0, '["a"]'), ("blank", 0, "[]"), ("blank", 1, '["a"]'), ("ok", 0, '["a"]'), ("ok", 1, '["b"]')]
    grid = ingest.grid_cells(spark.createDataFrame(raw, "sheet string, row_index int, row_json string"))
    assert rows(ingest.range_metadata(grid)) == [("blank", 2, True), ("ok", 2, False), ("one", 1, True)]


def test_issues_and_cycles(spark):
    node = {"id": "i1", "number": 1, "labels": {"nodes": [{"id": "l", "name": "bug", "color": "red"}]}, "state": {"name": "done"}}
    raw = spark.createDataFrame([(json.dumps(node),), (json.dumps({"id": "i2"}),)], "node string")
    issues = ingest.issues(raw)
    assert rows(issues.select("id", "state.name", F.size("labels"))) == [("i1", "done", 1), ("i2", None, 0)]
    assert rows(ingest.issue_labels(issues)) == [("i1", "l", "bug", "red")]
    cycles = spark.createDataFrame([("c", [1, 2], [0])], "id string, scope array<int>, done array<int>")
    assert rows(ingest.cycle_history(cycles, "id", ["scope", "done"])) == [("c", 0, 1, 0), ("c", 1, 2, None)]


def test_event_params(spark):
    kind = "event_id string, event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint,float_value:float,double_value:double>>>"
    data = [("e", [("page", ("home", None, None, None)), ("n", (None, 3, None, None)), ("none", (None, None, None, None))])]
    df = spark.createDataFrame(data, kind)
    assert rows(ingest.event_params(df, ["event_id"])) == [("e", "n", "3"), ("e", "none", None), ("e", "page", "home")]
    assert ingest.params_map(df, ["event_id"]).select(c("params")["n"]["int_value"]).first()[0] == 3


def test_seed_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "seed.csv"
    path.write_bytes("﻿id,name\n1,a\n2,\n".encode())
    assert rows(read_seed(spark, str(path), "id int, name string")) == [(1, "a"), (2, None)]


def test_half_open_turns_zone_offsets_into_utc(spark):
    df = spark.createDataFrame([(datetime(2022, 12, 15, 4, 59),), (datetime(2022, 12, 15, 5),), (datetime(2023, 1, 1, 5),)], "t timestamp_ntz")
    kept = df.where(half_open("t", "2022-12-15T00:00:00-05:00", "2023-01-01T00:00:00-05:00"))
    assert rows(kept) == [(datetime(2022, 12, 15, 5),)]


def test_push_sheet(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b")], "id int, v string").coalesce(1)
    path = str(tmp_path / "sheet")
    push_sheet(df, path)
    push_sheet(df, path, "append")
    lines = [line for f in (tmp_path / "sheet").glob("*.csv") for line in f.read_text().splitlines()]
    assert sorted(lines) == ["1,", "1,", "2,b", "2,b", "id,v", "id,v"]
    assert read_csv(spark, path, "id int, v string").count() == 4
