from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import joins, reshape
from tidewright.sources.tables import match_by_name, relations_by_pattern, relations_by_prefix

c = F.col


def test_pivot(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    wide = df.groupBy("size").agg(*reshape.pivot_columns("color", ["red", "blue", "blue's"], quote_identifiers=False))
    assert wide.columns == ["size", "red", "blue", "blues"]
    assert rows(wide) == [("M", 1, 0, 0), ("S", 1, 1, 1)]


def test_pivot_distinct_and_compare(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 5)], "k string, v int")
    made = df.groupBy("k").agg(
        *reshape.pivot_columns("v", [1], agg="count", distinct=True, then_value="v", else_value=None, prefix="n_"),
        *reshape.pivot_columns("v", [1], cmp=">", suffix="_more"),
    )
    assert rows(made) == [("a", 1, 1)]


def test_unpivot(spark):
    data = [(123, date(2017, 1, 1), "active", "tier 1", True), (567, date(2017, 3, 1), "churned", "tier 2", None)]
    df = spark.createDataFrame(data, "customer_id int, created_at date, status string, segment string, is_updated boolean")
    made = reshape.unpivot(df, exclude=["CUSTOMER_ID"], remove=["created_at"], field_name="prop", value_name="val")
    assert rows(made) == [
        (123, "is_updated", "true"), (123, "segment", "tier 1"), (123, "status", "active"),
        (567, "is_updated", None), (567, "segment", "tier 2"), (567, "status", "churned"),
    ]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "dana", "pi"), (2, "bob", "e"), (3, "alice", "4")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", 7), (2, "pink", 13)], "id int, favorite_color string, favorite_number int")
    made = reshape.union_relations({"a": a, "b": b})
    assert made.columns == ["_source_relation", "id", "name", "favorite_number", "favorite_color"]
    assert rows(made) == [
        ("a", 1, "dana", "pi", None), ("a", 2, "bob", "e", None), ("a", 3, "alice", "4", None),
        ("b", 1, None, "7", "green"), ("b", 2, None, "13", "pink"),
    ]
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["nothing"])


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "user_id int, event string, version int")
    only = df.where("user_id = 1")
    assert rows(reshape.deduplicate(only, ["user_id"], [F.desc("version")])) == [(1, "play", 2)]
    assert rows(reshape.newest(df, ["user_id"], ["version"])) == [(1, "play", 2), (2, "pause", 1)]


def test_series_and_spine(spark):
    assert [r[0] for r in reshape.generate_series(spark, 10).orderBy("generated_number").collect()] == list(range(1, 11))
    with pytest.raises(ValueError):
        reshape.generate_series(spark, 0)
    bounds = spark.createDataFrame([(date(2018, 1, 1), date(2018, 1, 10))], "a date, b date")
    days = [r[0] for r in reshape.date_spine(bounds, "day", "a", "b").collect()]
    assert days == [date(2018, 1, d) for d in range(1, 10)]
    # As many rows as boundaries: none within January, one up to the middle of February.
    assert reshape.date_spine(bounds, "month", "a", "b").columns == ["date_month"]
    assert reshape.date_spine(bounds, "month", "a", "b").count() == 0
    longer = spark.createDataFrame([(date(2018, 1, 1), date(2018, 2, 15))], "a date, b date")
    assert [r[0] for r in reshape.date_spine(longer, "month", "a", "b").collect()] == [date(2018, 1, 1)]


def test_star_and_columns(spark):
    df = spark.createDataFrame([("a", "b", "c")], "field_1 string, field_2 string, field_3 string")
    assert df.select(*reshape.star(df, ["FIELD_3"])).columns == ["field_1", "field_2"]
    assert df.select(*reshape.star(df, [], "p_", "_s")).columns == ["p_field_1_s", "p_field_2_s", "p_field_3_s"]
    assert df.alias("x").select(*reshape.star(df, ["field_1"], alias="x")).columns == ["field_2", "field_3"]
    # Exact names: leaving out amount_total keeps amount.
    other = spark.createDataFrame([(1, 2)], "amount int, amount_total int")
    assert reshape.drop_columns(other, ["Amount_Total"]).columns == ["amount"]


def test_star_in_group_by(spark):
    df = spark.createDataFrame([("a", "b", 1), ("a", "b", 2), ("c", "d", 3), ("c", "e", 4)], "g1 string, g2 string, v int")
    made = df.groupBy(*reshape.star(df, ["v"])).agg(F.sum("v").alias("s"))
    assert rows(made) == [("a", "b", 3), ("c", "d", 3), ("c", "e", 4)]
    assert rows(reshape.group_by(df, 2).agg(F.sum("v").alias("s"))) == rows(made)


def test_column_values(spark):
    df = spark.createDataFrame([(x,) for x in "abcdefggggg"], "field string")
    assert reshape.column_values(df, "field", 3) == ["g", "a", "b"]
    assert reshape.column_values(None, "field", default=["y", "z"]) == ["y", "z"]
    with pytest.raises(ValueError):
        reshape.column_values(None, "field")


def test_too_many_column_values_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(reshape, "MAX_VALUES", 5)
    df = spark.range(6).withColumnRenamed("id", "v")
    with pytest.raises(ValueError, match="more than 5"):
        reshape.column_values(df, "v")
    assert reshape.column_values(df, "v", max_records=2) == [0, 1]


def test_blanks(spark):
    df = spark.createDataFrame([("a", "", 1), ("", "b", 2)], "x string, y string, z int")
    assert rows(reshape.blanks_to_null(df)) == [(None, "b", 2), ("a", None, 1)]


def test_listagg(spark):
    data = [(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "a", 2), (2, "1", 1), (2, "p", 3), (3, "g", 1), (3, "g", 2), (3, "g", 3)]
    df = spark.createDataFrame(data, "k int, s string, o int")
    assert rows(reshape.listagg(df, ["k"], "s", "_|_", "o")) == [(1, "a_|_b_|_c"), (2, "1_|_a_|_p"), (3, "g_|_g_|_g")]
    assert rows(reshape.listagg(df, ["k"], "s", "_|_", "o", limit=2)) == [(1, "a_|_b"), (2, "1_|_a"), (3, "g_|_g")]
    assert rows(reshape.listagg(df.where("k = 3"), ["k"], "s", ", ", distinct=True)) == [(3, "g")]


def test_relation_names():
    names = ["data_events_1", "Data_Events_2", "data_events_old", "other", "data_events_1"]
    assert relations_by_pattern(names, "data_events%", "%old") == ["Data_Events_2", "data_events_1"]
    assert relations_by_prefix(names, "OTH") == ["other"]
    assert relations_by_pattern(["a.b", "axb"], "a.b") == ["a.b"]


def test_match_by_name(spark):
    df = spark.createDataFrame([(1, "x")], "ID int, NAME string")
    target = spark.createDataFrame([], "name string, id bigint, more double").schema
    made = match_by_name(df, target)
    assert made.dtypes == [("name", "string"), ("id", "bigint"), ("more", "double")]
    assert rows(made) == [("x", 1, None)]


def test_calendar_left_equals_left_join(spark):
    spine = spark.createDataFrame([(date(2024, 1, d),) for d in range(1, 6)], "day date")
    facts = spark.createDataFrame([(date(2024, 1, 2), 1), (date(2024, 1, 2), 2), (date(2024, 1, 4), 3), (date(2025, 1, 1), 9)], "d date, n int")
    plain = spine.join(facts, c("day") == c("d"), "left")
    assert rows(joins.calendar_left(spine, facts, "day", "d")) == rows(plain)


def test_column_values_in_an_order_of_ones_own(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("b", 9), ("c", 2)], "k string, v int")
    assert reshape.column_values(df, "k", order_by=F.min("v")) == ["b", "c", "a"]
    with pytest.raises(ValueError):
        reshape.column_values(df, "k", max_values=2)


def test_relations_of_other_schemas(spark):
    names = ["sales.orders_1", "SALES_eu.orders_2", "hr.orders_3", "sales.staff"]
    assert relations_by_pattern(names, "ORDERS%", schema_pattern="sales%") == ["SALES_eu.orders_2", "sales.orders_1"]
    assert relations_by_prefix(names, "orders_", exclude="%2", schema_pattern="sales%") == ["sales.orders_1"]


def test_listagg_rejects_wide_groups(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z")], "k string, v string")
    assert rows(reshape.listagg(df, ["k"], "v", max_rows=2)) == [("a", "x,y"), ("b", "z")]
    with pytest.raises(ValueError, match="has 2 texts"):
        reshape.listagg(df, ["k"], "v", max_rows=1)
