"""Each check on rows that pass and on rows that fail."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import checks as ck

c = F.col


def ints(spark, values, name="x"):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def stamp(text):
    return F.lit(text).cast("timestamp_ntz")


def test_accepted_range(spark):
    df = ints(spark, [-1, 11, None])
    assert ck.accepted_range(df, "x", -1, 11).isEmpty()
    assert rows(ck.accepted_range(df, "x", 0, 11)) == [(-1,)]
    assert rows(ck.accepted_range(df, "x", -1, 11, inclusive=False)) == [(-1,), (11,)]
    assert ck.accepted_range(df, "x").isEmpty()


def test_at_least_one(spark):
    assert ck.at_least_one(ints(spark, [None, 1]), "x").isEmpty()
    assert rows(ck.at_least_one(ints(spark, [None]), "x")) == [(0,)]


def test_cardinality_equality(spark):
    a = ints(spark, [1, 2, 3])
    assert ck.cardinality_equality(a, "x", ints(spark, [3, 1, 2], "y"), "y").isEmpty()
    assert rows(ck.cardinality_equality(a, "x", ints(spark, [1, 2, 2, None], "y"), "y")) == [
        (None, 1, "b"), (2, 1, "a"), (2, 2, "b"), (3, 1, "a"),
    ]


def test_row_counts(spark):
    a, b = ints(spark, [1, 2, 3]), ints(spark, [1, 2, 3, 4])
    assert rows(ck.equal_rowcount(a, b)) == [(3, 4, 1)]
    assert [ck.fewer_rows_than(x, y).first()["row_count_delta"] for x, y in ((a, b), (a, a), (b, a))] == [0, 1, 1]
    assert ck.loaded_vs_expected(a, 3).isEmpty()
    assert rows(ck.loaded_vs_expected(a, 5)) == [(3, 5)]


def test_equality(spark):
    a = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "x int, y string")
    b = spark.createDataFrame([(1, "a"), (2, None)], "x int, y string")
    assert ck.equality(a, b).isEmpty()
    other = spark.createDataFrame([(1, "a"), (3, None)], "x int, y string")
    found = ck.equality(a, other)
    assert rows(found) == [("a_minus_b", 2, None), ("b_minus_a", 3, None)]
    assert ck.equality_score(found).first()[0] == 2
    assert ck.equality_score(ck.equality(a, other.limit(0))).first()[0] == 4
    assert ck.equality(a, other, ["y"]).isEmpty()


def test_expression_is_true(spark):
    df = spark.createDataFrame([(0.0, 1.0), (1.0, 0.0), (0.5, 0.5), (None, 1.0)], "a double, b double")
    assert ck.expression_is_true(df, "a + b = 1").isEmpty()
    assert rows(ck.expression_is_true(df, "a < 1")) == [(1.0, 0.0)]
    assert ck.expression_is_true(df, "< 1", column="a", condition="b > 0").isEmpty()


def test_ranges(spark):
    no_gaps = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    assert ck.mutually_exclusive_ranges(no_gaps, "lo", "hi", gaps="not_allowed").isEmpty()
    assert ck.mutually_exclusive_ranges(no_gaps, "lo", "hi", gaps="required").count() == 2
    overlap = spark.createDataFrame([(0, 3), (1, 2), (None, 5)], "lo int, hi int")
    assert ck.mutually_exclusive_ranges(overlap.where("lo is not null"), "lo", "hi").count() == 1
    parts = spark.createDataFrame([(3, 1, 2), (3, 4, 4), (3, 5, 6), (4, 1, 9)], "k int, lo int, hi int")
    assert ck.mutually_exclusive_ranges(parts, "lo", "hi", "k", zero_length_range_allowed=True).isEmpty()
    assert ck.mutually_exclusive_ranges(parts, "lo", "hi", "k").count() == 1
    with pytest.raises(ValueError):
        ck.mutually_exclusive_ranges(parts, "lo", "hi", gaps="maybe")


def test_open_end_fails(spark):
    df = spark.createDataFrame([(1, 1, 2), (1, 3, None)], "k int, lo int, hi int")
    assert rows(ck.mutually_exclusive_ranges(df, "lo", "hi", "k").select("lo")) == [(3,)]


def test_values(spark):
    df = spark.createDataFrame([(1, "Barcelona"), (2, "London"), (3, None)], "id int, city string")
    assert ck.not_accepted_values(df, "city", ["Sydney"]).isEmpty()
    assert rows(ck.not_accepted_values(df, "city", ["London"])) == [("London",)]
    assert rows(ck.not_accepted_values(df, "id", ["1 + 1"], quote=False)) == [(2,)]
    assert rows(ck.accepted_values(df, "city", ["London"])) == [("Barcelona", 1)]
    assert rows(ck.not_null(df, "city")) == [(3, None)]
    assert ck.not_null(df, "city", where="id < 3").isEmpty()


def test_not_constant(spark):
    assert ck.not_constant(ints(spark, [1, 1, 2]), "x").isEmpty()
    assert ck.not_constant(ints(spark, [None, None]), "x").isEmpty()
    assert rows(ck.not_constant(ints(spark, [1, 1, None]), "x")) == [(1,)]


def test_not_null_proportion(spark):
    df = ints(spark, [1, None, None, 4, 5, 6, None, None, None, 10])
    assert ck.not_null_proportion(df, "x", 0.5).isEmpty()
    assert rows(ck.not_null_proportion(df, "x", 0.9)) == [(0.5,)]
    assert ck.not_null_proportion(df, "x", 0, 0.4).count() == 1
    assert ck.not_null_proportion(df.limit(0), "x", 0.9).isEmpty()


def test_recency_and_freshness(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1),), (datetime(2024, 1, 5),)], "t timestamp_ntz")
    assert ck.recency(df, "t", "day", 2, stamp("2024-01-06")).isEmpty()
    assert ck.recency(df, "t", "day", 2, stamp("2024-01-08")).count() == 1
    assert ck.recency(df.limit(0), "t", "day", 2, stamp("2024-01-08")).isEmpty()
    assert ck.recent_days(df, c("t"), 3, F.lit(date(2024, 1, 8))).isEmpty()
    assert ck.recent_days(df, c("t"), 2, F.lit(date(2024, 1, 8))).count() == 1
    for now, status in (("2024-01-05 01:00:00", "pass"), ("2024-01-06", "warn"), ("2024-01-09", "error")):
        assert ck.freshness(df, "t", stamp(now), (12, "hour"), (2, "day")).first()["status"] == status


def test_relationships_where(spark):
    child, parent = ints(spark, [1, 2, 4, None], "id"), ints(spark, [1, 2, 3], "id")
    assert ck.relationships_where(child, "id", parent, "id", from_condition="id <> 4").isEmpty()
    assert rows(ck.relationships(child, "id", parent, "id")) == [(4,)]
    assert rows(ck.relationships_where(child, "id", parent, "id", "id < 3", "id > 1")) == [(1,)]


def test_sequential_values(spark):
    assert ck.sequential_values(ints(spark, [2, 4, 6, 8, 10]), "x", 2).isEmpty()
    assert rows(ck.sequential_values(ints(spark, [1, 2, 4, 4]), "x")) == [(4, 2), (4, 4)]
    hours = spark.createDataFrame([(datetime(2021, 1, 1, h),) for h in (0, 1, 2, 4)], "t timestamp_ntz")
    assert rows(ck.sequential_values(hours, "t", 1, "hour")) == [(datetime(2021, 1, 1, 4), datetime(2021, 1, 1, 2))]


def test_unique(spark):
    df = spark.createDataFrame([(1, "a", False), (2, "a", True), (2, "a", False), (None, "b", True), (None, "b", True)], "id int, p string, gone boolean")
    assert rows(ck.unique_combination_of_columns(df, ["id", "p"])) == [(None, "b", 2), (2, "a", 2)]
    assert ck.unique(df, "id", where="not gone").isEmpty()
    assert rows(ck.unique(df, "id")) == [(2, 2)]


def test_average(spark):
    df = spark.createDataFrame([("d", "s", 3000.0), ("d", "s", 1500.0), ("e", "s", 10.0), ("f", None, None)], "d string, s string, v double")
    assert rows(ck.average(df, c("v"), "d", c("s"), 2000)) == [("d", "s", 2250.0), ("f", None, None)]


def test_completeness_hourly(spark):
    times = [datetime(2024, 1, 1, 0, 5), datetime(2024, 1, 1, 1), datetime(2024, 1, 1, 3), datetime(2023, 1, 1, 3)]
    df = spark.createDataFrame([(x,) for x in times], "t timestamp_ntz")
    found = ck.completeness_hourly(df, "t", 2, stamp("2024-01-02"))
    assert [tuple(r) for r in found.collect()] == [(datetime(2024, 1, 1, 1), 1, datetime(2024, 1, 1, 3), 2)]


def test_small_predicates(spark):
    df = spark.createDataFrame([("production", None), ("production", "x"), ("dev", None)], "a string, b string")
    assert rows(ck.missing_when(df, "a", "production", "b")) == [("production", None)]
    assert rows(ck.assert_equal(df, "a", "b")) == [("production", "x")]
    assert ck.assert_same(df, "a", "b").count() == 3
    totals = spark.createDataFrame([(1, 5), (1, -7), (2, 1)], "k int, v int")
    assert rows(ck.negative_totals(totals, "k", c("v"))) == [(1, -2)]


def test_verdicts(spark):
    bad = ints(spark, [1, 2])
    assert rows(ck.verdict(bad, "n"))[0][1:] == (2, "FAILED")
    assert rows(ck.verdict(bad, "n", "> 5", "> 1"))[0][1:] == (2, "WARNING")
    assert rows(ck.verdict(bad, "n", "> 5", "> 4"))[0][1:] == (2, "SUCCEEDED")
    assert rows(ck.verdict(bad, "n", severity="warn"))[0][1:] == (2, "WARNING")
    assert rows(ck.verdict(bad.agg(F.count("x").alias("c")), "n", "= 0", None, scalar="c"))[0][1:] == (2, "SUCCEEDED")
    with pytest.raises(ValueError):
        ck.verdict(bad, "n", "more than 3")


def test_run_checks(spark):
    df = spark.createDataFrame([(1, "TEST"), (None, "b"), (1, "c")], "id int, name string")
    plan = ck.CheckPlan(
        rows=[ck.RowCheck("t", "id filled", c("id").isNull()), ck.RowCheck("t", "no test rows", F.upper("name") == "TEST", severity="warn")],
        duplicates=[("t", ["id"]), ("t", ["name"])],
    )
    assert rows(ck.run_checks({"t": df}, plan)) == [
        ("t", "duplicates:id", 1, "FAILED"), ("t", "duplicates:name", 0, "SUCCEEDED"),
        ("t", "id filled", 1, "FAILED"), ("t", "no test rows", 1, "WARNING"),
    ]
