"""Golden rows of the scalar functions."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from tidewright.functions import dates, keys, numbers, text, web

c = F.col


def check(spark, ddl, data, made):
    """The last column holds the expected value; nulls must match nulls."""
    df = spark.createDataFrame(data, ddl)
    bad = df.withColumn("made", made).where(~c("made").eqNullSafe(c("expected")))
    assert bad.collect() == []


def ts(value):
    return datetime.fromisoformat(value) if value else None


def test_concat_is_null_with_a_null_part(spark):
    data = [("a", "b", "ab"), ("a", None, None), (None, "b", None), (None, None, None)]
    check(spark, "a string, b string, expected string", data, text.concat(c("a"), c("b")))


def test_hash(spark):
    data = [("ab", "187ef4436122d1cc2f40dc2b92f0eba0"), ("a", "0cc175b9c0f1b6a831c399e269772661"), ("1", "c4ca4238a0b923820dcc509a6f75849b")]
    check(spark, "a string, expected string", data, keys.hash_text(c("a")))


def test_surrogate_key(spark):
    data = [
        ("a", "b", "c", "7b193b3d33184464106f41ddf733783b"),
        ("a", "", "c", "c5fd1b92380c6222ab0ef67839208624"),
        ("a", None, "c", "c5fd1b92380c6222ab0ef67839208624"),
        ("", None, "c", "267743defab4558f1940311b66274e26"),
        (None, None, None, "cfab1ba8c67c7c838db98d666f02a132"),
    ]
    check(spark, "a string, b string, c string, expected string", data, keys.surrogate_key([c("a"), c("b"), c("c")]))


def test_length_position_replace(spark):
    check(spark, "a string, expected int", [("abcdef", 6), ("software", 8), ("www.google.com/path", 19)], text.length(c("a")))
    data = [("def", "abcdef", 4), ("land", "earth", 0), ("ware", "software", 5), ("ember", "december", 4)]
    check(spark, "n string, a string, expected int", data, text.position(c("n"), c("a")))
    check(spark, "a string, expected string", [("http://google.com", "google.com")], text.replace(c("a"), "http://", ""))


def test_right(spark):
    data = [("abcdef", 3, "def"), ("software", 4, "ware"), ("december", 5, "ember"), ("december", 0, ""), ("ab", 9, "ab")]
    check(spark, "a string, n int, expected string", data, text.right(c("a"), c("n")))


@pytest.mark.parametrize("part", [1, 2, 3])
def test_split_part(spark, part):
    data = [("a|b|c", "abc"[part - 1]), ("1|2|3", "123"[part - 1]), ("|", ""), (None, None)]
    check(spark, "a string, expected string", data, text.split_part(c("a"), "|", part))


def test_safe_cast_and_bool(spark):
    check(spark, "a string, expected int", [("123", 123), ("abc", None), (None, None)], text.safe_cast(c("a"), "int"))
    check(spark, "a boolean, expected string", [(True, "true"), (False, "false"), (None, None)], text.as_text(c("a")))


def test_slugify(spark):
    data = [("!Hell0 world-hi", "hell0_world_hi"), ("a  b", "a_b")]
    check(spark, "a string, expected string", data, text.slugify(c("a")))
    assert text.slugify_name("!Hell0 world-hi") == "hell0_world_hi"


def test_check_names(spark):
    data = [
        ("not_null_orders_id__ab12", "orders", "not_null", "id"),
        ("unique_orders__hidden__ab12", "orders", "unique", "_hidden"),
        ("assert_total__x", "orders", "assert_total", ""),
        ("plain", "orders", "plain", ""),
    ]
    df = spark.createDataFrame(data, "n string, m string, kind string, col string")
    made = df.select(text.check_kind(c("n"), c("m")).alias("k"), text.check_column(c("n"), c("m")).alias("o"), "kind", "col")
    assert [(r.k, r.o) for r in made.collect()] == [(r.kind, r.col) for r in made.collect()]


def test_safe_add_and_row_sum(spark):
    data = [(1, 2, 3, 6), (1, None, 3, 4), (None, None, 2, 2), (None, None, None, 0)]
    ddl = "a int, b int, c int, expected int"
    check(spark, ddl, data, numbers.safe_add(c("a"), c("b"), c("c")))
    check(spark, ddl, [(1, 2, 3, 6), (1, None, 3, None)], numbers.row_sum(c("a"), c("b"), c("c")))


def test_width_bucket(spark):
    data = [(190000.0, 0), (290000.0, 1), (320000.0, 2), (399999.99, 2), (400000.0, 3), (470000.0, 3), (510000.0, 4), (610000.0, 5)]
    check(spark, "a double, expected bigint", data, numbers.width_bucket(c("a"), 200000, 600000, 4))


def test_haversine(spark):
    row = [(48.864716, 2.349014, 52.379189, 4.899431)]
    df = spark.createDataFrame(row, "a double, b double, c double, d double")
    args = [c(x) for x in "abcd"]
    got = df.select(F.round(numbers.haversine(*args)), F.round(numbers.haversine(*args, unit="km"))).first()
    assert tuple(got) == (267.0, 430.0)
    with pytest.raises(ValueError):
        numbers.haversine(*args, unit="yd")


def test_cents(spark):
    data = [(12.34, 1234), (-0.01, -1), (112946.26, 11294626), (0.125, 13), (-0.125, -13), (None, None)]
    check(spark, "a double, expected bigint", data, numbers.to_cents(c("a")))
    check(spark, "a bigint, expected double", [(1234, 12.34), (5, 0.05)], numbers.cents_to_dollars(c("a")))


def test_dateadd(spark):
    start = ts("2018-01-01 01:00:00")
    for part, expected in {"day": "2018-01-02 01:00:00", "month": "2018-02-01 01:00:00", "year": "2019-01-01 01:00:00", "hour": "2018-01-01 02:00:00"}.items():
        check(spark, "a timestamp_ntz, expected timestamp_ntz", [(start, ts(expected)), (None, None)], dates.dateadd(part, 1, c("a")))


@pytest.mark.parametrize(
    "first, second, part, expected",
    [
        ("2018-01-01 01:00:00", "2018-01-02 01:00:00", "day", 1),
        ("2018-01-01 01:00:00", "2018-02-01 01:00:00", "month", 1),
        ("2018-01-01 01:00:00", "2019-01-01 01:00:00", "year", 1),
        ("2018-01-01 01:00:00", "2018-01-01 02:00:00", "hour", 1),
        ("2018-01-01 01:00:00", "2018-01-01 02:01:00", "minute", 61),
        ("2018-01-01 01:00:00", "2018-01-01 02:00:01", "second", 3601),
        ("2019-12-31 00:00:00", "2019-12-27 00:00:00", "week", -1),
        ("2019-12-31 00:00:00", "2019-12-30 00:00:00", "week", 0),
        ("2019-12-31 00:00:00", "2020-01-02 00:00:00", "week", 0),
        ("2019-12-31 00:00:00", "2020-01-06 02:00:00", "week", 1),
        ("2020-01-04 00:00:00", "2020-01-05 00:00:00", "week", 1),
        ("2018-12-31 23:59:59", "2019-01-01 00:00:00", "quarter", 1),
        ("2018-12-31 23:59:59.9", "2019-01-01 00:00:00", "second", 1),
        ("1969-12-31 23:59:59.5", "1970-01-01 00:00:00.5", "second", 1),
        ("2018-01-01 00:00:00", "2018-01-01 00:00:01", "millisecond", 1000),
        ("2018-01-01 00:00:00", "2018-01-01 00:00:01", "microsecond", 1000000),
        (None, "2018-01-01 02:00:00", "hour", None),
        ("2018-01-01 02:00:00", None, "hour", None),
    ],
)
def test_datediff_counts_boundaries(spark, first, second, part, expected):
    ddl = "a timestamp_ntz, b timestamp_ntz, expected bigint"
    check(spark, ddl, [(ts(first), ts(second), expected)], dates.datediff(c("a"), c("b"), part))


def test_datediff_rejects_other_parts():
    with pytest.raises(ValueError):
        dates.datediff(F.lit(1), F.lit(2), "fortnight")


@pytest.mark.parametrize("part, expected", [("month", date(2018, 1, 31)), ("quarter", date(2018, 3, 31)), ("year", date(2018, 12, 31))])
def test_last_day(spark, part, expected):
    check(spark, "a date, expected date", [(date(2018, 1, 2), expected), (None, None)], dates.last_day(c("a"), part))


def test_serial_dates(spark):
    check(spark, "a double, expected timestamp_ntz", [(43831.5, ts("2020-01-01 12:00:00"))], dates.serial_to_timestamp(c("a")))
    check(spark, "a double, expected date", [(43831.0, date(2020, 1, 1))], dates.serial_to_date(c("a")))


def test_julian(spark):
    data = [(2415020, date(1920, 1, 1)), (2415021, date(1920, 1, 2)), (None, None)]
    check(spark, "a int, expected date", data, dates.julian_to_date(c("a")))


def test_weekday(spark):
    check(spark, "a date, expected string", [(date(2024, 1, 1), "Monday"), (date(2024, 1, 7), "Sunday")], dates.weekday_name(c("a")))


def test_url_parts(spark):
    hosts = [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", "www.google.co.uk"),
        ("http://blog.example.com/2018/01/tips/", "blog.example.com"),
        ("https://www.nytimes.com/2018/01/01/blog", "www.nytimes.com"),
        ("android-app://m.facebook.com/", "m.facebook.com"),
        ("docs.nytimes.com/2021/01/01/index.js?utm_source=google", "docs.nytimes.com"),
    ]
    check(spark, "a string, expected string", hosts, web.url_host(c("a")))
    paths = [
        ("www.google.co.uk?utm_source=google&utm_medium=cpc", ""),
        ("http://blog.example.com/2018/01/tips/", "2018/01/tips/"),
        ("https://www.nytimes.com/2018/01/01/blog", "2018/01/01/blog"),
        ("http://blog.example.com/2018/01/tips/?utm_source=google", "2018/01/tips/"),
        ("plain", "plain"),
    ]
    check(spark, "a string, expected string", paths, web.url_path(c("a")))
    query = [
        ("http://example.com/milky?utm_medium=organic", None),
        ("http://example.com/milky?utm_medium=organic&utm_source=github", "github"),
        ("http://x.com?my_utm_source=inner", "inner"),
    ]
    check(spark, "a string, expected string", query, web.url_parameter(c("a"), "utm_source"))
