"""Cut windows give what plain ones give, however the keys and values are spread."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidewright.operators import windows as w

c = F.col


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key, half share one order value, and one key is null."""
    n = F.col("id")
    return spark.range(3000).select(
        n.alias("id"),
        F.when(n % 3 == 0, "hot").when(n % 50 == 1, None).otherwise(F.concat(F.lit("k"), (n % 7).cast("string"))).alias("k"),
        F.when(n % 2 == 0, 100).otherwise(n * 7919 % 911).cast("int").alias("o"),
        F.concat(F.lit("s"), (n * 31 % 17).cast("string")).alias("s"),
        F.when(n % 5 != 0, n % 13).alias("v"),
        F.lit("x").alias("one"),
    ).persist()


FULL = {
    "rn": w.row_number(), "rk": w.rank(), "total": w.running_sum("v"), "head": w.first_value("v"),
    "before": w.lag("v"), "after": w.lead("v"),
}
PEERS = {"rk": w.rank(), "total": w.running_sum("v")}


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("order, specs", [(["id"], FULL), (["o", "id"], FULL), (["s", "id"], FULL), (["o"], PEERS), (["s"], PEERS), (["one"], PEERS)])
def test_slices_match_plain_windows(skewed, keys, order, specs):
    cut = w.with_window(skewed, order, keys, hot_rows=100, slices=9, **specs)
    plain = w._plain(skewed, keys, order, specs)
    assert cut.columns == plain.columns
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_cut_groups_are_small(skewed):
    hot = w.hot_keys(skewed, ["k"], 100)
    assert {r[0] for r in hot.keys.collect()} >= {"hot"} and hot.largest == 1000
    assert w.hot_keys(skewed, ["k"], 10_000) is None


def test_hot_keys_from_a_sample(skewed, monkeypatch):
    monkeypatch.setattr(w, "SAMPLE_ROWS", 600)
    hot = w.hot_keys(skewed, ["k"], 700)
    assert [r[0] for r in hot.keys.collect()] == ["hot"] and 600 < hot.largest < 1400
    specs = {"rn": w.row_number(), "total": w.running_sum("v")}
    cut = w.with_window(skewed, ["o", "id"], ["k"], hot_rows=700, **specs)
    plain = w._plain(skewed, ["k"], ["o", "id"], specs)
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_key_source_changes_nothing(skewed, spark):
    other = spark.range(5000).select((c("id") * 3).alias("id"), F.lit("hot").alias("k"))
    cut = w.with_window(skewed, ["id"], ["k"], hot_rows=100, key_source=other, rn=w.row_number())
    plain = w._plain(skewed, ["k"], ["id"], {"rn": w.row_number()})
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_empty_and_single(spark):
    df = spark.createDataFrame([], "id bigint, v bigint")
    assert w.with_window(df, ["id"], rn=w.row_number()).count() == 0
    one = spark.createDataFrame([(1, None)], "id bigint, v bigint")
    got = w.with_window(one, ["id"], rn=w.row_number(), total=w.running_sum("v"), after=w.lead("v")).first()
    assert tuple(got) == (1, None, 1, None, None)


@pytest.mark.parametrize(
    "value",
    [
        "format_string('Customer#%09d', id * 37 % 3000)",
        "concat(repeat('é', 40), lpad(cast(id * 37 % 3000 as string), 5, '0'))",
        "1152921504606846976 + id * 37 % 3000",
        "cast(12345678901234567890.01 + id * 37 % 3000 as decimal(32, 2))",
        "encode(cast(id * 37 % 3000 as string), 'UTF-8')",
        "id % 2 = 0",
        "if(id % 3 > 0, id % 5, null)",
        "struct(id % 4 as a, 'b' as b)",
    ],
)
def test_any_type_of_order(skewed, value):
    rows = skewed.withColumn("z", F.expr(value))
    for keys, order, specs in ((["k"], ["z", "id"], FULL), ([], ["z"], PEERS)):
        cut = w.with_window(rows, order, keys, hot_rows=100, slices=13, **specs)
        plain = w._plain(rows, keys, order, specs)
        assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()


def test_many_hot_keys(spark):
    rows = spark.range(6000).select("id", (c("id") % 600).alias("k"), (c("id") % 3).alias("v"))
    assert w.hot_keys(rows, ["k"], 4).keys.count() == 600
    specs = {"rn": w.row_number(), "total": w.running_sum("v"), "before": w.lag("v")}
    cut = w.with_window(rows, ["id"], ["k"], hot_rows=4, slices=40, **specs)
    plain = w._plain(rows, ["k"], ["id"], specs)
    assert cut.exceptAll(plain).isEmpty() and plain.exceptAll(cut).isEmpty()
