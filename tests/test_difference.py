"""The hash tree finds what EXCEPT ALL finds, and compares only what lies under nodes that differ."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import difference

DDL = "k int, v string, x double, s struct<a:int,b:int>, l array<int>"


def some(rng, n):
    return [
        (rng.choice([None, *range(30)]), rng.choice([None, "a", "b"]), rng.choice([None, 0.0, 1.5]), rng.choice([None, (1, None), (None, 1)]),
         rng.choice([None, [], [None, 1], [1, None]]))
        for _ in range(n)
    ]


def brute(a, b):
    x, y = (Counter(map(str, side)) for side in (a, b))
    return sorted([(r, "a", n) for r, n in (x - y).items()] + [(r, "b", n) for r, n in (y - x).items()])


@pytest.mark.parametrize("bits, levels", [(2, 3), (12, 2), (4, 1)])
def test_rows_are_those_of_except_all(spark, bits, levels):
    rng = random.Random(bits)
    a = some(rng, 200)
    b = a[5:] + a[20:23] + some(rng, 4)
    frames = [spark.createDataFrame(x, DDL).repartition(3) for x in (a, b)]
    found = difference.differing_rows(*frames, ["k"], bits, levels).collect()
    got = sorted((str((r.k, r.v, r.x, r.s and tuple(r.s), r.l)), r.only_in, r.copies) for r in found)
    assert got == brute(a, b)


def test_equal_tables_and_empty_ones(spark):
    a = spark.createDataFrame(some(random.Random(1), 50), DDL)
    assert difference.differing_rows(a, a.repartition(5), ["k"]).isEmpty()
    assert difference.differing_rows(a, a.where("false"), ["k"]).agg(F.sum("copies")).first()[0] == 50
    assert difference.differing_rows(a.where("false"), a.where("false"), ["k"]).isEmpty()


def test_places_of_nulls_and_copies_tell_rows_apart(spark):
    a = spark.createDataFrame([(1, None, "a"), (2, "x", "x")], "k int, v string, w string")
    b = spark.createDataFrame([(1, "a", None), (2, "x", "x"), (2, "x", "x")], "k int, v string, w string")
    assert difference.differing_rows(a, b, ["k"]).count() == 3
    assert rows(difference.differing_rows(a, b, ["k"]).where("k = 2")) == [(2, "x", "x", "b", 1)]


def test_only_buckets_that_differ_are_compared(spark):
    a = spark.range(20_000).select(F.col("id").alias("k"), F.md5(F.col("id").cast("string")).alias("v"))
    b = a.withColumn("v", F.when(F.col("k") % 2000 == 7, "changed").otherwise(F.col("v")))
    nodes = difference.suspects(a, b, ["k"], bits=6, levels=2)
    assert nodes.count() == 10
    under = difference._under(a, ["k"], 12, nodes).count()
    assert 10 <= under <= 200  # of 20,000 rows
    assert difference.differing_rows(a, b, ["k"], 6, 2).count() == 20


def test_checksums_add_up(spark):
    a = spark.createDataFrame(some(random.Random(3), 100), DDL)
    fine, coarse = (difference.checksums(a, ["k"], bits) for bits in (6, 3))
    up = fine.withColumn("__node", F.shiftright("__node", 3)).groupBy("__node").agg(*[F.sum(s).alias(s) for s in difference._SUMS])
    assert rows(up) == rows(coarse)


def test_shapes_must_agree(spark):
    a = spark.createDataFrame([(1, 2)], "k int, v int")
    for other in ("k int, w int", "k int, v long"):
        with pytest.raises(ValueError):
            difference.differing_rows(a, spark.createDataFrame([(1, 2)], other), ["k"])
    with pytest.raises(ValueError):
        difference.differing_rows(a, a, ["k"], bits=16, levels=4)
