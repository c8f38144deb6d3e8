from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidewright.operators import audit
from tidewright.sources.tables import column_catalog

c = F.col


def pair(spark):
    a = spark.createDataFrame([(1, "a"), (2, "b")], "col_a int, col_b string")
    b = spark.createDataFrame([(1, "a"), (2, "c")], "col_a int, col_b string")
    return a, b


def test_compare_relations(spark):
    a, b = pair(spark)
    assert rows(audit.compare_relations(a, b)) == [(False, True, 1, 33.33), (True, False, 1, 33.33), (True, True, 1, 33.33)]
    assert rows(audit.compare_relations(a, b, exclude_columns=["COL_B"])) == [(True, True, 2, 100.0)]


def brute(a, b):
    """The classes over the full join, written out."""
    out = Counter()

    def judge(va, vb, has_a, has_b):
        if va is not None and va == vb:
            return 0
        if va is None and vb is None:
            return 1
        if not has_a:
            return 2
        if not has_b:
            return 3
        return 4 if va is None else 5 if vb is None else 6

    for ka, va in a:
        partners = [vb for kb, vb in b if ka is not None and ka == kb]
        for vb in partners:
            out[judge(va, vb, True, True)] += 1
        if not partners:
            out[judge(va, None, True, False)] += 1
    for kb, vb in b:
        if kb is None or all(ka != kb for ka, _ in a):
            out[judge(None, vb, False, True)] += 1
    return sorted((k, n) for k, n in out.items() if n)


@pytest.mark.parametrize("seed", range(6))
def test_compare_column_values_equals_the_full_join(spark, seed):
    rng = random.Random(seed)

    def side():
        return [(rng.choice([None, 1, 2, 3, 4, 5, 6]), rng.choice([None, "x", "y", "z"])) for _ in range(rng.randint(0, 25))]

    a, b = side(), side()
    frames = [spark.createDataFrame(x, "k int, v string") for x in (a, b)]
    made = audit.compare_column_values(*frames, "k", "v")
    assert sorted((r.match_order, r.count_records) for r in made.collect()) == brute(a, b)


def test_columns_and_schema(spark):
    a, b = pair(spark)
    other = b.select(c("col_b"), c("col_a").cast("bigint"), F.lit(1).alias("more"))
    ca, cb = column_catalog(spark, {"a": a}), column_catalog(spark, {"b": other})
    assert rows(audit.compare_relation_columns(ca, cb)) == [
        ("col_a", 1, 2, "int", "bigint", False, False),
        ("col_b", 2, 1, "string", "string", False, True),
        ("more", None, 3, None, "int", False, False),
    ]
    assert rows(audit.schema_parity(ca, cb, ["col_a", "col_b"]).select("column_name")) == [("col_a",)]


def test_parity(spark):
    a, b = pair(spark)
    assert audit.row_count_parity(a, b).isEmpty()
    assert rows(audit.row_count_parity(a, b.limit(1))) == [(2, 1)]
    assert audit.content_parity(a, a.orderBy(F.desc("col_a")), ["col_a", "col_b"]).isEmpty()
    assert audit.content_parity(a, b, ["col_a", "col_b"]).count() == 1
    # Pairs of equal rows cancel in an XOR, but not in the counts.
    twice = a.unionAll(b.limit(0)).unionAll(spark.createDataFrame([(9, "q"), (9, "q")], a.schema))
    assert audit.content_parity(a, twice, ["col_a", "col_b"]).count() == 1


def test_metrics_cursor_scalar(spark):
    a, b = pair(spark)
    left = audit.metrics(a, n=F.count(F.lit(1)), top=F.max("col_a"), none=F.max(F.lit(None).cast("int")))
    right = audit.metrics(b, n=F.count(F.lit(1)), top=F.max("col_a") + 0.005, none=F.max(F.lit(None).cast("int")))
    assert {r.metric: r.is_match for r in audit.reconcile_metrics(left, right).collect()} == {"n": True, "top": True, "none": True}
    drift = audit.cursor_reconciliation(a, b.where("col_a = 1"), "col_a").first()
    assert (drift.max_drift, drift.count_drift, drift.next_cursor) == (1.0, 1, 2.0)
    assert audit.scalar_reconciliation(a.agg(F.count("col_a")), b.agg(F.count("col_a"))).first().is_match
    assert not audit.scalar_reconciliation(a.agg(F.count("col_a")), b.agg(F.max("col_b"))).first().is_match
