"""Joins with a shape of their own. Strategy is left to Spark, which broadcasts only by checked size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def missing_in(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose key the parent does not have."""
    keys = parent.select(F.col(parent_key).alias("__key"))
    return child.join(keys, F.col(child_key) == F.col("__key"), "left_anti")


def semi_by_set(df: DataFrame, members: DataFrame, column: str) -> DataFrame:
    """Rows whose value is in a set computed from data."""
    return df.join(members.select(column), column, "left_semi")


def calendar_left(spine: DataFrame, facts: DataFrame, day: str, fact_day: str) -> DataFrame:
    """Every calendar day with its facts, or with nulls.

    Written as matching facts plus days without any: the calendar can then be the broadcast side, and a day
    with very many facts is never gathered in one task, as it would be on the null-supplying side of a left join.
    """
    matched = facts.join(spine, F.col(fact_day) == F.col(day), "inner")
    matched = matched.select(*spine.columns, *facts.columns)
    seen = facts.select(F.col(fact_day).alias("__day")).distinct()
    empty = spine.join(seen, F.col(day) == F.col("__day"), "left_anti")
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    return matched.unionByName(empty.select(*spine.columns, *nulls))


def side_by_side(frames: dict[str, Column], sources: dict[str, DataFrame]) -> DataFrame:
    """One row with one aggregate per source, without a cross join."""
    names = list(frames)
    parts = []
    for name in names:
        one = sources[name].agg(frames[name].alias(name))
        parts.append(one.select(*[F.col(n) if n == name else F.lit(None).alias(n) for n in names]))
    rows = reduce(DataFrame.unionByName, parts)
    return rows.agg(*[F.max(n).alias(n) for n in names])


def count_pair(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row: count_a and count_b."""
    n = F.count(F.lit(1))
    return side_by_side({"count_a": n, "count_b": n}, {"count_a": a, "count_b": b})


def inner_distinct_names(left: DataFrame, right: DataFrame, on: Sequence[str], suffix: str = "_right") -> DataFrame:
    """Inner join that keeps both sides' columns, the right side's doubles renamed."""
    renamed = right
    for c in right.columns:
        if c in left.columns and c not in on:
            renamed = renamed.withColumnRenamed(c, c + suffix)
    return left.join(renamed, list(on), "inner")
