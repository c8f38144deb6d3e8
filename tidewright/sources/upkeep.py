"""Aggregates kept up to date: a batch recomputes the groups it touches, or folds in partial results."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.session import landed
from tidewright.sources.load import KeyedTable


def facts_of(facts: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The facts of all groups that a batch has rows of; null is a group.

    Where the facts lie in folders by a key, only the folders of touched groups are read.
    """
    groups = batch.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys])
    return facts.join(groups, same, "left_semi")


def recompute(
    table: KeyedTable, batch: DataFrame, facts: DataFrame, keys: Sequence[str], model: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Bring a grouped model up to date after ``batch`` came into ``facts``, and return it.

    ``model`` turns facts into rows that have the table's keys, from facts of the same keys only. Groups the batch
    touches are computed anew from all their facts, so late rows, corrections and measures that do not add up (distinct
    counts, medians) come out as in a full run; a group without rows any more leaves. Repeating a batch changes nothing.
    """
    groups = landed(batch.select(*keys).distinct(), "touched")
    rows = model(facts_of(facts, groups, keys))
    # A group that has no facts left is still named, so that its old rows go.
    named = rows.withColumn("__kept", F.lit(True)).unionByName(groups.withColumn("__kept", F.lit(False)), allowMissingColumns=True)
    return table.replace_groups(named, "__kept")


def fold(table: KeyedTable, batch: DataFrame, merges: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Add partial results of a batch to the table's, and return it: facts are not read again.

    ``batch`` has the table's keys and a partial result in each of the ``merges`` columns, which name how two partials
    make one: ``F.sum`` for counts and sums, ``F.min``, ``F.max``, ``F.hll_union_agg``, ``F.kll_merge_agg_double``. Every batch must be
    folded once; late rows may come in any of them.
    """

    def add(now: DataFrame, new: DataFrame) -> DataFrame:
        both = now.unionByName(new)
        return both.groupBy(*table.keys).agg(*[merge(F.col(c)).alias(c) for c, merge in merges.items()])

    return table.folded(batch, add)
