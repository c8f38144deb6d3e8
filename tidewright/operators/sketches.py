"""Summaries of bounded size that add up: quantiles of any span from stored parts, and exact heavy values."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import landed

#: Size of a quantile sketch; its error is that of ``rank_error(QUANTILE_SIZE)``, about 0.6 %.
QUANTILE_SIZE = 800


class NotGuaranteed(Exception):
    """A sketch is too small to tell the heavy values of this column."""


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """Published error of a KLL sketch: how far the rank of a reported quantile may be off, as a share of all rows.

    It holds with a confidence of 99 % for one quantile, for a sketch of any number of merged parts.
    """
    return 2.296 / size**0.9021


def quantile_parts(df: DataFrame, by: Sequence[str], value: str, size: int = QUANTILE_SIZE) -> DataFrame:
    """One row per group: the number of values and their quantile sketch, to be stored. Null values are left out."""
    rows = df.where(F.col(value).isNotNull())
    sketch = F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(size))
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("n_values"), sketch.alias("quantiles"))


def merge_quantile_parts(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Stored parts put together for coarser groups, again to be stored or asked."""
    return parts.groupBy(*by).agg(F.sum("n_values").alias("n_values"), F.kll_merge_agg_double("quantiles").alias("quantiles"))


def quantiles(parts: DataFrame, **shares: float) -> DataFrame:
    """Quantiles of each row's sketch in columns of the given names: ``quantiles(parts, p50=0.5, p90=0.9)``."""
    asked = {name: F.kll_sketch_get_quantile_double("quantiles", F.lit(float(share))) for name, share in shares.items()}
    return parts.withColumns(asked).drop("quantiles")


def heavy_values(df: DataFrame, column: str, n: int, tracked: int = 10_000, skip_null: bool = True) -> DataFrame:
    """The ``n`` most frequent values with their exact counts: ``value, count, rank``; equal counts rank by value.

    A frequency sketch of ``tracked`` counters goes over the rows once and names the candidates; a second pass counts
    these alone, so the shuffle is bounded by counters and tasks, however many values the column has. A value that is not
    named occurs at most ``7 / map`` times the rows, where ``map`` is the sketch's size, the power of two from a third
    above ``tracked`` on (twice the published error), and no oftener than the rows that the candidates leave. If the last of the ``n``
    does not reach above that, ``NotGuaranteed`` is raised; more counters lower the bound.
    """
    kind = df.schema[column].dataType
    if isinstance(kind, T.StructType | T.ArrayType | T.MapType | T.VariantType):
        raise ValueError(f"{column}: {kind.simpleString()} has no order")
    value = F.col(column)
    rows = df.where(value.isNotNull()) if skip_null else df
    # The sketch knows no nulls, and null stands for no other text, so the two kinds are kept apart by a first letter.
    text = F.hex(value) if isinstance(kind, T.BinaryType) else value.cast("string")
    keyed = rows.select(value.alias("value"), F.when(value.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), text)).alias("key"))
    sketch = keyed.agg(F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(key, {tracked}, {tracked})").alias("top"))
    sketch = landed(sketch.select("rows", F.transform("top", lambda x: x.getField("item")).alias("keys")), "frequent")
    named = sketch.select(F.explode("keys").alias("key"))  # at most ``tracked`` rows
    counted = keyed.join(F.broadcast(named), "key", "left_semi").groupBy("key").agg(F.first("value").alias("value"), F.count(F.lit(1)).alias("count"))
    counted = landed(counted, "frequent-counted")
    total = sketch.select("rows").first()["rows"]
    left = total - (counted.agg(F.sum("count")).first()[0] or 0)
    bound = min(left, int(total * 7 / (1 << math.ceil(math.log2(math.ceil(tracked / 0.75))))))
    top = counted.orderBy(F.desc("count"), "value").select("value", "count").limit(n).collect()
    least = top[-1]["count"] if len(top) == n else 0
    if bound and least <= bound:
        raise NotGuaranteed(f"{column}: rank {n} counts {least}, values left out up to {bound}; track more than {tracked}")
    schema = T.StructType([T.StructField("value", kind), T.StructField("count", T.LongType()), T.StructField("rank", T.IntegerType())])
    return df.sparkSession.createDataFrame([(r["value"], r["count"], i) for i, r in enumerate(top, 1)], schema)
