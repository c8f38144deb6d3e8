"""Window columns that stay spread out when one key, or the whole table, is a single group.

A plain window puts all rows of a partition key into one task. Where a key is hot, or there is no key, the rows are range
partitioned by key and order columns instead, so slices end at real values of whatever type the columns have. Each slice
is a window group of its own, and a small table of slice totals carries counts, sums and edge values over from the slices
before. Rows of equal order may spread over several slices; ranks and sums count them as the peers they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.session import landed

# Rows one window group may hold before it is cut.
HOT_ROWS = 2_000_000
# Rows looked at to find out whether a key is hot. What is found touches the cost only.
SAMPLE_ROWS = 1_000_000

_SLICE, _AT = "__slice", "__at"


@dataclass(frozen=True)
class Spec:
    kind: str
    column: str | None = None


def row_number() -> Spec:
    return Spec("row_number")


def rank() -> Spec:
    return Spec("rank")


def running_sum(column: str) -> Spec:
    """Sum from the first row up to the current one and its peers."""
    return Spec("running_sum", column)


def first_value(column: str) -> Spec:
    return Spec("first_value", column)


def lag(column: str) -> Spec:
    return Spec("lag", column)


def lead(column: str) -> Spec:
    return Spec("lead", column)


@dataclass(frozen=True)
class HotKeys:
    """Keys that seem to have more rows than one task should read, and how many the largest one has."""

    keys: DataFrame
    largest: int


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> HotKeys | None:
    """The keys with more than ``hot_rows`` rows, or None if there are none.

    Small tables are settled by their row count; of large ones a sample of about SAMPLE_ROWS rows is counted.
    Plain and cut windows give the same rows, so an estimate is good enough.
    """
    total = df.count()
    if total <= hot_rows:
        return None
    share = min(1.0, SAMPLE_ROWS / max(total, 1))
    rows = df.select(*keys) if share == 1.0 else df.select(*keys).sample(share, seed=7)
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max(2.0, hot_rows * share))
    top = counts.agg(F.max("__n")).first()[0]
    return None if top is None else HotKeys(counts.select(*keys), int(top / share))


def with_window(
    df: DataFrame,
    order_by: Sequence[str],
    partition_by: Sequence[str] = (),
    *,
    hot_rows: int = HOT_ROWS,
    key_source: DataFrame | None = None,
    hot: HotKeys | None | str = "find",
    slices: int | None = None,
    **columns: Spec,
) -> DataFrame:
    """Add window columns over ``partition_by`` in ascending ``order_by``, nulls first.

    ``key_source`` is a cheaper frame with the key columns and about the same rows, for counting; where it is given,
    the rows of ``df`` are costly and are worked out once. ``hot`` takes the result of ``hot_keys`` when several calls
    share it. Without ``partition_by`` the whole table is one group and is always cut. Row numbers, lags and leads need a
    total order, as in any engine. The session needs a scratch folder when rows are cut.
    """
    keys, order = list(partition_by), list(order_by)
    source = key_source if key_source is not None else df
    if isinstance(hot, str):
        hot = hot_keys(source.select(*keys), keys, hot_rows) if keys else None
    if keys and hot is None:
        return _plain(df, keys, order, columns)
    if slices is None:
        slices = max(8, -(-2 * source.count() // max(hot_rows, 1)))
    return _sliced(landed(df, "rows") if key_source is not None else df, keys, order, columns, slices)


def _plain(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Spec]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    made = {
        "row_number": lambda c: F.row_number().over(w).cast("bigint"),
        "rank": lambda c: F.rank().over(w).cast("bigint"),
        "running_sum": lambda c: F.sum(c).over(upto),
        "first_value": lambda c: F.first(c).over(upto),
        "lag": lambda c: F.lag(c).over(w),
        "lead": lambda c: F.lead(c).over(w),
    }
    return df.select("*", *[made[s.kind](s.column).alias(name) for name, s in columns.items()])


def _same(columns: Sequence[str], prefix: str) -> Column:
    """Equality of columns and their copies, null with null."""
    test = F.lit(True)
    for k in columns:
        test = test & F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return test


def _sliced(df: DataFrame, keys: list[str], order: list[str], columns: dict[str, Spec], slices: int) -> DataFrame:
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    # The hash spreads rows of equal order; where such a value is cut does not matter.
    ranged = df.withColumn("__h", F.xxhash64(*hashed)).repartitionByRange(slices, *keys, *order, "__h").drop("__h")
    base = landed(ranged.withColumn(_SLICE, F.spark_partition_id()), "slices")
    key, at = F.struct(*keys) if keys else F.lit(0), F.struct(*order)

    # A key that goes on in the next slice is the last of one slice and the first of another.
    ends = base.groupBy(_SLICE).agg(F.min(key).alias("lo"), F.max(key).alias("hi"))
    ends = ends.select(_SLICE, F.explode(F.array_distinct(F.array("lo", "hi"))).alias("k"))
    wide = ends.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    marks = wide.select(F.lit(True).alias("__wide"), *[F.col("k")[k].alias(f"__w_{k}") for k in keys])
    rows = base.join(marks, _same(keys, "__w_")).select(*base.columns)

    aggs: list[Column] = [F.count(F.lit(1)).alias("__n"), F.min(at).alias("__first"), F.max(at).alias("__last")]
    for name, s in columns.items():
        if s.kind == "running_sum":
            aggs.append(F.sum(s.column).alias(f"__a_{name}"))
        elif s.kind in ("first_value", "lead"):
            aggs.append(F.min_by(F.struct(s.column), at).alias(f"__a_{name}"))
        elif s.kind == "lag":
            aggs.append(F.max_by(F.struct(s.column), at).alias(f"__a_{name}"))
    totals = landed(rows.groupBy(*keys, _SLICE).agg(*aggs), "totals")
    sums = [name for name, s in columns.items() if s.kind == "running_sum"]
    if sums or any(s.kind == "rank" for s in columns.values()):
        edge = totals.select(*[F.col(k).alias(f"__w_{k}") for k in [*keys, _SLICE]], "__first", "__last")
        counted = rows.join(edge, _same([*keys, _SLICE], "__w_")).groupBy(*keys, _SLICE).agg(
            F.count_if(at.eqNullSafe(F.col("__last"))).alias("__n_last"),
            *[F.sum(F.when(at.eqNullSafe(F.col("__first")), F.col(columns[x].column))).alias(f"__f_{x}") for x in sums],
        )
        copy = counted.select(*[F.col(k).alias(f"__w_{k}") for k in [*keys, _SLICE]], "__n_last", *[f"__f_{x}" for x in sums])
        totals = totals.join(copy, _same([*keys, _SLICE], "__w_")).drop(*[f"__w_{k}" for k in [*keys, _SLICE]])

    by_slice = Window.partitionBy(*keys).orderBy(_SLICE)
    before = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    with_last = Window.partitionBy(*keys, "__last")
    with_first = Window.partitionBy(*keys, "__first").orderBy(_SLICE).rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    offsets = totals.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    offsets = offsets.withColumn("__goes_on", F.lead("__first").over(by_slice).eqNullSafe(F.col("__last")))
    offsets = offsets.withColumn("__came_on", F.lag("__last").over(by_slice).eqNullSafe(F.col("__first")))
    carried: list[Column] = []
    for name, s in columns.items():
        edge = F.col(f"__a_{name}")
        if s.kind == "rank":
            # Rows before the value that a slice ends with: those before its first slice and before it in there.
            offsets = offsets.withColumn("__less", F.min(F.col("__before") + F.col("__n") - F.col("__n_last")).over(with_last))
            carried.append(F.lag("__less").over(by_slice).alias("__less_before"))
        elif s.kind == "running_sum":
            # Through the value that a slice starts with: what comes before the last such slice, and its part in there.
            so_far, here = F.sum(edge).over(before), F.col(f"__f_{name}")
            offsets = offsets.withColumn(f"__c_{name}", so_far)
            through = F.coalesce(F.col(f"__c_{name}") + here, F.col(f"__c_{name}"), here)
            offsets = offsets.withColumn(f"__t_{name}", F.last(through).over(with_first))
            carried.append(F.col(f"__c_{name}"))
            carried.append(F.lead(f"__t_{name}").over(by_slice).alias(f"__u_{name}"))
        elif s.kind == "first_value":
            start = by_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            carried.append(F.first(edge).over(start).alias(f"__c_{name}"))
        elif s.kind == "lag":
            carried.append(F.lag(edge).over(by_slice).alias(f"__c_{name}"))
        elif s.kind == "lead":
            carried.append(F.lead(edge).over(by_slice).alias(f"__c_{name}"))
    copies = [F.col(k).alias(f"__o_{k}") for k in [*keys, _SLICE]]
    offsets = landed(offsets.select(*copies, "__before", "__first", "__last", "__goes_on", "__came_on", *carried), "offsets")
    # At most two rows for each slice; Spark's own size check decides whether they are broadcast.
    joined = base.join(offsets, _same([*keys, _SLICE], "__o_"), "left").withColumn(_AT, at)

    w = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    upto = w.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    n_before, cut = F.coalesce("__before", F.lit(0)), F.col("__before").isNotNull()
    at_first = F.col("__came_on") & F.col(_AT).eqNullSafe(F.col("__first"))
    at_last = F.col("__goes_on") & F.col(_AT).eqNullSafe(F.col("__last"))
    out: list[Column] = [F.col(c) for c in df.columns]
    for name, s in columns.items():
        carry = F.col(f"__c_{name}") if s.column else None
        if s.kind == "row_number":
            made = n_before + F.row_number().over(w)
        elif s.kind == "rank":
            made = F.when(at_first, F.col("__less_before") + 1).otherwise(n_before + F.rank().over(w))
        elif s.kind == "running_sum":
            local = F.sum(s.column).over(upto)
            made = F.when(at_last, F.col(f"__u_{name}")).otherwise(F.coalesce(carry + local, local, carry))
        elif s.kind == "first_value":
            made = F.when(cut, carry[s.column]).otherwise(F.first(s.column).over(upto))
        elif s.kind == "lag":
            made = F.when(F.row_number().over(w) == 1, carry[s.column]).otherwise(F.lag(s.column).over(w))
        else:
            last = F.lead(F.lit(1)).over(w).isNull()
            made = F.when(last, carry[s.column]).otherwise(F.lead(s.column).over(w))
        out.append(made.alias(name))
    return joined.select(*out)
