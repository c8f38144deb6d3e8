"""Audit and reconciliation of two tables. Every comparison groups; none emits pairs of rows."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.dates import micros
from tidewright.functions.keys import fingerprint
from tidewright.functions.numbers import percent_of
from tidewright.operators.joins import count_pair
from tidewright.operators.reshape import filtered_columns
from tidewright.sources.schemas import wider

# Match classes in their order. The third and the last hold a zero-width joiner before the words.
MATCH_CLASSES = [
    "✅: perfect match",
    "✅: both are null",
    "🤷: ‍missing from a",
    "🤷: missing from b",
    "🤷: value is null in a only",
    "🤷: value is null in b only",
    "🙅: ‍values do not match",
]


def compare_queries(a: DataFrame, b: DataFrame) -> DataFrame:
    """How many distinct rows are in both frames, in the first and in the second only, with their share."""
    tagged = a.select("*", F.lit(True).alias("__a")).unionAll(
        b.select(*a.columns).select("*", F.lit(False).alias("__a"))
    )
    sides = tagged.groupBy(*a.columns).agg(
        F.max("__a").alias("in_a"), F.max(~F.col("__a")).alias("in_b")
    )
    # Rows of one class share one key, so they are counted on the map side.
    counts = sides.groupBy("in_a", "in_b").agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("*", percent_of(F.col("count"), total).alias("percent_of_total"))


def compare_relations(a: DataFrame, b: DataFrame, exclude_columns: Sequence[str] = ()) -> DataFrame:
    """``compare_queries`` on the first frame's columns less the excluded ones."""
    cols = filtered_columns(a, exclude_columns)
    return compare_queries(a.select(*cols), b.select(*cols))


def compare_column_values(a: DataFrame, b: DataFrame, primary_key: str, column: str) -> DataFrame:
    """Match classes of one column over the full join on the key, with counts and shares.

    The counts of the joined pairs follow from the counts per key and value, so a key that repeats on both
    sides costs no pairs. A missing row's null value meets the other side's null as "both are null".
    """
    parts = []
    for df, side in ((a, "a"), (b, "b")):
        parts.append(
            df.select(
                F.col(primary_key).alias("k"),
                F.col(column).alias("v"),
                F.lit(int(side == "a")).cast("bigint").alias("na"),
                F.lit(int(side == "b")).cast("bigint").alias("nb"),
                # Null keys match nothing, so each side keeps its own.
                F.when(F.col(primary_key).isNull(), F.lit(side)).alias("side"),
            )
        )
    per_value = parts[0].unionByName(parts[1]).groupBy("k", "side", "v").agg(
        F.sum("na").alias("na"), F.sum("nb").alias("nb")
    )
    null = F.col("v").isNull()
    zero = F.lit(0).cast("bigint")
    per_key = per_value.groupBy("k", "side").agg(
        F.sum("na").alias("na"),
        F.sum("nb").alias("nb"),
        F.sum(F.when(null, F.col("na")).otherwise(zero)).alias("na0"),
        F.sum(F.when(null, F.col("nb")).otherwise(zero)).alias("nb0"),
        F.sum(F.when(~null, F.col("na") * F.col("nb")).otherwise(zero)).alias("same"),
    )
    na, nb, na0, nb0 = (F.col(c) for c in ("na", "nb", "na0", "nb0"))
    both = (na > 0) & (nb > 0)
    counts = [
        F.when(both, F.col("same")).otherwise(zero),
        F.when(both, na0 * nb0).otherwise(na0 + nb0),
        F.when(na == 0, nb - nb0).otherwise(zero),
        F.when(nb == 0, na - na0).otherwise(zero),
        F.when(both, na0 * (nb - nb0)).otherwise(zero),
        F.when(both, (na - na0) * nb0).otherwise(zero),
        F.when(both, (na - na0) * (nb - nb0) - F.col("same")).otherwise(zero),
    ]
    sums = per_key.agg(*[F.sum(c).alias(f"c{i}") for i, c in enumerate(counts)])
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("match_order"), F.lit(name).alias("match_status"), F.col(f"c{i}").alias("count_records")
            )
            for i, name in enumerate(MATCH_CLASSES)
        ]
    )
    classes = sums.select(F.inline(rows)).where("count_records > 0")
    total = F.sum("count_records").over(Window.partitionBy())
    share = percent_of(F.col("count_records"), total).alias("percent_of_total")
    return classes.select("match_order", "match_status", "count_records", share)


def compare_relation_columns(a_columns: DataFrame, b_columns: DataFrame) -> DataFrame:
    """Position and type of every column on both sides, from two column catalogs."""
    a = a_columns.select(
        "column_name",
        F.col("ordinal_position").alias("a_ordinal_position"),
        F.col("data_type").alias("a_data_type"),
    )
    b = b_columns.select(
        "column_name",
        F.col("ordinal_position").alias("b_ordinal_position"),
        F.col("data_type").alias("b_data_type"),
    )
    no = F.lit(False)
    return a.join(b, "column_name", "full_outer").select(
        "column_name",
        "a_ordinal_position",
        "b_ordinal_position",
        "a_data_type",
        "b_data_type",
        F.coalesce(F.col("a_ordinal_position") == F.col("b_ordinal_position"), no).alias("has_ordinal_position_match"),
        F.coalesce(F.col("a_data_type") == F.col("b_data_type"), no).alias("has_data_type_match"),
    )


def row_count_parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row when the row counts differ."""
    return count_pair(a, b).where("count_a != count_b")


def schema_parity(wanted: DataFrame, actual: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Listed columns that the other table lacks or types differently, from two column catalogs."""
    have = actual.select("column_name", F.col("data_type").alias("actual_type"))
    rows = wanted.where(F.col("column_name").isin(*columns)).select("column_name", "data_type")
    return rows.join(have, "column_name", "left").where(
        F.col("actual_type").isNull() | (F.col("actual_type") != F.col("data_type"))
    )


def table_checksum(df: DataFrame, fields: Sequence[Column]) -> DataFrame:
    """Order-free checksum: XOR of row fingerprints, with the counts and a sum next to it.

    XOR alone is blind to pairs of equal rows and to rows with a null field.
    """
    fp = fingerprint(fields)
    return df.select(fp.alias("__fp")).agg(
        F.coalesce(F.bit_xor("__fp"), F.lit(0)).cast("bigint").alias("checksum"),
        F.coalesce(F.sum(F.col("__fp") % 1_000_003), F.lit(0)).cast("bigint").alias("fingerprint_sum"),
        F.count(F.lit(1)).alias("row_count"),
        F.count("__fp").alias("rows_without_null"),
    )


def content_parity(a: DataFrame, b: DataFrame, fields: Sequence[str]) -> DataFrame:
    """One row with both checksums when the listed columns' contents differ."""
    sides = []
    for df, side in ((a, "a"), (b, "b")):
        made = table_checksum(df, [F.col(c) for c in fields])
        sides.append(made.select(F.lit(side).alias("side"), F.struct(*made.columns).alias("sum")))
    both = sides[0].unionByName(sides[1]).agg(
        F.max(F.when(F.col("side") == "a", F.col("sum"))).alias("a"),
        F.max(F.when(F.col("side") == "b", F.col("sum"))).alias("b"),
    )
    return both.where(F.col("a") != F.col("b"))


def metrics(df: DataFrame, **columns: Column) -> DataFrame:
    """One row of named aggregates."""
    return df.agg(*[c.alias(name) for name, c in columns.items()])


def _plain_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.IntegralType | T.DecimalType)


def _difference(a: Column, b: Column, kind: T.DataType) -> Column:
    """``a - b`` without loss: whole numbers and decimals as decimals, days for dates, microseconds for timestamps."""
    if isinstance(kind, T.IntegralType):
        return a.cast("decimal(20,0)") - b.cast("decimal(20,0)")
    if isinstance(kind, T.NumericType):
        return a - b
    if isinstance(kind, T.DateType):
        return F.datediff(a, b).cast("bigint")
    if isinstance(kind, T.TimestampType | T.TimestampNTZType):
        return micros(a) - micros(b)
    return F.lit(None).cast("bigint")


def _one_row(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two one-row frames as the structs ``a`` and ``b`` of one row."""
    kinds = [df.select(F.struct(*df.columns).alias("s")).schema["s"].dataType for df in (a, b)]
    left = a.select(F.struct(*a.columns).alias("a"), F.lit(None).cast(kinds[1]).alias("b"))
    right = b.select(F.lit(None).cast(kinds[0]).alias("a"), F.struct(*b.columns).alias("b"))
    return left.unionAll(right).agg(F.first("a", ignorenulls=True).alias("a"), F.first("b", ignorenulls=True).alias("b"))


def reconcile_metrics(a: DataFrame, b: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Metrics of two one-row frames side by side, with a match flag; numbers may differ by the tolerance.

    The values are shown as doubles; whole numbers and decimals are compared exactly.
    """
    theirs = {f.name.lower(): f for f in b.schema.fields}
    shared = [(f, theirs[f.name.lower()]) for f in a.schema.fields if f.name.lower() in theirs]
    rows = []
    for f, g in shared:
        x, y = F.col("a").getField(f.name), F.col("b").getField(g.name)
        if _plain_number(f.dataType) and _plain_number(g.dataType):
            kind = wider(f.dataType, g.dataType)
            gap = F.abs(_difference(x.cast(kind), y.cast(kind), kind)) <= F.lit(Decimal(repr(tolerance)))
        else:
            gap = F.abs(x.cast("double") - y.cast("double")) <= tolerance
        same = x.cast("double").eqNullSafe(y.cast("double"))
        rows.append(
            F.struct(
                F.lit(f.name).alias("metric"),
                x.cast("double").alias("a_value"),
                y.cast("double").alias("b_value"),
                F.coalesce(gap, same).alias("is_match"),
            )
        )
    return _one_row(a, b).select(F.inline(F.array(*rows)))


def cursor_reconciliation(
    source: DataFrame, target: DataFrame, column: str, since: Column | None = None
) -> DataFrame:
    """Newest cursor value and row count on both sides since a stored cursor, and their drift.

    Any ordered type may be a cursor, and ``next_cursor`` keeps it (the wider one if the sides differ). ``max_drift`` is exact:
    a decimal for numbers (a double for doubles), days for dates, microseconds for timestamps, null for text.
    """
    kind = wider(source.schema[column].dataType, target.schema[column].dataType, column)

    def side(df: DataFrame, top: str, n: str) -> DataFrame:
        rows = df.where(F.col(column) > since) if since is not None else df
        return rows.agg(F.max(column).cast(kind).alias(top), F.count(F.lit(1)).alias(n))

    both = _one_row(side(source, "source_max", "source_count"), side(target, "target_max", "target_count"))
    flat = both.select("a.source_max", "b.target_max", "a.source_count", "b.target_count")
    return flat.select(
        "*",
        _difference(F.col("source_max"), F.col("target_max"), kind).alias("max_drift"),
        (F.col("source_count") - F.col("target_count")).alias("count_drift"),
        F.greatest("source_max", "target_max").alias("next_cursor"),
    )


def scalar_reconciliation(source: DataFrame, target: DataFrame) -> DataFrame:
    """Result of one query against the result of another, each a single value, compared by value.

    Numbers and times are compared in their common type, so 1.00 is 1; a text is read as the other side's type if that is
    another one. The values are shown as text.
    """
    s, t = source.schema.fields[0], target.schema.fields[0]
    both = _one_row(source.select(F.col(s.name).alias("v")), target.select(F.col(t.name).alias("v")))
    x, y = F.col("a.v"), F.col("b.v")
    if isinstance(s.dataType, T.StringType) != isinstance(t.dataType, T.StringType):
        kind = t.dataType if isinstance(s.dataType, T.StringType) else s.dataType
        kind = T.DecimalType(38, 10) if isinstance(kind, T.IntegralType) else kind
    else:
        kind = wider(s.dataType, t.dataType, "value")
    read = [v.try_cast(kind) for v in (x, y)]
    lost = (x.isNotNull() & read[0].isNull()) | (y.isNotNull() & read[1].isNull())
    return both.select(
        x.cast("string").alias("source_value"),
        y.cast("string").alias("target_value"),
        (read[0].eqNullSafe(read[1]) & ~lost).alias("is_match"),
    )
