"""Column selection, unions, pivots, deduplication and series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewright.functions.dates import dateadd, datediff
from tidewright.functions.text import blank_to_null, slugify_name


def filtered_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Column names without the excluded ones, compared in lower case."""
    drop = {c.lower() for c in exclude}
    return [c for c in df.columns if c.lower() not in drop]


def star(
    df: DataFrame, exclude: Sequence[str] = (), prefix: str = "", suffix: str = "", alias: str | None = None
) -> list[Column]:
    """All columns but the excluded ones, renamed only when a prefix or suffix is given."""
    out = []
    for c in filtered_columns(df, exclude):
        col = F.col(f"{alias}.{c}" if alias else c)
        out.append(col.alias(f"{prefix}{c}{suffix}") if prefix or suffix else col)
    return out


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Drop columns by exact name in any case."""
    return df.select(*filtered_columns(df, names))


def blanks_to_null(df: DataFrame) -> DataFrame:
    """'' to null in every string column; other columns and the order stay."""
    return df.select(
        *[
            blank_to_null(F.col(f.name)).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str = "_source_relation",
) -> DataFrame:
    """UNION ALL by name over all columns met; the first relation to bring a column sets its type and spelling.

    Names that differ in case only are one column. Missing columns are typed nulls and the relation's name comes first.
    """
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    override = {c.lower(): kind for c, kind in (column_override or {}).items()}
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    columns: dict[str, tuple[str, str]] = {}
    for df in relations.values():
        for field in df.schema.fields:
            low = field.name.lower()
            if low not in unwanted and (low in wanted or not wanted):
                columns.setdefault(low, (field.name, override.get(low, field.dataType.simpleString())))
    if not columns:
        raise ValueError(f"no columns to union for {', '.join(relations)}")
    parts = []
    for name, df in relations.items():
        have = {c.lower() for c in df.columns}
        cells = [(F.col(c) if low in have else F.lit(None)).cast(kind).alias(c) for low, (c, kind) in columns.items()]
        parts.append(df.select(F.lit(name).alias(source_column_name), *cells))
    return reduce(DataFrame.unionAll, parts)


def pivot_columns(
    column: str,
    values: Sequence[str],
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value: str | int = 1,
    else_value: str | int | None = 0,
    quote_identifiers: bool = True,
    distinct: bool = False,
    alias: bool = True,
) -> list[Column]:
    """One conditional aggregate per listed value, for use in ``groupBy(...).agg(*...)``.

    ``then_value`` and ``else_value`` are SQL expressions. Absent cells give ``else_value``, not null.
    """
    tests = {
        "=": lambda c, v: c == v,
        "!=": lambda c, v: c != v,
        "<>": lambda c, v: c != v,
        ">": lambda c, v: c > v,
        ">=": lambda c, v: c >= v,
        "<": lambda c, v: c < v,
        "<=": lambda c, v: c <= v,
    }
    then = F.expr(str(then_value))
    other = F.lit(None) if else_value is None else F.expr(str(else_value))
    out = []
    for value in values:
        cell = F.when(tests[cmp](F.col(column), F.lit(value)), then).otherwise(other)
        made = F.call_function(agg, cell) if not distinct else F.count_distinct(cell)
        if distinct and agg == "sum":
            made = F.sum_distinct(cell)
        name = f"{prefix}{value}{suffix}"
        out.append(made.alias(name if quote_identifiers else slugify_name(name)) if alias else made)
    return out


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Melt all columns but ``exclude`` (kept) and ``remove`` (dropped) in one scan; null cells stay."""
    keep = [c for name in exclude for c in df.columns if c.lower() == name.lower()]
    melted = filtered_columns(df, [*exclude, *remove])
    cast = df.select(*keep, *[F.col(c).cast("string").cast(cast_to).alias(c) for c in melted])
    return cast.unpivot(keep, melted, field_name, value_name)


def first_rows(df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of each group in the given order.

    Spark cuts each group down to ``n`` rows in every map task before the shuffle, so a group of any size is
    never gathered. The order should be total.
    """
    place = F.row_number().over(Window.partitionBy(*group_by).orderBy(*order_by))
    return df.withColumn("__place", place).where(F.col("__place") <= n).drop("__place")


def deduplicate(df: DataFrame, group_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each group in the given order."""
    return first_rows(df, group_by, order_by)


def newest(df: DataFrame, group_by: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Last row of each group in ascending ``order_by``."""
    return first_rows(df, group_by, [F.col(c).desc_nulls_last() for c in order_by])


def generate_series(spark: SparkSession, upper_bound: int) -> DataFrame:
    """1 to ``upper_bound``, spread over the default parallelism."""
    if upper_bound <= 0:
        raise ValueError("upper_bound must be positive")
    return spark.range(1, upper_bound + 1).withColumnRenamed("id", "generated_number")


def date_spine(bounds: DataFrame, datepart: str, start: str, end: str) -> DataFrame:
    """One row per ``datepart`` from ``start``: as many as part boundaries lie between ``start`` and ``end``.

    Both are columns of a one-row frame, which is read once. So ``end`` itself is left out where it starts a part, and a
    part that ``end`` only reaches into counts by its boundary: months from 1 January to 15 February give January alone.
    """
    lo, hi, n = bounds.select(start, end, datediff(F.col(start), F.col(end), datepart).alias("n")).first()
    name, kind = f"date_{datepart}", bounds.schema[start].dataType
    if lo is None or hi is None or n < 1:
        return bounds.select(F.col(start).alias(name)).limit(0)
    number = bounds.sparkSession.range(n)
    return number.select(dateadd(datepart, F.col("id").cast("int"), F.lit(lo).cast(kind)).cast(kind).alias(name))


def calendar(df: DataFrame, column: str, before: int = 0, after: int = 0, name: str = "day") -> DataFrame:
    """All days from the first to the last one in a column, and some around them.

    The two bounds are read once; the days that follow from them are few whatever the size of ``df``.
    """
    lo, hi = df.agg(F.to_date(F.min(column)), F.to_date(F.max(column))).first()
    if lo is None:
        return df.sparkSession.createDataFrame([], f"{name} date")
    first = F.date_sub(F.lit(lo), before)
    days = F.explode(F.sequence(first, F.date_add(F.lit(hi), after)))
    return df.sparkSession.range(1).select(days.alias(name))


def group_by(df: DataFrame, n: int):
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n])


def value_counts(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values by falling frequency, ties by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))
    ordered = counts.orderBy(F.desc("row_count"), "value")
    return ordered.limit(limit) if limit is not None else ordered


# Most values a column list may hold on the driver.
MAX_VALUES = 10_000


def column_values(
    df: DataFrame | None,
    column: str,
    max_records: int | None = None,
    default: Sequence[str] | None = None,
    order_by: Column | None = None,
    max_values: int | None = None,
) -> list:
    """Distinct values as a list, most frequent first or by ``order_by``; ``default`` when there is no table.

    ``order_by`` is an aggregate over the rows of a value. ``max_records`` asks for the first values only. Without it all
    values are wanted, and more than ``max_values`` (MAX_VALUES) of them are an error rather than a list cut short.
    """
    if df is None:
        if default is None:
            raise ValueError("the table does not exist and no default was given")
        return list(default)
    max_values = MAX_VALUES if max_values is None else max_values
    most = max_records or max_values + 1
    if order_by is None:
        ordered = value_counts(df, column, most)
    else:
        ordered = df.groupBy(F.col(column).alias("value")).agg(order_by.alias("__at")).orderBy("__at", "value").limit(most)
    found = [r["value"] for r in ordered.collect()]
    if max_records is None and len(found) > max_values:
        raise ValueError(f"{column} has more than {max_values} distinct values; give max_records")
    return found or list(default or [])


def add_constants(df: DataFrame, **values: object) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def listagg(
    df: DataFrame,
    group_by: Sequence[str],
    text: str,
    delimiter: str = ",",
    order_by: str | None = None,
    distinct: bool = False,
    limit: int | None = None,
    name: str = "listagg",
    max_rows: int | None = None,
) -> DataFrame:
    """Text of each group put together in order.

    With ``distinct`` the doubles go before the texts meet. With ``limit`` only the first texts of each group
    are kept, from the map side on, so a hot group never meets in full. A list is one value of one row; ``max_rows``
    makes a group of more texts an error before any list is made.
    """
    keys = list(group_by)
    if distinct:
        df, order_by = df.select(*keys, text).distinct(), text
    order_by = order_by or text
    rows = df.where(F.col(text).isNotNull()).select(*keys, F.col(order_by).alias("__at"), F.col(text).alias("__text"))
    if limit is not None:
        rows = first_rows(rows, keys, [F.col("__at"), F.col("__text")], limit)
    elif max_rows is not None:
        wide = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > max_rows).first()
        if wide is not None:
            raise ValueError(f"group {tuple(wide)[:-1]} has {wide['__n']} texts, more than {max_rows}")
    parts = F.sort_array(F.collect_list(F.struct("__at", "__text")))
    return rows.groupBy(*keys).agg(F.array_join(parts["__text"], delimiter).alias(name))
