"""Data-quality checks. Each returns the failing rows, so an empty frame means pass."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewright.functions.dates import dateadd, datediff, julian_to_date, year_out_of
from tidewright.functions.text import slugify_name
from tidewright.operators.joins import count_pair, missing_in
from tidewright.operators.windows import lag, landed, lead, with_window



def _fails(condition: Column) -> Column:
    """``not (condition)``; an unknown result passes."""
    return ~condition


def accepted_range(
    df: DataFrame, column: str, min_value=None, max_value=None, inclusive: bool = True
) -> DataFrame:
    """Rows outside the bounds; null passes, and so does everything when no bound is given."""
    col, tests = F.col(column), []
    if min_value is not None:
        tests.append(_fails(col >= min_value if inclusive else col > min_value))
    if max_value is not None:
        tests.append(_fails(col <= max_value if inclusive else col < max_value))
    return df.where(reduce(lambda a, b: a | b, tests) if tests else F.lit(False))


def at_least_one(df: DataFrame, column: str) -> DataFrame:
    """One row with count 0 when the column holds no value at all."""
    return df.agg(F.count(column).alias("filled")).where(F.col("filled") == 0)


def cardinality_equality(df: DataFrame, column: str, to: DataFrame, to_column: str) -> DataFrame:
    """Values whose row counts differ between two columns, each side's version tagged."""
    a = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    b = to.groupBy(F.col(to_column).alias("value")).agg(F.count(F.lit(1)).alias("num_rows"))
    tagged = a.select("*", F.lit(True).alias("in_a")).unionByName(b.select("*", F.lit(False).alias("in_a")))
    sides = tagged.groupBy("value", "num_rows").agg(
        F.max("in_a").alias("has_a"), F.min("in_a").alias("only_a")
    )
    return sides.where(F.col("has_a") == F.col("only_a")).select(
        "value", "num_rows", F.when(F.col("has_a"), "a").otherwise("b").alias("found_in")
    )


def equal_rowcount(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row with both counts and their distance; the distance is the number to judge by."""
    return count_pair(a, b).select("*", F.abs(F.col("count_a") - F.col("count_b")).alias("diff_count"))


def set_difference(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows found on one side only, tagged ``a_minus_b`` or ``b_minus_a``.

    One shuffle of both inputs; copies are merged on the map side.
    """
    cols = list(columns or a.columns)
    tagged = (
        a.select(*cols, F.lit(True).alias("__a")).unionAll(b.select(*cols, F.lit(False).alias("__a")))
    )
    sides = tagged.groupBy(*cols).agg(F.max("__a").alias("__any"), F.min("__a").alias("__all"))
    return sides.where(F.col("__any") == F.col("__all")).select(
        F.when(F.col("__any"), "a_minus_b").otherwise("b_minus_a").alias("which_diff"), *cols
    )


def equality(a: DataFrame, b: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``set_difference``; doubles do not count."""
    return set_difference(a, b, columns)


def equality_score(differences: DataFrame) -> DataFrame:
    """Number to judge by: rows that differ plus the gap between the two sides."""
    n = F.count(F.lit(1))
    a = F.count_if(F.col("which_diff") == "a_minus_b")
    b = F.count_if(F.col("which_diff") == "b_minus_a")
    return differences.agg((n + F.abs(a - b)).alias("failures"))


def expression_is_true(
    df: DataFrame, expression: str, column: str | None = None, condition: str = "1=1"
) -> DataFrame:
    """Rows under the condition for which the expression is false; an unknown result passes."""
    text = f"{column} {expression}" if column else expression
    return df.where(condition).where(_fails(F.expr(text)))


def fewer_rows_than(a: DataFrame, b: DataFrame) -> DataFrame:
    """Both counts and how far ``a`` is from having fewer rows: surplus, 1 when equal, 0 when fewer."""
    ca, cb = F.col("count_a"), F.col("count_b")
    short = F.when(ca > cb, ca - cb).when(ca == cb, F.lit(1)).otherwise(F.lit(0))
    return count_pair(a, b).select("*", short.alias("row_count_delta"))


_GAPS = {
    "not_allowed": lambda upper, nxt: upper == nxt,
    "allowed": lambda upper, nxt: upper <= nxt,
    "required": lambda upper, nxt: upper < nxt,
}


def mutually_exclusive_ranges(
    df: DataFrame,
    lower: str,
    upper: str,
    partition_by: str | None = None,
    gaps: str = "allowed",
    zero_length_range_allowed: bool = False,
    tie_break: Sequence[str] = (),
) -> DataFrame:
    """Ranges that are empty or reach into the next one of their group; a null bound fails, the last row passes."""
    if gaps not in _GAPS:
        raise ValueError(f"gaps must be one of {sorted(_GAPS)}, got {gaps!r}")
    keys = [partition_by] if partition_by else []
    rows = df.withColumn("__row", F.lit(1))
    seen = with_window(
        rows, [lower, *tie_break], keys, next_lower_bound=lead(lower), __next=lead("__row")
    ).drop("__row")
    lo, up = F.col(lower), F.col(upper)
    proper = F.coalesce(lo <= up if zero_length_range_allowed else lo < up, F.lit(False))
    clear = F.coalesce(_GAPS[gaps](up, F.col("next_lower_bound")), F.col("__next").isNull())
    return seen.where(~(proper & clear)).drop("__next")


def not_accepted_values(df: DataFrame, column: str, values: Sequence, quote: bool = True) -> DataFrame:
    """Distinct forbidden values that occur; unquoted values are SQL expressions."""
    listed = [F.lit(v) if quote else F.expr(str(v)) for v in values]
    return df.select(F.col(column).alias("value_field")).distinct().where(F.col("value_field").isin(*listed))


def not_constant(df: DataFrame, column: str) -> DataFrame:
    """One row when exactly one distinct value occurs; all-null passes."""
    seen = df.agg(F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    return seen.where(F.col("__lo") == F.col("__hi")).select(F.lit(1).cast("bigint").alias("distinct_values"))


def not_null_proportion(df: DataFrame, column: str, at_least: float, at_most: float = 1.0) -> DataFrame:
    share = F.count(column).cast("double") / F.nullif(F.count(F.lit(1)), F.lit(0))
    found = df.agg(share.alias("not_null_proportion"))
    p = F.col("not_null_proportion")
    return found.where((p < at_least) | (p > at_most))


def recency(df: DataFrame, column: str, datepart: str, interval: int, now: Column) -> DataFrame:
    """One row when the newest value is older than ``now`` minus the interval; an empty table passes."""
    limit = dateadd(datepart, -interval, now)
    newest = df.agg(F.max(column).alias("most_recent")).select("most_recent", limit.alias("threshold"))
    return newest.where(F.col("most_recent") < F.col("threshold"))


def relationships_where(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    from_condition: str = "1=1",
    to_condition: str = "1=1",
) -> DataFrame:
    """Child keys, not null and under their condition, that the conditioned parent lacks."""
    rows = child.where(from_condition).where(F.col(column).isNotNull()).select(F.col(column).alias("id"))
    return missing_in(rows, parent.where(to_condition), "id", parent_column)


def sequential_values(df: DataFrame, column: str, interval: int = 1, datepart: str | None = None) -> DataFrame:
    """Values that do not follow the one before by the interval; the first row passes.

    The order is over the whole table, so the lag runs on slices of it.
    """
    previous = f"previous_{slugify_name(column)}"
    seen = with_window(df.where(F.col(column).isNotNull()).select(column), [column], **{previous: lag(column)})
    step = dateadd(datepart, interval, F.col(previous)) if datepart else F.col(previous) + interval
    return seen.where(_fails(F.col(column) == step))


def unique_combination_of_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Key groups that occur more than once; nulls group together."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_records")).where("n_records > 1")


def unique(df: DataFrame, column: str, where: str = "1=1") -> DataFrame:
    rows = df.where(where).where(F.col(column).isNotNull())
    return unique_combination_of_columns(rows, [column])


def not_null(df: DataFrame, column: str, where: str = "1=1") -> DataFrame:
    return df.where(where).where(F.col(column).isNull())


def empty_column(df: DataFrame, column: str) -> DataFrame:
    """Rows that hold a value in a column meant to stay empty."""
    return df.where(F.col(column).isNotNull())


def accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Values outside the list with their row counts; null passes."""
    rows = df.where(_fails(F.col(column).isin(*values)))
    return rows.groupBy(F.col(column).alias("value_field")).agg(F.count(F.lit(1)).alias("n_records"))


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    return relationships_where(child, column, parent, parent_column)


def average(df: DataFrame, value: Column, date_field: str, store: Column, threshold: float) -> DataFrame:
    """Date and store groups whose average is above the threshold or null."""
    avg = F.sum(value).cast("double") / F.nullif(F.count(value), F.lit(0))
    means = df.groupBy(F.col(date_field).alias("date_"), store.alias("store")).agg(avg.alias("avg_"))
    return means.where((F.col("avg_") > threshold) | F.col("avg_").isNull())


def recent_days(df: DataFrame, day: Column, num_days: int, today: Column) -> DataFrame:
    """One row when the newest day is before today minus ``num_days``."""
    newest = df.agg(F.max(day.cast("date")).alias("latest_date"))
    return newest.where(F.col("latest_date") < F.date_sub(today, num_days))


def recent_julian_days(df: DataFrame, column: str, num_days: int, today: Column) -> DataFrame:
    return recent_days(df, julian_to_date(F.col(column)), num_days, today)


def completeness_hourly(df: DataFrame, column: str, num_days: int, now: Column) -> DataFrame:
    """Hours of the last ``num_days`` days whose following filled hour is not the very next one."""
    hours = (
        df.where(F.col(column) >= dateadd("day", -num_days, now))
        .groupBy(F.date_trunc("hour", F.col(column)).cast("timestamp_ntz").alias("hour_"))
        .agg(F.count(F.lit(1)).alias("rows_"))
    )
    seen = with_window(landed(hours, "hours"), ["hour_"], next_hour=lead("hour_"))
    gap = datediff(F.col("hour_"), F.col("next_hour"), "hour")
    return seen.withColumn("hourly_diff", gap).where("hourly_diff != 1")


def freshness(
    df: DataFrame,
    column: str,
    now: Column,
    warn_after: tuple[int, str] | None,
    error_after: tuple[int, str] | None,
    by: Sequence[str] = (),
) -> DataFrame:
    """Age of the newest row, for each group of ``by``, against warn and error ages: pass, warn or error.

    A table or group with no time at all is an error.
    """
    newest = df.groupBy(*by).agg(F.max(column).alias("max_loaded_at"))
    at = F.col("max_loaded_at")

    def late(age: tuple[int, str] | None) -> Column:
        return (at < dateadd(age[1], -age[0], now)) if age else F.lit(False)

    status = F.when(at.isNull() | late(error_after), "error").when(late(warn_after), "warn").otherwise("pass")
    return newest.select(*by, "max_loaded_at", status.alias("status"))


def missing_when(df: DataFrame, column: str, value: str, required: str) -> DataFrame:
    """Rows where ``column`` has the value but ``required`` is null."""
    return df.where((F.col(column) == value) & F.col(required).isNull())


def negative_totals(df: DataFrame, key: str, amount: Column, day: str | None = None, on=None) -> DataFrame:
    """Keys whose amounts add up to less than 0, optionally for one day."""
    rows = df.where(F.col(day) == on) if day else df
    return rows.groupBy(key).agg(F.sum(amount).alias("total_amount")).where("total_amount < 0")


def assert_equal(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows that differ; a null on either side passes."""
    return df.where(F.col(actual) != F.col(expected))


def assert_same(df: DataFrame, actual: str, expected: str) -> DataFrame:
    """Rows that differ, null counting as a value."""
    return df.where(~F.col(actual).eqNullSafe(F.col(expected)))


def not_empty_string(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) == "")


def timestamp_sanity(df: DataFrame, column: str, first_year: int = 2000, last_year: int = 2030) -> DataFrame:
    """Rows whose time is null or in a year outside the bounds."""
    return df.where(F.col(column).isNull() | year_out_of(F.col(column), first_year, last_year))


_THRESHOLD = re.compile(r"^\s*(>=|<=|!=|<>|=|>|<)\s*(-?\d+(?:\.\d+)?)\s*$")


def threshold(value: Column, expression: str | None) -> Column:
    """``value <op> number`` for texts such as ``> 0``."""
    if expression is None:
        return F.lit(False)
    m = _THRESHOLD.match(expression)
    if not m:
        raise ValueError(f"not a threshold: {expression!r}")
    op, number = m.group(1), F.lit(float(m.group(2)))
    return {
        ">": value > number, ">=": value >= number, "<": value < number, "<=": value <= number,
        "=": value == number, "!=": value != number, "<>": value != number,
    }[op]


def status(value: Column, error_if: str | None = "> 0", warn_if: str | None = "> 0", severity: str = "error") -> Column:
    """FAILED, WARNING or SUCCEEDED; severity ``warn`` turns failures into warnings."""
    failed = "WARNING" if severity == "warn" else "FAILED"
    return (
        F.when(threshold(value, error_if), failed).when(threshold(value, warn_if), "WARNING").otherwise("SUCCEEDED")
    )


def verdict(
    failing: DataFrame,
    name: str,
    error_if: str | None = "> 0",
    warn_if: str | None = "> 0",
    severity: str = "error",
    scalar: str | None = None,
) -> DataFrame:
    """One row: check, number and status. The number is the row count, or a column of a one-row result."""
    number = F.coalesce(F.max(F.col(scalar)), F.lit(0)).cast("bigint") if scalar else F.count(F.lit(1))
    counted = failing.agg(number.alias("failing_rows"))
    return counted.select(
        F.lit(name).alias("check_name"),
        "failing_rows",
        status(F.col("failing_rows"), error_if, warn_if, severity).alias("status"),
    )


def loaded_vs_expected(df: DataFrame, expected: int) -> DataFrame:
    """One row when the number of loaded rows is not the expected one."""
    return df.agg(F.count(F.lit(1)).alias("loaded_rows")).select(
        "loaded_rows", F.lit(expected).cast("bigint").alias("expected_rows")
    ).where("loaded_rows != expected_rows")


@dataclass(frozen=True)
class RowCheck:
    """A condition that marks a bad row of a table."""

    table: str
    name: str
    bad: Column
    error_if: str = "> 0"
    warn_if: str = "> 0"
    severity: str = "error"


@dataclass(frozen=True)
class CheckPlan:
    """Checks over several tables."""

    rows: list[RowCheck] = field(default_factory=list)
    duplicates: list[tuple[str, Sequence[str]]] = field(default_factory=list)


def run_checks(tables: dict[str, DataFrame], plan: CheckPlan) -> DataFrame:
    """Verdicts of all checks: one pass per table for the row checks, one grouping per duplicate check."""
    out: list[DataFrame] = []
    for table in dict.fromkeys(c.table for c in plan.rows):
        checks = [c for c in plan.rows if c.table == table]
        counted = tables[table].agg(*[F.count_if(c.bad).alias(f"n{i}") for i, c in enumerate(checks)])
        rows = F.array(
            *[
                F.struct(
                    F.lit(c.name).alias("check_name"),
                    F.col(f"n{i}").alias("failing_rows"),
                    status(F.col(f"n{i}"), c.error_if, c.warn_if, c.severity).alias("status"),
                )
                for i, c in enumerate(checks)
            ]
        )
        out.append(counted.select(F.lit(table).alias("table_name"), F.inline(rows)))
    for table, columns in plan.duplicates:
        name = f"duplicates:{','.join(columns)}"
        found = verdict(unique_combination_of_columns(tables[table], columns), name)
        out.append(found.select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, out)
