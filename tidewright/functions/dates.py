"""Date and time functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the Julian day key.
JULIAN_OFFSET = 2415020
JULIAN_BASE = "1920-01-01"

# Fixed value: day 0 of spreadsheet serial dates.
SHEET_EPOCH = "1899-12-30"

_MICROS = {"hour": 3_600_000_000, "minute": 60_000_000, "second": 1_000_000, "millisecond": 1_000, "microsecond": 1}


def micros(ts: Column) -> Column:
    """Microseconds since 1970 on the wall clock of the value, whatever the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts.cast("timestamp_ntz"))


def now_utc() -> Column:
    return F.current_timestamp()


def date_trunc(part: str, ts: Column) -> Column:
    return F.date_trunc(part, ts)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def dateadd(part: str, n: Column | int, ts: Column) -> Column:
    """``n`` units later; months keep the day where it exists."""
    return F.timestamp_add(part.upper(), n if isinstance(n, Column) else F.lit(n), ts)


def datediff(first: Column, second: Column, part: str) -> Column:
    """Number of ``part`` boundaries between two times; weeks start on Sunday."""
    part = part.lower()
    if part == "year":
        return (F.year(second) - F.year(first)).cast("bigint")
    if part in ("quarter", "month"):
        per_year, of = (4, F.quarter) if part == "quarter" else (12, F.month)
        return ((F.year(second) - F.year(first)) * per_year + of(second) - of(first)).cast("bigint")
    if part == "day":
        return F.datediff(second, first).cast("bigint")
    if part == "week":
        # 1970-01-01 is a Thursday, four days after a Sunday.
        def week(d: Column) -> Column:
            return F.floor((F.unix_date(F.to_date(d)) + 4) / 7)

        return (week(second) - week(first)).cast("bigint")
    if part in _MICROS:
        unit = _MICROS[part]
        if unit == 1:
            return micros(second) - micros(first)

        def index(ts: Column) -> Column:
            m = micros(ts)
            return (m - F.pmod(m, F.lit(unit))) / unit

        return (index(second) - index(first)).cast("bigint")
    raise ValueError(f"unsupported date part {part!r}")


def last_day(day: Column, part: str) -> Column:
    """Last day of the month, quarter or year."""
    part = part.lower()
    if part == "month":
        return F.last_day(day)
    if part == "quarter":
        return F.date_sub(F.add_months(F.trunc(day, "quarter"), 3), 1)
    if part == "year":
        return F.date_sub(F.add_months(F.trunc(day, "year"), 12), 1)
    raise ValueError(f"unsupported date part {part!r}")


def epoch_seconds(ts: Column) -> Column:
    m = micros(ts)
    return ((m - F.pmod(m, F.lit(1_000_000))) / 1_000_000).cast("bigint")


def parse_timestamp(text: Column) -> Column:
    """Timestamp without zone, or null when the text is not one."""
    return text.try_cast("timestamp_ntz")


def julian_to_date(day_key: Column, base: str = JULIAN_BASE) -> Column:
    return F.date_add(F.lit(base).cast("date"), (day_key - JULIAN_OFFSET).cast("int"))


def date_to_julian(day: Column, base: str = JULIAN_BASE) -> Column:
    return F.datediff(day, F.lit(base).cast("date")) + JULIAN_OFFSET


def weekday_name(day: Column) -> Column:
    return F.date_format(day, "EEEE")


def serial_to_timestamp(serial: Column) -> Column:
    """Spreadsheet serial (days since 1899-12-30) as a timestamp without zone."""
    seconds = F.rint(serial * 86400).cast("bigint")
    return F.timestamp_add("SECOND", seconds, F.lit(SHEET_EPOCH).cast("timestamp_ntz"))


def serial_to_date(serial: Column) -> Column:
    return F.to_date(serial_to_timestamp(serial))


def year_out_of(ts: Column, first: int, last: int) -> Column:
    return (F.year(ts) < first) | (F.year(ts) > last)
