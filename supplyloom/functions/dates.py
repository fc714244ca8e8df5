"""Fiscal calendar, ``yyyyMM00`` periods and working days, as plain column expressions.

The fiscal year runs from October to September and carries the number of the year it ends in. Working
days are Monday to Friday, less the optional ``holidays``. Both are our documented reading: the source
system only calls these functions, their bodies are not published with it.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONDAY = date(1970, 1, 5)


def _day(value: Column | date | datetime | str) -> Column:
    return (value if isinstance(value, Column) else F.lit(value)).cast("date")


def fiscal_year(d: Column) -> Column:
    """Fiscal year as text; NULL for NULL."""
    return (F.year(d) + F.when(F.month(d) >= 10, 1).otherwise(0)).cast("string")


def fiscal_year_number(d: date) -> int:
    return d.year + (d.month >= 10)


def fiscal_year_span(d: date) -> tuple[date, date]:
    """First day of the fiscal year of ``d`` and first day of the next one."""
    year = fiscal_year_number(d)
    return date(year - 1, 10, 1), date(year, 10, 1)


def fiscal_month(d: Column) -> Column:
    """Two characters, October is ``01``."""
    return F.lpad((F.pmod(F.month(d) + 2, F.lit(12)) + 1).cast("string"), 2, "0")


def month_name(d: Column) -> Column:
    return F.date_format(d, "MMM")


def fiscal_label(d: Column) -> Column:
    """``FY18 - 01 - Oct``; NULL for NULL."""
    return F.concat(
        F.lit("FY"), F.right(fiscal_year(d), F.lit(2)), F.lit(" - "), fiscal_month(d), F.lit(" - "), month_name(d)
    )


def year_month(d: Column) -> Column:
    """``yyyy-MM``, and a bare ``-`` for NULL."""
    return F.concat(F.coalesce(F.date_format(d, "yyyy"), F.lit("")), F.lit("-"), F.coalesce(F.date_format(d, "MM"), F.lit("")))


def period_of(d: Column) -> Column:
    """``yyyyMM00``."""
    return F.concat(F.date_format(d, "yyyyMM"), F.lit("00"))


def fiscal_year_of_period(period: Column) -> Column:
    """Fiscal year of ``yyyyMM00`` as text; NULL where the first six characters are no year and month."""
    known = period.rlike("^[0-9]{4}(0[1-9]|1[0-2])")
    month = F.when(known, F.substring(period, 5, 2).cast("int"))
    return (F.when(known, F.left(period, F.lit(4)).cast("int")) + F.when(month >= 10, 1).otherwise(0)).cast("string")


def valid_at(period: Column, valid_from: Column, valid_to: Column) -> Column:
    """``period`` lies within the bounds; a NULL bound is open."""
    return (valid_from.isNull() | (period >= valid_from)) & (valid_to.isNull() | (period <= valid_to))


def is_valid_period(valid_from: Column, valid_to: Column, d: Column) -> Column:
    """1 when the day lies between the first month and the last day of the last month, else 0."""
    day = F.date_format(d, "yyyyMMdd")
    last = F.concat(F.left(valid_to, F.lit(6)), F.lit("31"))
    return F.when(valid_at(day, valid_from, last), 1).otherwise(0)


def previous_periods(as_of: date, n: int = 1) -> list[str]:
    """The ``n`` months before ``as_of``, oldest first."""
    if n < 0:
        raise ValueError("number of periods must not be negative")
    months = [as_of.year * 12 + as_of.month - 1 - back for back in range(n, 0, -1)]
    return [f"{m // 12:04d}{m % 12 + 1:02d}00" for m in months]


def periods(spark: SparkSession, as_of: date, n: int = 1) -> DataFrame:
    """The same list as a one-column frame."""
    previous_periods(as_of, n)
    months_back = F.explode(F.sequence(F.lit(1), F.lit(n))) if n else F.explode(F.array().cast("array<int>"))
    return spark.range(1).select(months_back.alias("back")).select(
        period_of(F.add_months(F.lit(as_of), -F.col("back"))).alias("period")
    )


def in_periods(d: Column, wanted: Sequence[str]) -> Column:
    """``d`` falls in one of the periods. The plain range in front is what reaches the file scan."""
    if not wanted:
        return F.lit(False)
    low, high = min(wanted), max(wanted)
    start = date(int(low[:4]), int(low[4:6]), 1)
    months = int(high[:4]) * 12 + int(high[4:6])
    end = date(months // 12, months % 12 + 1, 1)
    span = (d >= F.lit(start)) & (d < F.lit(end))
    contiguous = len(set(wanted)) == months - (start.year * 12 + start.month) + 1
    return span if contiguous else span & period_of(d).isin(*wanted)


def _workday_number(d: Column) -> Column:
    """Working days from the base Monday up to and including ``d``."""
    n = F.datediff(d, F.lit(MONDAY))
    return (F.floor(n / 7) * 5 + F.least(F.pmod(n, F.lit(7)) + 1, F.lit(5))).cast("int")


def _workday_date(number: Column) -> Column:
    t = number - 1
    return F.date_add(F.lit(MONDAY), (F.floor(t / 5) * 7 + F.pmod(t, F.lit(5))).cast("int"))


def _weekday_holidays(holidays: Sequence[date]) -> list[date]:
    return sorted({h for h in holidays if h.weekday() < 5})


def workdays_between(
    start: Column | date | str, end: Column | date | str, inclusive_start: bool = False, holidays: Sequence[date] = ()
) -> Column:
    """Working days in ``(start, end]``, or in ``[start, end]``; NULL when a side is NULL."""
    a, b = _day(start), _day(end)
    if inclusive_start:
        a = F.date_sub(a, 1)
    days = _workday_number(b) - _workday_number(a)
    off = _weekday_holidays(holidays)
    if off:
        listed = F.array(*[F.lit(h) for h in off])
        # with the dates in reverse order the count is negative, as the plain difference is
        forward = F.size(F.filter(listed, lambda h: (h > a) & (h <= b)))
        backward = F.size(F.filter(listed, lambda h: (h > b) & (h <= a)))
        days = days - forward + backward
    return days


def add_workdays(n: int | Column, start: Column | date | str, holidays: Sequence[date] = ()) -> Column:
    """The day ``n`` working days after ``start``."""
    steps = n if isinstance(n, Column) else F.lit(n)
    due = _workday_date(_workday_number(_day(start)) + steps)
    off = _weekday_holidays(holidays)
    if off:
        # each holiday met on the way, in date order, moves the due day by one working day
        due = F.aggregate(
            F.array(*[F.lit(h) for h in off]),
            due,
            lambda d, h: F.when((h > _day(start)) & (h <= d), _workday_date(_workday_number(d) + 1)).otherwise(d),
        )
    return due
