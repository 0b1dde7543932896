"""Date expressions: month arithmetic, fiscal periods (year end in any month), week numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewheel.functions.semantics import ColumnLike, col

#: The last month of the fiscal year.
FISCAL_END = 9


def month_end(c: ColumnLike, months: int = 0) -> Column:
    """The last day of the month, `months` later."""
    d = col(c)
    return F.last_day(F.add_months(d, months) if months else d)


def shift_month_end(c: ColumnLike, months: int) -> Column:
    """A month-end some months on, snapped to its month's end (28 February goes to 29 in a leap year)."""
    return F.last_day(F.add_months(F.last_day(col(c)), months))


def month_diff(a: ColumnLike, b: ColumnLike) -> Column:
    """Month boundaries between two dates: 31 January to 1 February is 1."""
    index = lambda c: F.year(col(c)) * 12 + F.month(col(c))
    return index(b) - index(a)


def fiscal_year(c: ColumnLike, end: int = FISCAL_END) -> Column:
    return F.year(col(c)) + (F.month(col(c)) > end).cast("int")


def fiscal_month(c: ColumnLike, end: int = FISCAL_END) -> Column:
    return F.pmod(F.month(col(c)) - end - 1, F.lit(12)) + 1


def fiscal_quarter(c: ColumnLike, end: int = FISCAL_END) -> Column:
    return F.ceil(fiscal_month(c, end) / 3).cast("int")


def fiscal_start(c: ColumnLike, end: int = FISCAL_END) -> Column:
    """The first day of the fiscal year that holds the date."""
    return F.make_date(fiscal_year(c, end) - (1 if end < 12 else 0), F.lit(end % 12 + 1), F.lit(1))


def fiscal_start_by_calendar_year(c: ColumnLike, end: int = FISCAL_END) -> Column:
    """The calendar year's start moved back by the fiscal offset: a year early for dates after the fiscal
    year's end. For comparison with results that were made so."""
    return F.add_months(F.trunc(col(c), "year"), end - 12)


def ledger_month_end(year: ColumnLike, period: ColumnLike, end: int = FISCAL_END) -> Column:
    """The calendar month-end of a ledger's fiscal year and period."""
    first = F.make_date(col(year).cast("int"), F.lit(1), F.lit(1))
    return F.last_day(F.add_months(first, col(period).cast("int") - 1 - (12 - end)))


def week_number(c: ColumnLike) -> Column:
    """Week of the year; weeks begin on Sunday, the first holds 1 January."""
    first = F.trunc(col(c), "year")
    return F.floor((F.dayofyear(col(c)) - 1 + F.dayofweek(first) - 1) / 7).cast("int") + 1


def week_start(c: ColumnLike, shift: int = 0) -> Column:
    """The Monday of the date's week, `shift` days on."""
    return F.date_add(F.trunc(col(c), "week"), shift)
