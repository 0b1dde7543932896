"""Blank semantics, dates, text: every rule on small rows."""

import datetime as dt

from pyspark.sql import functions as F

from tidewheel import functions as T
from tidewheel.functions import dates, semantics, text
from tidewheel.functions.calendar import fiscal_calendar


def one(spark, *cols):
    return list(spark.range(1).select(*[c.alias(f"c{k}") for k, c in enumerate(cols)]).first())


def lit(x, kind="double"):
    return F.lit(x).cast(kind)


def test_blanks(spark):
    n, z, x = lit(None), lit(0), lit(5)
    assert one(spark, T.is_zero(n), T.plus(x, n), T.plus(n, n), T.minus(n, x), T.times(x, n), T.divide(x, z), T.divide(x, n), T.divide(x, z, 0), T.divide(x, lit(2))) == [True, 5, None, -5, None, None, None, 0, 2.5]
    assert one(spark, T.least0(n, x), T.greatest0(n, lit(-1)), T.blank0(n)) == [0, 0, 0]
    assert one(spark, T.ci_eq(F.lit("Open"), "OPEN"), T.ci_eq(F.lit("a"), F.lit("A"))) == [True, True]


def test_double_rounding(spark):
    got = one(spark, *(semantics.round_twice(lit(v)) for v in (0.3149, 0.3144, None)))
    assert [None if v is None else float(v) for v in got] == [0.32, 0.31, None]


def test_months(spark):
    d = lambda s: F.lit(dt.date.fromisoformat(s))
    assert one(spark, T.month_diff(d("2025-01-31"), d("2025-02-01")), T.month_diff(d("2025-03-01"), d("2024-12-31"))) == [1, -3]
    assert one(spark, T.month_end(d("2024-02-10")), T.shift_month_end(d("2025-02-28"), -12), T.month_end(d("2024-01-31"), 1)) == [dt.date(2024, 2, 29)] * 3
    assert one(spark, *(T.ledger_month_end(F.lit(2025), F.lit(p)) for p in (1, 3, 4, 12))) == [dt.date(2024, 10, 31), dt.date(2024, 12, 31), dt.date(2025, 1, 31), dt.date(2025, 9, 30)]
    assert one(spark, *(T.week_number(d(s)) for s in ("2025-01-01", "2025-01-04", "2025-01-05", "2023-01-01", "2023-01-08"))) == [1, 1, 2, 1, 2]
    fiscal = [f(d(s)) for s in ("2025-09-30", "2025-10-01") for f in (T.fiscal_year, T.fiscal_month, T.fiscal_quarter)]
    assert one(spark, *fiscal) == [2025, 12, 4, 2026, 1, 1]
    assert one(spark, dates.fiscal_start(d("2025-11-15")), dates.fiscal_start_by_calendar_year(d("2025-11-15"))) == [dt.date(2025, 10, 1), dt.date(2024, 10, 1)]


def test_text(spark):
    assert one(spark, T.proper(F.lit("o'neil-SMITH & co2x")), T.trim_all(F.lit(" \t a b\r\n ")), T.first_filled(F.lit(""), F.lit(None).cast("string"), F.lit("x"))) == ["O'Neil-Smith & Co2X", "a b", "x"]
    assert T.proper_names(["JOB_NUMBER", "fiscalYear", "a"]) == ["Job Number", "Fiscal Year", "A"]
    day = F.lit(dt.date(2025, 3, 7))
    got = one(spark, *(T.fmt(lit(1234567.891), p) for p in ("#,0", "$#,0", "0.0", "0")), T.fmt(lit(0.12345), "0.0%"), T.fmt(lit(-5), "$#,0.00"), *(T.fmt(day, p) for p in ("MMM yyyy", "dd-MMM-yyyy", "MMM d, yyyy")), T.fmt(lit(None), "#,0"))
    assert got == ["1,234,568", "$1,234,568", "1234567.9", "1234568", "12.3%", "-$5.00", "Mar 2025", "07-Mar-2025", "Mar 7, 2025", None]
    signs = [text.fmt_by_sign(lit(v), p) for p in ("$#,0;($#,0);0", "0.0") for v in (5, -5, 0, None)]
    assert one(spark, *signs) == ["$5", "($5)", "0", None, "5.0", "-5.0", "0.0", None]
    assert text.described(spark.range(1), {"id": "0"}).schema["id"].metadata == {"format": "0"}
    assert one(spark, text.trend(lit(0.05)), text.trend(lit(-0.5)), text.trend(lit(0)), text.percent_encoded(F.lit('<a b="#1%">'))) == ["▲\u20075.0%", "▼\u200750.0%", "▬\u20070.0%", "%3Ca b=%22%231%25%22%3E"]
    assert one(spark, T.try_value(F.lit("x"), "int"), T.try_value(F.lit("7"), "int"), T.strip_prefix_word(F.lit("the Big"), "THE")) == [None, 7, "Big"]


def test_calendar_flags(spark):
    c = fiscal_calendar(spark, dt.date(2025, 9, 1), dt.date(2026, 3, 31), dt.date(2026, 1, 14))
    rows = {r.date: r for r in c.collect()}
    assert rows[dt.date(2025, 12, 31)].completed_month and not rows[dt.date(2026, 1, 1)].completed_month
    assert rows[dt.date(2025, 12, 31)].completed_quarter and rows[dt.date(2025, 12, 31)].previous_month
    r = rows[dt.date(2025, 11, 15)]
    assert (r.fiscal_year, r.fiscal_start, r.fiscal_end, r.fiscal_quarter_start, r.fiscal_quarter_end, r.fiscal_day, r.fiscal_week, r.fy_offset, r.month_offset) == (2026, dt.date(2025, 10, 1), dt.date(2026, 9, 30), dt.date(2025, 10, 1), dt.date(2025, 12, 31), 46, 7, 0, -2)
    assert rows[dt.date(2026, 1, 12)].current_week and not rows[dt.date(2026, 1, 11)].current_week and rows[dt.date(2026, 1, 12)].week_start == dt.date(2026, 1, 12)
    odd = fiscal_calendar(spark, dt.date(2025, 11, 15), dt.date(2025, 11, 15), dt.date(2026, 1, 14), compat=True).first()
    assert odd.fiscal_start == dt.date(2024, 10, 1) and odd.week_start.weekday() == 1
