"""The fiscal calendar: one row per day, with periods, labels, offsets and completion flags as of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates as D


def days(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row (date) per day from start to end."""
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))


def fiscal_calendar(spark: SparkSession, start: dt.date, end: dt.date, as_of: dt.date, fy_end: int = D.FISCAL_END, compat: bool = False) -> DataFrame:
    """The calendar from start to end. compat: fiscal year starts as fiscal_start_by_calendar_year() gives them,
    and weeks that begin on Tuesday."""
    d = F.col("date")
    now = F.lit(as_of)
    fy, fm, fq = D.fiscal_year(d, fy_end), D.fiscal_month(d, fy_end), D.fiscal_quarter(d, fy_end)
    first = D.fiscal_start_by_calendar_year(d, fy_end) if compat else D.fiscal_start(d, fy_end)
    week = D.week_start(d, 1 if compat else 0)
    this_month = F.trunc(now, "month")
    quarter_start = F.add_months(F.trunc(d, "month"), -(F.pmod(fm - 1, F.lit(3))))
    now_fm = D.fiscal_month(now, fy_end)
    now_quarter = F.add_months(this_month, -(F.pmod(now_fm - 1, F.lit(3))))
    return days(spark, start, end).select(
        d,
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.trunc(d, "month").alias("month_start"),
        F.last_day(d).alias("month_end"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_format(d, "MMM yyyy").alias("month_label"),
        F.dayofweek(d).alias("day_of_week"),
        D.week_number(d).alias("week"),
        week.alias("week_start"),
        F.date_add(week, 6).alias("week_end"),
        fy.alias("fiscal_year"),
        fm.alias("fiscal_month"),
        fq.alias("fiscal_quarter"),
        first.alias("fiscal_start"),
        F.date_sub(F.add_months(first, 12), 1).alias("fiscal_end"),
        quarter_start.alias("fiscal_quarter_start"),
        F.last_day(F.add_months(quarter_start, 2)).alias("fiscal_quarter_end"),
        (F.datediff(d, first) + 1).alias("fiscal_day"),
        (F.floor(F.datediff(d, first) / 7) + 1).cast("int").alias("fiscal_week"),
        F.concat(F.lit("FY"), fy.cast("string")).alias("fy_label"),
        F.concat(F.lit("FQ"), fq.cast("string")).alias("fq_label"),
        F.concat(F.lit("FM"), F.lpad(fm.cast("string"), 2, "0")).alias("fm_label"),
        (fy - D.fiscal_year(now, fy_end)).alias("fy_offset"),
        D.month_diff(now, d).alias("month_offset"),
        (D.month_diff(F.lit(start), d) + 1).alias("month_index"),
        (F.last_day(d) < this_month).alias("completed_month"),
        (F.last_day(F.add_months(quarter_start, 2)) < now_quarter).alias("completed_quarter"),
        (F.trunc(d, "month") == this_month).alias("current_month"),
        (F.trunc(d, "month") == F.add_months(this_month, -1)).alias("previous_month"),
        (fy == D.fiscal_year(now, fy_end)).alias("current_fy"),
        (fy == D.fiscal_year(now, fy_end) - 1).alias("previous_fy"),
        (week == D.week_start(now, 1 if compat else 0)).alias("current_week"),
    )

