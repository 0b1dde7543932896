"""Percent-complete revenue, over and under billing, backlog, schedules, contracts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions import blank0, divide, fiscal_year, month_diff
from tidewheel.operators.reshape import classified, explode_months


def earned_revenue(rows: DataFrame, job: str, month: str, actual: str, forecast: str, change: str, contract: str) -> DataFrame:
    """Adds earned (cumulative) and earned_month.

    earned = cumulative actual / cumulative forecast (rounded to cents; 0 is blank), at most 1, times the
    contract plus cumulative change orders; blank without a contract. earned_month is the difference
    to the month before; a blank one counts as 0 there, and a blank month stays blank.
    """
    w = Window.partitionBy(job).orderBy(month)
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    total = lambda c: F.sum(blank0(c)).over(upto)
    base = F.round(total(forecast), 2)
    share = divide(total(actual), base)
    share = F.when(share.isNotNull(), F.least(share, F.lit(1.0)))  # least() alone would skip a blank
    value = share * (F.col(contract) + total(change)).cast("double")
    out = rows.withColumn("earned", value)
    return out.withColumn("earned_month", F.when(F.col("earned").isNotNull(), F.col("earned") - blank0(F.lag("earned").over(w))))


def earned_uncapped(rows: DataFrame, job: str, actual: str, forecast: str, contract: str) -> DataFrame:
    """Per job: share (rounded to four places, not capped), earned and complete (the share capped at 1)."""
    out = rows.groupBy(job).agg(F.sum(actual).alias("actual"), F.sum(forecast).alias("forecast"), F.max(contract).alias("contract"))
    share = F.round(divide("actual", "forecast").cast("decimal(28,10)"), 4)
    return out.withColumns({"share": share, "earned": F.col("contract") * share, "complete": F.when(share.isNotNull(), F.least(share, F.lit(1)))})


def billing_position(rows: DataFrame, job: str, month: str, billed: str, earned: str) -> DataFrame:
    """Adds cumulative over_under (billed less earned) and is_under."""
    upto = Window.partitionBy(job).orderBy(month).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("over_under", F.sum(blank0(billed)).over(upto) - F.sum(blank0(earned)).over(upto))
    return out.withColumn("is_under", F.col("over_under") < 0)


def recognised(rows: DataFrame, start: str, end: str, value: str, as_of: dt.date) -> DataFrame:
    """Adds months (of the term), elapsed (of these, up to as_of) and recognised, the value's even share of them."""
    months = month_diff(start, end) + 1
    elapsed = F.least(F.greatest(month_diff(start, F.lit(as_of)) + 1, F.lit(0)), months)
    return rows.withColumns({"months": months, "elapsed": elapsed, "recognised": F.col(value) / months * elapsed})


def straight_line(rows: DataFrame, keys: list[str], date: str, amount: str) -> DataFrame:
    """The total of each key spread evenly over the months from its first to its last date."""
    total = rows.groupBy(*keys).agg(F.sum(amount).alias("total"), F.min(F.to_date(date)).alias("first"), F.max(F.to_date(date)).alias("last"))
    spread = explode_months(total, "first", "last")
    return spread.select(*keys, "month_end", (F.col("total").cast("double") / (month_diff("first", "last") + 1)).alias("amount"))


def backlog(rows: DataFrame, contract: str, revenue: str, cost: str, estimate: str, end: str, as_of: dt.date, short: float = 1.25, near: int = 2) -> DataFrame:
    """Adds backlog (contract less revenue), backlog_gp, months_left and burn, the backlog of a month.

    A backlog of at most `short` average months, or an end at most `near` months off, burns at once; a
    finished or negative one not at all.
    """
    left = blank0(contract) - blank0(revenue)
    cost_left = F.greatest(blank0(estimate) - blank0(cost), F.lit(0))
    months = month_diff(F.lit(as_of), end)
    out = rows.withColumns({"backlog": left, "backlog_gp": left - cost_left, "months_left": months})
    even = divide("backlog", "months_left")
    rules = [((F.col("backlog") <= 0), F.lit(0.0)), (F.col("months_left").isNull() | (F.col("months_left") <= near), F.col("backlog").cast("double")), (F.col("backlog") <= even * short, F.col("backlog").cast("double"))]
    burn: Column | None = None
    for condition, value in rules:
        burn = F.when(condition, value) if burn is None else burn.when(condition, value)
    return out.withColumn("burn", burn.otherwise(even))


def contract_years(rows: DataFrame, contract: str, year: str, end: str, as_of: dt.date) -> DataFrame:
    """Adds latest_year, is_latest, is_active (ends today or later) and status of a contract's years."""
    w = Window.partitionBy(contract)
    out = rows.withColumn("latest_year", F.max(year).over(w)).withColumns({"is_latest": F.col(year) == F.max(year).over(w), "is_active": F.coalesce(F.to_date(end) >= F.lit(as_of), F.lit(False))})
    bands = [(F.col("is_latest") & F.col("is_active"), "Current"), (F.col("is_active"), "Active Prior"), (F.col("is_latest"), "Expired")]
    return out.withColumn("status", classified(F.col(year), bands, "Historical"))


def current_of_group(rows: DataFrame, keys: list[str], by: str, name: str = "is_current") -> DataFrame:
    """Marks the rows whose `by` is their group's largest; ties are all marked."""
    return rows.withColumn(name, F.col(by) == F.max(by).over(Window.partitionBy(*keys)))


def run_rate(rows: DataFrame, estimate: str, actual: str, elapsed: str, total: str) -> DataFrame:
    """Adds remaining (estimate less actual), rate (actual per elapsed month) and projected over the months left."""
    rate = divide(actual, elapsed)
    left = F.greatest(F.col(total) - F.col(elapsed), F.lit(0))
    return rows.withColumns({"remaining": blank0(estimate) - blank0(actual), "rate": rate, "projected": rate * left})


def years_to_date(rows: DataFrame, axes: list[str], date: str, fiscal: int, last: dt.date, values: dict[str, Column]) -> DataFrame:
    """Per axes, each of values (aggregated by sum) in the fiscal year, and with suffix _ly in the one before up to, but
    not on, the day of last in it. last's day in a year without it (29 February) is 1 March."""
    # the day falls in the calendar year before where last does so in its own fiscal year
    year = fiscal - 1 - (last.year == fiscal - 1)
    cut = dt.date(year, last.month, 1) + dt.timedelta(days=last.day - 1)
    d = F.to_date(date)
    now, before = fiscal_year(d) == fiscal, (fiscal_year(d) == fiscal - 1) & (d < F.lit(cut))
    sums = [F.sum(F.when(on, v)).alias(n + end) for n, v in values.items() for on, end in ((now, ""), (before, "_ly"))]
    return rows.filter(now | before).groupBy(*axes).agg(*sums)


def billings_forward(kind: str, closed: str, billing: str, amount: str) -> Column:
    """The amounts billed forward on open repairs."""
    return F.sum(F.when(F.col(closed).isNull() & (F.upper(kind) == "REPAIR") & (F.upper(billing) == "BILLINGS FORWARD"), F.col(amount)))


def service_calls(rows: DataFrame, axes: list[str], kind: str, opened: str, closed: str, billed: str, as_of: dt.date, late_pm: int = 60, late_open: int = 7) -> DataFrame:
    """Per axes: calls, open ones, late maintenance, late open, days open on average (negative ones blank), not billed."""
    now = F.lit(as_of)
    is_open = F.col(closed).isNull()
    days = F.datediff(F.coalesce(F.to_date(closed), now), F.to_date(opened))
    n = lambda c: F.sum(c.cast("long"))
    return rows.groupBy(*axes).agg(
        F.count("*").alias("calls"),
        n(is_open).alias("open_calls"),
        n(is_open & (F.lower(kind) == "pm") & (days > late_pm)).alias("late_pm"),
        n(is_open & (F.lower(kind) != "pm") & (days > late_open)).alias("late_open"),
        F.avg(F.when(days >= 0, days)).alias("days_open"),
        n(blank0(billed) == 0).alias("not_billed"),
    )
