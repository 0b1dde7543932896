"""Time intelligence: wrappers over any measure, anchors and running windows."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions.dates import FISCAL_END
from tidewheel.plans.context import Context
from tidewheel.plans.measure import Derived, Leaf, Measure, With
from tidewheel.plans.model import Model
from tidewheel.functions import divide, minus


def _month_end(d: dt.date) -> dt.date:
    return (d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1)


def add_months(d: dt.date, n: int) -> dt.date:
    """n months on, the day cut to the month's length."""
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    last = _month_end(dt.date(y, m + 1, 1)).day
    return dt.date(y, m + 1, min(d.day, last))


@dataclass(frozen=True)
class Clock:
    """A date column of the calendar, the date that everything is as of, and the fiscal year's last month."""

    date: str
    as_of: dt.date
    fy_end: int = FISCAL_END

    def fiscal_start(self, d: dt.date | None = None) -> dt.date:
        d = d or self.as_of
        first = self.fy_end % 12 + 1
        return dt.date(d.year - (d.month < first), first, 1)

    def between(self, start: dt.date, end: dt.date) -> str:
        return f"{self.date} >= date'{start}' AND {self.date} <= date'{end}'"

    # Calculation items: the current value and six others.
    def mtd(self, m: Measure) -> Measure:
        return With(m, set={self.date: self.between(self.as_of.replace(day=1), self.as_of)})

    def qtd(self, m: Measure) -> Measure:
        """From the start of the fiscal quarter."""
        start = self.fiscal_start()
        quarter = ((self.as_of.year - start.year) * 12 + self.as_of.month - start.month) // 3
        return With(m, set={self.date: self.between(add_months(start, 3 * quarter), self.as_of)})

    def ytd(self, m: Measure) -> Measure:
        return With(m, set={self.date: self.between(self.fiscal_start(), self.as_of)})

    def py(self, m: Measure) -> Measure:
        """The same period of the year before: dates move on by twelve months before they meet the calendar."""
        return With(m, shift=12)

    def yoy(self, m: Measure) -> Measure:
        return Derived({"now": m, "before": self.py(m)}, lambda now, before: minus(now, before))

    def yoy_pct(self, m: Measure) -> Measure:
        return Derived({"now": m, "before": self.py(m)}, lambda now, before: divide(minus(now, before), before))

    # Windows that end at an anchor.
    def r12m(self, m: Measure, anchor: dt.date, years_back: int = 0, naive: bool = False) -> Measure:
        """The twelve months that end at the anchor, or as many years before. naive: bounds moved by months but
        not snapped to month-ends, which on month-end dates takes 13 months after a leap February."""
        end, start = add_months(anchor, -12 * years_back), add_months(anchor, -12 * (years_back + 1))
        if not naive:
            end, start = _month_end(end), _month_end(start)
        return With(m, set={self.date: f"{self.date} > date'{start}' AND {self.date} <= date'{end}'"})

    def fy_as_of(self, m: Measure, last: dt.date, years_back: int = 0) -> Measure:
        """The fiscal year to date, cut at the last date with data; years_back moves both bounds."""
        end = min(self.as_of, last)
        start = self.fiscal_start(end)
        return With(m, set={self.date: self.between(add_months(start, -12 * years_back), add_months(end, -12 * years_back))})


def anchor(last: dt.date | None, selected: dt.date | None = None) -> dt.date | None:
    """The month-end that windows end at: the selected one, but not after the last with data."""
    days = [_month_end(d) for d in (last, selected) if d is not None]
    return min(days) if days else None


def last_date(rows: DataFrame, date: str, where: str | None = None) -> dt.date | None:
    """The last date with data (where a predicate holds), once per query and then a constant of its plan."""
    rows = rows.filter(where) if where else rows
    found = rows.agg(F.max(F.to_date(date))).first()[0]
    return found


def latest_of_slicers(model: Model, column: str, ctx: Context) -> object:
    """The largest value of a calendar column that the report's own filters on the calendar leave, whatever measures and axes
    filter; a constant of the plan. None if they leave nothing."""
    rows = model.tables[model.calendar]
    for f in ctx.outer().filters:
        if model.home.get(f.column) == model.calendar:
            rows = rows.filter(f.sql) if f.rows is None else rows.join(f.rows.select(F.col(f.rows.columns[0]).alias("_member")), F.col(f.column) == F.col("_member"), "left_semi")
    return rows.agg(F.max(column)).first()[0]


def leaf_sum(fact: str, expr: str, where: dict[str, str] | None = None) -> Measure:
    """A sum, gated by filters on columns."""
    return With(Leaf(fact, "sum", expr), keep=where or {}) if where else Leaf(fact, "sum", expr)


def sliding(rows: DataFrame, axes: list[str], key: str, period: str, value: str, of: dict[str, Column], length: int = 12, first: int | None = None, last: int | None = None) -> DataFrame:
    """For every period, sums over all keys of functions of a key's two windows: cy, the `length` periods that end at it, and
    py, as many before. A row for each combination of axes and each period (whole numbers) from the first with data (or
    first) to the last (or last).

    of: columns over cy and py, whose sum over keys is taken; they are 0 where both are. An amount enters cy in its own
    period, goes over to py after `length` periods and leaves after as many more, so a key has three events for each
    of its periods, whatever the number of windows. A key's functions change only at its events; the changes are added up
    by period, and running sums over periods give all windows at once. Amounts are exact decimals or whole numbers (others are
    taken to six places), so that a window that is empty again is 0. Blank amounts count as 0, rows without a period
    nowhere; a blank key is a key.
    """
    kind = dict(rows.dtypes)[value]
    exact = kind if kind.startswith("decimal") or kind in ("bigint", "int") else "decimal(28,6)"
    amount = F.coalesce(F.sum(F.col(value).cast(exact)), F.lit(0))
    monthly = rows.filter(F.col(period).isNotNull()).groupBy(*axes, key, F.col(period).cast("int").alias("_at")).agg(amount.alias("_v"))
    event = lambda n, cy, py: F.struct((F.col("_at") + n).alias("_at"), cy.alias("_cy"), py.alias("_py"))
    v, none = F.col("_v"), F.col("_v") - F.col("_v")
    events = monthly.select(*axes, key, F.inline(F.array(event(0, v, none), event(length, -v, v), event(2 * length, none, -v))))
    events = events.groupBy(*axes, key, "_at").agg(F.sum("_cy").alias("_cy"), F.sum("_py").alias("_py"))
    w = Window.partitionBy(*axes, key).orderBy("_at")  # a row for each period of a key with an event
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = events.select(*axes, key, "_at", F.sum("_cy").over(upto).alias("cy"), F.sum("_py").over(upto).alias("py"))
    state = state.select(*axes, key, "_at", *(c.alias(n) for n, c in of.items()))
    changes = state.select(*axes, "_at", *((F.col(n) - F.coalesce(F.lag(n).over(w), F.lit(0))).alias(n) for n in of))
    changes = changes.groupBy(*axes, "_at").agg(*(F.sum(n).alias(n) for n in of))
    per = Window.partitionBy(*axes).orderBy("_at")  # a row for each period
    sums = changes.select(*axes, "_at", F.lead("_at").over(per).alias("_next"), *(F.sum(n).over(per.rowsBetween(Window.unboundedPreceding, Window.currentRow)).alias(n) for n in of))
    ends = monthly.agg(F.min("_at").alias("a"), F.max("_at").alias("b")).select(F.lit(first).cast("int").alias("f"), F.lit(last).cast("int").alias("l"), "a", "b")
    lo, hi = F.coalesce("f", "a"), F.coalesce("l", "b")
    sums = sums.crossJoin(ends)  # one row
    low, high = F.greatest("_at", lo), F.least(F.coalesce(F.col("_next") - 1, hi), hi)
    return sums.filter(low <= high).select(*axes, F.explode(F.sequence(low, high)).alias(period), *of)


# Running windows over rows that have been aggregated per key and period.
def running(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Running total within keys."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(name, F.sum(value).over(w))


def previous(rows: DataFrame, keys: list[str], order: str, value: str, name: str) -> DataFrame:
    """Difference to the row before (to 0 for the first)."""
    return rows.withColumn(name, F.col(value) - F.lag(value, 1, 0).over(Window.partitionBy(*keys).orderBy(order)))


def average_of_before(rows: DataFrame, keys: list[str], order: str, value: str, n: int, name: str) -> DataFrame:
    """The sum of the n rows before, over n; blank if there is none."""
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(-n, -1)
    return rows.withColumn(name, F.sum(value).over(w).cast("double") / n)
