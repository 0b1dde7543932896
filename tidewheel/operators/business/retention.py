"""Customer retention, lifecycle, promoter scores, stream mix."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import blank0, divide, month_diff
from tidewheel.operators.reshape import classified
from tidewheel.plans.timeint import _month_end, add_months


def windows(anchor: dt.date, date: str = "d") -> tuple[Column, Column]:
    """Conditions for the twelve months up to the anchor and the twelve before, both month-end snapped."""
    bounds = [_month_end(add_months(anchor, -12 * k)) for k in range(3)]
    d = F.to_date(date)
    return (d > F.lit(bounds[1])) & (d <= F.lit(bounds[0])), (d > F.lit(bounds[2])) & (d <= F.lit(bounds[1]))


def current_and_prior(rows: DataFrame, keys: list[str], amount: str, anchor: dt.date, date: str = "d") -> DataFrame:
    """cy and py of each key in one pass (null: no rows), for keys with a row in either window."""
    now, before = windows(anchor, date)
    return rows.filter(now | before).groupBy(*keys).agg(F.sum(F.when(now, F.col(amount))).alias("cy"), F.sum(F.when(before, F.col(amount))).alias("py"))


def movements(cy: str = "cy", py: str = "py") -> dict[str, Column]:
    """A customer's part in base, churn, contraction and upsell; credits (cy < 0) count as retained."""
    c, p = blank0(cy), blank0(py)
    had, zero = p > 0, F.lit(0).cast("decimal(18,4)")
    return {
        "base": F.when(had, p).otherwise(zero),
        "churn": F.when(had & (c == 0), p).otherwise(zero),
        "contraction": F.when(had & (c > 0) & (c < p), p - c).otherwise(zero),
        "upsell": F.when(had & (c > p), c - p).otherwise(zero),
    }


def category(cy: str = "cy", py: str = "py") -> Column:
    """Churned, New Business, Contraction, Upsell, Steady; null for customers without revenue in either window."""
    c, p = blank0(cy), blank0(py)
    return classified(c, [((p > 0) & (c == 0), "Churned"), ((p == 0) & (c > 0), "New Business"), ((p > 0) & (c < p), "Contraction"), ((p > 0) & (c > p), "Upsell"), ((p > 0) & (c == p), "Steady")])


def retention(rows: DataFrame, customer: str, axes: list[str], amount: str, anchor: dt.date, date: str = "d") -> DataFrame:
    """Net and gross revenue retention and logo retention per axes; classified per customer, then summed."""
    each = current_and_prior(rows, [customer, *axes], amount, anchor, date)
    had, gone = blank0("py") > 0, blank0("cy") == 0
    parts = [F.sum(c).alias(n) for n, c in movements().items()]
    total = each.groupBy(*axes).agg(*parts, F.sum(had.cast("long")).alias("logos"), F.sum((had & gone).cast("long")).alias("logos_lost"))
    return total.withColumns({
        "nrr": divide(F.col("base") - F.col("churn") - F.col("contraction") + F.col("upsell"), "base"),
        "grr": divide(F.col("base") - F.col("churn") - F.col("contraction"), "base"),
        "logo_retention": divide(F.col("logos") - F.col("logos_lost"), "logos"),
    })


def retention_single_grain(rows: DataFrame, axes: list[str], amount: str, anchor: dt.date, date: str = "d") -> DataFrame:
    """The same movements of the axes' totals themselves, not of customers: gains and losses offset each other."""
    each = current_and_prior(rows, axes, amount, anchor, date)
    return each.select(*axes, "cy", "py", *(c.alias(n) for n, c in movements().items()))


#: The waterfall's steps: label, component, sign, in order of display.
WATERFALL = [("Base", "base", 1), ("Churn", "churn", -1), ("Contraction", "contraction", -1), ("Upsell", "upsell", 1), ("Retained", None, 1)]


def waterfall(totals: DataFrame) -> DataFrame:
    """The one row of totals (base, churn, contraction, upsell) as ordered, signed steps and their sum."""
    net = F.col("base") - F.col("churn") - F.col("contraction") + F.col("upsell")
    steps = [F.struct(F.lit(k + 1).alias("step"), F.lit(label).alias("label"), (F.col(c) * sign if c else net).alias("amount")) for k, (label, c, sign) in enumerate(WATERFALL)]
    return totals.select(F.inline(F.array(*steps)))


def lifecycle(rows: DataFrame, customer: str, amount: str, date: str, as_of: dt.date, dormant: int = 6, inactive: int = 12) -> DataFrame:
    """customer, last_date, months and status by the months since the last non-zero amount: Active, Dormant,
    Inactive; No Activity if there is none."""
    last = rows.groupBy(customer).agg(F.max(F.when(F.col(amount) != 0, F.to_date(date))).alias("last_date"))
    months = month_diff("last_date", F.lit(as_of))
    bands = [(F.col("last_date").isNull(), "No Activity"), (months < dormant, "Active"), (months < inactive, f"Dormant ({dormant}–{inactive - 1} mo)")]
    return last.select(customer, "last_date", months.alias("months"), classified(months, bands, f"Inactive ({inactive}+ mo)").alias("status"))


def promoter_score(rows: DataFrame, axes: list[str], score: str) -> DataFrame:
    """Promoters (9 and more), detractors (6 and less), answers and the score in percent."""
    s = F.col(score)
    out = rows.groupBy(*axes).agg(F.sum((s >= 9).cast("long")).alias("promoters"), F.sum((s <= 6).cast("long")).alias("detractors"), F.count(s).alias("answers"))
    return out.withColumn("nps", divide(F.col("promoters") - F.col("detractors"), "answers") * 100)


def yes_share(rows: DataFrame, axes: list[str], answer: Column, name: str = "yes_share") -> DataFrame:
    """Share of yes among yes and no; other answers don't count."""
    yes, no = F.sum((F.lower(answer) == "yes").cast("long")), F.sum((F.lower(answer) == "no").cast("long"))
    return rows.groupBy(*axes).agg(divide(yes, yes + no).alias(name))


def mix(rows: DataFrame, key: str, streams: list[str], cy: str = "cy", py: str = "py") -> DataFrame:
    """Of rows (key, stream columns with cy amounts, cy, py): the largest stream's share and the momentum cy / py - 1."""
    largest = F.greatest(*(blank0(s) for s in streams))
    total = sum((blank0(s) for s in streams[1:]), blank0(streams[0]))
    name = classified(largest, [(blank0(s) == largest, s) for s in streams])
    return rows.select(key, F.when(total != 0, name).alias("top_stream"), divide(largest, total).alias("concentration"), (divide(cy, py) - 1).alias("momentum"))
