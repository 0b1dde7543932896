"""Revenue, cost and margin by stream; margin floors with a baseline year; ledger profit and loss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewheel.functions import blank0, divide
from tidewheel.functions.semantics import col, round_twice


def margin_columns(revenue: str = "revenue", cost: str = "cost") -> dict[str, Column]:
    gp = blank0(revenue) - blank0(cost)
    return {"gp": gp, "gp_pct": divide(gp, revenue)}


def by_stream(rows: DataFrame, axes: list[str], stream: str, streams: dict[str, str], revenue: str = "revenue", cost: str = "cost") -> DataFrame:
    """Revenue of each stream and in total, cost, margin and margin percent: one aggregation with conditions.
    streams: stream value -> name of its column."""
    parts = [F.sum(F.when(F.col(stream) == v, F.col(revenue))).alias(n) for v, n in streams.items()]
    out = rows.groupBy(*axes).agg(*parts, F.sum(revenue).alias("revenue"), F.sum(cost).alias("cost"))
    return out.withColumns(margin_columns())


def floor_flags(sell: str, gp: str, floor: float) -> tuple[Column, Column]:
    """(below, at or above): by the margin percent rounded to three, then two places; a blank one is neither."""
    pct = round_twice(divide(gp, sell))
    return F.coalesce(pct < F.lit(floor).cast("decimal(9,4)"), F.lit(False)), F.coalesce(pct >= F.lit(floor).cast("decimal(9,4)"), F.lit(False))


def floor_impact(rows: DataFrame, axes: list[str], sell: str = "sell", gp: str = "gp", floor: float = 0.32) -> DataFrame:
    """Per axes: counts and sells below and at or above the floor, their shares, the shortfall of what is below, and
    the margin if that were lifted to the floor. Rows decide at their own grain: group to bookings first for that one."""
    below, above = floor_flags(sell, gp, floor)
    s, g, level = blank0(sell), blank0(gp), F.lit(floor).cast("decimal(9,4)")
    short = F.when(below, F.greatest(s * level - g, F.lit(0))).otherwise(0)
    out = rows.groupBy(*axes).agg(
        F.count("*").alias("n"), F.sum(below.cast("long")).alias("n_below"), F.sum(above.cast("long")).alias("n_above"), F.sum(s).alias("sell"), F.sum(g).alias("gp"),
        F.sum(F.when(below, s).otherwise(0)).alias("sell_below"), F.sum(F.when(above, s).otherwise(0)).alias("sell_above"), F.sum(short).alias("shortfall"),
    )
    return out.withColumns({
        "share_below": divide("n_below", "n"), "gp_pct": divide("gp", "sell"), "gap": divide("gp", "sell") - F.lit(float(floor)),
        "simulated_gp": F.col("gp") + F.col("shortfall"), "simulated_pct": divide(F.col("gp") + F.col("shortfall"), "sell"),
    })


def against_baseline(rows: DataFrame, axes: list[str], year: str, value: str, baseline: int) -> DataFrame:
    """Each year's value and its difference to the same axes' value in the baseline year (blank if there is none)."""
    base = rows.filter(F.col(year) == baseline).select(*(F.col(a).alias(f"_{a}") for a in axes), F.col(value).alias("baseline"))
    on = [F.col(a).eqNullSafe(F.col(f"_{a}")) for a in axes]
    out = rows.join(base, on, "left").drop(*(f"_{a}" for a in axes))
    return out.withColumns({"variance": F.col(value) - F.col("baseline"), "variance_pct": divide(F.col(value) - F.col("baseline"), "baseline")})


#: Account classes by the leading digits of an account number: (from, to, class).
ACCOUNT_CLASSES = [(0, 399, "Balance"), (400, 999, "Revenue"), (1000, 1599, "Cost of Sales"), (1600, 1899, "Expense")]


def account_class(number: Column, classes: list[tuple[int, int, str]] = ACCOUNT_CLASSES, default: str = "Other") -> Column:
    out = None
    for low, high, name in classes:
        hit = number.between(low, high)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise(default)


def profit_and_loss(rows: DataFrame, axes: list[str], kind: str, balance: str) -> DataFrame:
    """Revenue (credits, so with the sign turned), cost of sales, margin and its percent from ledger balances."""
    out = rows.groupBy(*axes).agg((-F.sum(F.when(F.col(kind) == "Revenue", F.col(balance)))).alias("revenue"), F.sum(F.when(F.col(kind) == "Cost of Sales", F.col(balance))).alias("cost_of_sales"), F.sum(F.when(F.col(kind) == "Expense", F.col(balance))).alias("expense"))
    gp = blank0("revenue") - blank0("cost_of_sales")
    return out.withColumns({"gross_profit": gp, "gross_pct": divide(gp, "revenue"), "net": gp - blank0("expense")})


def budget_variance(actual: DataFrame, budget: DataFrame, axes: list[str]) -> DataFrame:
    """actual and budget (each one row per axes, columns actual and budget) side by side with the variance."""
    from tidewheel.operators.joins import blended

    out = blended({"actual": actual, "budget": budget}, axes)
    return out.withColumns({"variance": blank0("actual") - blank0("budget"), "variance_pct": divide(blank0("actual") - blank0("budget"), "budget")})


def reconciled(parts: dict[str, DataFrame], amount: str, tolerance: float = 0.005) -> DataFrame:
    """Totals of two or more tables and the difference of each to the first."""
    every = None
    for k, (name, df) in enumerate(parts.items()):
        part = df.agg(F.sum(amount).alias("total")).select(F.lit(k).alias("n"), F.lit(name).alias("part"), "total")
        every = part if every is None else every.unionByName(part)
    first = every.filter("n = 0").select(F.col("total").alias("_first"))
    out = every.crossJoin(first).withColumn("difference", F.col("total") - F.col("_first"))  # one row for each table
    return out.withColumn("matches", F.abs("difference") <= tolerance).drop("_first")


def methods_compared(parts: dict[str, DataFrame], keys: list[str], amount: str = "amount", against: str | None = None) -> DataFrame:
    """A column per method (its table: keys and amount) and the variance of each to one of them."""
    names = list(parts)
    against = against or names[0]
    every = None
    for name, df in parts.items():
        row = df.select(*keys, F.lit(name).alias("_method"), F.col(amount).alias("_amount"))
        every = row if every is None else every.unionByName(row)
    out = every.groupBy(*keys).agg(*(F.sum(F.when(F.col("_method") == n, F.col("_amount"))).alias(n) for n in names))
    return out.withColumns({f"{n}_variance": blank0(n) - blank0(against) for n in names if n != against})


def display_rows(rows: DataFrame, key: str, metrics: dict[str, Column]) -> DataFrame:
    """A row per key and metric with the value as text; null values are left out."""
    each = [F.struct(F.lit(k + 1).alias("line"), F.lit(n).alias("metric"), c.alias("value")) for k, (n, c) in enumerate(metrics.items())]
    return rows.select(key, F.inline(F.array(*each))).filter(F.col("value").isNotNull())


def axis_maximum(value: Column) -> Column:
    """A round number at or above the value, one significant digit (chart axes)."""
    size = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(col(value)))))
    return F.when(value != 0, F.signum(value) * F.ceil(F.abs(value) / size) * size).otherwise(F.lit(0.0))
