"""The numbers behind in-cell charts: scales, variances, waterfall positions, arcs. Drawing is up to the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.functions import blank0, divide
from tidewheel.operators.business.margin import axis_maximum
from tidewheel.operators.joins import blended


def bar(value: Column, largest: Column, width: float) -> Column:
    """A bar's length: the value's share of the largest, times the width."""
    return F.coalesce(divide(F.abs(blank0(value)), largest), F.lit(0.0)) * width


def variance(main: Column, base: Column, good: str = "up") -> dict[str, Column]:
    """Absolute and relative variance and whether it is welcome (costs are the other way round)."""
    change = blank0(main) - blank0(base)
    return {"change": change, "change_pct": divide(change, F.abs(blank0(base))), "favourable": change >= 0 if good == "up" else change <= 0}


def scaled_variance(rows: DataFrame, group: list[str], main: str, base: str, width: float) -> DataFrame:
    """Bars of both values and of the variance on one scale per group: the round maximum of the group's largest."""
    w = Window.partitionBy(*group)
    top = axis_maximum(F.max(F.greatest(F.abs(blank0(main)), F.abs(blank0(base)))).over(w).cast("double"))
    out = rows.withColumn("axis", top)
    return out.withColumns({**variance(F.col(main), F.col(base)), "bar": bar(F.col(main), F.col("axis"), width), "base_bar": bar(F.col(base), F.col("axis"), width)})


def waterfall_positions(rows: DataFrame, group: list[str], order: str, amount: str) -> DataFrame:
    """Where each step's bar starts and ends: running totals before and after it."""
    upto = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    out = rows.withColumn("bar_end", F.sum(blank0(amount)).over(upto))
    return out.withColumn("bar_start", F.col("bar_end") - blank0(amount))


def waterfall_levels(rows: DataFrame, group: list[str], index: str, sign: str, amount: str, level1: str, level2: str) -> DataFrame:
    """A statement as bars, of its rows and of the subtotals of level1, per group.

    Rows stand in order of index; their sign says whether an amount adds ("+"), takes away ("-") or is a sum by itself
    ("="). Adds level (2: a row; 1: a subtotal, or a row without level2), change (the signed amount), bar_from and bar_to
    (a "=" row begins at 0, another at the running total of all rows before it that have a level2 and aren't "=", a
    subtotal at that of its first row) and marker: on rows of level 2 the line of their subtotal, which is its
    amount, or, for a row that takes away, the running total before the subtotal's last row. A row of the result
    for each row and each subtotal; a group is as long as its statement.
    """
    v = blank0(amount)
    plus, minus, total = F.col(sign) == "+", F.col(sign) == "-", F.col(sign) == "="
    change = F.when(plus | total, v).when(minus, -v).otherwise(v * 0)
    adds = F.when(F.col(level2).isNotNull() & (plus | minus), change).otherwise(v * 0)
    order = Window.partitionBy(*group).orderBy(index)
    before = F.coalesce(F.sum(adds).over(order.rowsBetween(Window.unboundedPreceding, -1)), v * 0)
    part = Window.partitionBy(*group, level1)
    out = rows.withColumns({"_before": before, "change": change})
    last = F.max(F.struct(index, "_before")).over(part)["_before"]
    below = F.col(level2).isNotNull()
    each = out.withColumns({"level": F.when(below, 2).otherwise(1), "bar_from": F.when(total, v * 0).otherwise(F.col("_before")), "marker": F.when(below, F.when(minus, last).otherwise(F.sum(v).over(part)))})
    first = lambda c: F.min(F.struct(index, c))[c]
    sums = out.filter(below & ~total).groupBy(*group, level1).agg(F.min(index).alias(index), first(sign).alias(sign), F.sum(v).alias(amount), F.sum("change").alias("change"), first("_before").alias("bar_from"))
    shape = [*group, level1, level2, index, sign, amount, "level", "change", "bar_from", "marker"]
    sums = sums.withColumns({level2: F.lit(None).cast(rows.schema[level2].dataType), "level": F.lit(1), "marker": F.lit(None).cast(each.schema["marker"].dataType)})
    return each.select(*shape).unionByName(sums.select(*shape)).withColumn("bar_to", F.col("bar_from") + F.col("change"))


def scenario_columns(scenarios: dict[str, DataFrame], period: str, group: list[str], height: float) -> DataFrame:
    """Actuals (AC), prior year (PY), plan (PL) and forecast (FC), each a frame of group, period and a column of its
    name, side by side for every period that any of them has.

    Adds main (AC, or FC where there is none) and scenario, and on the scale of the largest of all values of the group: the tops and
    heights of main's and the plan's column and the prior year's mark, and the variance's bar between main and plan.
    """
    names = ["AC", "PY", "PL", "FC"]
    rows = blended({k: scenarios[k] for k in names}, [*group, period])
    top = F.max(F.greatest(*names)).over(Window.partitionBy(*group)).cast("double")
    main = F.coalesce("AC", "FC")
    rows = rows.withColumns({"main": main, "scenario": F.when(F.col("AC").isNotNull(), "AC").when(F.col("FC").isNotNull(), "FC"), "_top": top})
    tall = lambda c: divide(F.col(c).cast("double"), "_top") * height
    out = rows.withColumns({f"{n}_height": tall(c) for n, c in (("main", "main"), ("plan", "PL"))} | {"prior_at": height - tall("PY")})
    out = out.withColumns({f"{n}_at": height - F.col(f"{n}_height") for n in ("main", "plan")})
    bars = {"variance_at": F.least("main_at", "plan_at"), "variance_height": F.abs(F.col("main_at") - F.col("plan_at"))}
    both = F.col("main").isNotNull() & F.col("PL").isNotNull()
    return out.withColumns({n: F.when(both, c) for n, c in bars.items()} | {"favourable": F.when(both, F.col("main") >= F.col("PL"))}).drop("_top")


def small_multiples(rows: DataFrame, category: str, period: str, value: str, sort: str, last_actual: Column | int, height: float) -> DataFrame:
    """Columns of every category on one scale, which holds all values and zero.

    Adds category_rank (by the category's sum of sort, the largest first; ties share a rank), place (of the period in its
    category), is_actual, bar_from (from the top of the plot) and bar_size. A blank value has no bar.
    """
    order = rows.groupBy(category).agg(F.sum(sort).alias("_sort"))
    order = order.select(F.col(category).alias("_category"), F.rank().over(Window.orderBy(F.desc_nulls_last("_sort"))).alias("category_rank"))  # a row for each chart of the page
    scale = rows.agg(F.greatest(F.max(value), F.lit(0)).alias("_top"), F.least(F.min(value), F.lit(0)).alias("_bottom"))
    out = rows.join(order, F.col(category).eqNullSafe(F.col("_category"))).crossJoin(scale)  # one row
    part = lambda c: F.when(F.col(value).isNotNull(), blank0(divide(c, F.col("_top") - F.col("_bottom"))) * height)
    out = out.withColumns({"place": F.row_number().over(Window.partitionBy(category).orderBy(period)), "is_actual": F.col(period) <= last_actual, "bar_from": part(F.col("_top") - F.greatest(F.col(value), F.lit(0))), "bar_size": part(F.abs(value))})
    return out.drop("_category", "_top", "_bottom")


def wide_variance(main: Column, base: Column, largest: Column, height: float) -> dict[str, Column]:
    """Columns of a value and its base on the scale of a given maximum, and the variance's column between their ends."""
    ends = {"bar": bar(main, largest, height), "base_bar": bar(base, largest, height)}
    return {**ends, "variance_from": F.least(*ends.values()), "variance_to": F.greatest(*ends.values()), **variance(main, base)}


def pie(share: Column, radius: float = 1.0) -> dict[str, Column]:
    """End of the arc that starts at the top and covers a share, and whether it is the long way round."""
    angle = 2 * F.pi() * F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0))
    return {"x": F.sin(angle) * radius, "y": -F.cos(angle) * radius, "long": share > 0.5}
