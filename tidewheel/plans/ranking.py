"""Dense ranks without a task that sorts all rows, and without a join by value.

The rows are written once. At about `parts` values of theirs (exact values, at approximate quantiles)
they are cut into ranges: one between each two of these values and one for each value itself, so that
a value that very many rows share is a range of its own, in which nothing has to be sorted. Rows are
ranked within their range and moved on by how many values the ranges above hold.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewheel.sources.shared import stored


def placed(rows: DataFrame, by: str, within: tuple[str, ...] = (), counted: Column | None = None, name: str = "rank", parts: int = 64) -> DataFrame:
    """Adds the dense rank of by (descending) among the rows of its group: one more than the larger values there are.

    counted: whether a row's value is one of those that others are ranked among (default: all are). Rows whose by is
    blank are dropped. Blank groups are a group.
    """
    table = stored(rows.filter(F.col(by).isNotNull()).withColumn("_counted", F.lit(True) if counted is None else F.coalesce(counted, F.lit(False))))
    cuts = sorted(set(table.agg(F.percentile_approx(by, [k / parts for k in range(1, parts)], 10_000)).first()[0] or []), reverse=True)
    kind = table.schema[by].dataType
    values = [F.lit(c).cast(kind) for c in cuts]
    above = reduce(lambda a, b: a + b, ((v > F.col(by)).cast("int") for v in values), F.lit(0))
    at_cut = F.col(by).isin(*values) if values else F.lit(False)
    table = table.withColumns({"_range": 2 * above + at_cut.cast("int"), "_one": at_cut})
    # a row for each range of a group: how many values the ranges above it hold
    before = Window.partitionBy(*within).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = table.groupBy(*within, "_range").agg(F.count_distinct(F.when(F.col("_counted"), F.col(by))).alias("_n"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    single = table.filter("_one").withColumn("_own", F.lit(0).cast("bigint"))
    w = Window.partitionBy(*within, "_range").orderBy(F.desc(by))
    more = table.filter(~F.col("_one"))
    if counted is None:
        several = more.withColumn("_own", (F.dense_rank().over(w) - 1).cast("bigint"))
    else:
        rows_of = Window.partitionBy(*within, "_range").orderBy(F.desc(by), F.desc("_counted"))
        first = F.col("_counted") & ~F.coalesce(F.lag(by).over(rows_of) == F.col(by), F.lit(False))
        several = more.withColumn("_first", first.cast("bigint"))
        upto = F.sum("_first").over(w.rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum("_first").over(w.rangeBetween(Window.currentRow, Window.currentRow))
        several = several.withColumn("_own", upto).drop("_first")
    ranked = single.unionByName(several)
    names = {c: f"_g{i}" for i, c in enumerate((*within, "_range"))}
    sizes = sizes.withColumnsRenamed(names)
    on = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in names.items()))
    out = ranked.join(F.broadcast(sizes) if not within else sizes, on, "left")
    return out.withColumn(name, (F.col("_own") + F.col("_before") + 1).cast("int")).select(*rows.columns, name)


def ranked(rows: DataFrame, by: str, within: tuple[str, ...] = (), name: str = "rank", top: int | None = None, parts: int = 64) -> DataFrame:
    """Adds the dense rank of by (descending) among rows where it isn't blank; top keeps ranks up to it.

    For a top over all rows only the largest values are ranked; for one within groups each task first drops what is beyond
    the top of its own rows.
    """
    if top is None:
        return placed(rows, by, within, name=name, parts=parts)
    rows = rows.filter(F.col(by).isNotNull())
    if within:
        return rows.withColumn(name, F.dense_rank().over(Window.partitionBy(*within).orderBy(F.desc(by)))).filter(F.col(name) <= top)
    best = rows.select(by).distinct().orderBy(F.desc(by)).limit(top)
    place = best.withColumn(name, F.row_number().over(Window.orderBy(F.desc(by))))  # `top` rows
    return rows.join(F.broadcast(place), by).select(*rows.columns, name)
