"""Pivot, unpivot, explode, scaffold, unions, conversion with error capture, subtotals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unpivot_amounts(rows: DataFrame, ids: list[str], values: list[str], kind: str = "type", value: str = "value", keep_zero: bool = False) -> DataFrame:
    """Columns to (kind, value) rows; nulls and, unless kept, zeros are dropped."""
    out = rows.unpivot(ids, values, kind, value).filter(F.col(value).isNotNull())
    return out if keep_zero else out.filter(F.col(value) != 0)


def pivot_fixed(rows: DataFrame, keys: list[str], kind: str, value: str, kinds: list[str]) -> DataFrame:
    """Rows to a fixed list of columns (there even if no row has the kind), summed; one aggregation, no scan for the kinds."""
    return rows.groupBy(*keys).agg(*(F.sum(F.when(F.col(kind) == k, F.col(value))).alias(k) for k in kinds))


def explode_years(rows: DataFrame, n: str, name: str = "year_index") -> DataFrame:
    """A row for each of 1..n; null or less than 1 counts as 1."""
    return rows.withColumn(name, F.explode(F.sequence(F.lit(1), F.greatest(F.coalesce(F.col(n), F.lit(1)), F.lit(1)).cast("int"))))


def explode_months(rows: DataFrame, start: str, end: str, name: str = "month_end") -> DataFrame:
    """A row for each month from start's to end's, with its last day. An end before the start gives none."""
    months = F.sequence(F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month"))
    return rows.filter(F.trunc(start, "month") <= F.trunc(end, "month")).withColumn(name, F.explode(months)).withColumn(name, F.last_day(name))


def composite_key(*parts: str | Column, sep: str = "_", null_breaks: bool = True) -> Column:
    """Parts as one text; a null part makes it null, or is left out."""
    cs = [F.col(p).cast("string") if isinstance(p, str) else p.cast("string") for p in parts]
    if not null_breaks:
        return F.concat_ws(sep, *cs)
    return F.concat(*[x for c in cs for x in (c, F.lit(sep))][:-1])


def scaffold(keys: list[str], parts: dict[str, DataFrame]) -> DataFrame:
    """Every key that any part has, with each part's value column (its name); parts have one row per key."""
    every = None
    for name, p in parts.items():
        row = p.select(*keys, *((F.col(n) if n == name else F.lit(None).cast(parts[n].schema[n].dataType)).alias(n) for n in parts))
        every = row if every is None else every.unionByName(row)
    return every.groupBy(*keys).agg(*(F.max(n).alias(n) for n in parts))


def union_all(*frames: DataFrame) -> DataFrame:
    """By name; columns that a frame lacks are null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def convert(rows: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """Columns as types; what can't be converted becomes null."""
    return rows.withColumns({c: F.col(c).try_cast(k) for c, k in kinds.items()})


def conversion_errors(rows: DataFrame, kinds: dict[str, str], key: str) -> DataFrame:
    """key, column and value of what convert() would lose."""
    bad = F.array(*(F.when(F.col(c).isNotNull() & F.col(c).try_cast(k).isNull(), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))) for c, k in kinds.items()))
    return rows.select(key, F.explode(F.array_compact(bad)).alias("_bad")).select(key, "_bad.column", "_bad.value")


def without_zero_rows(rows: DataFrame, *values: str) -> DataFrame:
    """Drops rows in which all the values are zero or null."""
    keep = None
    for v in values:
        c = F.coalesce(F.col(v), F.lit(0)) != 0
        keep = c if keep is None else keep | c
    return rows.filter(keep)


def classified(c: Column, bands: list[tuple[Column, str]], default: str | None = None) -> Column:
    """The label of the first condition that holds."""
    out = None
    for condition, label in bands:
        out = F.when(condition, label) if out is None else out.when(condition, label)
    return out.otherwise(default) if default is not None else out


def subtotals(rows: DataFrame, axes: list[str], aggs: dict[str, Column]) -> DataFrame:
    """Additive aggregates for every leading part of the axes, in one pass; level: how many axes a row has."""
    level = F.lit(len(axes)) - F.bit_count(F.grouping_id())
    return rows.rollup(*axes).agg(*(a.alias(n) for n, a in aggs.items()), level.cast("int").alias("level"))


def except_rows(rows: DataFrame, other: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct combinations in rows that other lacks; null equals null."""
    return rows.select(*columns).subtract(other.select(*columns))
