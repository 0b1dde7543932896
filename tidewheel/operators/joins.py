"""Joins with the guarantees that a fact load needs: no fan-out, exclusion, fallback keys, inferred members."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row per key: the first in the given order (name enough columns to make it total)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def latest_per_key(rows: DataFrame, keys: list[str], by: str) -> DataFrame:
    """The row with the largest `by` of each key, by partial aggregation instead of a sort."""
    rest = [c for c in rows.columns if c not in keys]
    best = rows.groupBy(*keys).agg(F.max(F.struct(by, *(c for c in rest if c != by))).alias("_best"))
    return best.select(*keys, *(F.col(f"_best.{c}").alias(c) for c in rest))


def lookup(rows: DataFrame, other: DataFrame, on: dict[str, str], take: dict[str, str], order: list[str] | None = None) -> DataFrame:
    """Left join that never multiplies rows: other is reduced to one row per key first.

    on: column of rows -> column of other; take: new name -> column of other; order decides which row of
    a key stays (by default the smallest of all taken columns).
    """
    keys = list(on.values())
    row = F.struct(*(F.col(c).alias(f"_o{i}") for i, c in enumerate(order or [])), *(F.col(c).alias(n) for n, c in take.items()))
    slim = other.groupBy(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min(row).alias("_row"))
    slim = slim.select(*(f"_k{i}" for i in range(len(keys))), *(F.col(f"_row.{n}").alias(n) for n in take))
    cond = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_k{i}") for i, c in enumerate(on)))
    return rows.join(slim, cond, "left").drop(*(f"_k{i}" for i in range(len(keys))))


def lookup_or_unique(rows: DataFrame, other: DataFrame, key: str, second: str, other_key: str, other_second: str, take: str, name: str) -> DataFrame:
    """Looks up `take` by both keys, else by the first alone where that one has a single value."""
    exact = other.select(F.col(other_key).alias("_k"), F.col(other_second).alias("_s"), F.col(take).alias("_exact")).groupBy("_k", "_s").agg(F.min("_exact").alias("_exact"))
    unique = other.groupBy(F.col(other_key).alias("_u")).agg(F.min(take).alias("_lo"), F.max(take).alias("_hi"))
    unique = unique.filter("_lo = _hi").select("_u", F.col("_lo").alias("_only"))
    out = rows.join(exact, (F.col(key) == F.col("_k")) & (F.col(second) == F.col("_s")), "left").join(unique, F.col(key) == F.col("_u"), "left")
    return out.withColumn(name, F.coalesce("_exact", "_only")).select(*rows.columns, name)


def excluding(rows: DataFrame, other: DataFrame, on: dict[str, str], ignore_case: bool = False) -> DataFrame:
    """Rows whose key isn't in other. Keys with a null stay, as they match nothing."""
    return _filtering(rows, other, on, ignore_case, "left_anti")


def among(rows: DataFrame, other: DataFrame, on: dict[str, str], ignore_case: bool = False) -> DataFrame:
    """Rows whose key is in other."""
    return _filtering(rows, other, on, ignore_case, "left_semi")


def _filtering(rows: DataFrame, other: DataFrame, on: dict[str, str], ignore_case: bool, how: str) -> DataFrame:
    norm = (lambda c: F.upper(F.trim(c))) if ignore_case else (lambda c: c)
    slim = other.select(*(norm(F.col(c)).alias(f"_k{i}") for i, c in enumerate(on.values())))
    cond = reduce(lambda a, b: a & b, (norm(F.col(c)) == F.col(f"_k{i}") for i, c in enumerate(on)))
    return rows.join(slim, cond, how)


def aggregated_lookup(rows: DataFrame, other: DataFrame, on: dict[str, str], aggs: dict[str, Column], where: str | None = None) -> DataFrame:
    """A correlated aggregate over another table, as one aggregation per key and a join."""
    other = other.filter(where) if where else other
    slim = other.groupBy(*(F.col(c).alias(f"_k{i}") for i, c in enumerate(on.values()))).agg(*(a.alias(n) for n, a in aggs.items()))
    cond = reduce(lambda a, b: a & b, (F.col(c) == F.col(f"_k{i}") for i, c in enumerate(on)))
    return rows.join(slim, cond, "left").drop(*(f"_k{i}" for i in range(len(on))))


def blended(parts: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """Separate facts side by side: each part (keys and its value columns, aggregated to the keys) in one union and
    one aggregation, instead of a chain of full joins."""
    values = {c: p for p in parts.values() for c in p.columns if c not in keys}
    every = None
    for p in parts.values():
        row = p.select(*keys, *((F.col(c) if c in p.columns else F.lit(None).cast(values[c].schema[c].dataType)).alias(c) for c in values))
        every = row if every is None else every.unionByName(row)
    return every.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in values))


def inferred_members(dim: DataFrame, key: str, facts: dict[str, tuple[DataFrame, str, str]], parse: dict[str, Column] | None = None) -> DataFrame:
    """Rows for keys that facts hold and the dimension lacks.

    facts: label -> (rows, key column, date column), at most two. Keys are trimmed. Each missing key
    gets its first and last date over all facts, the label of the fact that has it (`Both` if both do)
    and the columns that parse makes of `key`.
    """
    every = None
    for label, (rows, k, d) in facts.items():
        part = rows.select(F.trim(F.col(k).cast("string")).alias(key), F.col(d).alias("_d")).filter(F.col(key).isNotNull())
        part = part.groupBy(key).agg(F.min("_d").alias("first_date"), F.max("_d").alias("last_date")).withColumn("_label", F.lit(label))
        every = part if every is None else every.unionByName(part)
    every = every.groupBy(key).agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.min("_label").alias("_lo"), F.max("_label").alias("_hi"))
    known = dim.select(F.trim(F.col(key).cast("string")).alias("_known"))
    missing = every.join(known, F.col(key) == F.col("_known"), "left_anti")
    source = F.when(F.col("_lo") == F.col("_hi"), F.concat("_lo", F.lit(" Only"))).otherwise("Both")
    return missing.select(key, "first_date", "last_date", source.alias("source"), *(c.alias(n) for n, c in (parse or {}).items()))


def contract_key_parts(key: str, mark: str = "SERV_GP_") -> dict[str, Column]:
    """Customer (before the mark), contract (between) and year (the number after the last `_`, else 0) of a key."""
    k = F.col(key)
    rest = F.when(F.instr(k, mark) > 0, F.substring_index(k, mark, -1)).otherwise(F.lit(""))
    tail = F.substring_index(rest, "_", -1)
    numbered = F.contains(rest, F.lit("_")) & tail.rlike("^[0-9]+$")
    contract = F.when(F.contains(rest, F.lit("_")), F.expr(f"left(substring_index(substr({key}, instr({key}, '{mark}') + {len(mark)}), '{mark}', -1), greatest(length(substring_index({key}, '{mark}', -1)) - length(substring_index({key}, '_', -1)) - 1, 0))")).otherwise(rest)
    return {"customer": F.when(F.instr(k, mark) > 0, F.substring_index(k, mark, 1)).otherwise(k), "contract": F.when(numbered, contract).otherwise(rest), "year": F.when(numbered, tail.try_cast("int")).otherwise(0)}
