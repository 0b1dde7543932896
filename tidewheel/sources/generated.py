"""Literal tables, series and parameters; all are made on the JVM side."""

from __future__ import annotations

import datetime as dt
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def literal(spark: SparkSession, columns: str, rows: list[tuple[Any, ...]]) -> DataFrame:
    """A small table; columns as DDL."""
    names = [c.split()[0] for c in columns.split(",")]
    kinds = [c.split(None, 1)[1].strip() for c in columns.split(",")]
    structs = [F.struct(*(F.lit(v).cast(k).alias(n) for n, k, v in zip(names, kinds, row))) for row in rows]
    if not structs:
        return spark.range(0).select(*(F.lit(None).cast(k).alias(n) for n, k in zip(names, kinds)))
    return spark.range(1).select(F.inline(F.array(*structs)))


def date_range(spark: SparkSession, start: dt.date, end: dt.date, name: str = "date") -> DataFrame:
    return spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias(name))


def number_range(spark: SparkSession, start: float, stop: float, step: float, name: str = "value", places: int = 2) -> DataFrame:
    """start, start + step ... up to stop, as exact decimals (what-if parameters)."""
    n = round((stop - start) / step)
    return spark.range(n + 1).select((F.lit(start).cast(f"decimal(18,{places})") + F.col("id") * F.lit(step).cast(f"decimal(18,{places})")).cast(f"decimal(18,{places})").alias(name))


def refresh_time(offset: str = "-05:00") -> Column:
    """The current time in a fixed offset from UTC."""
    return F.from_utc_timestamp(F.current_timestamp(), offset)


def choices(labels: dict[str, Any], chosen: str, default: str | None = None) -> Any:
    """A field parameter: the column or measure behind a label; an unknown label takes the default."""
    return labels[chosen if chosen in labels or default is None else default]
