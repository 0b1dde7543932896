"""Registration, and the star schema that the queries run on."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.plans.model import Model, Relationship
from tidewheel.functions.calendar import fiscal_calendar
from tidewheel.sources import parquet_table

Query = Callable[[SparkSession, str], DataFrame]
#: The date that everything is as of, and the month-end that windows end at.
AS_OF, ANCHOR = dt.date(2001, 8, 15), dt.date(2001, 7, 31)
FIRST, LAST = dt.date(1995, 1, 1), dt.date(2002, 12, 31)


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.sql: dict[str, str] = {}

    def add(self, sql: str | None = None, dates: tuple[str, ...] = ()) -> Callable[[Query], Query]:
        """Registers a function under its name, with the SQL that gives the same rows. Dates (those columns in
        the SQL) are given as text, so that results compare whatever reads them."""

        def take(f: Query) -> Query:
            def run(spark: SparkSession, sf_dir: str) -> DataFrame:
                out = f(spark, sf_dir)
                return out.withColumns({c: F.col(c).cast("string") for c, k in out.dtypes if k == "date"})

            run.__doc__ = f.__doc__
            self.queries[f.__name__] = run
            if sql:
                texts = ", ".join(f"CAST(CAST({c} AS DATE) AS VARCHAR) AS {c}" for c in dates)
                self.sql[f.__name__] = f"SELECT * REPLACE ({texts}) FROM ({sql})" if dates else sql
            return f

        return take


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return parquet_table(spark, sf_dir, name)


def money(c: str) -> str:
    return f"CAST({c} AS DECIMAL(12,2))"


#: Revenue and cost of a line, exact to four places.
REVENUE = f"{money('l_extendedprice')} * (1 - CAST(l_discount AS DECIMAL(4,2)))"
COST = f"{money('p_retailprice')} * CAST(l_quantity AS DECIMAL(6,0)) * 1.5"


def sales(spark: SparkSession, sf_dir: str, *more: str, shipped: tuple[dt.date | None, dt.date] | None = None) -> DataFrame:
    """Lines with order and customer: l_orderkey, customer, segment, nation, stream, d (shipped), created, revenue, cost and
    any more columns of lineitem. shipped: first (None: any) and last day that are needed; compared with the timestamp itself, so
    that the scan can leave out row groups."""
    line = table(spark, sf_dir, "lineitem")
    if shipped:
        line = line.filter(F.col("l_shipdate") < F.lit(shipped[1] + dt.timedelta(days=1)).cast("timestamp"))
        if shipped[0]:
            line = line.filter(F.col("l_shipdate") >= F.lit(shipped[0]).cast("timestamp"))
    line = line.select("l_orderkey", "l_partkey", F.to_date("l_shipdate").alias("d"), F.col("l_returnflag").alias("stream"), F.expr(REVENUE).alias("revenue"), "l_quantity", *more)
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("created"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation"))
    part = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice", "p_brand")
    out = line.join(part, line.l_partkey == part.p_partkey).withColumn("cost", F.expr(COST)).drop("p_partkey", "p_retailprice", "l_quantity")
    return out.join(order, F.col("l_orderkey") == F.col("o_orderkey")).join(customer, F.col("o_custkey") == F.col("c_custkey")).drop("o_orderkey", "c_custkey").withColumnRenamed("o_custkey", "customer")


#: The same in SQL, as a common table expression named s.
SALES = f"""s AS (
  SELECT l_orderkey, o_custkey AS customer, c_mktsegment AS segment, c_nationkey AS nation, l_returnflag AS stream, CAST(l_shipdate AS DATE) AS d, CAST(o_orderdate AS DATE) AS created,
    {REVENUE} AS revenue, {COST} AS cost, l_partkey, p_brand, l_suppkey, l_linestatus, l_quantity, l_tax, l_extendedprice
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey)"""

#: Fiscal year (October to September) and month of a date.
FY, FM = "(year({0}) + CASE WHEN month({0}) > 9 THEN 1 ELSE 0 END)", "((month({0}) + 2) % 12 + 1)"


def fy(c: str = "d") -> str:
    return FY.format(c)


def double(c: str, name: str) -> str:
    return f"CAST({c} AS DOUBLE) AS {name}"


def ratio(a: str, b: str, name: str | None = None) -> str:
    """Quotient to six places; null for a zero divisor."""
    q = f"round(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0), 6)"
    return f"{q} AS {name}" if name else q


def rounded(df: DataFrame, *ratios: str) -> DataFrame:
    """Decimals as doubles and ratios to six places, so that results compare."""
    kinds = dict(df.dtypes)
    return df.select(*((F.round(F.col(c).cast("double"), 6) if c in ratios else F.col(c).cast("double") if k.startswith("decimal") else F.col(c)).alias(c) for c, k in kinds.items()))


def star(spark: SparkSession, sf_dir: str) -> Model:
    """Lines (with revenue) to orders, customers, nations, regions, parts, suppliers and the calendar; the
    calendar also by order date, inactive; brands filter back over parts."""
    part = table(spark, sf_dir, "part")
    line = table(spark, sf_dir, "lineitem").withColumn("revenue", F.expr(REVENUE))
    calendar = fiscal_calendar(spark, FIRST, LAST, AS_OF)
    tables = {"line": line, "orders": table(spark, sf_dir, "orders"), "customer": table(spark, sf_dir, "customer"), "nation": table(spark, sf_dir, "nation"), "region": table(spark, sf_dir, "region"), "part": part, "supplier": table(spark, sf_dir, "supplier"), "calendar": calendar}
    edges = [
        Relationship("line", "l_orderkey", "orders", "o_orderkey"), Relationship("orders", "o_custkey", "customer", "c_custkey"), Relationship("customer", "c_nationkey", "nation", "n_nationkey"), Relationship("nation", "n_regionkey", "region", "r_regionkey"),
        Relationship("line", "l_partkey", "part", "p_partkey"), Relationship("line", "l_suppkey", "supplier", "s_suppkey"), Relationship("line", "l_shipdate", "calendar", "date", date_part=True, total=True),
        Relationship("orders", "o_orderdate", "calendar", "date", active=False, date_part=True, total=True),
    ]
    return Model(tables, edges, calendar="calendar", sort_by={"month_label": "month_start"})
