"""Sources, projections, joins, reshaping, windows and set operations."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import dates as D
from tidewheel.functions import text as T
from tidewheel.functions.calendar import fiscal_calendar
from tidewheel.operators import joins as J
from tidewheel.operators import reshape as R
from tidewheel.plans import timeint
from tidewheel.plans.measure import ranked
from tidewheel.queries.base import ANCHOR, AS_OF, REVENUE, SALES, Registry, fy, money, rounded, sales, table
from tidewheel.sources import csv_table, json_table, literal, number_range, shared_folder, warehouse_table, workbook_table, write_csv, write_parquet, write_warehouse, write_workbooks


def register(reg: Registry) -> None:
    @reg.add("SELECT o_orderkey AS order_id, o_custkey AS customer_id, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'fast' ELSE 'normal' END AS lane FROM orders WHERE o_orderstatus NOT IN ('P') AND CAST(o_orderdate AS DATE) <= DATE '2001-06-30'")
    def project_filter(spark: SparkSession, d: str) -> DataFrame:
        """Select, rename, computed column, deny list and the guard against future rows."""
        o = table(spark, d, "orders").filter(~F.col("o_orderstatus").isin("P") & (F.to_date("o_orderdate") <= F.lit(dt.date(2001, 6, 30))))
        return o.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"), F.expr(money("o_totalprice")).cast("double").alias("total"), F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "fast").otherwise("normal").alias("lane"))

    @reg.add("SELECT c_custkey AS \"C Custkey\", c_mktsegment AS \"C Mktsegment\", c_nationkey AS \"C Nationkey\" FROM customer")
    def rename_proper(spark: SparkSession, d: str) -> DataFrame:
        """Programmatic renaming of all columns."""
        c = table(spark, d, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
        return c.toDF(*T.proper_names(c.columns))

    @reg.add("SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, TRY_CAST(event_type AS INTEGER) AS bad FROM events")
    def convert_lenient(spark: SparkSession, d: str) -> DataFrame:
        """JSON field and conversions in which errors become null."""
        e = table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"), F.col("event_type").alias("bad"))
        return R.convert(e, {"k": "bigint", "bad": "int"})

    @reg.add("SELECT p_partkey, 'p_type' AS \"column\", p_type AS \"value\" FROM part WHERE p_type IS NOT NULL AND TRY_CAST(p_type AS INTEGER) IS NULL UNION ALL SELECT p_partkey, 'p_brand', p_brand FROM part WHERE TRY_CAST(substr(p_brand, 7) AS INTEGER) > 12 AND TRY_CAST(p_brand AS INTEGER) IS NULL")
    def conversion_error_rows(spark: SparkSession, d: str) -> DataFrame:
        """Rows that a typed load would lose, with column and value."""
        p = table(spark, d, "part").withColumn("p_brand", F.when(F.substring("p_brand", 7, 9).try_cast("int") > 12, F.col("p_brand")))
        return R.conversion_errors(p, {"p_type": "int", "p_brand": "int"}, "p_partkey")

    @reg.add("SELECT p_partkey, upper(substr(p_name, 1, 1)) || substr(p_name, 2, instr(p_name, ' ') - 1) || upper(substr(p_name, instr(p_name, ' ') + 1, 1)) || substr(p_name, instr(p_name, ' ') + 2) AS name, trim(p_type) AS kind, coalesce(nullif(CASE WHEN p_size > 25 THEN p_brand ELSE '' END, ''), p_type) AS label FROM part")
    def text_functions(spark: SparkSession, d: str) -> DataFrame:
        """Proper case, full trimming, first filled text."""
        p = table(spark, d, "part").withColumn("own", F.when(F.col("p_size") > 25, F.col("p_brand")).otherwise(""))
        return p.select("p_partkey", T.proper("p_name").alias("name"), T.trim_all(F.concat(F.lit("  \t"), "p_type", F.lit(" \n"))).alias("kind"), T.first_filled("own", "p_type").alias("label"))

    @reg.add("""SELECT c_custkey, format('{:,}', CAST(round(CAST(c_acctbal AS DECIMAL(12,2))) AS BIGINT)) AS whole, CASE WHEN c_acctbal < 0 THEN '-' ELSE '' END || '$' || format('{:,}', CAST(round(abs(CAST(c_acctbal AS DECIMAL(12,2)))) AS BIGINT)) AS price,
      CAST(CAST(round(CAST(c_nationkey AS DECIMAL(18,8)) / 8 * 100, 1) AS DECIMAL(18,1)) AS VARCHAR) || '%' AS pct FROM customer""")
    def display_formats(spark: SparkSession, d: str) -> DataFrame:
        """Numbers as display text."""
        c = table(spark, d, "customer")
        balance = F.round(F.col("c_acctbal") * 100).cast("decimal(12,0)") / 100  # parts of a cent as SQL's cast rounds them: 8.495 is 8.49 there, 8.50 by Spark's
        return c.select("c_custkey", T.fmt(balance, "#,0").alias("whole"), T.fmt(balance, "$#,0", sign="c_acctbal").alias("price"), T.fmt(F.col("c_nationkey") / 8, "0.0%").alias("pct"))

    BALANCE, DAY = "CAST(c_acctbal AS DECIMAL(12,2))", "strftime(o_orderdate, '{}')"

    @reg.add(f"""SELECT c_custkey, CASE WHEN {BALANCE} < 0 THEN '($' || format('{{:,}}', CAST(round(abs({BALANCE})) AS BIGINT)) || ')' WHEN {BALANCE} = 0 THEN '0' ELSE '$' || format('{{:,}}', CAST(round({BALANCE}) AS BIGINT)) END AS balance,
      CASE WHEN c_nationkey < 12 THEN '(' ELSE '' END || CAST(CAST(round(abs(c_nationkey - 12) * CAST(12.5 AS DECIMAL(18,8)), 2) AS DECIMAL(18,2)) AS VARCHAR) || '%' || CASE WHEN c_nationkey < 12 THEN ')' ELSE '' END AS change FROM customer""")
    def formats_by_sign(spark: SparkSession, d: str) -> DataFrame:
        """Formats with a section for each sign, kept as metadata of the columns and applied."""
        formats = {"balance": "$#,0;($#,0);0", "change": "0.00%;(0.00%)"}
        c = table(spark, d, "customer").select("c_custkey", F.expr(money("c_acctbal")).alias("balance"), ((F.col("c_nationkey") - 12) / 8).alias("change"))
        c = T.described(c, formats)
        return c.select("c_custkey", *(T.fmt_by_sign(n, c.schema[n].metadata["format"]).alias(n) for n in formats))

    @reg.add("SELECT o_orderkey, " + ", ".join(f"{DAY.format(p)} AS {n}" for n, p in {"month": "%b %Y", "day": "%d-%b-%Y", "long_day": "%b %-d, %Y", "iso": "%Y-%m-%d"}.items()) + ", CAST(CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DECIMAL(18,2)) AS VARCHAR) AS cents FROM orders")
    def date_formats(spark: SparkSession, d: str) -> DataFrame:
        """Dates and plain numbers as display text."""
        o, day = table(spark, d, "orders"), F.col("o_orderdate")
        return o.select("o_orderkey", T.fmt(day, "MMM yyyy").alias("month"), T.fmt(day, "dd-MMM-yyyy").alias("day"), T.fmt(day, "MMM d, yyyy").alias("long_day"), T.fmt(day, "yyyy-MM-dd").alias("iso"), T.fmt(F.expr(money("o_totalprice")), "0.00").alias("cents"))

    @reg.add("""SELECT CAST(d AS DATE) AS date, year(d) + CASE WHEN month(d) > 9 THEN 1 ELSE 0 END AS fiscal_year, (month(d) + 2) % 12 + 1 AS fiscal_month, CAST(ceil(((month(d) + 2) % 12 + 1) / 3.0) AS INTEGER) AS fiscal_quarter,
        last_day(CAST(d AS DATE)) AS month_end, make_date(year(d) + CASE WHEN month(d) > 9 THEN 0 ELSE -1 END, 10, 1) AS fiscal_start, strftime(d, '%b %Y') AS month_label,
        last_day(CAST(d AS DATE)) < DATE '2001-08-01' AS completed_month, (year(d) - 2001) * 12 + month(d) - 8 AS month_offset, (year(d) - 1995) * 12 + month(d) AS month_index,
        CAST(floor((dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) / 7) AS INTEGER) + 1 AS week, CAST(date_trunc('week', d) AS DATE) AS week_start
        , lines
      FROM range(TIMESTAMP '1995-01-01', TIMESTAMP '2003-01-01', INTERVAL 1 DAY) r(d) LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS k, count(*) AS lines FROM lineitem GROUP BY 1) ON k = CAST(d AS DATE)""", dates=('date', 'month_end', 'fiscal_start', 'week_start'))
    def fiscal_days(spark: SparkSession, d: str) -> DataFrame:
        """The fiscal calendar, with the lines shipped on each day."""
        c = fiscal_calendar(spark, dt.date(1995, 1, 1), dt.date(2002, 12, 31), AS_OF)
        shipped = table(spark, d, "lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(F.count("*").alias("lines"))
        return c.join(shipped, "date", "left").select("lines", "date", "fiscal_year", "fiscal_month", "fiscal_quarter", "month_end", "fiscal_start", "month_label", "completed_month", "month_offset", "month_index", "week", "week_start")

    @reg.add(f"""WITH {SALES} SELECT year(d) AS year, CAST(floor((dayofyear(d) - 1 + dayofweek(date_trunc('year', d))) / 7) AS INTEGER) + 1 AS week, CAST(sum(revenue) AS DOUBLE) AS revenue, count(*) AS lines FROM s GROUP BY ALL""")
    def weekly_revenue(spark: SparkSession, d: str) -> DataFrame:
        """Revenue by calendar year and number of the week, weeks beginning on Sunday."""
        day = F.col("d")
        return rounded(sales(spark, d).groupBy(F.year(day).alias("year"), D.week_number(day).alias("week")).agg(F.sum("revenue").alias("revenue"), F.count("*").alias("lines")))

    @reg.add(f"""WITH {SALES} SELECT CAST({fy()} AS INTEGER) AS fiscal_year, (month(d) + 2) % 12 + 1 AS period, last_day(CAST(make_date(CAST({fy()} AS INTEGER) - 1, 10, 1) + to_months(CAST((month(d) + 2) % 12 AS INTEGER)) AS DATE)) AS period_end, CAST(sum(revenue) AS DOUBLE) AS amount FROM s GROUP BY ALL""", dates=('period_end',))
    def ledger_periods(spark: SparkSession, d: str) -> DataFrame:
        """Amounts by a ledger's fiscal year and period, with the period's month-end."""
        day = F.col("d")
        rows = sales(spark, d).groupBy(D.fiscal_year(day).alias("fiscal_year"), D.fiscal_month(day).alias("period")).agg(F.sum("revenue").alias("amount"))
        return rounded(rows.withColumn("period_end", D.ledger_month_end("fiscal_year", "period")))

    @reg.add(f"""WITH {SALES}, b AS (SELECT CAST(floor(CAST(revenue - cost AS DOUBLE) * 100 / CAST(revenue AS DOUBLE)) AS BIGINT) + 1 AS k, count(*) AS lines, sum(revenue) AS revenue FROM s WHERE revenue <> 0 GROUP BY 1)
      SELECT CAST(v AS DOUBLE) / 100 AS floor, v AS n, CAST(coalesce(sum(lines), 0) AS BIGINT) AS lines_below, CAST(sum(revenue) AS DOUBLE) AS revenue_below FROM range(0, 101) r(v) LEFT JOIN b ON k <= v GROUP BY v""")
    def what_if_series(spark: SparkSession, d: str) -> DataFrame:
        """A what-if parameter's values, and what lies below the margin floor that each would set: lines by the first value that
        is above their margin, then added up over values."""
        below = (F.floor((F.col("revenue") - F.col("cost")).cast("double") * 100 / F.col("revenue").cast("double")) + 1).alias("k")
        buckets = sales(spark, d).filter("revenue <> 0").groupBy(below).agg(F.count("*").alias("lines"), F.sum("revenue").alias("revenue"))  # a row for each percent of margin
        series = number_range(spark, 0, 1, 0.01, "floor").select(F.col("floor").cast("double").alias("floor"), (F.col("floor") * 100).cast("bigint").alias("n"))
        out = F.broadcast(series).join(buckets, F.col("k") <= F.col("n"), "left").groupBy("floor", "n")
        return rounded(out.agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines_below"), F.sum("revenue").alias("revenue_below")))

    # Joins.
    @reg.add("SELECT n_name, r_name, count(*) AS customers FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey GROUP BY ALL")
    def join_lookup(spark: SparkSession, d: str) -> DataFrame:
        """Enrichment by left joins that can't multiply rows."""
        c = J.lookup(table(spark, d, "customer"), table(spark, d, "nation"), {"c_nationkey": "n_nationkey"}, {"n_name": "n_name", "r": "n_regionkey"})
        return J.lookup(c, table(spark, d, "region"), {"r": "r_regionkey"}, {"r_name": "r_name"}).groupBy("n_name", "r_name").agg(F.count("*").alias("customers"))

    @reg.add("SELECT o_orderkey, a.n_name AS home, b.n_name AS next, c.n_name AS far FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = (c_nationkey + 1) % 25 LEFT JOIN nation c ON c.n_nationkey = (c_nationkey + 2) % 25")
    def join_role_playing(spark: SparkSession, d: str) -> DataFrame:
        """One dimension in three roles."""
        o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        n = table(spark, d, "nation")
        o = o.withColumns({"k1": (F.col("c_nationkey") + 1) % 25, "k2": (F.col("c_nationkey") + 2) % 25})
        for key, name in (("c_nationkey", "home"), ("k1", "next"), ("k2", "far")):
            o = J.lookup(o, n, {key: "n_nationkey"}, {name: "n_name"})
        return o.select("o_orderkey", "home", "next", "far")

    @reg.add("""WITH m AS (SELECT l_partkey AS k, l_suppkey AS s, min(l_returnflag) AS f FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL), u AS (SELECT l_partkey AS k, min(l_returnflag) AS f FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL HAVING min(l_returnflag) = max(l_returnflag))
      SELECT p.l_partkey, p.l_suppkey, coalesce(m.f, u.f) AS flag, count(*) AS n FROM lineitem p LEFT JOIN m ON p.l_partkey = m.k AND p.l_suppkey = m.s LEFT JOIN u ON p.l_partkey = u.k WHERE p.l_linestatus = 'O' GROUP BY ALL""")
    def join_composite_fallback(spark: SparkSession, d: str) -> DataFrame:
        """Lookup by two keys, else by one that is unique."""
        line = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")
        out = J.lookup_or_unique(line.filter("l_linestatus = 'O'").select("l_partkey", "l_suppkey"), line.filter("l_linestatus = 'F'"), "l_partkey", "l_suppkey", "l_partkey", "l_suppkey", "l_returnflag", "flag")
        return out.groupBy("l_partkey", "l_suppkey", "flag").agg(F.count("*").alias("n"))

    @reg.add("SELECT c_custkey, c_mktsegment FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
    def join_anti(spark: SparkSession, d: str) -> DataFrame:
        """Exclusion by key."""
        return J.excluding(table(spark, d, "customer").select("c_custkey", "c_mktsegment"), table(spark, d, "orders").filter("o_orderstatus = 'P'"), {"c_custkey": "o_custkey"})

    @reg.add("SELECT p_partkey, p_type FROM part WHERE upper(p_type) IN ('ECONOMY', 'SMALL')")
    def join_semi_ignore_case(spark: SparkSession, d: str) -> DataFrame:
        """Membership of a text key, without regard to case and blanks."""
        kinds = literal(spark, "kind string", [(" economy",), ("Small ",)])
        return J.among(table(spark, d, "part").select("p_partkey", "p_type"), kinds, {"p_type": "kind"}, ignore_case=True)

    @reg.add("WITH a AS (SELECT o_custkey AS k, count(*) AS orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS opened FROM orders WHERE o_orderstatus = 'O' GROUP BY 1) SELECT coalesce(a.k, b.k) AS customer, orders, opened FROM a FULL JOIN b ON a.k = b.k")
    def join_full_blend(spark: SparkSession, d: str) -> DataFrame:
        """Facts side by side: one union and one aggregation give what a full join does."""
        o = table(spark, d, "orders").withColumnRenamed("o_custkey", "customer")
        one = lambda s, n: o.filter(F.col("o_orderstatus") == s).groupBy("customer").agg(F.count("*").alias(n))
        return J.blended({"f": one("F", "orders"), "o": one("O", "opened")}, ["customer"])

    @reg.add(f"SELECT o_orderkey, n, CAST(revenue AS DOUBLE) AS revenue FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n, sum({REVENUE}) AS revenue FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1) ON o_orderkey = l_orderkey")
    def correlated_lookup(spark: SparkSession, d: str) -> DataFrame:
        """An aggregate of another table's rows with the same key, as one aggregation and a join."""
        out = J.aggregated_lookup(table(spark, d, "orders").select("o_orderkey"), table(spark, d, "lineitem"), {"o_orderkey": "l_orderkey"}, {"n": F.count("*"), "revenue": F.sum(F.expr(REVENUE))}, "l_linestatus = 'O'")
        return rounded(out)

    @reg.add("SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS day FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders) WHERE rn = 1", dates=('day',))
    def first_row_per_key(spark: SparkSession, d: str) -> DataFrame:
        """One row per key by a stated order (the fan-out guard)."""
        o = J.first_per_key(table(spark, d, "orders").select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.desc("o_orderdate"), "o_orderkey"])
        return o.select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("day"))

    @reg.add("SELECT s_nationkey, max(s_suppkey) AS s_suppkey, arg_max(s_name, s_suppkey) AS s_name FROM supplier GROUP BY 1")
    def latest_row_per_key(spark: SparkSession, d: str) -> DataFrame:
        """The row with the largest value per key, by partial aggregation."""
        return J.latest_per_key(table(spark, d, "supplier").select("s_nationkey", "s_suppkey", "s_name"), ["s_nationkey"], "s_suppkey")

    @reg.add("""WITH a AS (SELECT DISTINCT 'C' || l_suppkey || 'SERV_GP_P' || l_partkey % 7 || '_' || l_linenumber AS k, CAST(l_shipdate AS DATE) AS d, 'Revenue' AS f FROM lineitem WHERE l_returnflag = 'A' UNION ALL SELECT DISTINCT 'C' || l_suppkey || 'SERV_GP_P' || l_partkey % 7 || '_' || l_linenumber, CAST(l_shipdate AS DATE), 'Cost' FROM lineitem WHERE l_returnflag = 'R')
      SELECT k AS key, min(d) AS first_date, max(d) AS last_date, CASE WHEN min(f) = max(f) THEN min(f) || ' Only' ELSE 'Both' END AS source, split_part(k, 'SERV_GP_', 1) AS customer, split_part(split_part(k, 'SERV_GP_', 2), '_', 1) AS contract, CAST(split_part(k, '_', 4) AS INTEGER) AS year
      FROM a WHERE k NOT IN (SELECT DISTINCT 'C' || l_suppkey || 'SERV_GP_P' || l_partkey % 7 || '_' || l_linenumber FROM lineitem WHERE l_linenumber <= 4) GROUP BY k""", dates=('first_date', 'last_date'))
    def inferred_dimension_members(spark: SparkSession, d: str) -> DataFrame:
        """Dimension rows for keys that only facts hold, parsed from the key."""
        key = F.concat(F.lit("C"), F.col("l_suppkey").cast("string"), F.lit("SERV_GP_P"), (F.col("l_partkey") % 7).cast("string"), F.lit("_"), F.col("l_linenumber").cast("string"))
        line = table(spark, d, "lineitem").select(key.alias("key"), F.to_date("l_shipdate").alias("d"), "l_returnflag", "l_linenumber")
        dim = line.filter("l_linenumber <= 4").select("key").distinct()
        facts = {"Revenue": (line.filter("l_returnflag = 'A'"), "key", "d"), "Cost": (line.filter("l_returnflag = 'R'"), "key", "d")}
        return J.inferred_members(dim, "key", facts, J.contract_key_parts("key"))

    # Reshaping.
    @reg.add("SELECT o_orderkey, type, CAST(value AS DOUBLE) AS value FROM (UNPIVOT (SELECT l_orderkey AS o_orderkey, sum(CAST(l_quantity AS DECIMAL(12,2))) AS quantity, sum(CAST(l_discount AS DECIMAL(12,2))) AS discount, sum(CAST(l_tax AS DECIMAL(12,2))) AS tax FROM lineitem GROUP BY 1) ON quantity, discount, tax INTO NAME type VALUE value) WHERE value <> 0")
    def unpivot_without_zeros(spark: SparkSession, d: str) -> DataFrame:
        """Amount columns to rows, zeros dropped."""
        sums = [F.sum(F.col(f"l_{c}").cast("decimal(12,2)")).alias(c) for c in ("quantity", "discount", "tax")]
        return rounded(R.unpivot_amounts(table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(*sums), ["o_orderkey"], ["quantity", "discount", "tax"]))

    @reg.add(f"SELECT l_suppkey, CAST(sum({REVENUE}) FILTER (WHERE l_returnflag = 'A') AS DOUBLE) AS \"A\", CAST(sum({REVENUE}) FILTER (WHERE l_returnflag = 'N') AS DOUBLE) AS \"N\", CAST(sum({REVENUE}) FILTER (WHERE l_returnflag = 'X') AS DOUBLE) AS \"X\" FROM lineitem GROUP BY 1")
    def pivot_fixed_columns(spark: SparkSession, d: str) -> DataFrame:
        """Rows to a fixed list of columns, one of which no row has."""
        line = table(spark, d, "lineitem").select("l_suppkey", "l_returnflag", F.expr(REVENUE).alias("revenue"))
        return rounded(R.pivot_fixed(line, ["l_suppkey"], "l_returnflag", "revenue", ["A", "N", "X"]))

    @reg.add("SELECT p_partkey, 'P' || p_partkey || '_' || y AS contract_year, CAST(y AS INTEGER) AS year_index FROM (SELECT p_partkey, unnest(range(1, CAST(greatest(coalesce(nullif(p_size % 5, 4), 1), 1) AS BIGINT) + 1)) AS y FROM part)")
    def explode_contract_years(spark: SparkSession, d: str) -> DataFrame:
        """A row per contract year (null or 0: one), with a composite key."""
        p = table(spark, d, "part").select("p_partkey", F.nullif(F.col("p_size") % 5, F.lit(4)).alias("n"))
        p = R.explode_years(p, "n")
        return p.select("p_partkey", R.composite_key(F.concat(F.lit("P"), F.col("p_partkey").cast("string")), "year_index").alias("contract_year"), "year_index")

    @reg.add("SELECT o_custkey, CAST(last_day(m) AS DATE) AS month_end FROM (SELECT o_custkey, unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)), INTERVAL 1 MONTH)) AS m FROM orders GROUP BY 1)", dates=('month_end',))
    def explode_between_months(spark: SparkSession, d: str) -> DataFrame:
        """A row per month from the first to the last order of a customer."""
        o = table(spark, d, "orders").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
        return R.explode_months(o, "a", "b").select("o_custkey", "month_end")

    @reg.add("""WITH k AS (SELECT l_partkey AS part, last_day(CAST(l_shipdate AS DATE)) AS month_end, sum(CAST(l_quantity AS DECIMAL(12,2))) FILTER (WHERE l_returnflag = 'A') AS actual, sum(CAST(l_quantity AS DECIMAL(12,2))) FILTER (WHERE l_returnflag = 'N') AS forecast FROM lineitem GROUP BY ALL)
      SELECT part, month_end, CAST(actual AS DOUBLE) AS actual, CAST(forecast AS DOUBLE) AS forecast FROM k WHERE actual IS NOT NULL OR forecast IS NOT NULL""", dates=('month_end',))
    def job_month_scaffold(spark: SparkSession, d: str) -> DataFrame:
        """All job-months that any fact has, with each fact's value."""
        line = table(spark, d, "lineitem").select(F.col("l_partkey").alias("part"), F.last_day(F.to_date("l_shipdate")).alias("month_end"), F.col("l_quantity").cast("decimal(12,2)").alias("q"), "l_returnflag")
        one = lambda f, n: line.filter(F.col("l_returnflag") == f).groupBy("part", "month_end").agg(F.sum("q").alias(n))
        return rounded(R.scaffold(["part", "month_end"], {"actual": one("A", "actual"), "forecast": one("N", "forecast")}))

    # Windows.
    @reg.add(f"""WITH m AS (SELECT l_partkey, last_day(CAST(l_shipdate AS DATE)) AS month_end, sum({REVENUE}) AS amount FROM lineitem GROUP BY ALL)
      SELECT l_partkey, month_end, CAST(amount AS DOUBLE) AS amount, CAST(sum(amount) OVER w AS DOUBLE) AS total, CAST(amount - lag(amount, 1, 0) OVER w AS DOUBLE) AS change, round(CAST(sum(amount) OVER (PARTITION BY l_partkey ORDER BY month_end ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 6, 6) AS before
      FROM m WINDOW w AS (PARTITION BY l_partkey ORDER BY month_end)""", dates=('month_end',))
    def running_windows(spark: SparkSession, d: str) -> DataFrame:
        """Running total, difference to the month before, average of six before."""
        m = table(spark, d, "lineitem").groupBy("l_partkey", F.last_day(F.to_date("l_shipdate")).alias("month_end")).agg(F.sum(F.expr(REVENUE)).alias("amount"))
        m = timeint.running(m, ["l_partkey"], "month_end", "amount", "total")
        m = timeint.previous(m, ["l_partkey"], "month_end", "amount", "change")
        return rounded(timeint.average_of_before(m, ["l_partkey"], "month_end", "amount", 6, "before"), "before")

    @reg.add(f"SELECT o_custkey, CAST(amount AS DOUBLE) AS amount, CAST(dense_rank() OVER (ORDER BY amount DESC) AS INTEGER) AS rank FROM (SELECT o_custkey, sum({money('o_totalprice')}) AS amount FROM orders GROUP BY 1)")
    def rank_customers(spark: SparkSession, d: str) -> DataFrame:
        """Dense rank over all customers, in parts."""
        o = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.expr(money("o_totalprice"))).alias("amount"))
        return rounded(ranked(o, "amount"))

    @reg.add(f"SELECT * FROM (SELECT c_mktsegment, o_custkey, CAST(amount AS DOUBLE) AS amount, CAST(dense_rank() OVER (PARTITION BY c_mktsegment ORDER BY amount DESC) AS INTEGER) AS rank FROM (SELECT c_mktsegment, o_custkey, sum({money('o_totalprice')}) AS amount FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL)) WHERE rank <= 5")
    def top_n_per_group(spark: SparkSession, d: str) -> DataFrame:
        """The five largest of each group, ties included."""
        o = table(spark, d, "orders").join(table(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        o = o.groupBy("c_mktsegment", "o_custkey").agg(F.sum(F.expr(money("o_totalprice"))).alias("amount"))
        return rounded(ranked(o, "amount", ("c_mktsegment",), top=5))

    @reg.add(f"SELECT o_custkey, CAST(amount AS DOUBLE) AS amount, CAST(rank AS INTEGER) AS rank FROM (SELECT *, dense_rank() OVER (ORDER BY amount DESC) AS rank FROM (SELECT o_custkey, sum({money('o_totalprice')}) AS amount FROM orders GROUP BY 1)) WHERE rank <= 10")
    def top_n_overall(spark: SparkSession, d: str) -> DataFrame:
        """The ten largest values' customers."""
        o = table(spark, d, "orders").groupBy("o_custkey").agg(F.sum(F.expr(money("o_totalprice"))).alias("amount"))
        return rounded(ranked(o, "amount", top=10))

    @reg.add("SELECT p_partkey, p_brand, p_size, p_size = max(p_size) OVER (PARTITION BY p_brand) AS is_current FROM part")
    def group_maximum_flag(spark: SparkSession, d: str) -> DataFrame:
        """Rows that have their group's largest value; ties are all marked."""
        from tidewheel.operators.business.projects import current_of_group

        return current_of_group(table(spark, d, "part").select("p_partkey", "p_brand", "p_size"), ["p_brand"], "p_size")

    # Set operations.
    @reg.add("SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer")
    def union_by_name(spark: SparkSession, d: str) -> DataFrame:
        """Union by column name, missing columns null."""
        s = table(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
        return R.union_all(s, table(spark, d, "customer").select(F.col("c_name").alias("name"), F.col("c_custkey").alias("id"), F.col("c_mktsegment").alias("segment")))

    @reg.add("SELECT s_nationkey AS nation FROM supplier UNION SELECT c_nationkey FROM customer")
    def union_distinct(spark: SparkSession, d: str) -> DataFrame:
        """Distinct values of a union."""
        return table(spark, d, "supplier").select(F.col("s_nationkey").alias("nation")).union(table(spark, d, "customer").select("c_nationkey")).distinct()

    @reg.add("SELECT c_nationkey AS nation, c_mktsegment AS segment FROM customer EXCEPT SELECT c_nationkey, c_mktsegment FROM customer WHERE c_acctbal < -900")
    def except_distinct(spark: SparkSession, d: str) -> DataFrame:
        """Combinations that the other side lacks."""
        c = table(spark, d, "customer").select(F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_acctbal")
        return R.except_rows(c, c.filter("c_acctbal < -900"), ["nation", "segment"])

    @reg.add("SELECT c_nationkey AS nation FROM customer WHERE c_acctbal > 9000 INTERSECT SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000")
    def intersect_distinct(spark: SparkSession, d: str) -> DataFrame:
        """Values on both sides."""
        return table(spark, d, "customer").filter("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation")).intersect(table(spark, d, "supplier").filter("s_acctbal > 5000").select("s_nationkey"))

    @reg.add("SELECT DISTINCT p_brand, p_type FROM part")
    def distinct_rows(spark: SparkSession, d: str) -> DataFrame:
        return table(spark, d, "part").select("p_brand", "p_type").distinct()

    @reg.add("SELECT n_regionkey, string_agg(n_name, ', ' ORDER BY n_name) AS names, count(*) AS n FROM nation GROUP BY 1")
    def text_aggregate(spark: SparkSession, d: str) -> DataFrame:
        """Names of a group as one text, in order."""
        return table(spark, d, "nation").groupBy("n_regionkey").agg(F.expr("listagg(n_name, ', ') WITHIN GROUP (ORDER BY n_name)").alias("names"), F.count("*").alias("n"))

    @reg.add(f"""WITH {SALES}, r AS (SELECT segment, nation, sum(revenue) AS revenue, count(*) AS n, grouping(segment) AS a, grouping(nation) AS b FROM s GROUP BY ROLLUP (segment, nation))
      SELECT segment, nation, CAST(revenue AS DOUBLE) AS revenue, n, CAST(2 - a - b AS INTEGER) AS level FROM r""")
    def matrix_subtotals(spark: SparkSession, d: str) -> DataFrame:
        """Row totals of every level in one pass."""
        return rounded(R.subtotals(sales(spark, d), ["segment", "nation"], {"revenue": F.sum("revenue"), "n": F.count("*")}))

    @reg.add(f"SELECT l_partkey, CAST(q AS DOUBLE) AS q, CAST(x AS DOUBLE) AS x FROM (SELECT l_partkey, sum(CASE WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN CAST(l_tax AS DECIMAL(4,2)) END) AS q, sum(CASE WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN {REVENUE} END) AS x FROM lineitem GROUP BY 1) WHERE coalesce(q, 0) <> 0 OR coalesce(x, 0) <> 0")
    def drop_zero_rows(spark: SparkSession, d: str) -> DataFrame:
        """Rows in which all measures are zero or null go: parts with neither tax on a sixth line of stream A nor revenue on a seventh of stream R."""
        one = lambda stream, number, value: F.sum(F.when((F.col("l_returnflag") == stream) & (F.col("l_linenumber") == number), value))
        part = table(spark, d, "lineitem").groupBy("l_partkey").agg(one("A", 6, F.col("l_tax").cast("decimal(4,2)")).alias("q"), one("R", 7, F.expr(REVENUE)).alias("x"))
        return rounded(R.without_zero_rows(part, "q", "x"))

    @reg.add("SELECT c_custkey, trim(c_name) AS c_name, c_mktsegment, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM customer WHERE c_acctbal IS NOT NULL")
    def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
        """The table written by the CSV sink and read back with a declared schema."""
        path = shared_folder(spark)
        write_csv(table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal").filter("c_acctbal is not null"), path)
        return csv_table(spark, path, "c_custkey bigint, c_name string, c_mktsegment string, c_acctbal double").withColumn("c_name", F.trim("c_name"))

    @reg.add("SELECT c_nationkey, c_mktsegment, count(*) AS n FROM customer GROUP BY ALL")
    def parquet_sink(spark: SparkSession, d: str) -> DataFrame:
        """Counts over a table that the partitioned Parquet sink wrote."""
        path = shared_folder(spark)
        write_parquet(table(spark, d, "customer").select("c_nationkey", "c_mktsegment"), path, ["c_mktsegment"])
        kinds = dict(table(spark, d, "customer").dtypes)
        rows = spark.read.schema(f"c_nationkey {kinds['c_nationkey']}, c_mktsegment string").parquet(path)
        return rows.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"))

    @reg.add("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, o_orderpriority, o_orderstatus = 'F' AS finished FROM orders", dates=("o_orderdate",))
    def workbook_round_trip(spark: SparkSession, d: str) -> DataFrame:
        """The orders as spreadsheet workbooks, and read back with a declared schema."""
        path = shared_folder(spark)
        write_workbooks(table(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("o_orderdate"), F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice"), "o_orderpriority", (F.col("o_orderstatus") == "F").alias("finished")), path, sheet="Orders")
        return rounded(workbook_table(spark, path, "o_orderkey bigint, o_orderdate date, o_totalprice decimal(12,2), o_orderpriority string, finished boolean", table="Orders"))

    @reg.add("SELECT c_nationkey, c_mktsegment, count(*) AS n, CAST(sum(CAST(c_acctbal AS DECIMAL(12,2))) AS DOUBLE) AS balance FROM customer WHERE c_custkey > 10 AND c_mktsegment <> 'BUILDING' GROUP BY ALL")
    def warehouse_scan(spark: SparkSession, d: str) -> DataFrame:
        """Customers in a SQL warehouse (tidewheel.warehouse.url, else one in this process's memory), scanned in ranges of their
        key; filters and columns are the warehouse's work."""
        url = spark.conf.get("tidewheel.warehouse.url", None)
        if url is None:
            spark._jvm.java.lang.System.setProperty("derby.stream.error.file", "/dev/null")  # else it logs into the working folder
            url = "jdbc:derby:memory:tidewheel;create=true"
        rows = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", F.col("c_acctbal").cast("decimal(12,2)").alias("c_acctbal"))
        write_warehouse(rows, url, "tidewheel_customer", types="c_mktsegment VARCHAR(40)")
        scan = warehouse_table(spark, url, "tidewheel_customer", key="c_custkey", parts=8).filter("c_custkey > 10 AND c_mktsegment <> 'BUILDING'")
        return rounded(scan.groupBy("c_nationkey", "c_mktsegment").agg(F.count("*").alias("n"), F.sum("c_acctbal").alias("balance")))

    @reg.add("SELECT p_partkey, replace(replace(replace(replace(replace(CASE p_partkey % 3 WHEN 0 THEN '<' || p_name || '>' WHEN 1 THEN p_type || ' #' || p_size || ' 100%' ELSE '\"' || p_brand || '\"' END, '%', '%25'), '#', '%23'), '<', '%3C'), '>', '%3E'), '\"', '%22') AS encoded FROM part")
    def percent_encoding(spark: SparkSession, d: str) -> DataFrame:
        """Labels made safe for a data URI."""
        kind = F.col("p_partkey") % 3
        label = F.when(kind == 0, F.concat(F.lit("<"), "p_name", F.lit(">"))).when(kind == 1, F.concat("p_type", F.lit(" #"), F.col("p_size").cast("string"), F.lit(" 100%"))).otherwise(F.concat(F.lit('"'), "p_brand", F.lit('"')))
        return table(spark, d, "part").select("p_partkey", T.percent_encoded(label).alias("encoded"))

    @reg.add("SELECT s_suppkey, s_nationkey, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS DOUBLE) AS s_acctbal FROM supplier")
    def json_round_trip(spark: SparkSession, d: str) -> DataFrame:
        """The suppliers as JSON lines, and read back with a declared schema."""
        path = shared_folder(spark)
        table(spark, d, "supplier").select("s_suppkey", "s_nationkey", F.col("s_acctbal").cast("decimal(12,2)").alias("s_acctbal")).write.json(path)
        kinds = dict(table(spark, d, "supplier").dtypes)
        return rounded(json_table(spark, path, f"s_suppkey {kinds['s_suppkey']}, s_nationkey {kinds['s_nationkey']}, s_acctbal decimal(12,2)"))
