"""The domain computations, on the star schema of the test tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewheel.functions import divide, fiscal_month, fiscal_year, fmt
from tidewheel.functions.text import trend
from tidewheel.operators import charts
from tidewheel.operators.business import ledger as L
from tidewheel.operators.business import margin as M
from tidewheel.operators.business import projects as P
from tidewheel.operators.business import retention as R
from tidewheel.operators.joins import blended
from tidewheel.queries.base import ANCHOR, AS_OF, REVENUE, SALES, Registry, double, fy, money, ratio, rounded, sales, table

#: The days of the current and the prior twelve months.
WINDOWS = (dt.date(1999, 8, 1), ANCHOR)
WINDOW = "SELECT {keys}, sum(revenue) FILTER (WHERE d > DATE '2000-07-31' AND d <= DATE '2001-07-31') AS cy, sum(revenue) FILTER (WHERE d > DATE '1999-07-31' AND d <= DATE '2000-07-31') AS py FROM s WHERE d > DATE '1999-07-31' AND d <= DATE '2001-07-31' GROUP BY ALL"
MOVES = "CASE WHEN p > 0 THEN p ELSE 0 END AS base, CASE WHEN p > 0 AND c = 0 THEN p ELSE 0 END AS churn, CASE WHEN p > 0 AND c > 0 AND c < p THEN p - c ELSE 0 END AS contraction, CASE WHEN p > 0 AND c > p THEN c - p ELSE 0 END AS upsell"
EACH = "each AS (SELECT *, coalesce(cy, 0) AS c, coalesce(py, 0) AS p FROM w)"
SUMS = "sum(base) AS base, sum(churn) AS churn, sum(contraction) AS contraction, sum(upsell) AS upsell"


def jobs(spark: SparkSession, d: str) -> DataFrame:
    """Part by month: actual (cost), forecast, change orders, contract, billed."""
    s = sales(spark, d, "l_tax", "l_extendedprice", "l_linestatus")
    change = F.round(F.expr("CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))"), 2)
    out = s.groupBy("l_partkey", F.last_day("d").alias("month_end")).agg(F.sum(F.when(F.col("l_linestatus") == "F", F.col("cost"))).alias("actual"), F.sum("cost").alias("forecast"), F.sum(F.when(F.col("stream") == "R", change)).alias("change"), F.sum("revenue").alias("billed"))
    return out.withColumn("contract", F.when(F.col("l_partkey") % 3 != 0, F.col("l_partkey") * 100 + 50000).cast("decimal(18,2)"))


JOBS = f"""{SALES}, jobs AS (SELECT l_partkey, last_day(d) AS month_end, sum(cost) FILTER (WHERE l_linestatus = 'F') AS actual, sum(cost) AS forecast,
    sum(round(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)), 2)) FILTER (WHERE stream = 'R') AS change, sum(revenue) AS billed, CASE WHEN l_partkey % 3 <> 0 THEN l_partkey * 100 + 50000 END AS contract
  FROM s GROUP BY ALL)"""
EARNED = """e AS (SELECT *, CASE WHEN round(f, 2) <> 0 THEN least(CAST(a AS DOUBLE) / CAST(round(f, 2) AS DOUBLE), 1.0) * CAST(contract + x AS DOUBLE) END AS earned
  FROM (SELECT *, sum(coalesce(actual, 0)) OVER w AS a, sum(coalesce(forecast, 0)) OVER w AS f, sum(coalesce(change, 0)) OVER w AS x FROM jobs WINDOW w AS (PARTITION BY l_partkey ORDER BY month_end)))"""


def register(reg: Registry) -> None:
    streams = {"A": "first", "N": "second", "R": "third"}

    @reg.add(f"WITH {SALES} SELECT segment, {', '.join(double(f'sum(revenue) FILTER (WHERE stream = {chr(39)}{k}{chr(39)})', v) for k, v in streams.items())}, {double('sum(revenue)', 'revenue')}, {double('sum(cost)', 'cost')}, {double('sum(revenue) - sum(cost)', 'gp')}, {ratio('sum(revenue) - sum(cost)', 'sum(revenue)', 'gp_pct')} FROM s WHERE d < DATE '2001-08-01' GROUP BY 1")
    def b1_margin_by_stream(spark: SparkSession, d: str) -> DataFrame:
        """Revenue by stream, cost and margin of completed months."""
        return rounded(M.by_stream(sales(spark, d, shipped=(None, ANCHOR)), ["segment"], "stream", streams), "gp_pct")

    @reg.add(f"""WITH {SALES}, w AS ({WINDOW.format(keys='customer, segment')}), {EACH}, m AS (SELECT segment, c, p, {MOVES} FROM each), t AS (SELECT segment, {SUMS}, count(*) FILTER (WHERE p > 0) AS logos, count(*) FILTER (WHERE p > 0 AND c = 0) AS logos_lost FROM m GROUP BY 1)
      SELECT segment, {', '.join(double(c, c) for c in ('base', 'churn', 'contraction', 'upsell'))}, logos, logos_lost, {ratio('base - churn - contraction + upsell', 'base', 'nrr')}, {ratio('base - churn - contraction', 'base', 'grr')}, {ratio('logos - logos_lost', 'logos', 'logo_retention')} FROM t""")
    def b2_retention(spark: SparkSession, d: str) -> DataFrame:
        """Rolling-twelve-month retention, both windows in one pass."""
        return rounded(R.retention(sales(spark, d, shipped=WINDOWS), "customer", ["segment"], "revenue", ANCHOR), "nrr", "grr", "logo_retention")

    @reg.add(f"WITH {SALES}, w AS ({WINDOW.format(keys='segment')}), {EACH} SELECT segment, {double('cy', 'cy')}, {double('py', 'py')}, {', '.join(x.replace(' AS ', ' AS DOUBLE) AS ').replace('CASE', 'CAST(CASE', 1) for x in MOVES.split(', '))} FROM each")
    def b2_retention_single_grain(spark: SparkSession, d: str) -> DataFrame:
        """The same movements of totals, where gains and losses offset each other."""
        return rounded(R.retention_single_grain(sales(spark, d, shipped=WINDOWS), ["segment"], "revenue", ANCHOR))

    @reg.add(f"""WITH {SALES}, w AS ({WINDOW.format(keys='customer')}), {EACH} SELECT customer, {double('cy', 'cy')}, {double('py', 'py')},
      CASE WHEN p > 0 AND c = 0 THEN 'Churned' WHEN p = 0 AND c > 0 THEN 'New Business' WHEN p > 0 AND c < p THEN 'Contraction' WHEN p > 0 AND c > p THEN 'Upsell' WHEN p > 0 THEN 'Steady' END AS category FROM each""")
    def b4_retention_category(spark: SparkSession, d: str) -> DataFrame:
        """Each customer's category."""
        return rounded(R.current_and_prior(sales(spark, d, shipped=WINDOWS), ["customer"], "revenue", ANCHOR).withColumn("category", R.category()))

    @reg.add(f"""WITH {SALES}, w AS ({WINDOW.format(keys='customer')}), {EACH}, t AS (SELECT {SUMS} FROM (SELECT {MOVES} FROM each))
      SELECT CAST(step AS INTEGER) AS step, label, {double('amount', 'amount')} FROM t, LATERAL (VALUES (1, 'Base', base), (2, 'Churn', -churn), (3, 'Contraction', -contraction), (4, 'Upsell', upsell), (5, 'Retained', base - churn - contraction + upsell)) v(step, label, amount)""")
    def b5_waterfall(spark: SparkSession, d: str) -> DataFrame:
        """The movements as ordered, signed steps."""
        return rounded(R.waterfall(R.retention(sales(spark, d, shipped=WINDOWS), "customer", [], "revenue", ANCHOR)))

    @reg.add("""WITH l AS (SELECT c_custkey AS customer, max(CAST(o_orderdate AS DATE)) FILTER (WHERE o_totalprice <> 0) AS last_date FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1), m AS (SELECT *, (2001 - year(last_date)) * 12 + 8 - month(last_date) AS months FROM l)
      SELECT customer, last_date, CAST(months AS INTEGER) AS months, CASE WHEN last_date IS NULL THEN 'No Activity' WHEN months < 6 THEN 'Active' WHEN months < 12 THEN 'Dormant (6–11 mo)' ELSE 'Inactive (12+ mo)' END AS status FROM m""", dates=('last_date',))
    def b6_lifecycle(spark: SparkSession, d: str) -> DataFrame:
        """Status by the months since the last billing; customers without any are there."""
        o = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderdate")
        rows = table(spark, d, "customer").select(F.col("c_custkey").alias("customer")).join(o, F.col("customer") == F.col("o_custkey"), "left")
        return R.lifecycle(rows, "customer", "o_totalprice", "o_orderdate", AS_OF)

    @reg.add(f"""WITH {SALES}, a AS (SELECT segment, sum(revenue) FILTER (WHERE d BETWEEN DATE '2000-10-01' AND DATE '2001-08-15') AS cy, sum(revenue) FILTER (WHERE d BETWEEN DATE '1999-10-01' AND DATE '2000-08-15') AS py FROM s GROUP BY 1), b AS (SELECT *, CAST(cy - py AS DOUBLE) / CAST(py AS DOUBLE) AS yoy FROM a)
      SELECT segment, {double('cy', 'cy')}, {double('py', 'py')}, round(yoy, 6) AS yoy, CASE WHEN yoy > 0 THEN '▲' WHEN yoy < 0 THEN '▼' ELSE '▬' END || chr(8199) || CAST(CAST(round(abs(CAST(yoy AS DECIMAL(28,8))) * 100, 1) AS DECIMAL(28,1)) AS VARCHAR) || '%' AS glyph FROM b""")
    def b7_year_to_date(spark: SparkSession, d: str) -> DataFrame:
        """Fiscal year to date against the same days of the year before, with the trend as text."""
        day = F.col("d")
        s = sales(spark, d, shipped=(dt.date(1999, 10, 1), AS_OF))
        every = table(spark, d, "customer").select(F.col("c_mktsegment").alias("segment")).distinct()  # segments without a line in either window are there too
        s = s.groupBy("segment").agg(F.sum(F.when(day.between("2000-10-01", "2001-08-15"), F.col("revenue"))).alias("cy"), F.sum(F.when(day.between("1999-10-01", "2000-08-15"), F.col("revenue"))).alias("py"))
        s = every.join(s, "segment", "left").withColumn("yoy", divide(F.col("cy") - F.col("py"), "py"))
        return rounded(s.withColumn("glyph", trend("yoy")), "yoy")

    @reg.add("""WITH e AS (SELECT event_type, CAST(floor(value) AS BIGINT) % 11 AS score, CASE CAST(floor(value * 100) AS BIGINT) % 3 WHEN 0 THEN 'Yes' WHEN 1 THEN 'no' ELSE 'n/a' END AS answer FROM events), a AS (SELECT event_type, count(*) FILTER (WHERE score >= 9) AS promoters, count(*) FILTER (WHERE score <= 6) AS detractors, count(score) AS answers, count(*) FILTER (WHERE lower(answer) = 'yes') AS y, count(*) FILTER (WHERE lower(answer) = 'no') AS n FROM e GROUP BY 1)
      SELECT event_type, promoters, detractors, answers, round(CAST(promoters - detractors AS DOUBLE) / answers * 100, 6) AS nps, round(CAST(y AS DOUBLE) / (y + n), 6) AS on_time FROM a""")
    def b8_promoter_score(spark: SparkSession, d: str) -> DataFrame:
        """Promoter score and the share of yes."""
        answer = F.when(F.floor(F.col("value") * 100) % 3 == 0, "Yes").when(F.floor(F.col("value") * 100) % 3 == 1, "no").otherwise("n/a")
        e = table(spark, d, "events").select("event_type", (F.floor("value") % 11).alias("score"), answer.alias("answer"))
        return rounded(R.promoter_score(e, ["event_type"], "score").join(R.yes_share(e, ["event_type"], F.col("answer"), "on_time"), "event_type"), "nps", "on_time")

    def floor_sql(rows: str) -> str:
        return f"""WITH {SALES}, r AS ({rows}), f AS (SELECT *, round(round(CAST(CAST(gp AS DOUBLE) / nullif(CAST(sell AS DOUBLE), 0) AS DECIMAL(28,10)), 3), 2) AS pct FROM r), a AS (SELECT segment, count(*) AS n, count(*) FILTER (WHERE pct < 0.32) AS n_below, count(*) FILTER (WHERE pct >= 0.32) AS n_above, sum(sell) AS sell, sum(gp) AS gp, sum(CASE WHEN pct < 0.32 THEN sell ELSE 0 END) AS sell_below, sum(CASE WHEN pct >= 0.32 THEN sell ELSE 0 END) AS sell_above,
          sum(CASE WHEN pct < 0.32 THEN greatest(sell * 0.32 - gp, 0) ELSE 0 END) AS shortfall FROM f GROUP BY 1)
          SELECT segment, n, n_below, n_above, {', '.join(double(c, c) for c in ('sell', 'gp', 'sell_below', 'sell_above', 'shortfall'))}, {ratio('n_below', 'n', 'share_below')}, {ratio('gp', 'sell', 'gp_pct')}, round(CAST(gp AS DOUBLE) / CAST(sell AS DOUBLE) - 0.32, 6) AS gap, {double('gp + shortfall', 'simulated_gp')}, {ratio('gp + shortfall', 'sell', 'simulated_pct')} FROM a"""

    @reg.add(floor_sql("SELECT segment, revenue AS sell, revenue - cost AS gp FROM s"))
    def b9_floor_by_row(spark: SparkSession, d: str) -> DataFrame:
        """The margin floor decided row by row."""
        s = sales(spark, d).select("segment", F.col("revenue").alias("sell"), (F.col("revenue") - F.col("cost")).alias("gp"))
        return rounded(M.floor_impact(s, ["segment"]), "share_below", "gp_pct", "gap", "simulated_pct")

    @reg.add(floor_sql("SELECT segment, l_orderkey, sum(revenue) AS sell, sum(revenue - cost) AS gp FROM s GROUP BY ALL"))
    def b9_floor_by_booking(spark: SparkSession, d: str) -> DataFrame:
        """The margin floor decided per booking (order)."""
        s = sales(spark, d).groupBy("segment", "l_orderkey").agg(F.sum("revenue").alias("sell"), F.sum(F.col("revenue") - F.col("cost")).alias("gp"))
        return rounded(M.floor_impact(s, ["segment"]), "share_below", "gp_pct", "gap", "simulated_pct")

    @reg.add(f"WITH {SALES}, y AS (SELECT segment, CAST({fy()} AS INTEGER) AS year, sum(revenue) AS revenue FROM s GROUP BY ALL) SELECT y.segment, y.year, {double('y.revenue', 'revenue')}, {double('b.revenue', 'baseline')}, {double('y.revenue - b.revenue', 'variance')}, {ratio('y.revenue - b.revenue', 'b.revenue', 'variance_pct')} FROM y LEFT JOIN y b ON y.segment = b.segment AND b.year = 1998")
    def b9_baseline_year(spark: SparkSession, d: str) -> DataFrame:
        """Every year against a baseline year."""
        s = sales(spark, d).groupBy("segment", fiscal_year("d").alias("year")).agg(F.sum("revenue").alias("revenue"))
        return rounded(M.against_baseline(s, ["segment"], "year", "revenue", 1998), "variance_pct")

    @reg.add(f"WITH {JOBS}, {EARNED} SELECT l_partkey, month_end, round(earned, 4) AS earned, round(CAST(CASE WHEN earned IS NOT NULL THEN earned - coalesce(lag(earned) OVER (PARTITION BY l_partkey ORDER BY month_end), 0) END AS DOUBLE), 4) AS earned_month FROM e", dates=('month_end',))
    def b10_earned_revenue(spark: SparkSession, d: str) -> DataFrame:
        """Percent-complete revenue, cumulative and by month."""
        out = P.earned_revenue(jobs(spark, d), "l_partkey", "month_end", "actual", "forecast", "change", "contract")
        return out.select("l_partkey", "month_end", F.round("earned", 4).alias("earned"), F.round("earned_month", 4).alias("earned_month"))

    @reg.add(f"""WITH {JOBS}, j AS (SELECT l_partkey, sum(actual) AS actual, sum(forecast) AS forecast, max(contract) AS contract FROM jobs GROUP BY 1), k AS (SELECT *, round(CAST(CAST(actual AS DOUBLE) / nullif(CAST(forecast AS DOUBLE), 0) AS DECIMAL(28,10)), 4) AS share FROM j)
      SELECT l_partkey, {double('actual', 'actual')}, {double('forecast', 'forecast')}, {double('contract', 'contract')}, {double('share', 'share')}, round(CAST(contract AS DOUBLE) * CAST(share AS DOUBLE), 4) AS earned, CASE WHEN share IS NOT NULL THEN CAST(least(share, 1) AS DOUBLE) END AS complete FROM k""")
    def b11_earned_uncapped(spark: SparkSession, d: str) -> DataFrame:
        """The variant by job, rounded and not capped."""
        out = rounded(P.earned_uncapped(jobs(spark, d), "l_partkey", "actual", "forecast", "contract"))
        return out.withColumn("earned", F.round("earned", 4))

    @reg.add(f"WITH {JOBS} SELECT l_partkey, month_end, CAST(over_under AS DOUBLE) AS over_under, over_under < 0 AS is_under FROM (SELECT *, sum(coalesce(billed, 0)) OVER w - sum(coalesce(forecast, 0)) OVER w AS over_under FROM jobs WINDOW w AS (PARTITION BY l_partkey ORDER BY month_end))", dates=('month_end',))
    def b12_over_under_billing(spark: SparkSession, d: str) -> DataFrame:
        """Cumulative billings less cumulative cost."""
        return rounded(P.billing_position(jobs(spark, d), "l_partkey", "month_end", "billed", "forecast").select("l_partkey", "month_end", "over_under", "is_under"))

    CONTRACTS = "SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS a, CAST(max(o_orderdate) AS DATE) AS b, sum(CAST(o_totalprice AS DECIMAL(12,2))) AS amount FROM orders WHERE o_orderstatus = 'F' GROUP BY 1"

    @reg.add(f"""WITH c AS ({CONTRACTS}), m AS (SELECT *, (year(b) - year(a)) * 12 + month(b) - month(a) + 1 AS months, (2001 - year(a)) * 12 + 8 - month(a) + 1 AS e FROM c)
      SELECT o_custkey, CAST(months AS INTEGER) AS months, CAST(least(greatest(e, 0), months) AS INTEGER) AS elapsed, round(CAST(amount AS DOUBLE) / months * least(greatest(e, 0), months), 2) AS recognised FROM m""")
    def b13_recognised(spark: SparkSession, d: str) -> DataFrame:
        """A contract's value over its months, up to a date."""
        o = table(spark, d, "orders").filter("o_orderstatus = 'F'").groupBy("o_custkey").agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"), F.sum(F.expr(money("o_totalprice"))).cast("double").alias("amount"))
        return P.recognised(o, "a", "b", "amount", AS_OF).select("o_custkey", "months", "elapsed", F.round(F.col("recognised").cast("double"), 2).alias("recognised"))

    @reg.add(f"""WITH c AS ({CONTRACTS}), m AS (SELECT *, (year(b) - year(a)) * 12 + month(b) - month(a) + 1 AS months FROM c)
      SELECT o_custkey, CAST(last_day(t) AS DATE) AS month_end, round(CAST(amount AS DOUBLE) / months, 2) AS amount FROM (SELECT *, unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS t FROM m)""", dates=('month_end',))
    def b14_straight_line(spark: SparkSession, d: str) -> DataFrame:
        """Billings spread evenly from the first to the last month."""
        o = table(spark, d, "orders").filter("o_orderstatus = 'F'").select("o_custkey", "o_orderdate", F.expr(money("o_totalprice")).alias("amount"))
        o = o.groupBy("o_custkey", "o_orderdate").agg(F.sum("amount").alias("amount"))
        out = P.straight_line(o, ["o_custkey"], "o_orderdate", "amount")
        return out.select("o_custkey", "month_end", F.round(F.col("amount").cast("double"), 2).alias("amount"))

    BACKLOG = f"""{JOBS}, j AS (SELECT l_partkey, max(contract) AS contract, sum(actual) AS revenue, sum(change) AS cost, sum(forecast) AS estimate, max(month_end) + CAST(l_partkey % 9 AS INTEGER) * 30 AS e FROM jobs GROUP BY 1),
      k AS (SELECT l_partkey, coalesce(contract, 0) - coalesce(revenue, 0) AS backlog, greatest(coalesce(estimate, 0) - coalesce(cost, 0), 0) AS cost_left, (year(e) - 2001) * 12 + month(e) - 8 AS months_left FROM j)"""

    @reg.add(f"""WITH {BACKLOG} SELECT l_partkey, {double('backlog', 'backlog')}, {double('backlog - cost_left', 'backlog_gp')}, CAST(months_left AS INTEGER) AS months_left,
      round(CASE WHEN backlog <= 0 THEN 0 WHEN months_left IS NULL OR months_left <= 2 THEN CAST(backlog AS DOUBLE) WHEN CAST(backlog AS DOUBLE) <= CAST(backlog AS DOUBLE) / nullif(months_left, 0) * 1.25 THEN CAST(backlog AS DOUBLE) ELSE CAST(backlog AS DOUBLE) / nullif(months_left, 0) END, 4) AS burn FROM k""")
    def b15_backlog(spark: SparkSession, d: str) -> DataFrame:
        """Backlog and how fast it burns."""
        j = jobs(spark, d).groupBy("l_partkey").agg(F.max("contract").alias("contract"), F.sum("actual").alias("revenue"), F.sum("change").alias("cost"), F.sum("forecast").alias("estimate"), F.max("month_end").alias("e"))
        j = j.withColumn("e", F.date_add("e", ((F.col("l_partkey") % 9) * 30).cast("int")))
        out = P.backlog(j, "contract", "revenue", "cost", "estimate", "e", AS_OF)
        return rounded(out.select("l_partkey", "backlog", "backlog_gp", "months_left", F.round("burn", 4).alias("burn")))

    CLASS = "CASE WHEN a BETWEEN 0 AND 399 THEN 'Balance' WHEN a BETWEEN 400 AND 999 THEN 'Revenue' WHEN a BETWEEN 1000 AND 1599 THEN 'Cost of Sales' WHEN a BETWEEN 1600 AND 1899 THEN 'Expense' ELSE 'Other' END"

    @reg.add(f"""WITH {SALES}, p AS (SELECT segment, {CLASS} AS kind, CASE WHEN a BETWEEN 400 AND 999 THEN -revenue ELSE cost END AS bal FROM (SELECT *, l_partkey % 2000 AS a FROM s)), t AS (SELECT segment, -sum(bal) FILTER (WHERE kind = 'Revenue') AS revenue, sum(bal) FILTER (WHERE kind = 'Cost of Sales') AS cost_of_sales, sum(bal) FILTER (WHERE kind = 'Expense') AS expense FROM p GROUP BY 1)
      SELECT segment, {double('revenue', 'revenue')}, {double('cost_of_sales', 'cost_of_sales')}, {double('expense', 'expense')}, {double('coalesce(revenue, 0) - coalesce(cost_of_sales, 0)', 'gross_profit')}, {ratio('coalesce(revenue, 0) - coalesce(cost_of_sales, 0)', 'revenue', 'gross_pct')}, {double('coalesce(revenue, 0) - coalesce(cost_of_sales, 0) - coalesce(expense, 0)', 'net')} FROM t""")
    def b16_profit_and_loss(spark: SparkSession, d: str) -> DataFrame:
        """Ledger classes by account number, then the statement."""
        s = sales(spark, d).withColumn("a", F.col("l_partkey") % 2000).withColumn("kind", M.account_class(F.col("a")))
        s = s.withColumn("bal", F.when(F.col("a").between(400, 999), -F.col("revenue")).otherwise(F.col("cost")))
        return rounded(M.profit_and_loss(s, ["segment"], "kind", "bal"), "gross_pct")

    @reg.add(f"""WITH {SALES}, a AS (SELECT segment, sum(revenue) AS v FROM s WHERE {fy()} = 2001 GROUP BY 1), b AS (SELECT segment, sum(revenue) AS v FROM s WHERE {fy()} = 2000 AND segment <> 'BUILDING' GROUP BY 1)
      SELECT coalesce(a.segment, b.segment) AS segment, {double('a.v', 'actual')}, {double('b.v', 'budget')}, {double('coalesce(a.v, 0) - coalesce(b.v, 0)', 'variance')}, {ratio('coalesce(a.v, 0) - coalesce(b.v, 0)', 'b.v', 'variance_pct')} FROM a FULL JOIN b ON a.segment = b.segment""")
    def b16_budget(spark: SparkSession, d: str) -> DataFrame:
        """Actual against budget, either side may lack a row."""
        s = sales(spark, d).withColumn("fy", fiscal_year("d"))
        one = lambda y, n: s.filter(F.col("fy") == y).groupBy("segment").agg(F.sum("revenue").alias(n))
        return rounded(M.budget_variance(one(2001, "actual"), one(2000, "budget").filter("segment <> 'BUILDING'"), ["segment"]), "variance_pct")

    @reg.add(f"""WITH {SALES}, u AS (SELECT customer, last_day(d) AS month_end, 'shipped' AS m, revenue AS a FROM s UNION ALL SELECT customer, last_day(created), 'ordered', revenue FROM s UNION ALL SELECT customer, last_day(d), 'cost', cost FROM s), p AS (SELECT customer, month_end, sum(a) FILTER (WHERE m = 'shipped') AS shipped, sum(a) FILTER (WHERE m = 'ordered') AS ordered, sum(a) FILTER (WHERE m = 'cost') AS cost FROM u GROUP BY ALL)
      SELECT customer, month_end, {double('shipped', 'shipped')}, {double('ordered', 'ordered')}, {double('cost', 'cost')}, {double('coalesce(ordered, 0) - coalesce(shipped, 0)', 'ordered_variance')}, {double('coalesce(cost, 0) - coalesce(shipped, 0)', 'cost_variance')} FROM p""", dates=('month_end',))
    def b17_methods_compared(spark: SparkSession, d: str) -> DataFrame:
        """Methods of recognition by customer and month, and their variances."""
        s = sales(spark, d)
        one = lambda c, v: s.groupBy("customer", F.last_day(c).alias("month_end")).agg(F.sum(v).alias("amount"))
        return rounded(M.methods_compared({"shipped": one("d", "revenue"), "ordered": one("created", "revenue"), "cost": one("d", "cost")}, ["customer", "month_end"]))

    @reg.add("""WITH y AS (SELECT p_partkey % 500 AS contract, p_size % 5 AS year, max(DATE '2000-01-01' + CAST(p_partkey % 1000 AS INTEGER)) AS e FROM part GROUP BY ALL), z AS (SELECT *, max(year) OVER (PARTITION BY contract) AS latest_year, coalesce(e >= DATE '2001-08-15', false) AS is_active FROM y)
      SELECT contract, year, e, latest_year, year = latest_year AS is_latest, is_active, CASE WHEN year = latest_year AND is_active THEN 'Current' WHEN is_active THEN 'Active Prior' WHEN year = latest_year THEN 'Expired' ELSE 'Historical' END AS status FROM z""", dates=('e',))
    def b19_contract_years(spark: SparkSession, d: str) -> DataFrame:
        """Latest year per contract, activity and status."""
        p = table(spark, d, "part").groupBy((F.col("p_partkey") % 500).alias("contract"), (F.col("p_size") % 5).alias("year")).agg(F.max(F.expr("date_add(DATE '2000-01-01', CAST(p_partkey % 1000 AS INT))")).alias("e"))
        return P.contract_years(p, "contract", "year", "e", AS_OF)

    CALLS = "SELECT l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN 'PM' ELSE 'Repair' END AS kind, CAST(o_orderdate AS DATE) AS opened, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS closed, CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END AS billed FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate <= TIMESTAMP '2001-08-15'"

    @reg.add(f"""WITH c AS ({CALLS}), e AS (SELECT *, closed IS NULL AS o, coalesce(closed, DATE '2001-08-15') - opened AS days FROM c)
      SELECT l_suppkey, count(*) AS calls, count(*) FILTER (WHERE o) AS open_calls, count(*) FILTER (WHERE o AND kind = 'PM' AND days > 60) AS late_pm, count(*) FILTER (WHERE o AND kind <> 'PM' AND days > 7) AS late_open, round(avg(days) FILTER (WHERE days >= 0), 6) AS days_open, count(*) FILTER (WHERE billed = 0) AS not_billed FROM e GROUP BY 1""")
    def b20_service_calls(spark: SparkSession, d: str) -> DataFrame:
        """Call counts, lateness, days open."""
        c = table(spark, d, "lineitem").join(table(spark, d, "orders").filter("o_orderdate <= TIMESTAMP '2001-08-15'"), F.col("l_orderkey") == F.col("o_orderkey"))
        c = c.select("l_suppkey", F.when(F.col("l_linenumber") % 3 == 0, "PM").otherwise("Repair").alias("kind"), F.to_date("o_orderdate").alias("opened"), F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("closed"), F.when(F.col("l_returnflag") == "R", 0).otherwise(1).alias("billed"))
        return rounded(P.service_calls(c, ["l_suppkey"], "kind", "opened", "closed", "billed", AS_OF), "days_open")

    TO_DATE = "SELECT l_suppkey, CASE WHEN l_linenumber % 3 = 0 THEN 'PM' ELSE 'Repair' END AS kind, CAST(o_orderdate AS DATE) AS opened, CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END AS closed, CASE WHEN l_linenumber % 4 = 2 THEN 'Billings Forward' ELSE 'Standard' END AS billing, CAST(l_extendedprice AS DECIMAL(12,2)) AS amount FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE o_orderdate < TIMESTAMP '2001-08-16'"

    @reg.add(f"""WITH c AS ({TO_DATE}), e AS (SELECT *, {fy('opened')} AS y FROM c),
      a AS (SELECT l_suppkey, count(*) FILTER (WHERE y = 2001) AS calls, count(*) FILTER (WHERE y = 2000 AND opened < DATE '2000-08-15') AS calls_ly, sum(amount) FILTER (WHERE y = 2001) AS amount, sum(amount) FILTER (WHERE y = 2000 AND opened < DATE '2000-08-15') AS amount_ly FROM e WHERE y = 2001 OR (y = 2000 AND opened < DATE '2000-08-15') GROUP BY 1),
      f AS (SELECT l_suppkey, sum(amount) FILTER (WHERE closed IS NULL AND kind = 'Repair' AND billing = 'Billings Forward') AS forward FROM e GROUP BY 1)
      SELECT l_suppkey, nullif(calls, 0) AS calls, nullif(calls_ly, 0) AS calls_ly, {double('amount', 'amount')}, {double('amount_ly', 'amount_ly')}, {ratio('amount', 'nullif(calls, 0)', 'average')}, {ratio('amount_ly', 'nullif(calls_ly, 0)', 'average_ly')}, {double('forward', 'forward')} FROM f LEFT JOIN a USING (l_suppkey)""")
    def b20_calls_to_date(spark: SparkSession, d: str) -> DataFrame:
        """Calls and amounts of the fiscal year, of the one before up to the same day, and what is billed forward."""
        o = table(spark, d, "orders").filter("o_orderdate < TIMESTAMP '2001-08-16'")
        c = table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
            "l_suppkey", F.when(F.col("l_linenumber") % 3 == 0, "PM").otherwise("Repair").alias("kind"), F.to_date("o_orderdate").alias("opened"), F.when(F.col("l_linestatus") == "F", F.to_date("l_shipdate")).alias("closed"),
            F.when(F.col("l_linenumber") % 4 == 2, "Billings Forward").otherwise("Standard").alias("billing"), F.expr(money("l_extendedprice")).alias("amount"),
        )
        a = P.years_to_date(c, ["l_suppkey"], "opened", 2001, AS_OF, {"calls": F.lit(1), "amount": F.col("amount")})
        f = c.groupBy("l_suppkey").agg(P.billings_forward("kind", "closed", "billing", "amount").alias("forward"))
        out = f.join(a, "l_suppkey", "left").withColumns({"average": divide("amount", "calls"), "average_ly": divide("amount_ly", "calls_ly")})
        return rounded(out.select("l_suppkey", "calls", "calls_ly", "amount", "amount_ly", "average", "average_ly", "forward"), "average", "average_ly")

    @reg.add("""WITH h AS (SELECT l_suppkey, sum(CAST(l_quantity AS DECIMAL(12,2))) AS estimate, sum(CAST(l_quantity AS DECIMAL(12,2))) FILTER (WHERE l_linestatus = 'F') AS actual, count(DISTINCT date_trunc('month', l_shipdate)) FILTER (WHERE l_shipdate < TIMESTAMP '2001-08-01') AS elapsed, count(DISTINCT date_trunc('month', l_shipdate)) AS total FROM lineitem GROUP BY 1)
      SELECT l_suppkey, CAST(estimate AS DOUBLE) AS estimate, CAST(actual AS DOUBLE) AS actual, elapsed, total, CAST(estimate - actual AS DOUBLE) AS remaining, round(CAST(actual AS DOUBLE) / elapsed, 6) AS rate, round(CAST(actual AS DOUBLE) / elapsed * greatest(total - elapsed, 0), 6) AS projected FROM h""")
    def b21_run_rate(spark: SparkSession, d: str) -> DataFrame:
        """Hours left and the projection at the present rate."""
        month = F.trunc("l_shipdate", "month")
        h = table(spark, d, "lineitem").withColumn("q", F.col("l_quantity").cast("decimal(12,2)")).groupBy("l_suppkey").agg(F.sum("q").alias("estimate"), F.sum(F.when(F.col("l_linestatus") == "F", F.col("q"))).alias("actual"), F.count_distinct(F.when(F.col("l_shipdate") < "2001-08-01", month)).alias("elapsed"), F.count_distinct(month).alias("total"))
        return rounded(P.run_rate(h, "estimate", "actual", "elapsed", "total"), "rate", "projected")

    @reg.add(f"""WITH {SALES}, w AS ({WINDOW.format(keys='customer')}), t AS (SELECT customer, sum(revenue) FILTER (WHERE stream = 'A') AS a, sum(revenue) FILTER (WHERE stream = 'N') AS n, sum(revenue) FILTER (WHERE stream = 'R') AS r FROM s WHERE d > DATE '2000-07-31' AND d <= DATE '2001-07-31' GROUP BY 1), j AS (SELECT w.*, coalesce(a, 0) AS a, coalesce(n, 0) AS n, coalesce(r, 0) AS r FROM w LEFT JOIN t ON w.customer = t.customer)
      SELECT customer, CASE WHEN a + n + r <> 0 THEN CASE WHEN a >= n AND a >= r THEN 'a' WHEN n >= r THEN 'n' ELSE 'r' END END AS top_stream, {ratio('greatest(a, n, r)', 'a + n + r', 'concentration')}, round(CAST(cy AS DOUBLE) / nullif(CAST(py AS DOUBLE), 0) - 1, 6) AS momentum FROM j""")
    def b22_mix(spark: SparkSession, d: str) -> DataFrame:
        """Concentration on the largest stream, and momentum."""
        s = sales(spark, d, shipped=WINDOWS)
        now, _ = R.windows(ANCHOR)
        w = R.current_and_prior(s, ["customer"], "revenue", ANCHOR)
        t = s.filter(now).groupBy("customer").agg(*(F.sum(F.when(F.col("stream") == k, F.col("revenue"))).alias(k.lower()) for k in "ANR"))
        return rounded(R.mix(w.join(t, "customer", "left"), "customer", ["a", "n", "r"]), "concentration", "momentum")

    @reg.add(f"""WITH {SALES}, t AS (SELECT 0 AS n, 'lines' AS part, sum({REVENUE}) AS total FROM lineitem UNION ALL SELECT 1, 'joined', sum(revenue) FROM s UNION ALL SELECT 2, 'building', sum(revenue) FROM s WHERE segment = 'BUILDING')
      SELECT CAST(n AS INTEGER) AS n, part, {double('total', 'total')}, {double('total - first_value(total) OVER (ORDER BY n)', 'difference')}, abs(total - first_value(total) OVER (ORDER BY n)) <= 0.005 AS matches FROM t""")
    def b23_reconciliation(spark: SparkSession, d: str) -> DataFrame:
        """Totals at source and destination, and whether they agree."""
        s = sales(spark, d).select("segment", "revenue")
        return rounded(M.reconciled({"lines": table(spark, d, "lineitem").select(F.expr(REVENUE).alias("revenue")), "joined": s, "building": s.filter("segment = 'BUILDING'")}, "revenue"))

    @reg.add(f"""WITH c AS (SELECT o_custkey AS customer, count(*) AS n, sum({money('o_totalprice')}) AS t, max(CAST(o_orderdate AS DATE)) AS m, CAST(count(*) FILTER (WHERE o_orderstatus = 'F') AS DOUBLE) / count(*) AS f FROM orders GROUP BY 1)
      SELECT customer, CAST(line AS INTEGER) AS line, metric, value FROM c, LATERAL (VALUES (1, 'Orders', CAST(n AS VARCHAR)), (2, 'Total', '$' || format('{{:,}}', CAST(round(t) AS BIGINT))), (3, 'Last Order', strftime(m, '%d-%b-%Y')), (4, 'Finished', CASE WHEN f > 0 THEN CAST(CAST(round(CAST(f AS DECIMAL(28,8)) * 100, 1) AS DECIMAL(28,1)) AS VARCHAR) || '%' END)) v(line, metric, value) WHERE value IS NOT NULL""")
    def b24_profile_rows(spark: SparkSession, d: str) -> DataFrame:
        """A customer's metrics of different types as lines of text."""
        o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(F.count("*").alias("n"), F.sum(F.expr(money("o_totalprice"))).alias("t"), F.max(F.to_date("o_orderdate")).alias("m"), (F.sum((F.col("o_orderstatus") == "F").cast("int")) / F.count("*")).alias("f"))
        return M.display_rows(o, "customer", {"Orders": F.col("n").cast("string"), "Total": fmt("t", "$#,0"), "Last Order": fmt("m", "dd-MMM-yyyy"), "Finished": F.when(F.col("f") > 0, fmt("f", "0.0%"))})

    @reg.add("""WITH a AS (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'SERV_GP' ELSE 'MECH_GP' END AS source, CAST(300 + p_partkey % 600 AS VARCHAR) AS a, CAST(10 + p_size AS VARCHAR) AS b, CAST(100 + p_partkey % 877 AS VARCHAR) AS c FROM part), k AS (SELECT *, CAST(floor(CAST(a AS INTEGER) / 100.0) * 100 AS INTEGER) AS h FROM a),
      t AS (SELECT *, CASE h WHEN 300 THEN CASE WHEN a IN ('330', '331', '332') THEN 'REVENUE' ELSE 'COST OF SALES' END WHEN 500 THEN 'OPERATIONS EXPENSE' WHEN 600 THEN 'SALES EXPENSE' WHEN 700 THEN 'G&A EXPENSE' WHEN 800 THEN 'OTHER INCOME & EXPENSE' ELSE 'BROKEN' END AS kind FROM k)
      SELECT p_partkey, kind, CASE WHEN kind = 'COST OF SALES' THEN CASE right(c, 1) WHEN '2' THEN 'EQUIPMENT & MATERIAL' WHEN '3' THEN 'LABOR' WHEN '9' THEN 'BURDEN' WHEN '7' THEN 'SUBCONTRACT' WHEN '0' THEN 'DISCOUNTS' WHEN '6' THEN 'VEHICLE EXPENSE' WHEN '8' THEN 'TAX EXPENSE' END END AS category,
        CASE WHEN source = 'SERV_GP' THEN CASE WHEN left(a, 1) = '3' AND left(c, 1) = '4' THEN 'CERTIFIED' WHEN left(a, 1) = '3' AND left(c, 1) = '7' THEN 'INSPECTION' WHEN left(a, 1) = '3' AND left(c, 1) = '8' THEN 'PROJECT REPAIR'
            WHEN left(a, 1) = '3' AND left(c, 1) = '6' THEN CASE WHEN right(a, 1) = '5' OR right(b, 1) = '5' THEN 'INTERCOMPANY SPOT' WHEN right(b, 1) = '7' THEN 'O&M SPOT' ELSE 'SPOT' END
            WHEN left(c, 1) = '3' THEN CASE WHEN right(b, 1) = '7' THEN 'O&M' WHEN left(a, 1) = '3' THEN 'ASSURED' ELSE 'A' END WHEN left(c, 1) = '5' THEN CASE WHEN right(b, 1) = '7' THEN 'O&M PROJECTS' ELSE 'PROJECTS' END END
          WHEN left(a, 1) = '3' THEN CASE right(b, 1) WHEN '0' THEN 'CONTROLS' WHEN '1' THEN 'DESIGN BUILD' WHEN '2' THEN 'INDUSTRIAL' WHEN '3' THEN 'PERFORMANCE CONTRACT' WHEN '4' THEN 'PLAN SPEC' WHEN '5' THEN 'SPECIAL PROJECT' END END AS market FROM t""")
    def b16_account_classes(spark: SparkSession, d: str) -> DataFrame:
        """Type, cost category and market from the segments of an account number."""
        p, c = table(spark, d, "part"), F.col
        a = p.select("p_partkey", F.when(c("p_partkey") % 3 == 0, "SERV_GP").otherwise("MECH_GP").alias("source"), (300 + c("p_partkey") % 600).cast("string").alias("a"), (10 + c("p_size")).cast("string").alias("b"), (100 + c("p_partkey") % 877).cast("string").alias("c"))
        return a.select("p_partkey", L.account_type(c("a")).alias("kind"), L.cost_category(L.account_type(c("a")), c("c")).alias("category"), L.market(c("source"), c("a"), c("b"), c("c")).alias("market"))

    @reg.add(f"""WITH {SALES}, y AS (SELECT segment, {fy()} AS year, CAST(sum(revenue) AS DOUBLE) AS v, CAST(sum(cost) AS DOUBLE) AS w FROM s GROUP BY ALL), m AS (SELECT *, max(greatest(v, w)) OVER (PARTITION BY segment) AS top, sum(v) OVER (PARTITION BY segment ORDER BY year) AS bar_end FROM y), x AS (SELECT *, ceil(top / pow(10, floor(log10(top)))) * pow(10, floor(log10(top))) AS axis FROM m)
      SELECT segment, CAST(year AS INTEGER) AS year, axis, round(v - w, 2) AS change, round((v - w) / w, 6) AS change_pct, v - w >= 0 AS favourable, round(v / axis * 120, 6) AS bar, round(w / axis * 120, 6) AS base_bar, round(bar_end, 2) AS bar_end, round(bar_end - v, 2) AS bar_start FROM x""")
    def chart_variance_waterfall(spark: SparkSession, d: str) -> DataFrame:
        """Bars, variances and waterfall positions on a round scale per group."""
        y = sales(spark, d).groupBy("segment", fiscal_year("d").alias("year")).agg(F.sum("revenue").cast("double").alias("v"), F.sum("cost").cast("double").alias("w"))
        out = charts.waterfall_positions(charts.scaled_variance(y, ["segment"], "v", "w", 120), ["segment"], "year", "v").drop("v", "w")
        return rounded(out.withColumns({c: F.round(c, 2) for c in ("change", "bar_end", "bar_start")}), "change_pct", "bar", "base_bar")

    YEARS = f"y AS (SELECT segment, CAST({fy()} AS INTEGER) AS year, CAST(sum(revenue) AS DOUBLE) AS v, CAST(sum(cost) AS DOUBLE) AS w FROM s GROUP BY ALL)"

    @reg.add(f"""WITH {SALES}, {YEARS}, g AS (SELECT segment, year, v - w AS change FROM y), c AS (SELECT segment, CAST(rank() OVER (ORDER BY sum(change) DESC) AS INTEGER) AS category_rank FROM g GROUP BY 1), m AS (SELECT greatest(max(change), 0) AS top, least(min(change), 0) AS bottom FROM g)
      SELECT segment, year, round(change, 2) AS change, category_rank, CAST(row_number() OVER (PARTITION BY segment ORDER BY year) AS INTEGER) AS place, year <= 2001 AS is_actual, round((top - greatest(change, 0)) / (top - bottom) * 130, 6) AS bar_from, round(abs(change) / (top - bottom) * 130, 6) AS bar_size FROM g JOIN c USING (segment), m""")
    def chart_small_multiples(spark: SparkSession, d: str) -> DataFrame:
        """The variance of each year as columns, a chart per segment, all on one scale."""
        y = sales(spark, d).groupBy("segment", fiscal_year("d").alias("year")).agg(F.sum("revenue").cast("double").alias("v"), F.sum("cost").cast("double").alias("w"))
        out = charts.small_multiples(y.select("segment", "year", (F.col("v") - F.col("w")).alias("change")), "segment", "year", "change", "change", 2001, 130)
        return rounded(out.withColumn("change", F.round("change", 2)), "bar_from", "bar_size")

    @reg.add(f"""WITH {SALES}, {YEARS}, x AS (SELECT *, max(greatest(v, w)) OVER (PARTITION BY segment) AS top FROM y), b AS (SELECT *, v / top * 90 AS bar, w / top * 90 AS base_bar FROM x)
      SELECT segment, year, round(bar, 6) AS bar, round(base_bar, 6) AS base_bar, round(least(bar, base_bar), 6) AS variance_from, round(greatest(bar, base_bar), 6) AS variance_to, round(v - w, 2) AS change, round((v - w) / w, 6) AS change_pct, v - w >= 0 AS favourable FROM b""")
    def chart_wide_variance(spark: SparkSession, d: str) -> DataFrame:
        """Value, base and the variance between their ends, by year on the scale of the segment's largest."""
        y = sales(spark, d).groupBy("segment", fiscal_year("d").alias("year")).agg(F.sum("revenue").cast("double").alias("v"), F.sum("cost").cast("double").alias("w"))
        top = F.max(F.greatest("v", "w")).over(Window.partitionBy("segment"))
        out = y.withColumn("top", top)
        out = out.select("segment", "year", *(c.alias(n) for n, c in charts.wide_variance(F.col("v"), F.col("w"), F.col("top"), 90).items()))
        return rounded(out.withColumn("change", F.round("change", 2)), "bar", "base_bar", "variance_from", "variance_to", "change_pct")

    @reg.add(f"WITH {SALES}, t AS (SELECT segment, CAST(sum(revenue) AS DOUBLE) AS v FROM s GROUP BY 1), p AS (SELECT segment, v / sum(v) OVER () AS share FROM t) SELECT segment, round(share, 6) AS share, round(sin(2 * pi() * share), 6) AS x, round(-cos(2 * pi() * share), 6) AS y, share > 0.5 AS long FROM p")
    def chart_pie(spark: SparkSession, d: str) -> DataFrame:
        """Arcs of a pie by share of the total."""
        t = sales(spark, d).groupBy("segment").agg(F.sum("revenue").cast("double").alias("v"))
        whole = t.agg(F.sum("v").alias("whole"))
        share = t.crossJoin(whole).select("segment", (F.col("v") / F.col("whole")).alias("share"))  # one row
        return rounded(share.withColumns(charts.pie(F.col("share"))), "share", "x", "y")

    @reg.add(f"WITH {SALES}, t AS (SELECT segment, CAST(sum(revenue) AS DOUBLE) AS v FROM s GROUP BY 1) SELECT segment, round(v, 4) AS v, ceil(v / pow(10, floor(log10(v)))) * pow(10, floor(log10(v))) AS axis FROM t")
    def chart_axis(spark: SparkSession, d: str) -> DataFrame:
        """Round axis maxima for charts."""
        s = sales(spark, d).groupBy("segment").agg(F.sum("revenue").cast("double").alias("v"))
        return s.select("segment", F.round("v", 4).alias("v"), M.axis_maximum(F.col("v")).alias("axis"))

    STATEMENT = """r AS (SELECT segment, stream, sum(revenue) AS r, sum(cost) AS c FROM s GROUP BY ALL), l AS (
        SELECT segment, CASE stream WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS line, '+' AS sign, r AS amount, 'Revenue' AS part, stream AS item FROM r UNION ALL SELECT segment, 3 + CASE stream WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, '-', c, 'Cost', stream FROM r
        UNION ALL SELECT segment, 7, '=', sum(r - c), 'Gross profit', NULL FROM r GROUP BY 1)"""

    @reg.add(f"""WITH {SALES}, {STATEMENT},
      b AS (SELECT *, CASE sign WHEN '-' THEN -amount ELSE amount END AS change, coalesce(sum(CASE sign WHEN '+' THEN amount WHEN '-' THEN -amount ELSE 0 END) OVER (PARTITION BY segment ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l),
      e AS (SELECT segment, part, item, line, sign, amount, CASE WHEN item IS NULL THEN 1 ELSE 2 END AS level, change, CASE sign WHEN '=' THEN 0 ELSE before END AS bar_from, CASE WHEN item IS NULL THEN NULL WHEN sign = '-' THEN arg_max(before, line) OVER (PARTITION BY segment, part) ELSE sum(amount) OVER (PARTITION BY segment, part) END AS marker FROM b),
      u AS (SELECT * FROM e UNION ALL SELECT segment, part, NULL, min(line), min(sign), sum(amount), 1, sum(change), arg_min(before, line), NULL FROM b WHERE item IS NOT NULL GROUP BY segment, part)
      SELECT segment, part, item, CAST(line AS INTEGER) AS line, sign, {double('amount', 'amount')}, level, {double('change', 'change')}, {double('bar_from', 'bar_from')}, {double('marker', 'marker')}, {double('bar_from + change', 'bar_to')} FROM u""")
    def chart_statement_waterfall(spark: SparkSession, d: str) -> DataFrame:
        """A profit statement per segment as a waterfall: streams that add and take away, their subtotals, the sum from zero."""
        r = sales(spark, d).groupBy("segment", "stream").agg(F.sum("revenue").alias("r"), F.sum("cost").alias("c"))
        number = F.when(F.col("stream") == "A", 1).when(F.col("stream") == "N", 2).otherwise(3)
        line = lambda at, sign, amount, part: F.struct(at.alias("line"), F.lit(sign).alias("sign"), F.col(amount).cast("decimal(30,4)").alias("amount"), F.lit(part).alias("part"), F.col("stream").alias("item"))
        items = r.select("segment", F.inline(F.array(line(number, "+", "r", "Revenue"), line(number + 3, "-", "c", "Cost"))))
        total = r.groupBy("segment").agg(F.sum(F.col("r") - F.col("c")).cast("decimal(30,4)").alias("amount")).select("segment", F.lit(7).alias("line"), F.lit("=").alias("sign"), "amount", F.lit("Gross profit").alias("part"), F.lit(None).cast("string").alias("item"))
        return rounded(charts.waterfall_levels(items.unionByName(total), ["segment"], "line", "sign", "amount", "part", "item"))

    @reg.add(f"""WITH {SALES}, y AS (SELECT segment, CAST({fy()} AS INTEGER) AS f, (month(d) + 2) % 12 + 1 AS month, d, revenue FROM s),
      a AS (SELECT segment, month, sum(revenue) FILTER (WHERE f = 2001 AND d < DATE '2001-08-01') AS ac, sum(revenue) FILTER (WHERE f = 2000) AS py, sum(revenue) FILTER (WHERE f = 2001 AND d >= DATE '2001-08-01') AS fc FROM y WHERE f IN (2000, 2001) GROUP BY ALL),
      b AS (SELECT segment, month, CAST(ac AS DOUBLE) AS ac, CAST(py AS DOUBLE) AS py, CAST(py AS DOUBLE) * 1.05 AS pl, CAST(fc AS DOUBLE) AS fc FROM a), c AS (SELECT *, coalesce(ac, fc) AS main, max(greatest(ac, py, pl, fc)) OVER (PARTITION BY segment) AS top FROM b),
      h AS (SELECT *, main / top * 180 AS mh, pl / top * 180 AS ph FROM c)
      SELECT segment, month, CASE WHEN ac IS NOT NULL THEN 'AC' WHEN fc IS NOT NULL THEN 'FC' END AS scenario, round(main, 4) AS main, round(mh, 6) AS main_height, round(180 - mh, 6) AS main_at, round(ph, 6) AS plan_height, round(180 - ph, 6) AS plan_at, round(180 - py / top * 180, 6) AS prior_at, round(least(180 - mh, 180 - ph), 6) AS variance_at, round(abs(ph - mh), 6) AS variance_height, main >= pl AS favourable FROM h""")
    def chart_scenario_columns(spark: SparkSession, d: str) -> DataFrame:
        """Actual, prior year, plan and forecast of each month of the fiscal year, aligned by month, with the variance to plan."""
        months = lambda name, rows, factor=1.0: rows.groupBy("segment", fiscal_month("d").alias("month")).agg((F.sum("revenue").cast("double") * factor).alias(name))
        rows = sales(spark, d, shipped=(dt.date(1999, 10, 1), dt.date(2001, 9, 30)))
        now, before = rows.filter(fiscal_year("d") == 2001), rows.filter(fiscal_year("d") == 2000)
        first_open = AS_OF.replace(day=1)
        scenarios = {"AC": months("AC", now.filter(F.col("d") < F.lit(first_open))), "PY": months("PY", before), "PL": months("PL", before, 1.05), "FC": months("FC", now.filter(F.col("d") >= F.lit(first_open)))}
        out = charts.scenario_columns(scenarios, "month", ["segment"], 180).drop("AC", "PY", "PL", "FC")
        return rounded(out.withColumn("main", F.round("main", 4)), "main_height", "main_at", "plan_height", "plan_at", "prior_at", "variance_at", "variance_height")
