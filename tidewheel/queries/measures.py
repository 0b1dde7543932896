"""Queries through the semantic model: filter context, calculation items, totals, iteration."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.functions import divide
from tidewheel.plans.context import Context
from tidewheel.operators.business.retention import movements
from tidewheel.plans.calcgroup import CalculationGroup, by_items
from tidewheel.plans.measure import Cumulative, Derived, Having, InScope, Iterate, Leaf, Rank, Selected, With, calculated, ordered, query, ranked, share
from tidewheel.plans.model import Model, Relationship
from tidewheel.plans.timeint import Clock, anchor, last_date, latest_of_slicers, sliding
from tidewheel.queries.base import ANCHOR, AS_OF
from tidewheel.queries.base import COST as COST_OF_LINE
from tidewheel.queries.base import SALES, Registry, double, fy, ratio, rounded, star
from tidewheel.sources import choices, literal

REVENUE, COST, LINES = Leaf("line", "sum", "revenue"), Leaf("line", "sum", COST_OF_LINE), Leaf("line", "count")
COMPLETED = {"completed_month": "completed_month"}
CLOCK = Clock("date", AS_OF)
REGION = f"WITH {SALES}, g AS (SELECT s.*, n_name, r_name FROM s JOIN nation ON nation = n_nationkey JOIN region ON n_regionkey = r_regionkey)"


def register(reg: Registry) -> None:
    @reg.add(f"{REGION} SELECT r_name, {double('sum(revenue)', 'revenue')}, {double('sum(cost)', 'cost')}, {double('sum(revenue) - sum(cost)', 'gp')}, {ratio('sum(revenue) - sum(cost)', 'sum(revenue)', 'gp_pct')} FROM g WHERE d < DATE '2001-08-01' GROUP BY 1")
    def measure_margin(spark: SparkSession, d: str) -> DataFrame:
        """Base sums gated by the completed month, their difference and ratio; one scan."""
        r, c = With(REVENUE, keep=COMPLETED), With(COST, keep=COMPLETED)
        return rounded(query(star(spark, d), ["r_name"], {"revenue": r, "cost": c, "gp": r - c, "gp_pct": (r - c) / r}), "gp_pct")

    @reg.add(f"{REGION} SELECT r_name, {double('sum(revenue) FILTER (WHERE stream = $$A$$)', 'a')}, {double('sum(revenue) FILTER (WHERE stream = $$A$$ AND segment = $$BUILDING$$)', 'both')}, {double('sum(revenue) FILTER (WHERE stream = $$N$$)', 'overwritten')} FROM g WHERE stream = 'N' OR stream = 'A' GROUP BY 1".replace("$$", "'"))
    def context_set_and_keep(spark: SparkSession, d: str) -> DataFrame:
        """A filter that overwrites, one that adds, in a sliced report."""
        a = With(REVENUE, set={"l_returnflag": "l_returnflag = 'A'"})
        both = With(a, keep={"c_mktsegment": "c_mktsegment = 'BUILDING'"})
        return rounded(query(star(spark, d), ["r_name"], {"a": a, "both": both, "overwritten": With(REVENUE, set={"l_returnflag": "l_returnflag = 'N'"})}))

    @reg.add(f"{REGION} SELECT r_name, n_name, {double('sum(revenue)', 'revenue')}, {ratio('sum(revenue)', 'sum(sum(revenue)) OVER (PARTITION BY r_name)', 'of_region')}, {ratio('sum(revenue)', 'sum(sum(revenue)) OVER ()', 'of_all')} FROM g GROUP BY r_name, n_name")
    def share_of_total(spark: SparkSession, d: str) -> DataFrame:
        """Shares of the parent's and of the grand total."""
        return rounded(query(star(spark, d), ["r_name", "n_name"], {"revenue": REVENUE, "of_region": share(REVENUE, "n_name"), "of_all": share(REVENUE, "r_name", "n_name")}), "of_region", "of_all")

    @reg.add(f"{REGION} SELECT n_name, {ratio('sum(revenue)', '(SELECT sum(revenue) FROM g WHERE segment = $$BUILDING$$)', 'of_selected')}, {ratio('sum(revenue)', '(SELECT sum(revenue) FROM g)', 'of_all')} FROM g WHERE segment = 'BUILDING' GROUP BY 1".replace("$$", "'"))
    def share_of_selected(spark: SparkSession, d: str) -> DataFrame:
        """Share of what the slicers leave, and of everything."""
        ctx = Context.slicers(c_mktsegment="c_mktsegment = 'BUILDING'")
        return rounded(query(star(spark, d), ["n_name"], {"of_selected": REVENUE / With(REVENUE, outer=True), "of_all": REVENUE / With(REVENUE, clear=True)}, ctx), "of_selected", "of_all")

    @reg.add(f"WITH {SALES} SELECT fiscal_year, {double('sum(revenue)', 'shipped')}, {double('sum(ordered)', 'ordered')} FROM (SELECT {fy()} AS fiscal_year, revenue, NULL AS ordered FROM s UNION ALL SELECT {fy('created')}, NULL, revenue FROM s) GROUP BY 1")
    def inactive_relationship(spark: SparkSession, d: str) -> DataFrame:
        """The same measure by shipping date and, over the inactive edge, by order date."""
        return rounded(query(star(spark, d), ["fiscal_year"], {"shipped": REVENUE, "ordered": With(REVENUE, use=("o_orderdate",))}))

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {double('sum(revenue)', 'revenue')}, count(DISTINCT customer) AS customers, count(*) AS lines FROM s WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3') GROUP BY 1")
    def virtual_relationship(spark: SparkSession, d: str) -> DataFrame:
        """Restriction to the values of a table that has no relationship."""
        brands = literal(spark, "brand string", [("Brand#1",), ("Brand#2",), ("Brand#3",)])
        m = {"revenue": REVENUE, "customers": Leaf("line", "countd", "o_custkey"), "lines": LINES}
        return rounded(query(star(spark, d), ["c_mktsegment"], {k: With(v, among={"p_brand": brands}) for k, v in m.items()}))

    def items(kind: str) -> str:
        now = {"mtd": "d >= DATE '2001-08-01' AND d <= DATE '2001-08-15'", "qtd": "d >= DATE '2001-07-01' AND d <= DATE '2001-08-15'", "ytd": "d >= DATE '2000-10-01' AND d <= DATE '2001-08-15'"}
        before = {k: v.replace("2001-", "2000-").replace("2000-10-01", "1999-10-01") if k != "ytd" else "d >= DATE '1999-10-01' AND d <= DATE '2000-08-15'" for k, v in now.items()}
        part = lambda c, p: f"sum({c}) FILTER (WHERE {p})"
        return ", ".join([*(double(part(kind, p), f"{k}") for k, p in now.items()), *(double(part(kind, p), f"{k}_py") for k, p in before.items())])

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {items('revenue')} FROM s GROUP BY 1")
    def calculation_items(spark: SparkSession, d: str) -> DataFrame:
        """Month, fiscal quarter and fiscal year to date, and the same of the year before."""
        now = {"mtd": CLOCK.mtd(REVENUE), "qtd": CLOCK.qtd(REVENUE), "ytd": CLOCK.ytd(REVENUE)}
        return rounded(query(star(spark, d), ["c_mktsegment"], {**now, **{f"{k}_py": CLOCK.py(m) for k, m in now.items()}}))

    @reg.add(f"""WITH {SALES}, y AS (SELECT {fy()} AS fiscal_year, sum(revenue) AS revenue, sum(revenue - cost) AS gp FROM s GROUP BY 1), k AS (SELECT fiscal_year FROM y UNION SELECT fiscal_year + 1 FROM y)
      SELECT k.fiscal_year, {double('a.revenue', 'revenue')}, {double('b.revenue', 'py')}, {double('coalesce(a.revenue, 0) - coalesce(b.revenue, 0)', 'yoy')}, {ratio('coalesce(a.revenue, 0) - coalesce(b.revenue, 0)', 'b.revenue', 'yoy_pct')}, {double('coalesce(a.gp, 0) - coalesce(b.gp, 0)', 'gp_yoy')}
      FROM k LEFT JOIN y a ON k.fiscal_year = a.fiscal_year LEFT JOIN y b ON k.fiscal_year = b.fiscal_year + 1""")
    def year_over_year(spark: SparkSession, d: str) -> DataFrame:
        """The prior year on the axis of years, and the changes; years with only a prior one stay."""
        gp = REVENUE - COST
        return rounded(query(star(spark, d), ["fiscal_year"], {"revenue": REVENUE, "py": CLOCK.py(REVENUE), "yoy": CLOCK.yoy(REVENUE), "yoy_pct": CLOCK.yoy_pct(REVENUE), "gp_yoy": CLOCK.yoy(gp)}), "yoy_pct")

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {double('sum(revenue) FILTER (WHERE d > DATE $$2000-07-31$$ AND d <= DATE $$2001-07-31$$)', 'r12m')}, {double('sum(revenue) FILTER (WHERE d > DATE $$1999-07-31$$ AND d <= DATE $$2000-07-31$$)', 'r12m_py')}, {double('sum(revenue) FILTER (WHERE d >= DATE $$2000-10-01$$ AND d <= DATE $$2001-07-31$$)', 'fy_as_of')}, {double('sum(revenue) FILTER (WHERE d >= DATE $$1999-10-01$$ AND d <= DATE $$2000-07-31$$)', 'fy_as_of_py')} FROM s GROUP BY 1".replace("$$", "'"))
    def windows_as_of(spark: SparkSession, d: str) -> DataFrame:
        """Rolling twelve months and fiscal year to date at an anchor, with their prior years."""
        return rounded(query(star(spark, d), ["c_mktsegment"], {"r12m": CLOCK.r12m(REVENUE, ANCHOR), "r12m_py": CLOCK.r12m(REVENUE, ANCHOR, 1), "fy_as_of": CLOCK.fy_as_of(REVENUE, ANCHOR), "fy_as_of_py": CLOCK.fy_as_of(REVENUE, ANCHOR, 1)}))

    @reg.add(f"""WITH {SALES}, c AS (SELECT segment, customer, sum(revenue) AS r, sum(revenue - cost) AS g FROM s GROUP BY ALL)
      SELECT segment AS c_mktsegment, count(*) FILTER (WHERE g > 0) AS gaining, {double('sum(CASE WHEN g > 0 THEN r END)', 'gaining_revenue')}, {double('max(r)', 'largest')} FROM c GROUP BY 1""")
    def iterate_customers(spark: SparkSession, d: str) -> DataFrame:
        """Classification per customer, then counts and sums: aggregates of aggregates."""
        parts = {"r": REVENUE, "g": REVENUE - COST}
        m = {"gaining": Iterate(("o_custkey",), parts, "sum(CASE WHEN g > 0 THEN 1 ELSE 0 END)"), "gaining_revenue": Iterate(("o_custkey",), parts, "sum(k)", {"k": "CASE WHEN g > 0 THEN r END"}), "largest": Iterate(("o_custkey",), parts, "max(r)")}
        return rounded(query(star(spark, d), ["c_mktsegment"], m))

    @reg.add(f"""{REGION}, a AS (SELECT r_name, n_name, count(DISTINCT customer) AS customers, {ratio('sum(revenue - cost)', 'sum(revenue)', 'gp_pct')}, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level FROM g GROUP BY ROLLUP (r_name, n_name)) SELECT * FROM a""")
    def totals_non_additive(spark: SparkSession, d: str) -> DataFrame:
        """Distinct counts and ratios at every level, each evaluated at its own."""
        return rounded(query(star(spark, d), ["r_name", "n_name"], {"customers": Leaf("line", "countd", "o_custkey"), "gp_pct": (REVENUE - COST) / REVENUE}, totals=True), "gp_pct")

    @reg.add(f"WITH {SALES} SELECT p_brand, {double('sum(revenue)', 'revenue')}, CAST(dense_rank() OVER (ORDER BY sum(revenue) DESC) AS INTEGER) AS rank FROM s GROUP BY 1 QUALIFY dense_rank() OVER (ORDER BY sum(revenue) DESC) <= 5")
    def top_n_parameter(spark: SparkSession, d: str) -> DataFrame:
        """A field parameter chooses the axis, a what-if parameter the number of ranks."""
        axis = choices({"Brand": "p_brand", "Kind": "p_type"}, "Brand")
        return rounded(ranked(query(star(spark, d), [axis], {"revenue": REVENUE}), "revenue", top=5))

    @reg.add(f"WITH {SALES} SELECT CASE WHEN p.p_size > 40 THEN 'large' ELSE 'other' END AS lane, {double('sum(revenue)', 'revenue')}, {double('min(revenue)', 'least')}, round(CAST(avg(CAST(revenue AS DOUBLE)) AS DOUBLE), 4) AS mean FROM s JOIN part p ON s.l_partkey = p.p_partkey GROUP BY 1")
    def leaf_aggregates(spark: SparkSession, d: str) -> DataFrame:
        """Sum, minimum and mean over a dimension's condition."""
        model = star(spark, d)
        m = {"revenue": REVENUE, "least": Leaf("line", "min", "revenue"), "mean": Leaf("line", "avg", "CAST(revenue AS DOUBLE)")}
        model.tables["part"] = model.tables["part"].withColumn("lane", F.when(F.col("p_size") > 40, "large").otherwise("other"))
        model.home["lane"] = "part"
        out = query(model, ["lane"], m)
        return rounded(out.withColumn("mean", F.round("mean", 4)))

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {double('sum(CASE WHEN stream = $$A$$ THEN revenue WHEN stream = $$R$$ THEN revenue - cost END)', 'routed')} FROM s GROUP BY 1".replace("$$", "'"))
    def selector_routing(spark: SparkSession, d: str) -> DataFrame:
        """A measure that routes by stream, its parts in one scan."""
        a, r = {"l_returnflag": "l_returnflag = 'A'"}, {"l_returnflag": "l_returnflag = 'R'"}
        return rounded(query(star(spark, d), ["c_mktsegment"], {"routed": With(REVENUE, set=a) + (With(REVENUE, set=r) - With(COST, set=r))}))

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {double('sum(revenue)', 'revenue')}, count(*) AS n FROM s WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 45 AND p_type = 'PROMO') GROUP BY 1")
    def both_ways_filter(spark: SparkSession, d: str) -> DataFrame:
        """A filter on a table on the many side of a dimension comes back over a both-ways edge, as a set of keys."""
        base = star(spark, d)
        part = base.tables["part"]
        bridge = part.select(F.col("p_partkey").alias("b_part"), F.col("p_size").alias("b_size"), F.col("p_type").alias("b_type"))
        model = Model({**base.tables, "bridge": bridge}, [*base.relationships, Relationship("bridge", "b_part", "part", "p_partkey", both=True)], calendar="calendar")
        m = {k: With(v, keep={"b_size": "b_size > 45 AND b_type = 'PROMO'"}) for k, v in {"revenue": REVENUE, "n": LINES}.items()}
        return rounded(query(model, ["c_mktsegment"], m))

    @reg.add(f"""WITH {SALES}, a AS (SELECT last_day(max(d)) AS anchor FROM s WHERE revenue <> 0 AND d < DATE '2001-08-01') SELECT segment AS c_mktsegment, {double('sum(revenue)', 'revenue')} FROM s, a WHERE d > anchor - INTERVAL 1 MONTH AND d <= anchor AND date_trunc('month', d) = date_trunc('month', anchor) GROUP BY 1""")
    def anchored_month(spark: SparkSession, d: str) -> DataFrame:
        """The month of the last non-zero amount before the current one; the anchor ignores all filters and is a constant."""
        model = star(spark, d)
        last = last_date(model.tables["line"], "l_shipdate", "revenue <> 0 AND l_shipdate < TIMESTAMP '2001-08-01'")
        end = anchor(last)
        return rounded(query(model, ["c_mktsegment"], {"revenue": With(REVENUE, set={"date": f"month_end = date'{end}'"})}))

    @reg.add(f"""WITH {SALES}, m AS (SELECT segment, (year(d) - 1995) * 12 + month(d) AS i, sum(revenue) AS r FROM s GROUP BY ALL), n AS (SELECT (2001 - 1995) * 12 + 8 AS n)
      SELECT segment AS c_mktsegment, {double('sum(r) FILTER (WHERE i = n)', 'this_month')}, {double('sum(r) FILTER (WHERE i = n - 1)', 'last_month')}, {double('sum(r) FILTER (WHERE i < n)', 'before')}, {double('sum(r) FILTER (WHERE i BETWEEN n - 12 AND n - 1)', 'twelve')}, {ratio('sum(r) FILTER (WHERE i BETWEEN n - 6 AND n - 1)', '6', 'six_average')} FROM m, n GROUP BY 1""")
    def month_index_windows(spark: SparkSession, d: str) -> DataFrame:
        """This month, the last, all before, twelve and the average of six, by a running month index."""
        n = (AS_OF.year - 1995) * 12 + AS_OF.month
        window = lambda sql: With(REVENUE, set={"month_index": sql})
        six = Derived({"v": window(f"month_index BETWEEN {n - 6} AND {n - 1}")}, lambda v: v.cast("double") / 6)
        m = {"this_month": window(f"month_index = {n}"), "last_month": window(f"month_index = {n - 1}"), "before": window(f"month_index < {n}"), "twelve": window(f"month_index BETWEEN {n - 12} AND {n - 1}"), "six_average": six}
        return rounded(query(star(spark, d), ["c_mktsegment"], m), "six_average")

    @reg.add(f"""WITH {SALES}, m AS (SELECT {fy()} AS fiscal_year, (month(d) + 2) % 12 + 1 AS fiscal_month, sum(revenue) AS revenue FROM s WHERE d < DATE '2001-08-01' GROUP BY ALL)
      SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year, fiscal_month, {double('revenue', 'revenue')}, {double('sum(revenue) OVER (PARTITION BY fiscal_year ORDER BY fiscal_month)', 'cumulative')} FROM m""")
    def cumulative_in_year(spark: SparkSession, d: str) -> DataFrame:
        """Cumulative revenue within the fiscal year, completed months only."""
        from tidewheel.plans.timeint import running

        rows = query(star(spark, d), ["fiscal_year", "fiscal_month"], {"revenue": With(REVENUE, keep=COMPLETED)})
        return rounded(running(rows, ["fiscal_year"], "fiscal_month", "revenue", "cumulative"))

    @reg.add(f"WITH {SALES}, m AS (SELECT CAST(date_trunc('month', d) AS DATE) AS first, sum(revenue) AS revenue FROM s GROUP BY 1) SELECT strftime(first, '%b %Y') AS month_label, CAST(row_number() OVER (ORDER BY first) AS INTEGER) AS place, {double('revenue', 'revenue')} FROM m")
    def sort_by_column(spark: SparkSession, d: str) -> DataFrame:
        """Month labels in the order of their months; place is that in the ordered result."""
        model = star(spark, d)
        rows = ordered(model, query(model, ["month_label"], {"revenue": REVENUE}), "month_label")
        place = rows.agg(F.posexplode(F.collect_list(F.struct("month_label", "revenue"))).alias("place", "row"))  # a row for each month of the calendar
        return rounded(place.select("row.month_label", (F.col("place") + 1).cast("int").alias("place"), "row.revenue"))

    @reg.add(f"{REGION} SELECT r_name, n_name, CAST(2 - grouping(r_name) - grouping(n_name) AS INTEGER) AS level, CASE WHEN grouping(n_name) = 0 THEN {ratio('sum(revenue)', 'count(*)')} WHEN grouping(r_name) = 0 THEN CAST(count(*) AS DOUBLE) ELSE round(CAST(sum(revenue) AS DOUBLE), 6) END AS value, CAST(sum(revenue) FILTER (WHERE stream = 'A') AS DOUBLE) AS chosen FROM g WHERE stream IN ('A') GROUP BY ROLLUP (r_name, n_name)")
    def measures_by_scope(spark: SparkSession, d: str) -> DataFrame:
        """A measure that differs by the level it stands at, and one chosen by the one value of a slicer."""
        value = InScope({"n_name": REVENUE / LINES, "r_name": LINES}, REVENUE)
        chosen = Selected("l_returnflag", {"A": REVENUE, "N": LINES}, COST)
        out = query(star(spark, d), ["r_name", "n_name"], {"value": value, "chosen": chosen}, Context.slicers(l_returnflag="l_returnflag IN ('A')"), totals=True)
        return rounded(out.withColumn("value", F.col("value").cast("double")), "value")

    floor = "round(round(CAST({} AS DECIMAL(28,10)), 3), 2) < 0.25"

    @reg.add(f"""WITH {SALES}, o AS (SELECT l_orderkey, sum(revenue) AS r, sum(revenue - cost) AS g FROM s GROUP BY 1), low AS (SELECT l_orderkey FROM o WHERE {floor.format('CAST(g AS DOUBLE) / nullif(CAST(r AS DOUBLE), 0)')}),
      t AS (SELECT segment, revenue, cost, l_orderkey IN (SELECT l_orderkey FROM low) AS b FROM s)
      SELECT segment AS c_mktsegment, {double('sum(revenue) FILTER (WHERE b)', 'price')}, {double('sum(revenue - cost) FILTER (WHERE b)', 'gp')}, {ratio('sum(revenue) FILTER (WHERE b)', 'sum(revenue)', 'price_share')} FROM t GROUP BY 1""")
    def filter_by_measure(spark: SparkSession, d: str) -> DataFrame:
        """Price and gross profit of the bookings (orders) whose own margin, rounded twice, is below the floor."""
        parts = {"r": REVENUE, "g": REVENUE - COST}
        below = lambda m: Having(m, ("l_orderkey",), parts, floor.format("try_divide(CAST(g AS DOUBLE), CAST(r AS DOUBLE))"))
        return rounded(query(star(spark, d), ["c_mktsegment"], {"price": below(REVENUE), "gp": below(REVENUE - COST), "price_share": below(REVENUE) / REVENUE}), "price_share")

    @reg.add(f"""{REGION}, c AS (SELECT r_name, {fy()} AS fiscal_year, customer, sum(revenue) AS r, count(*) AS n FROM g GROUP BY ALL)
      SELECT r_name, CAST(fiscal_year AS INTEGER) AS fiscal_year, {double('sum(r) FILTER (WHERE r > 150000)', 'of_large')}, count(*) FILTER (WHERE r > 150000) AS large, {double('sum(r)', 'revenue')} FROM c GROUP BY ALL""")
    def filter_by_measure_cells(spark: SparkSession, d: str) -> DataFrame:
        """Customers that are large in a region's fiscal year: every cell has members of its own."""
        parts = {"v": REVENUE}
        large = lambda m: Having(m, ("o_custkey",), parts, "v > 150000")
        out = query(star(spark, d), ["r_name", "fiscal_year"], {"of_large": large(REVENUE), "large": large(Leaf("line", "countd", "o_custkey")), "revenue": REVENUE})
        return rounded(out.fillna({"large": 0}))

    @reg.add(f"""{REGION}, o AS (SELECT r_name, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY 1), b AS (SELECT p_brand, r_name, sum(revenue) AS revenue FROM g GROUP BY ALL)
      SELECT p_brand, r_name, orders, {double('revenue', 'revenue')}, {ratio('revenue', 'orders', 'per_order')} FROM b LEFT JOIN o USING (r_name)""")
    def axis_not_reached(spark: SparkSession, d: str) -> DataFrame:
        """Orders beside lines by brand and region: brands don't filter orders, whose region's number stands at each of them."""
        orders = Leaf("orders", "count")
        return rounded(query(star(spark, d), ["p_brand", "r_name"], {"orders": orders, "revenue": REVENUE, "per_order": REVENUE / orders}), "per_order")

    @reg.add("SELECT p_brand, (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS orders FROM part WHERE p_size > 20 GROUP BY 1")
    def axis_alone(spark: SparkSession, d: str) -> DataFrame:
        """A measure that none of the axes filters, in a sliced report: its total at each value that the slicer leaves."""
        return query(star(spark, d), ["p_brand"], {"orders": Leaf("orders", "count")}, Context.slicers(o_orderpriority="o_orderpriority = '1-URGENT'", p_size="p_size > 20"))

    @reg.add(f"WITH {SALES}, t AS (SELECT segment, sum(revenue) AS r FROM s GROUP BY 1) SELECT DISTINCT p_brand, s.segment AS c_mktsegment, {double('r', 'of_segment')} FROM s JOIN t ON s.segment = t.segment")
    def axes_of_two_tables(spark: SparkSession, d: str) -> DataFrame:
        """A measure that lifts one of two tables' axes: its rows are the combinations that the shared fact has."""
        return rounded(query(star(spark, d), ["p_brand", "c_mktsegment"], {"of_segment": With(REVENUE, remove=("p_brand",))}))

    moves = "sum(CASE WHEN py > 0 THEN py ELSE 0 END) AS base, sum(CASE WHEN py > 0 AND cy = 0 THEN py ELSE 0 END) AS churn, sum(CASE WHEN py > 0 AND cy > 0 AND cy < py THEN py - cy ELSE 0 END) AS contraction, sum(CASE WHEN py > 0 AND cy > py THEN cy - py ELSE 0 END) AS upsell, sum(CASE WHEN py > 0 THEN 1 ELSE 0 END) AS logos, sum(CASE WHEN py > 0 AND cy = 0 THEN 1 ELSE 0 END) AS lost"

    @reg.add(f"""WITH {SALES}, m AS (SELECT segment, customer, (year(d) - 1995) * 12 + month(d) AS i, sum(revenue) AS v FROM s GROUP BY ALL), p AS (SELECT DISTINCT i AS n FROM m),
      w AS (SELECT segment, customer, n, coalesce(sum(v) FILTER (WHERE i > n - 12), 0) AS cy, coalesce(sum(v) FILTER (WHERE i <= n - 12), 0) AS py FROM m JOIN p ON i <= n AND i > n - 24 GROUP BY ALL),
      a AS (SELECT segment, n, {moves} FROM w GROUP BY ALL)
      SELECT segment AS c_mktsegment, CAST(n AS INTEGER) AS month_index, {double('base', 'base')}, {double('churn', 'churn')}, {double('contraction', 'contraction')}, {double('upsell', 'upsell')}, CAST(logos AS BIGINT) AS logos, CAST(lost AS BIGINT) AS lost, {ratio('base - churn - contraction + upsell', 'base', 'nrr')} FROM a""")
    def retention_trend(spark: SparkSession, d: str) -> DataFrame:
        """Retention as of every month, each with its own rolling year and the one before, in one pass over monthly amounts."""
        rows = query(star(spark, d), ["c_mktsegment", "o_custkey", "month_index"], {"v": REVENUE})
        had = F.col("py") > 0
        of = {**{n: F.coalesce(c, F.lit(0)).cast("decimal(30,4)") for n, c in movements().items()}, "logos": had.cast("bigint"), "lost": (had & (F.col("cy") == 0)).cast("bigint")}
        out = sliding(rows, ["c_mktsegment"], "o_custkey", "month_index", "v", of)
        kept = F.col("base") - F.col("churn") - F.col("contraction") + F.col("upsell")
        return rounded(out.withColumn("nrr", divide(kept, "base")), "nrr")

    @reg.add(f"""WITH {SALES}, y AS (SELECT segment, CAST({fy()} AS INTEGER) AS f, revenue, customer FROM s), k AS (SELECT DISTINCT segment, unnest(range(1995, 2004)) AS fiscal_year FROM y),
      first AS (SELECT segment, customer, min(f) AS f FROM y GROUP BY ALL), o AS (SELECT c_mktsegment AS segment, {fy('o_orderdate')} AS f FROM orders JOIN customer ON o_custkey = c_custkey),
      r AS (SELECT k.segment, k.fiscal_year, sum(revenue) AS revenue, min(revenue) AS least, count(*) AS n FROM k JOIN y ON y.segment = k.segment AND y.f <= k.fiscal_year GROUP BY ALL)
      SELECT r.segment AS c_mktsegment, CAST(r.fiscal_year AS INTEGER) AS fiscal_year, {double('revenue', 'revenue')}, {double('least', 'least')}, {ratio('revenue', 'n', 'per_line')},
        (SELECT count(*) FROM first WHERE first.segment = r.segment AND first.f <= r.fiscal_year) AS customers, (SELECT count(*) FROM o WHERE o.segment = r.segment AND o.f <= r.fiscal_year AND o.f >= 1995) AS orders FROM r""")
    def cumulative_measures(spark: SparkSession, d: str) -> DataFrame:
        """Everything up to each fiscal year: sums, an extreme, a ratio, distinct customers; orders by their own date."""
        total = {"revenue": REVENUE, "least": Leaf("line", "min", "revenue"), "per_line": REVENUE / LINES, "customers": Leaf("line", "countd", "o_custkey")}
        m = {k: Cumulative(v) for k, v in total.items()}
        m["orders"] = With(Cumulative(Leaf("orders", "count")), use=("o_orderdate",))
        return rounded(query(star(spark, d), ["c_mktsegment", "fiscal_year"], m), "per_line")

    @reg.add(f"""WITH {SALES}, p AS (SELECT CAST(unnest(range(DATE '2000-01-01', DATE '2001-01-01', INTERVAL 1 MONTH)) AS DATE) AS first)
      SELECT CAST((year(first) - 1995) * 12 + month(first) AS INTEGER) AS month_index, {double('sum(revenue)', 'upto')}, {double('sum(revenue) FILTER (WHERE d >= first)', 'own')} FROM p JOIN s ON d < first + INTERVAL 1 MONTH AND d >= DATE '1995-01-01' GROUP BY ALL""")
    def cumulative_in_slice(spark: SparkSession, d: str) -> DataFrame:
        """A slicer on the calendar says which months are shown, not which days a cumulative value adds up."""
        return rounded(query(star(spark, d), ["month_index"], {"upto": Cumulative(REVENUE), "own": REVENUE}, Context.slicers(year="year = 2000")))

    @reg.add(f"""WITH {SALES}, a AS (SELECT segment, customer, sum(revenue) AS revenue FROM s GROUP BY ALL)
      SELECT segment AS c_mktsegment, customer AS o_custkey, {double('revenue', 'revenue')}, CAST(dense_rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS rank, CAST(dense_rank() OVER (PARTITION BY segment ORDER BY revenue DESC) AS INTEGER) AS in_segment FROM a""")
    def rank_measure(spark: SparkSession, d: str) -> DataFrame:
        """The rank of a customer's revenue among all customers and among those of its segment, as measures."""
        m = {"revenue": REVENUE, "rank": Rank(REVENUE, "o_custkey", lift=("c_mktsegment",)), "in_segment": Rank(REVENUE, "o_custkey")}
        return rounded(query(star(spark, d), ["c_mktsegment", "o_custkey"], m))

    @reg.add(f"""{REGION}, f AS (SELECT {fy()} AS fiscal_year, * FROM g), n AS (SELECT fiscal_year, n_name, sum(revenue) AS v FROM f WHERE n_name <> 'NATION_7' GROUP BY ALL), r AS (SELECT r_name, fiscal_year, sum(revenue) AS v FROM f GROUP BY ALL)
      SELECT r_name, CAST(fiscal_year AS INTEGER) AS fiscal_year, CAST(1 + (SELECT count(DISTINCT v) FROM n WHERE n.fiscal_year = r.fiscal_year AND n.v > r.v / 5) AS INTEGER) AS place FROM r""")
    def rank_of_other_cells(spark: SparkSession, d: str) -> DataFrame:
        """A region's fifth placed among the nations' values of the fiscal year: cells that are no members of what ranks them."""
        fifth = InScope({"r_name": Derived({"v": REVENUE}, lambda v: v.cast("decimal(30,4)") / 5)}, Derived({"v": REVENUE}, lambda v: v.cast("decimal(30,4)") * 1))
        return query(star(spark, d), ["r_name", "fiscal_year"], {"place": Rank(fifth, "n_name", lift=("r_name",), where="n_name <> 'NATION_7'")})

    @reg.add(f"""WITH {SALES}, y AS (SELECT {fy()} AS fiscal_year, sum(revenue) AS v, count(*) AS n FROM s GROUP BY 1), k AS (SELECT fiscal_year FROM y UNION SELECT fiscal_year + 1 FROM y), j AS (SELECT k.fiscal_year, a.v, a.n, b.v AS pv, b.n AS pn FROM k LEFT JOIN y a ON a.fiscal_year = k.fiscal_year LEFT JOIN y b ON b.fiscal_year + 1 = k.fiscal_year),
      u AS (SELECT fiscal_year, 'Current' AS period, 0 AS period_ordinal, NULL AS period_format, v, n FROM j UNION ALL SELECT fiscal_year, 'PY', 1, NULL, pv, pn FROM j UNION ALL SELECT fiscal_year, 'YoY', 2, NULL, coalesce(v, 0) - coalesce(pv, 0), coalesce(n, 0) - coalesce(pn, 0) FROM j
        UNION ALL SELECT fiscal_year, 'YoY %', 3, '0.0%', (CAST(coalesce(v, 0) AS DOUBLE) - coalesce(pv, 0)) / CAST(pv AS DOUBLE), (CAST(coalesce(n, 0) AS DOUBLE) - coalesce(pn, 0)) / pn FROM j)
      SELECT CAST(fiscal_year AS INTEGER) AS fiscal_year, period, period_ordinal, period_format, round(CAST(v AS DOUBLE), 4) AS revenue, round(CAST(n AS DOUBLE), 4) AS lines FROM u WHERE v IS NOT NULL OR n IS NOT NULL""")
    def calculation_group_axis(spark: SparkSession, d: str) -> DataFrame:
        """The items of a calculation group as rows beside the fiscal year, for two measures in one query, with formats."""
        group = CalculationGroup("period", {"Current": lambda m: m, "PY": CLOCK.py, "YoY": CLOCK.yoy, "YoY %": CLOCK.yoy_pct}, {"YoY %": "0.0%"})
        out = by_items(star(spark, d), ["fiscal_year"], {"revenue": REVENUE, "lines": LINES}, [group])
        return out.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("revenue", "lines")})

    @reg.add(f"WITH {SALES}, v AS (SELECT customer, sum(revenue) AS r, count(DISTINCT l_orderkey) AS o FROM s GROUP BY 1) SELECT c_custkey, c_mktsegment, {double('r', 'revenue')}, o AS orders, {ratio('r', '(SELECT sum(revenue) FROM s)', 'share')} FROM customer LEFT JOIN v ON c_custkey = customer")
    def calculated_column(spark: SparkSession, d: str) -> DataFrame:
        """Columns of the customer table that are measures, each in the context of its row."""
        m = {"revenue": REVENUE, "orders": Leaf("line", "countd", "l_orderkey"), "share": REVENUE / With(REVENUE, clear=True)}
        return rounded(calculated(star(spark, d), "customer", m, keys=["c_custkey"]).select("c_custkey", "c_mktsegment", *m), "share")

    @reg.add(f"WITH {SALES}, k AS (SELECT DISTINCT CASE WHEN p_size > 25 THEN 'large' ELSE 'small' END AS lane, p_partkey FROM part WHERE p_type <> 'PROMO') SELECT lane, {double('sum(revenue)', 'revenue')}, count(DISTINCT customer) AS customers FROM k JOIN s ON l_partkey = p_partkey WHERE segment = 'BUILDING' GROUP BY 1")
    def filters_over_several_edges(spark: SparkSession, d: str) -> DataFrame:
        """A table two edges beyond a dimension filters the fact, and is an axis: down to the bridge, and back over a both-ways edge."""
        base = star(spark, d)
        bridge = base.tables["part"].select(F.col("p_partkey").alias("b_part"), F.col("p_size").alias("b_size"), F.col("p_type").alias("b_type"))
        sizes = base.tables["part"].select(F.col("p_size").alias("size_key"), F.when(F.col("p_size") > 25, "large").otherwise("small").alias("lane")).distinct()
        edges = [Relationship("bridge", "b_part", "part", "p_partkey", both=True), Relationship("bridge", "b_size", "sizes", "size_key")]
        model = Model({**base.tables, "bridge": bridge, "sizes": sizes}, [*base.relationships, *edges], calendar="calendar")
        m = {"revenue": REVENUE, "customers": Leaf("line", "countd", "o_custkey")}
        kept = {k: With(v, keep={"b_type": "b_type <> 'PROMO'"}) for k, v in m.items()}
        return rounded(query(model, ["lane"], kept, Context.slicers(c_mktsegment="c_mktsegment = 'BUILDING'")))

    @reg.add(f"WITH {SALES} SELECT segment AS c_mktsegment, {double('sum(revenue) FILTER (WHERE year(d) BETWEEN 1998 AND 2000)', 'sliced')}, {double(f'sum(revenue) FILTER (WHERE {fy()} = 2001 AND year(d) BETWEEN 1998 AND 2000)', 'latest')}, {double(f'sum(revenue) FILTER (WHERE {fy()} = 2000 AND year(d) BETWEEN 1998 AND 2000)', 'before')}, string_agg(DISTINCT p_type, ', ' ORDER BY p_type) FILTER (WHERE year(d) BETWEEN 1998 AND 2000 AND p_brand = 'Brand#1') AS kinds FROM s JOIN part p USING (p_brand) WHERE p.p_partkey = l_partkey GROUP BY 1")
    def year_of_slicer(spark: SparkSession, d: str) -> DataFrame:
        """The largest fiscal year that the slicer on the calendar leaves, and the one before it; a text that lists values."""
        model, ctx = star(spark, d), Context.slicers(year="year BETWEEN 1998 AND 2000")
        latest = latest_of_slicers(model, "fiscal_year", ctx)
        m = {"sliced": REVENUE, "latest": With(REVENUE, set={"fiscal_year": f"fiscal_year = {latest}"}), "before": With(REVENUE, set={"fiscal_year": f"fiscal_year = {latest - 1}"}), "kinds": With(Leaf("line", "texts", "p_type"), keep={"p_brand": "p_brand = 'Brand#1'"})}
        return rounded(query(model, ["c_mktsegment"], m, ctx))
