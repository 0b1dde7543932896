"""Filter context and the measure compiler, on a model of a few rows."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewheel.plans.calcgroup import CalculationGroup, by_items
from tidewheel.plans.context import Context
from tidewheel.plans.measure import Cumulative, Having, Iterate, Leaf, Rank, With, calculated, query, ranked, share
from tidewheel.plans.model import Model, Relationship
from tidewheel.plans.ranking import placed
from tidewheel.plans.timeint import Clock, add_months, anchor, sliding
from tidewheel.sources import literal

AMOUNT, ROWS = Leaf("sale", "sum", "amount"), Leaf("sale", "count")


@pytest.fixture(scope="module")
def model(spark):
    sale = spark.createDataFrame([(1, 10, "2025-01-05 10:00:00", "2024-12-20", 100.0), (1, 11, "2025-02-05 00:00:00", "2025-02-01", 50.0), (2, 10, "2025-02-06 00:00:00", "2025-01-01", 30.0), (9, 12, "2024-02-07 00:00:00", "2024-02-01", 20.0)], "s_customer int, s_item int, sold string, made string, amount double")
    sale = sale.selectExpr("s_customer", "s_item", "CAST(sold AS TIMESTAMP) AS sold", "CAST(made AS DATE) AS made", "amount")
    customer = spark.createDataFrame([(1, "north", "a"), (2, "south", "b"), (3, "south", "c")], "customer int, region string, name string")
    item = spark.createDataFrame([(10, "x"), (11, "y"), (12, "y")], "item int, kind string")
    tag = spark.createDataFrame([(10, "new"), (11, "old"), (12, "old")], "t_item int, tag string")
    calendar = spark.sql("SELECT d AS day, year(d) AS year, month(d) AS month FROM (SELECT explode(sequence(DATE'2024-01-01', DATE'2026-12-31')) AS d)")
    edges = [Relationship("sale", "s_customer", "customer", "customer"), Relationship("sale", "s_item", "item", "item"), Relationship("tag", "t_item", "item", "item", both=True), Relationship("sale", "sold", "calendar", "day", date_part=True), Relationship("sale", "made", "calendar", "day", active=False)]
    return Model({"sale": sale, "customer": customer, "item": item, "tag": tag, "calendar": calendar}, edges, calendar="calendar")


def rows(df, *axes):
    return {tuple(r[a] for a in axes): tuple(r[c] for c in df.columns if c not in axes) for r in df.collect()}


def test_blank_member_and_blank_rows(model):
    got = rows(query(model, ["region"], {"v": AMOUNT}), "region")
    assert got == {("north",): (150,), ("south",): (30,), (None,): (20,)}  # an unknown customer's rows stay; region rows without sales don't show
    got = rows(query(model, ["name"], {"v": AMOUNT, "n": ROWS}), "name")
    assert ("c",) not in got and got[("a",)] == (150, 2)


def test_context_changes(model):
    m = {"x": With(AMOUNT, set={"kind": "kind = 'x'"}), "both": With(With(AMOUNT, keep={"kind": "kind = 'x'"}), keep={"region": "region = 'north'"}), "all": With(AMOUNT, remove=("region",)), "of": share(AMOUNT, "region")}
    got = rows(query(model, ["region"], m), "region")
    assert got[("north",)] == (100, 100, 200, 0.75) and got[("south",)] == (30, None, 200, 0.15)


def test_outer_and_clear(model):
    ctx = Context.slicers(kind="kind = 'y'")
    m = {"v": With(AMOUNT, set={"region": "region = 'north'"}), "outer": With(AMOUNT, outer=True), "clear": With(AMOUNT, clear=True)}
    assert rows(query(model, [], m, ctx))[()] == (50, 70, 200)


def test_relationships(model):
    got = rows(query(model, ["year"], {"sold": AMOUNT, "made": With(AMOUNT, use=("made",))}), "year")
    assert got == {(2024,): (20, 120), (2025,): (180, 80)}
    tagged = With(AMOUNT, keep={"tag": "tag = 'new'"})  # comes back over the both-ways edge
    assert rows(query(model, [], {"v": tagged}))[()] == (130,)


def test_virtual_relationship(spark, model):
    kinds = literal(spark, "k string", [("y",)])
    assert rows(query(model, [], {"v": With(AMOUNT, among={"kind": kinds})}))[()] == (70,)


def test_time(model):
    clock = Clock("day", dt.date(2025, 2, 15), fy_end=12)
    m = {"mtd": clock.mtd(AMOUNT), "ytd": clock.ytd(AMOUNT), "ytd_py": clock.py(clock.ytd(AMOUNT))}
    assert rows(query(model, [], m))[()] == (80, 180, 20)
    got = rows(query(model, ["year"], {"v": AMOUNT, "py": clock.py(AMOUNT), "yoy": clock.yoy(AMOUNT), "pct": clock.yoy_pct(AMOUNT)}), "year")
    assert got == {(2024,): (20, None, 20, None), (2025,): (180, 20, 160, 8), (2026,): (None, 180, -180, -1)}


def test_rolling_window_months():
    days = [(y, m) for y in (2023, 2024, 2025) for m in range(1, 13)]
    ends = [add_months(dt.date(y, m, 31) if m in (1, 3, 5, 7, 8, 10, 12) else dt.date(y, m, 28), 0) for y, m in days]
    ends = [(d.replace(day=28) + dt.timedelta(days=4)).replace(day=1) - dt.timedelta(days=1) for d in ends]
    clock, a = Clock("d", dt.date(2025, 2, 28)), dt.date(2025, 2, 28)

    def months(measure):
        low, high = (dt.date.fromisoformat(x) for x in __import__("re").findall(r"'([\d-]+)'", measure.set["d"]))
        return sum(low < e <= high for e in ends)

    assert (months(clock.r12m(AMOUNT, a)), months(clock.r12m(AMOUNT, a, 1))) == (12, 12)
    assert (months(clock.r12m(AMOUNT, a, naive=True)), months(clock.r12m(AMOUNT, a, 1, naive=True))) == (13, 11)
    assert anchor(dt.date(2025, 5, 3), dt.date(2025, 7, 31)) == dt.date(2025, 5, 31) and anchor(None, None) is None


def test_iteration_and_totals(model):
    m = {"big": Iterate(("s_customer",), {"v": AMOUNT}, "sum(CASE WHEN v >= 100 THEN 1 ELSE 0 END)"), "n": Leaf("sale", "countd", "name")}
    got = query(model, ["region", "name"], m, totals=True).collect()
    by = {(r.region, r.name, r.level): (r.big, r.n) for r in got}
    assert by[(None, None, 0)] == (1, 3)  # a blank name counts as a value
    assert by[("north", None, 1)] == (1, 1) and by[("north", "a", 2)] == (1, 1)


def test_ranks(spark):
    df = spark.createDataFrame([("a", 5.0), ("b", 5.0), ("c", 9.0), ("d", None), ("e", 1.0)], "k string, v double")
    assert {r.k: r["rank"] for r in ranked(df, "v").collect()} == {"a": 2, "b": 2, "c": 1, "e": 3}
    assert {r.k: r["rank"] for r in ranked(df, "v", top=2).collect()} == {"a": 2, "b": 2, "c": 1}


def test_introspection():
    ctx = Context.slicers(kind="kind = 'y'").keep("region", "region IN ('a', 'b')")
    assert ctx.selected("kind") == "y" and ctx.selected("region", "-") == "-" and ctx.is_filtered("region") and not ctx.has_one_value("region")
    assert ctx.set("kind", "kind = 'z'").selected("kind") == "z" and not ctx.remove("kind").is_filtered("kind") and ctx.outer().filters[0].column == "kind"


def test_duplicate_columns_are_refused(spark):
    a = spark.range(1)
    with pytest.raises(ValueError):
        Model({"a": a, "b": a}, [])


def test_ranks_in_ranges(spark):
    rows = [(k, float(k * 37 % 501 // 2)) for k in range(1500)]
    want = {v: i + 1 for i, v in enumerate(sorted({v for _, v in rows}, reverse=True))}
    got = ranked(spark.createDataFrame(rows, "k int, v double"), "v", parts=7).collect()
    assert len(got) == 1500 and all(r["rank"] == want[r.v] for r in got)


def test_selected_values():
    c = Context.slicers(kind="kind IN ('x', 'y')")
    assert c.selected("kind") is None and c.keep("kind", "kind = 'y'").selected("kind") == "y"
    assert Context.slicers(kind="kind in ('it''s')").selected("kind") == "it's" and Context.slicers(year="year = 2025").selected("year") == "2025"
    assert Context.slicers(kind="kind > 'a'").selected("kind", "none") == "none" and not c.has_one_value("kind")


def test_having(model):
    # by region and customer: north 1: 150 of 2 rows; south 2: 30; blank 9: 20
    big = Having(AMOUNT, ("s_customer",), {"v": AMOUNT}, "v > 25")
    assert rows(query(model, ["region"], {"v": big, "n": Having(ROWS, ("s_customer",), {"v": AMOUNT}, "v > 25")}), "region") == {("north",): (150, 2), ("south",): (30, 1)}
    # of each kind on its own: customer 1 has 100 in x and 50 in y
    cells = Having(AMOUNT, ("s_customer",), {"v": AMOUNT}, "v >= 50")
    assert rows(query(model, ["kind"], {"v": cells}), "kind") == {("x",): (100,), ("y",): (50,)}
    items = Having(ROWS, ("s_item",), {"n": ROWS, "v": AMOUNT}, "v / n > 40")  # 10: 65, 11: 50, 12: 20
    assert rows(query(model, [], {"n": items}, Context.slicers(region="region = 'north'")))[()] == (2,)
    assert rows(query(model, [], {"n": With(items, keep={"kind": "kind = 'y'"})}))[()] == (1,)
    assert rows(query(model, [], {"n": Cumulative(Leaf("sale", "countd", "concat('c', CAST(s_customer AS STRING))"))}))[()] == (3,)
    with pytest.raises(ValueError, match="lifts the axis region"):
        query(model, ["region"], {"v": Having(With(AMOUNT, remove=("region",)), ("s_customer",), {"v": AMOUNT}, "v > 25")})


def test_axes_that_a_fact_does_not_reach(spark, model):
    visit = spark.createDataFrame([(1, 5), (2, 7), (2, 1)], "v_customer int, minutes int")
    wide = Model({**model.tables, "visit": visit}, [*model.relationships, Relationship("visit", "v_customer", "customer", "customer")], calendar="calendar")
    minutes = Leaf("visit", "sum", "minutes")
    assert rows(query(wide, ["kind"], {"m": minutes}), "kind") == {("x",): (13,), ("y",): (13,)}
    got = rows(query(wide, ["kind", "region"], {"m": minutes, "v": AMOUNT, "per": AMOUNT / minutes}), "kind", "region")
    assert got == {("x", "north"): (5, 100, 20), ("y", "north"): (5, 50, 10), ("x", "south"): (8, 30, 3.75), ("y", None): (None, 20, None)}
    assert rows(query(wide, ["kind"], {"m": minutes}, Context.slicers(kind="kind = 'x'", region="region = 'south'")), "kind") == {("x",): (8,)}
    got = query(wide, ["region", "kind"], {"m": minutes}, totals=True).collect()
    assert sorted((r.region or "", r.kind or "", r.m) for r in got if r.level == 1) == [("north", "", 5), ("south", "", 8)] and [r.m for r in got if r.level == 0] == [13]
    lifted = rows(query(wide, ["kind", "region"], {"v": With(AMOUNT, remove=("kind",))}), "kind", "region")
    assert lifted == {("x", "north"): (150,), ("y", "north"): (150,), ("x", "south"): (30,), ("y", None): (20,)}
    far = spark.createDataFrame([("p", 1), ("q", 2)], "place string, size int")
    apart = Model({**wide.tables, "far": far}, wide.relationships, calendar="calendar")
    got = rows(query(apart, ["place", "region"], {"s": Leaf("far", "sum", "size"), "m": minutes}), "place", "region")
    assert got == {(p, r): (s, m) for p, s in (("p", 1), ("q", 2)) for r, m in (("north", 5), ("south", 8))} | {(p, "south"): (s, 8) for p, s in (("p", 1), ("q", 2))}
    each = Iterate(("s_customer",), {"v": AMOUNT}, "max(v)")
    assert rows(query(apart, ["place"], {"v": each}), "place") == {("p",): (150,), ("q",): (150,)}


def test_filters_over_several_edges(spark, model):
    group = spark.createDataFrame([("new", "hot"), ("old", "cold")], "g_tag string, heat string")
    # heat -> tag (many to one would be tag -> group): group filters tag, tag comes back to item, item filters sale
    tag = model.tables["tag"]
    wide = Model({**{k: v for k, v in model.tables.items() if k != "tag"}, "tag": tag, "group": group}, [*model.relationships, Relationship("tag", "tag", "group", "g_tag")], calendar="calendar")
    assert rows(query(wide, [], {"v": With(AMOUNT, keep={"heat": "heat = 'hot'"})}))[()] == (130,)
    assert rows(query(wide, ["heat"], {"v": AMOUNT}), "heat") == {("hot",): (130,), ("cold",): (70,)}
    assert rows(query(wide, ["tag", "region"], {"v": AMOUNT}, Context.slicers(tag="tag = 'old'")), "tag", "region") == {("old", "north"): (50,), ("old", None): (20,)}
    hot = literal(spark, "h string", [("hot",), ("hot",)])
    assert rows(query(wide, [], {"v": With(AMOUNT, among={"heat": hot})}))[()] == (130,)
    second = spark.createDataFrame([("hot", 1)], "s_heat string, n int")
    more = [Relationship("tag", "tag", "group", "g_tag"), Relationship("second", "s_heat", "group", "g_tag"), Relationship("second", "n", "item", "item", both=True)]
    double = Model({**wide.tables, "second": second}, [*model.relationships, *more], calendar="calendar")
    with pytest.raises(ValueError, match="group comes to sale by"):
        query(double, [], {"v": With(AMOUNT, keep={"heat": "heat = 'hot'"})})


def test_ranks_as_measures(model):
    by = {"v": AMOUNT, "rank": Rank(AMOUNT, "s_customer")}
    assert rows(query(model, ["s_customer"], by), "s_customer") == {(1,): (150, 1), (2,): (30, 2), (9,): (20, 3)}
    assert rows(query(model, ["kind", "s_customer"], by), "kind", "s_customer") == {("x", 1): (100, 1), ("x", 2): (30, 2), ("y", 1): (50, 1), ("y", 9): (20, 2)}
    # a cell that is no member is placed among the members: south's 30 and the blank region's 20 lie within the customers'
    assert rows(query(model, ["region"], {"rank": Rank(AMOUNT, "s_customer", lift=("region",))}), "region") == {("north",): (1,), ("south",): (2,), (None,): (3,)}
    assert rows(query(model, [], {"rank": Rank(With(AMOUNT, keep={"region": "region = 'south'"}), "s_customer")}))[()] == (1,)
    # what a measure filters is lifted for the members, what the report filters isn't
    one = With(Rank(AMOUNT, "s_customer"), set={"s_customer": "s_customer = 9"})
    assert rows(query(model, [], {"r": one}))[()] == (3,)
    assert rows(query(model, [], {"r": one}, Context.slicers(s_customer="s_customer <> 1")))[()] == (3,)  # set overwrites the slicer as well
    assert rows(query(model, ["s_customer"], {"r": Rank(AMOUNT, "s_customer")}, Context.slicers(s_customer="s_customer <> 1")), "s_customer") == {(2,): (1,), (9,): (2,)}
    assert rows(query(model, ["s_customer"], {"r": Rank(AMOUNT, "s_customer", where="s_customer <> 2")}), "s_customer") == {(1,): (1,), (2,): (2,), (9,): (2,)}


def test_places_within_groups(spark):
    rnd = random.Random(1)
    data = [(rnd.choice(["a", "a", "a", "b", None]), rnd.choice([0, 0, 0, rnd.randint(-50, 50)]), rnd.random() < 0.5) for _ in range(3000)] + [("c", 7, False)]
    df = spark.createDataFrame([(g, Decimal(v), c) for g, v, c in data], "g string, v decimal(12,2), c boolean")
    for counted in (None, F.col("c")):
        got = placed(df, "v", ("g",), counted, parts=8).collect()
        values = {}
        for g, v, c in data:
            if c or counted is None:
                values.setdefault(g, set()).add(v)
        assert len(got) == len(data) and all(r["rank"] == 1 + sum(x > r.v for x in values.get(r.g, ())) for r in got)
    assert placed(df.filter("v is null"), "v").count() == 0


def test_cumulative(model):
    m = {"v": Cumulative(AMOUNT), "n": Cumulative(Leaf("sale", "countd", "s_customer")), "least": Cumulative(Leaf("sale", "min", "amount")), "mean": Cumulative(Leaf("sale", "avg", "amount")), "per": Cumulative(AMOUNT / ROWS)}
    got = rows(query(model, ["year"], m), "year")
    assert got == {(2024,): (20, 1, 20, 20, 20), (2025,): (200, 3, 20, 50, 50), (2026,): (200, 3, 20, 50, 50)}
    by = rows(query(model, ["region", "year"], {"v": Cumulative(AMOUNT), "own": AMOUNT}), "region", "year")
    assert by == {(None, 2024): (20, 20), (None, 2025): (20, None), (None, 2026): (20, None), ("north", 2025): (150, 150), ("north", 2026): (150, None), ("south", 2025): (30, 30), ("south", 2026): (30, None)}
    # the calendar's filter says which cells there are and where they end, not what is summed up
    cut = rows(query(model, ["year", "month"], {"v": Cumulative(AMOUNT)}, Context.slicers(day="day >= DATE'2025-01-01' AND day <= DATE'2025-02-05'")), "year", "month")
    assert cut == {(2025, 1): (120,), (2025, 2): (170,)}
    assert rows(query(model, [], {"v": Cumulative(AMOUNT)}, Context.slicers(day="day <= DATE'2025-02-05'")))[()] == (170,)
    ordered = rows(query(model, ["year"], {"v": With(Cumulative(AMOUNT), use=("made",))}), "year")
    assert ordered == {(2024,): (120,), (2025,): (200,), (2026,): (200,)}
    with pytest.raises(TypeError):
        query(model, ["year"], {"v": Cumulative(Iterate(("s_customer",), {"v": AMOUNT}, "max(v)"))})


def test_sliding_windows(spark):
    rnd = random.Random(4)
    data = [(rnd.choice("ab"), rnd.choice([1, 2, 3, 4, 5, None]), rnd.randint(1, 40), rnd.choice([5, 10, -5, 0, None])) for _ in range(150)] + [("a", 1, None, 9)]
    df = spark.createDataFrame([(g, k, m, None if v is None else Decimal(v)) for g, k, m, v in data], "g string, k int, m int, v decimal(12,2)")
    of = {"cy_sum": F.col("cy"), "kept": F.when((F.col("py") > 0) & (F.col("cy") > 0), F.least("cy", "py")).otherwise(F.col("cy") * 0), "lost": ((F.col("py") > 0) & (F.col("cy") == 0)).cast("int")}
    got = {(r.g, r.m): (r.cy_sum, r.kept, r.lost) for r in sliding(df, ["g"], "k", "m", "v", of, length=6).collect()}
    months = [m for _, _, m, _ in data if m]
    for g in "ab":
        start = min(m for x, _, m, _ in data if x == g and m)
        for m in range(start, max(months) + 1):
            total = lambda k, lo, hi: sum(v or 0 for x, y, n, v in data if (x, y) == (g, k) and n and lo < n <= hi)
            each = [(total(k, m - 6, m), total(k, m - 12, m - 6)) for k in (1, 2, 3, 4, 5, None)]
            assert got.pop((g, m)) == (sum(c for c, _ in each), sum(min(c, p) for c, p in each if c > 0 and p > 0), sum(p > 0 and c == 0 for c, p in each))
    assert not got


def test_calculation_group(model):
    clock = Clock("day", dt.date(2025, 2, 15), fy_end=12)
    times = CalculationGroup("item", {"Current": lambda m: m, "PY": clock.py, "YoY %": clock.yoy_pct}, {"YoY %": "0.0%"})
    scale = CalculationGroup("unit", {"One": lambda m: m, "Share": lambda m: share(m, "year")}, precedence=5)
    got = by_items(model, ["year"], {"v": AMOUNT, "n": ROWS}, [times])
    assert got.columns == ["year", "item", "item_ordinal", "item_format", "v", "n"]
    by = {(r.year, r["item"]): (r.item_ordinal, r.item_format, r.v, r.n) for r in got.collect()}
    assert by[(2025, "Current")] == (0, None, 180, 3) and by[(2025, "PY")] == (1, None, 20, 1) and by[(2025, "YoY %")] == (2, "0.0%", 8, 2) and (2024, "PY") not in by
    both = {(r.year, r["item"], r.unit): r.v for r in by_items(model, ["year"], {"v": AMOUNT}, [times, scale], only={"item": ["Current", "PY"]}).collect()}
    assert both[(2025, "PY", "One")] == 20 and both[(2025, "PY", "Share")] == 20 / 200 and both[(2025, "Current", "Share")] == 0.9 and (2025, "YoY %", "One") not in both


def test_calculated_columns(spark, model):
    out = calculated(model, "customer", {"total": AMOUNT, "of_all": AMOUNT / With(AMOUNT, clear=True)})
    assert rows(out, "customer") == {(1,): ("north", "a", 150, 0.75), (2,): ("south", "b", 30, 0.15), (3,): ("south", "c", None, None)}
    twice = model.tables["tag"].unionByName(model.tables["tag"].limit(1)).unionByName(spark.createDataFrame([(None, "none")], "t_item int, tag string"))
    wide = Model({**model.tables, "tag": twice}, model.relationships, calendar="calendar")
    got = calculated(wide, "tag", {"v": AMOUNT}, keys=["t_item"]).collect()
    assert sorted((r.t_item or 0, r.v or 0) for r in got) == [(0, 0), (10, 130), (10, 130), (11, 50), (12, 20)]
    with pytest.raises(ValueError):
        calculated(model, "customer", {"name": AMOUNT})


def test_totals_in_one_rollup(model):
    m = {"n": Leaf("sale", "countd", "s_customer"), "mean": Leaf("sale", "avg", "amount"), "v": AMOUNT, "kinds": Leaf("sale", "countd", "kind")}
    out = query(model, ["kind", "region"], m, Context.slicers(made="made > DATE'2024-01-01'"), totals=True)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("Expand") >= 1
    got = {(r.level, r.kind, r.region): (r.n, r["mean"], r.v, r.kinds) for r in out.collect()}
    assert got[(0, None, None)] == (3, 50, 200, 2) and got[(1, "x", None)] == (2, 65, 130, 1) and got[(1, "y", None)] == (2, 35, 70, 1) and got[(2, "y", None)] == (1, 20, 20, 1) and len(got) == 7
