"""The worked examples of the domain computations."""

import datetime as dt
from decimal import Decimal

import pytest

from tidewheel.operators import reshape
from tidewheel.operators.business import margin, projects, retention
from tidewheel.operators.joins import contract_key_parts, inferred_members

ANCHOR = dt.date(2025, 12, 31)


def month(k):
    y, m = divmod(2025 * 12 + 11 - k, 12)
    return dt.date(y, m + 1, 15)


@pytest.fixture
def revenue(spark):
    data = {"A": (10000, 10000), "B": (10000, 15000), "C": (10000, 5000), "D": (10000, None), "F": (None, 10000)}
    rows = [(c, month(14 if which == 0 else 2), Decimal(v)) for c, pair in data.items() for which, v in enumerate(pair) if v is not None]
    rows.append(("E", month(40), Decimal(500)))
    return spark.createDataFrame(rows, "customer string, d date, amount decimal(18,4)")


def test_retention(spark, revenue):
    r = retention.retention(revenue, "customer", [], "amount", ANCHOR).first()
    assert (r.base, r.churn, r.contraction, r.upsell) == (40000, 10000, 5000, 5000)
    assert (r.nrr, r.grr, r.logos, r.logos_lost, r.logo_retention) == (0.75, 0.625, 4, 1, 0.75)
    each = retention.current_and_prior(revenue, ["customer"], "amount", ANCHOR).withColumn("k", retention.category())
    assert {x.customer: x.k for x in each.collect()} == {"A": "Steady", "B": "Upsell", "C": "Contraction", "D": "Churned", "F": "New Business"}
    steps = [(x.label, int(x.amount)) for x in retention.waterfall(retention.retention(revenue, "customer", [], "amount", ANCHOR)).orderBy("step").collect()]
    assert steps == [("Base", 40000), ("Churn", -10000), ("Contraction", -5000), ("Upsell", 5000), ("Retained", 30000)]
    total = retention.retention_single_grain(revenue, [], "amount", ANCHOR).first()
    assert (total.cy, total.py, total.contraction, total.upsell) == (40000, 40000, 0, 0)


def test_credit_counts_as_retained(spark):
    df = spark.createDataFrame([("G", month(14), Decimal(10000)), ("G", month(2), Decimal(-1000))], "customer string, d date, amount decimal(18,4)")
    r = retention.retention(df, "customer", [], "amount", ANCHOR).first()
    assert (r.base, r.churn, r.contraction, r.upsell) == (10000, 0, 0, 0)
    assert retention.current_and_prior(df, ["customer"], "amount", ANCHOR).select(retention.category().alias("k")).first().k == "Contraction"


def test_window_bounds(spark):
    days = spark.createDataFrame([("x", d, Decimal(1)) for d in (dt.date(2024, 1, 1), dt.date(2023, 12, 1), dt.date(2024, 12, 31), dt.date(2025, 12, 31))], "c string, d date, amount decimal(18,4)")
    r = retention.current_and_prior(days, ["c"], "amount", ANCHOR).first()
    assert (r.cy, r.py) == (1, 2)


def test_lifecycle(spark):
    ends = {"a": month(5), "b": month(6), "c": month(11), "d": month(12), "e": None}
    rows = [(c, 0.0 if d is None else 1.0, d or month(1)) for c, d in ends.items()]
    got = {r.customer: r.status for r in retention.lifecycle(spark.createDataFrame(rows, "customer string, amount double, d date"), "customer", "amount", "d", ANCHOR).collect()}
    assert got == {"a": "Active", "b": "Dormant (6–11 mo)", "c": "Dormant (6–11 mo)", "d": "Inactive (12+ mo)", "e": "No Activity"}


def test_promoter_score(spark):
    r = retention.promoter_score(spark.createDataFrame([("x", v) for v in (10, 9, 8, 6, 1, None)], "k string, s int"), ["k"], "s").first()
    assert (r.promoters, r.detractors, r.answers, r.nps) == (2, 2, 5, 0)


def test_floor(spark):
    rows = [(100.0, 31.49), (100.0, 31.44), (0.0, 5.0), (100.0, 40.0), (-100.0, -10.0)]
    df = spark.createDataFrame([(Decimal(str(s)), Decimal(str(g))) for s, g in rows], "sell decimal(18,4), gp decimal(18,4)")
    below, above = margin.floor_flags("sell", "gp", 0.32)
    assert [tuple(r) for r in df.select(below, above).collect()] == [(False, True), (True, False), (False, False), (False, True), (True, False)]
    r = margin.floor_impact(df.limit(2), []).first()
    assert (r.n, r.n_below, float(r.shortfall)) == (2, 1, pytest.approx(0.56))


CASES = [
    ([100, 200, 0, 300], [400, 0, 100, 0], [0, 0, 100, 0], 1000, [250, 750, 660, 1100], [250, 500, -90, 440]),
    ([50, 50], [0, 200], [0, 0], 500, [None, 250], [None, 250]),
    ([50, 25, 25], [200, -200, 100], [0, 0, 0], 500, [125, None, 500], [125, None, 500]),
    ([50, 50], [100, 0], [0, 0], None, [None, None], [None, None]),
]


@pytest.mark.parametrize("actual,forecast,change,contract,earned,monthly", CASES)
def test_earned_revenue(spark, actual, forecast, change, contract, earned, monthly):
    rows = [("j", dt.date(2025, k + 1, 28), Decimal(a), Decimal(f), Decimal(c), None if contract is None else Decimal(contract)) for k, (a, f, c) in enumerate(zip(actual, forecast, change))]
    df = spark.createDataFrame(rows, "job string, month date, a decimal(18,2), f decimal(18,2), c decimal(18,2), contract decimal(18,2)")
    got = projects.earned_revenue(df, "job", "month", "a", "f", "c", "contract").orderBy("month").collect()
    number = lambda v: None if v is None else round(v, 6)
    assert [number(r.earned) for r in got] == earned and [number(r.earned_month) for r in got] == monthly


def test_straight_line(spark):
    df = spark.createDataFrame([("k", dt.date(2024, 1, 15), 700.0), ("k", dt.date(2024, 4, 2), 500.0)], "k string, d date, amount double")
    got = [(r.month_end, float(r.amount)) for r in projects.straight_line(df, ["k"], "d", "amount").orderBy("month_end").collect()]
    assert got == [(dt.date(2024, m, d), 300.0) for m, d in ((1, 31), (2, 29), (3, 31), (4, 30))]


def test_contract_years_and_keys(spark):
    n = spark.createDataFrame([("a", None), ("b", 0), ("c", 3)], "k string, n int")
    got = [(r.k, r.year_index) for r in reshape.explode_years(n, "n").orderBy("k", "year_index").collect()]
    assert got == [("a", 1), ("b", 1), ("c", 1), ("c", 2), ("c", 3)]
    keys = spark.createDataFrame([("C1SERV_GP_K9_2",), ("C1SERV_GP_AB_7_3",), ("C2SERV_GP_X",), ("C3SERV_GP_A_b",)], "key string")
    parts = contract_key_parts("key")
    got = {r.key: (r.customer, r.contract, r.year) for r in keys.select("key", *(c.alias(k) for k, c in parts.items())).collect()}
    assert got == {"C1SERV_GP_K9_2": ("C1", "K9", 2), "C1SERV_GP_AB_7_3": ("C1", "AB_7", 3), "C2SERV_GP_X": ("C2", "X", 0), "C3SERV_GP_A_b": ("C3", "A_b", 0)}


def test_inferred_members(spark):
    fact = lambda rows: spark.createDataFrame(rows, "k string, d date")
    dim = spark.createDataFrame([("known",)], "key string")
    facts = {"Revenue": (fact([("a ", month(3)), ("known", month(1)), (None, month(1)), ("r", month(2))]), "k", "d"), "Cost": (fact([("a", month(9)), ("c", month(4))]), "k", "d")}
    got = {r.key: (r.first_date, r.last_date, r.source) for r in inferred_members(dim, "key", facts).collect()}
    assert got == {"a": (month(9), month(3), "Both"), "r": (month(2), month(2), "Revenue Only"), "c": (month(4), month(4), "Cost Only")}


def test_backlog_rules(spark):
    rows = [("burn at once", 100, 0, dt.date(2026, 2, 1)), ("even", 1000, 0, dt.date(2026, 10, 1)), ("done", 100, 150, dt.date(2026, 10, 1)), ("no end", 100, 0, None)]
    df = spark.createDataFrame([(k, Decimal(c), Decimal(r), Decimal(0), Decimal(0), e) for k, c, r, e in rows], "k string, contract decimal(18,2), revenue decimal(18,2), cost decimal(18,2), estimate decimal(18,2), e date")
    got = {r.k: r.burn for r in projects.backlog(df, "contract", "revenue", "cost", "estimate", "e", ANCHOR).collect()}
    assert got == {"burn at once": 100, "even": 100, "done": 0, "no end": 100}


def test_conversion_errors(spark):
    df = spark.createDataFrame([(1, "5", "x"), (2, "y", None)], "id int, a string, b string")
    assert [tuple(r) for r in reshape.conversion_errors(df, {"a": "int", "b": "int"}, "id").orderBy("id").collect()] == [(1, "b", "x"), (2, "a", "y")]
    assert [tuple(r) for r in reshape.convert(df, {"a": "int"}).orderBy("id").select("a").collect()] == [(5,), (None,)]


def test_composite_keys(spark):
    df = spark.createDataFrame([("a", None, 1)], "x string, y string, z int")
    r = df.select(reshape.composite_key("x", "y", "z").alias("p"), reshape.composite_key("x", "y", "z", null_breaks=False).alias("q")).first()
    assert (r.p, r.q) == (None, "a_1")
