import datetime as dt
import math

from pyspark.sql import functions as F

from tidewheel.operators import charts
from tidewheel.operators.business import ledger as L
from tidewheel.streaming import month_close as M


def test_accounts(spark):
    rows = [
        ("SERV_GP", "330", "20", "412", "REVENUE", None, "CERTIFIED"), ("SERV_GP", "345", "27", "632", "COST OF SALES", "EQUIPMENT & MATERIAL", "INTERCOMPANY SPOT"), ("SERV_GP", "340", "27", "633", "COST OF SALES", "LABOR", "O&M SPOT"),
        ("SERV_GP", "340", "20", "639", "COST OF SALES", "BURDEN", "SPOT"), ("SERV_GP", "340", "27", "300", "COST OF SALES", "DISCOUNTS", "O&M"), ("SERV_GP", "340", "20", "301", "COST OF SALES", None, "ASSURED"), ("SERV_GP", "510", "20", "301", "OPERATIONS EXPENSE", None, "A"),
        ("SERV_GP", "610", "27", "501", "SALES EXPENSE", None, "O&M PROJECTS"), ("MECH_GP", "331", "04", "1", "REVENUE", None, "PLAN SPEC"), ("MECH_GP", "710", "04", "1", "G&A EXPENSE", None, None), ("X", "999", "04", "1", "BROKEN", None, None), ("SERV_GP", "x", "04", "7", "BROKEN", None, None),
    ]
    df = spark.createDataFrame(rows, "source string, a string, b string, c string, kind string, category string, market string")
    c = F.col
    out = df.withColumn("k", L.account_type(c("a"))).withColumn("g", L.cost_category(c("k"), c("c"))).withColumn("m", L.market(c("source"), c("a"), c("b"), c("c")))
    for r in out.collect():
        assert (r.k, r.g, r.m) == (r.kind, r.category, r.market), r
    where = {"SERV_GP": {"one": ["20", "27"]}, "MECH_GP": {"two": ["04"]}}
    assert [r.r for r in df.select(L.region(c("source"), c("b"), where).alias("r")).collect()] == ["one"] * 8 + ["two", "two", "BROKEN", "Missing Division"]


def test_charts(spark):
    df = spark.createDataFrame([("a", 1, 40.0, 50.0), ("a", 2, -10.0, None), ("b", 1, 0.0, 0.0)], "g string, i int, v double, w double")
    out = {(r.g, r.i): r for r in charts.waterfall_positions(charts.scaled_variance(df, ["g"], "v", "w", 100), ["g"], "i", "v").collect()}
    r = out["a", 1]
    assert (r.axis, r.bar, r.base_bar, r.change, r.change_pct, r.favourable) == (50, 80, 100, -10, -0.2, False)
    assert (out["a", 2].bar_start, out["a", 2].bar_end, out["a", 2].change_pct) == (40, 30, None) and out["b", 1].bar == 0
    many = {(r.g, r.i): r for r in charts.small_multiples(df.unionByName(df.limit(1).select(F.lit("c").alias("g"), "i", F.lit(None).cast("double").alias("v"), "w")), "g", "i", "v", "v", 1, 100).collect()}
    assert [(many[k].category_rank, many[k].place, many[k].is_actual, many[k].bar_from, many[k].bar_size) for k in (("a", 1), ("a", 2), ("b", 1), ("c", 1))] == [(1, 1, True, 0, 80), (1, 2, False, 80, 20), (2, 1, True, 80, 0), (3, 1, True, None, None)]
    w = df.filter("i = 1 and g = 'a'").select(*(v.alias(k) for k, v in charts.wide_variance(F.col("v"), F.col("w"), F.lit(100.0), 10).items())).first()
    assert (w.bar, w.base_bar, w.variance_from, w.variance_to, w.change) == (4, 5, 4, 5, -10)
    p = df.limit(1).select(*(v.alias(k) for k, v in charts.pie(F.lit(0.25)).items())).first()
    assert math.isclose(p.x, 1) and abs(p.y) < 1e-12 and not p.long


def test_month_close(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "k string, d date, amount double"

    def feed(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        M.start(spark.readStream.schema(schema).parquet(source), out, str(tmp_path / "check"), ["k"], "d", "amount").awaitTermination()

    feed([("a", dt.date(2025, 1, 5), 10.0), ("a", dt.date(2025, 2, 5), 1.0)])
    feed([("a", dt.date(2025, 1, 30), 5.0), ("b", dt.date(2025, 3, 1), 7.0)])  # January again, late
    got = {(r.k, r.month_end): (r.amount, r.rows) for r in M.published(spark, out, ["k"], dt.date(2025, 3, 10)).collect()}
    assert got == {("a", dt.date(2025, 1, 31)): (15, 2), ("a", dt.date(2025, 2, 28)): (1, 1)}


def test_rolling(spark, tmp_path):
    rows = spark.createDataFrame([("a", dt.datetime(2025, 1, 1), 1.0), ("a", dt.datetime(2025, 1, 2), 2.0), ("a", dt.datetime(2025, 3, 1), 4.0)], "k string, t timestamp, amount double")
    rows.write.parquet(str(tmp_path / "in"))
    stream = M.rolling(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), "t", ["k"], "amount", "2 days", "2 days")
    q = stream.writeStream.outputMode("complete").format("memory").queryName("rolling").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.amount for r in spark.table("rolling").collect()) == [1.0, 2.0, 4.0] or sorted(r.amount for r in spark.table("rolling").collect()) == [3.0, 4.0]


def test_statement_waterfall(spark):
    lines = [(1, "+", 100, "R", "a"), (2, "+", 40, "R", "b"), (3, "-", 30, "C", "c"), (4, "-", 50, "C", "d"), (5, "=", 60, "Margin", None), (6, "-", 20, "O", "e"), (7, "+", None, "O2", "f"), (8, "=", 40, "Net", None)]
    df = spark.createDataFrame([("g", *x) for x in lines] + [("h", 1, "-", 5, "X", "y")], "k string, n int, s string, v int, p string, i string")
    got = {(r.k, r.level, r.p, r.i): (r.n, r.change, r.bar_from, r.bar_to, r.marker) for r in charts.waterfall_levels(df, ["k"], "n", "s", "v", "p", "i").collect()}
    assert got[("g", 2, "R", "a")] == (1, 100, 0, 100, 140) and got[("g", 2, "R", "b")] == (2, 40, 100, 140, 140) and got[("g", 2, "C", "d")] == (4, -50, 110, 60, 110) and got[("g", 2, "C", "c")] == (3, -30, 140, 110, 110)
    assert got[("g", 1, "Margin", None)] == (5, 60, 0, 60, None) and got[("g", 1, "R", None)] == (1, 140, 0, 140, None) and got[("g", 1, "C", None)] == (3, -80, 140, 60, None)
    assert got[("g", 2, "O", "e")] == (6, -20, 60, 40, 60) and got[("g", 2, "O2", "f")] == (7, 0, 40, 40, 0) and got[("g", 1, "Net", None)] == (8, 40, 0, 40, None) and got[("h", 1, "X", None)] == (1, -5, 0, -5, None)
    assert len(got) == 8 + 4 + 2


def test_scenarios_side_by_side(spark):
    frame = lambda name, rows: spark.createDataFrame(rows, f"m int, {name} double")
    out = charts.scenario_columns({"AC": frame("AC", [(1, 50.0), (2, 20.0)]), "PY": frame("PY", [(2, 100.0), (4, 10.0)]), "PL": frame("PL", [(1, 40.0), (3, 30.0)]), "FC": frame("FC", [(2, 99.0), (3, 25.0)])}, "m", [], 200)
    got = {r.m: r for r in out.collect()}
    assert [(got[m].scenario, got[m].main) for m in (1, 2, 3, 4)] == [("AC", 50), ("AC", 20), ("FC", 25), (None, None)]
    assert (got[1].main_height, got[1].main_at, got[1].plan_height, got[1].variance_at, got[1].variance_height, got[1].favourable) == (100, 100, 80, 100, 20, True)
    assert got[2].prior_at == 0 and got[2].variance_at is None and got[3].favourable is False and got[4].prior_at == 180
