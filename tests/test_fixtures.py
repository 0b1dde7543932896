"""Cases that the test tables lack: customers who stop and return, rows of zeros."""

import datetime as dt

from tidewheel.operators import reshape
from tidewheel.operators.business import retention as R
from tidewheel.queries.base import ANCHOR


def test_customers_stop_and_return(spark):
    now, before, older = dt.date(2001, 3, 1), dt.date(2000, 3, 1), dt.date(1999, 3, 1)
    rows = [("stopped", before, 10.0), ("returned", older, 5.0), ("returned", now, 7.0), ("less", before, 9.0), ("less", now, 4.0), ("more", before, 2.0), ("more", now, 3.0), ("steady", before, 1.0), ("steady", now, 1.0), ("gone", older, 8.0)]
    s = spark.createDataFrame(rows, "customer string, d date, revenue double")
    got = {r.customer: r.category for r in R.current_and_prior(s, ["customer"], "revenue", ANCHOR).withColumn("category", R.category()).collect()}
    assert got == {"stopped": "Churned", "returned": "New Business", "less": "Contraction", "more": "Upsell", "steady": "Steady"}
    (r,) = R.retention(s, "customer", [], "revenue", ANCHOR).collect()
    assert (r.base, r.churn, r.contraction, r.upsell, r.logos, r.logos_lost) == (22.0, 10.0, 5.0, 1.0, 4, 1)


def test_zero_rows_go(spark):
    rows = spark.createDataFrame([(1, 0.0, None), (2, None, None), (3, 0.0, 2.0), (4, 1.0, None), (5, 0.0, 0.0)], "k int, q double, x double")
    assert sorted(r.k for r in reshape.without_zero_rows(rows, "q", "x").collect()) == [3, 4]
