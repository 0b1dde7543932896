"""All registered queries on the smallest test tables, against DuckDB where there is SQL."""

import os

import duckdb
import pytest

from tidewheel.queries import REGISTRY

DATA = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


def plain(row):
    return str({k: float(f"{v:.8g}") if isinstance(v, float) else v for k, v in sorted(row.items())})


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query(spark, name):
    out = REGISTRY.queries[name](spark, DATA)
    got = sorted(plain(r.asDict()) for r in out.collect())
    if name not in REGISTRY.sql:
        assert got
        return
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cur = con.execute(REGISTRY.sql[name])
    names = [c[0] for c in cur.description]
    import decimal

    number = lambda v: float(v) if isinstance(v, decimal.Decimal) else v
    assert got == sorted(plain({k: number(v) for k, v in zip(names, r)}) for r in cur.fetchall())


def test_display_formats_of_balances_around_zero(spark, tmp_path):
    balances = [None, -0.0, 0.0, -1e-9, -0.004, -0.01, -0.49, -0.494, -0.495, -0.5, -1.5, -999.5, -1000.0, 0.004, 0.49, 0.495, 0.5, 1234567.5, 8.495, -8.495, 1024.495, 9999999999.99]
    rows = [(k, None if k == 3 else k % 25, b) for k, b in enumerate(balances)]
    spark.createDataFrame(rows, "c_custkey bigint, c_nationkey int, c_acctbal double").write.parquet(str(tmp_path / "customer.parquet"))
    got = sorted(tuple(r) for r in REGISTRY.queries["display_formats"](spark, str(tmp_path)).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW customer AS SELECT * FROM '{tmp_path}/customer.parquet/*.parquet'")
    assert got == sorted(con.execute(REGISTRY.sql["display_formats"]).fetchall())
    assert [p for _, _, p, _ in got[1:10]] == ["$0", "$0", "-$0", "-$0", "-$0", "-$0", "-$0", "-$1", "-$1"]
