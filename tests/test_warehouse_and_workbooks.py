"""Workbooks and a warehouse that the test itself fills."""

import datetime as dt
import io
import zipfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidewheel import sources as S
from tidewheel.sources import workbook as W

SCHEMA = "id bigint, name string, day date, at timestamp, amount decimal(12,2), share double, flag boolean"
ROWS = [
    (1, "plain", dt.date(2025, 1, 31), dt.datetime(2025, 1, 31, 13, 45, 30, 250000), Decimal("12.34"), 0.1, True),
    (2, " <&>\"' é😀\n\ttab ", dt.date(1900, 1, 1), dt.datetime(1900, 2, 28, 6), Decimal("-0.01"), -1e-9, False),
    (3, "_x0041_ \x01 \r", dt.date(1900, 3, 1), dt.datetime(1999, 12, 31, 23, 59, 59, 999000), None, 1e300, None),
    (None, "plain", None, None, Decimal("9999999999.99"), None, None),
    (2**53, "", None, None, None, None, None),
]


def test_workbooks_there_and_back(spark):
    df = spark.createDataFrame(ROWS * 4, SCHEMA).repartition(2)
    path = S.shared_folder(spark)
    S.write_workbooks(df, path, sheet="Sales", rows=7)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    assert files.count() >= 3
    for f in files.select("content").collect():
        with zipfile.ZipFile(io.BytesIO(bytes(f.content))) as z:
            assert z.testzip() is None and z.comment == b"\n"
    want = sorted(map(str, df.collect()))
    for where in ({}, {"sheet": "Sales"}, {"table": "Sales"}):
        assert sorted(map(str, S.workbook_table(spark, path, SCHEMA, **where).collect())) == want
    few = S.workbook_table(spark, path, "amount double, missing string, name int, day string, bad string", errors="bad").collect()
    assert len(few) == 20 and all(r.missing is None and r.name is None for r in few)
    assert {r.bad for r in few} == {"name: plain", "name:  <&>\"' é😀\n\ttab ", "name: _x0041_ \x01 \r", None} and {r.day for r in few} == {"45688.0", "1.0", "61.0", None}
    assert S.workbook_table(spark, path, SCHEMA).filter("false").count() == 0
    with pytest.raises(Exception, match="no sheet Other"):
        S.workbook_table(spark, path, SCHEMA, sheet="Other").count()


def book(sheet, shared="", more=""):
    out = io.BytesIO()
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}>{more}<sheets><sheet name="A" sheetId="3" r:id="x"/><sheet name="B" sheetId="1" r:id="y"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships><Relationship Id="y" Target="worksheets/other.xml"/><Relationship Id="x" Target="/xl/worksheets/one.xml"/></Relationships>')
        z.writestr("xl/worksheets/one.xml", f"<worksheet {ns}><sheetData>{sheet}</sheetData></worksheet>")
        z.writestr("xl/worksheets/other.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        if shared:
            z.writestr("xl/sharedStrings.xml", f"<sst {ns}>{shared}</sst>")
    return out.getvalue()


def test_cells_as_others_write_them():
    shared = "<si><t>Day</t></si><si><r><t>Na</t></r><r><rPr/><t>me</t></r><rPh><t>no</t></rPh></si>"
    sheet = '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="AA2" t="s"><v>1</v></c></row><row r="5"><c r="AA5" t="inlineStr"><is><t>x</t></is></c><c t="e"><v>#N/A</v></c></row><row><c t="b"><v>1</v></c><c><v>1.5</v></c><c t="str"><f>A1</f><v>y</v></c><c t="d"><v>2025-01-02</v></c><c><f>B1</f></c></row>'
    w = W.Workbook(book(sheet, shared, '<workbookPr date1904="1"/>'))
    rows = list(w.rows())
    assert rows[0][1] == "Day" and rows[0][26] == "Name" and len(rows[0]) == 27 and rows[1][26:] == ["x", None] and rows[2] == [True, "1.5", "y", "2025-01-02", None]
    assert w.since_1904 and list(w.rows("B")) == []
    kind = lambda ddl: __import__("pyspark").sql.types.StructType.fromDDL(f"x {ddl}")[0].dataType
    assert W.converted(W._Number("0"), kind("date"), True) == dt.date(1904, 1, 1) and W.converted("2025-01-02", kind("date")) == dt.date(2025, 1, 2)
    assert W.converted(W._Number("59"), kind("date")) == dt.date(1900, 2, 28) and W.converted(W._Number("61"), kind("date")) == dt.date(1900, 3, 1)
    assert W.converted(W._Number("1.5E2"), kind("int")) == 150 and W.converted(True, kind("string")) == "TRUE" and W.converted(W._Number("1"), kind("boolean")) is True
    for value, ddl in (("x", "int"), (W._Number("1.5"), "int"), (W._Number("3000000000"), "int"), ("soon", "date"), (True, "date"), (W._Number("1234"), "decimal(3,0)")):
        with pytest.raises((ValueError, ArithmeticError)):
            W.converted(value, kind(ddl))


def test_warehouse(spark):
    url = "jdbc:derby:memory:tidewheel_test;create=true"
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).cast("int").alias("g"), (F.col("id") * 1.5).alias("v"), F.concat(F.lit("n"), F.col("id")).alias("name"))
    S.write_warehouse(df, url, "facts", types="name VARCHAR(40)")
    whole = S.warehouse_table(spark, url, "facts", key="k", parts=4)
    assert whole.rdd.getNumPartitions() == 4 and sorted(map(tuple, whole.collect())) == sorted(map(tuple, df.collect()))
    sizes = [r.n for r in whole.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) <= 260  # ranges follow the key's own bounds
    some = whole.filter("k >= 990 and name <> 'n995'").select("k", "v")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,990)" in plan and "Not(EqualTo(name,n995))" in plan and "ReadSchema: struct<k:bigint,v:double" in plan and some.count() == 9
    S.write_warehouse(df.limit(0), url, "nothing")
    assert S.warehouse_table(spark, url, "nothing", key="k").count() == 0
    S.warehouse_catalog(spark, "wh", url)
    total = spark.sql("SELECT g, sum(v) AS v, count(*) AS n FROM wh.APP.FACTS WHERE k < 500 GROUP BY g")
    plan = total._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregates: [SUM(v), COUNT(*)]" in plan and "PushedGroupByExpressions: [g]" in plan
    want = df.filter("k < 500").groupBy("g").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    assert sorted(map(tuple, total.collect())) == sorted(map(tuple, want.collect()))
