import datetime as dt
import difflib
import random

from tidewheel import sources as S
from tidewheel.operators import entity as E
from tidewheel.operators.joins import among, blended, excluding, latest_per_key, lookup


def test_csv_and_latest_file(spark, tmp_path):
    for year in (2023, 2025, 2024):
        (tmp_path / f"report FY{year}.csv").write_text(f"id,name\n{year},é€\nx,y\n", encoding="cp1252")
    path = S.latest_file(spark, str(tmp_path))
    assert path.endswith("FY2025.csv")
    rows = S.csv_table(spark, path, "id int, name string, bad string", encoding="cp1252", errors="bad").collect()
    assert [(r.id, r.name) for r in rows] == [(2025, "é€"), (None, "y")] and rows[1].bad
    assert S.latest_file(spark, str(tmp_path), r"none(\d)") is None


def test_literals_and_series(spark, tmp_path):
    t = S.literal(spark, "k int, d date", [(1, dt.date(2025, 1, 1)), (None, None)])
    assert [tuple(r) for r in t.collect()] == [(1, dt.date(2025, 1, 1)), (None, None)] and S.literal(spark, "k int", []).count() == 0
    assert S.date_range(spark, dt.date(2025, 1, 30), dt.date(2025, 2, 2)).count() == 4
    assert [float(r.value) for r in S.number_range(spark, 5, 50, 5, places=0).collect()] == list(range(5, 51, 5))
    S.write_parquet(t, str(tmp_path / "p"))
    S.write_csv(t, str(tmp_path / "c"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 2 and spark.read.csv(str(tmp_path / "c"), header=True).count() == 2
    S_json = tmp_path / "j.json"
    S_json.write_text('{"a": 1}\n{"a": "x"}\n')
    assert [r.a for r in S.json_table(spark, str(S_json), "a int").collect()] == [1, None]


def test_joins(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "b"), (1, "a"), (None, "z")], "r int, v string")
    assert sorted((r.k or 0, r.x or "") for r in lookup(left, right, {"k": "r"}, {"x": "v"}).collect()) == [(0, ""), (1, "a"), (2, "")]
    assert sorted(r.k or 0 for r in excluding(left, right, {"k": "r"}).collect()) == [0, 2] and [r.k for r in among(left, right, {"k": "r"}).collect()] == [1]
    out = blended({"a": spark.createDataFrame([(1, 5), (2, 6)], "k int, a int"), "b": spark.createDataFrame([(2, 7), (None, 8)], "k int, b int")}, ["k"])
    assert {(r.k, r.a, r.b) for r in out.collect()} == {(1, 5, None), (2, 6, 7), (None, None, 8)}
    assert [tuple(r) for r in latest_per_key(right, ["r"], "v").orderBy("r").collect()] == [(None, "z"), (1, "b")]


def test_cleaning(spark):
    names = {"The A&B Co. c/o Bob": ("The A&B Co.", "A AND B"), "Smith + Sons, L.L.C": ("Smith + Sons, L.L.C", "SMITH AND SONS LLC"), "Walmart #12": ("Walmart #12", "WALMART 12"), "Acme CO East": ("Acme", "ACME")}
    got = {r.name: (r.stripped, r.normal, r.master) for r in E.cleaned(spark.createDataFrame([(n,) for n in names], "name string"), "name").collect()}
    assert {k: v[:2] for k, v in got.items()} == names and got["Walmart #12"][2] == "WALMART"
    kinds = {"GRACE CHURCH SCHOOL": "Private Schools", "LAKE ELEMENTARY": "Public Schools", "HOLY TRINITY": "Religious", "VET CLINIC": "Medical", "RED INN": "Hospitality", "CITY JAIL": "Municipal", "CLOUD NINE": "Data Center", "TOOL WORKS": "Industrial", "LAW FIRM": "Office", "ZZZ": "Other"}
    rows = spark.createDataFrame([(n,) for n in kinds], "name string")
    assert {r.name: r.s for r in rows.select("name", E.segment("name").alias("s")).collect()} == kinds


def greedy(names):
    import re

    key = lambda n: re.sub(rf"\b({E.NOISE_WORDS})\b", "", n).strip()
    out = {}
    names = sorted(names, key=lambda n: (len(n), n))
    for n in names:
        if n in out:
            continue
        out[n] = n
        for c in names:
            if c not in out and (key(n) == key(c) or difflib.SequenceMatcher(None, key(n), key(c)).ratio() > 0.95):
                out[c] = n
    return out


def test_merge_against_brute_force(spark):
    rnd = random.Random(6)
    names = set()
    for _ in range(25):
        base = "".join(rnd.choice("ABCDEFGH ") for _ in range(rnd.randint(3, 45))).strip()
        names.add(base)
        for _ in range(4):
            w = list(base)
            for _ in range(rnd.randint(1, 2)):
                at = rnd.randrange(len(w) + 1)
                rnd.choice([lambda: w.insert(at, rnd.choice("ABX")), lambda: w.__delitem__(slice(at, at + 1)), lambda: w.__setitem__(slice(at, at + 1), ["Q"])])()
            names.add("".join(w).strip())
        names.add(f"{base} INC")
    names.discard("")
    got = {r.name: r.canonical for r in E.merged(spark.createDataFrame([(n,) for n in names], "name string")).collect()}
    assert got == greedy(names)


def test_changes_log(spark):
    rows = spark.createDataFrame([(1, "Amazon Web LLC"), (2, "Blue Heron Trading Post c/o X"), (3, "Blue Heron Trading Post"), (4, "Blue Heron Trading Posts"), (5, None)], "k int, name string")
    got = {r.k: (r.master, r.changes) for r in E.resolved(rows, "k", "name").collect()}
    assert got[1] == ("AMAZON", "Chain Rule") and got[2] == ("BLUE HERON TRADING POST", "C/O Strip") and got[3][1] == "" and got[4] == ("BLUE HERON TRADING POST", "Fuzzy Merge")
    assert len(got) == 5
