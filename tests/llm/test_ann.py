import numpy as np
from pyspark.sql import functions as F

from tidewheel.llm import ann as A

SCHEMA = "vec_id bigint, embedding array<float>, score double"


def brute(rows, queries, k=5):
    out = {}
    good = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    for q in queries:
        s = [(-(v @ good[q]) / (np.sqrt(v @ v) * np.sqrt(good[q] @ good[q])), i) for i, v in good.items() if i != q]
        out[q] = [i for _, i in sorted((round(a, 12), i) for a, i in s)[:k]]
    return out


def found(spark, rows, every=20, **how):
    df = spark.createDataFrame([(i, v, 0.5) for i, v in rows], SCHEMA)
    vectors = A.usable(df)
    got = {}
    for r in A.search(vectors, vectors.filter(F.col("vec_id") % every == 0), **how).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return got


def test_recall_and_scores(spark, monkeypatch):
    draw = np.random.default_rng(1)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(4000, 16)))]
    want = brute(rows, range(0, 4000, 20))
    for size, block in ((64, 4096), (512, 100)):
        monkeypatch.setattr(A, "LIST_SIZE", size)
        monkeypatch.setattr(A, "BLOCK", block)  # lists and their queries in several blocks
        got = found(spark, rows)
        assert got.keys() == want.keys() and all([r for r, _, _ in v] == [1, 2, 3, 4, 5] for v in got.values())
        hits = sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want)
        assert hits >= 0.9 * 5 * len(want)
        for q, v in list(got.items())[:20]:
            for _, i, s in v:
                a, b = (np.array(rows[x][1], np.float32).astype(float) for x in (q, i))
                assert abs(s - a @ b / np.sqrt((a @ a) * (b @ b))) < 1e-12


def test_ties_copies_and_odd_vectors(spark):
    same = [1.0, 2.0, 3.0]
    rows = [(i, same) for i in range(0, 300)] + [(1000, None), (1001, []), (1002, [0.0, 0.0, 0.0]), (1003, [1.0, None, 2.0]), (1004, [float("nan"), 1.0, 1.0]), (1005, [float("inf"), 1.0, 1.0]), (1006, [1.0, 2.0]), (None, same), (60, same)]
    got = found(spark, rows)
    for q, v in got.items():
        want = [i for i in range(6) if i != q][:5]
        assert [i for _, i, _ in v] == want and all(abs(s - 1) < 1e-12 for _, _, s in v)
    assert sorted(got) == list(range(0, 300, 20))


def test_few_and_none(spark):
    got = found(spark, [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1e30, 1e30])])
    assert [(r, i) for r, i, _ in got[0]] == [(1, 2), (2, 1)]
    assert found(spark, [(0, [1.0, 0.0])]) == {} and found(spark, []) == {} and found(spark, [(0, None)]) == {}


def test_lists_are_balanced():
    draw = np.random.default_rng(3)
    x = A.units(np.concatenate([draw.normal(size=(900, 8)), draw.normal(size=(100, 8)) * 0.01 + 1]))
    sizes = [len(g) for g in A._leaves(x, np.arange(1000), 16, draw)]
    assert sum(sizes) == 1000 and max(sizes) - min(sizes) <= 4


def test_lists_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(A, "LIST_SIZE", 32)
    monkeypatch.setattr(A, "MAX_LISTS", 12)  # 125 lists would be needed
    monkeypatch.setattr(A, "CELL_ROWS", 150)
    draw = np.random.default_rng(6)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(4000, 12)))]
    want = brute(rows, range(0, 4000, 20))
    got = found(spark, rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert sum(len({i for _, i, _ in got[q]} & set(want[q])) for q in want) >= 0.9 * 5 * len(want)


def test_all_that_can_be_found(spark, monkeypatch):
    monkeypatch.setattr(A, "LIST_SIZE", 1)  # lists of one vector: what a query visits at first is too little
    draw = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(draw.normal(size=(40, 4)))]
    got = found(spark, rows, every=10, at_least=1)
    assert all(len(v) == 5 for v in got.values()) and len(got) == 4
    few = found(spark, rows[:4], every=1, at_least=1)
    assert all(len(v) == 3 for v in few.values())
