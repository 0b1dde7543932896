import math
from fractions import Fraction

import numpy as np
import pytest

from tidewheel.llm import whiten as W


def brute(rows, k=16):
    """vec_id -> (n, deviation, whitened up to sign, explained), in exact arithmetic up to the covariance."""
    kept = [(key, [math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v]) for key, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    d = len(kept[0][1])
    points = [list(p) for p in {tuple(x) for _, x in kept}]
    n, sums = len(points), [sum(c) for c in zip(*points)]
    centred = [[n * c - s for c, s in zip(p, sums)] for p in points]
    v = np.array([[float(Fraction(sum(p[i] * p[j] for p in centred), n**3)) for j in range(d)] for i in range(d)])
    values, columns = np.linalg.eigh(v)
    values, columns = values[::-1][:k], columns[:, ::-1][:, :k]
    out = []
    for key, x in kept:
        away = [n * c - s for c, s in zip(x, sums)]
        out.append((key, n, sum(a * a for a in away), np.array([a / n for a in away]) @ columns / np.sqrt(values), values / np.trace(v)))
    return out


@pytest.mark.parametrize("d,block", [(5, 8), (20, 8), (20, 64), (9, 4)])
def test_against_exact_arithmetic(spark, d, block):
    rnd = np.random.default_rng(d)
    mix = rnd.normal(size=(d, d)) * np.linspace(0.05, 1, d)[:, None]
    rows = [(k, [float(c) for c in rnd.normal(size=d) @ mix]) for k in range(300)]
    rows += [(k, rows[0][1]) for k in (500, 500, 501, None)] + [(600, None), (601, [float("nan")] * d), (602, [*rows[1][1][1:], None]), (603, [float("-inf")] * d), (604, []), (605, [1.0])]
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], "vec_id bigint, embedding array<float>, whitened string, n int")
    model = W.fit(df, block=block)
    assert model.long and model.error < 1e-9
    want = brute([r for r in rows if r[1] is None or len(r[1]) == d])
    got = W.components(W.transform(df, model), model).collect()
    assert W.transform(df, model).columns == ["vec_id", "embedding", "whitened", "n", "deviation"]
    k = min(16, d)
    assert len(got) == k * len(want) and {r.component for r in got} == set(range(1, k + 1))
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {}).setdefault(r.component, []).append(r)
    signs = None
    for key, n, deviation, whitened, explained in want:
        mine = by[key]
        w = np.array([mine[c + 1][0].whitened for c in range(k)])
        if signs is None:
            signs = np.sign(w * whitened)
        assert np.allclose(w * signs, whitened, rtol=1e-9, atol=1e-9)
        for c in range(k):
            assert {(r.n, r.deviation, r.whitened) for r in mine[c + 1]} == {(n, deviation, w[c])}
            assert abs(mine[c + 1][0].explained / explained[c] - 1) < 1e-9 and mine[c + 1][0].identity_error == model.error
    assert len(by[500][1]) == 2


def test_edges(spark):
    schema = "vec_id bigint, embedding array<double>"
    none = spark.createDataFrame([(1, None), (2, [])], schema)
    assert W.fit(none) is None and W.components(W.transform(none, None), None).count() == 0
    same = spark.createDataFrame([(1, [0.5, 0.25]), (2, [0.5, 0.25])], schema)
    model = W.fit(same)
    got = W.components(W.transform(same, model), model).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, 0.0, None)] * 4
    flat = spark.createDataFrame([(k, [k / 64, 1.0, -k / 64]) for k in range(50)], schema)  # one direction only
    model = W.fit(flat)
    assert model.error < 1e-9 and [w is None for w in W.transform(flat, model).first().whitened] == [False, True, True]
    vast = spark.createDataFrame([(1, [1e30, 0.0]), (2, [-1e30, 1.0]), (3, [0.0, 5.0])], schema)
    model = W.fit(vast)
    got = W.transform(vast, model).collect()
    x = [[int(max(min(64 * c, 2.0**40), -(2.0**40))) + 10**6 for c in v] for v in ([1e30, 0.0], [-1e30, 1.0], [0.0, 5.0])]
    sums = [sum(c) for c in zip(*x)]
    assert not model.long and sorted(int(r.deviation) for r in got) == sorted(sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for v in x)
