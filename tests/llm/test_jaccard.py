import random
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewheel.llm import jaccard as J
from tidewheel.llm import shared as S
from tidewheel.llm.components import components


def brute_set(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(docs):
    sets = [(k, brute_set(t)) for k, t in docs]
    root = {k: k for k, _ in docs}
    changed = True
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[i + 1 :] if x and y and 100 * len(x & y) >= 80 * len(x | y)]
    while changed:
        changed = False
        for a, b in links:
            m = min(root[a], root[b])
            if root[a] != m or root[b] != m:
                root[a] = root[b] = m
                changed = True
    return {k: (len(s), root[k]) for k, s in sets}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet="aAb \n\té ", max_size=60), max_size=6))
def test_sets_have_the_right_size(texts):
    assert [len(s) for s in J.shingle_sets(texts)] == [len(brute_set(t)) for t in texts]


def test_long_texts_and_slices():
    long = "lorem ipsum dolor sit amet consectetur " * 200_000
    a, b, c = J.shingle_sets([long, None, long[: len(long) // 2 // 39 * 39]])
    assert len(a) == 6 and len(b) == 0 and (a == c).all()
    word = "x" * 3_000_000
    (one,) = J.shingle_sets([word + " y"])
    assert len(one) == 1
    p, q = J.shingle_sets(["a" * 64 + "b", "a" * 65])
    assert p[0] != q[0]


def test_long_text_of_wide_characters_after_a_short_one():
    long = " ".join(f"漢語文字{k:x}列漢語文" for k in range(38_000))
    assert len(long) < J.SLICE and len(long.encode()) > 2 * J.SLICE
    texts = ["one two three four five six", long, None, "a b", long]
    got = list(J.shingle_sets(texts))
    assert [len(s) for s in got] == [len(brute_set(t)) for t in texts]
    (alone,) = J.shingle_sets([long])
    assert (got[1] == alone).all() and (got[4] == alone).all()


def corpus(seed, n_groups=6, dense=40):
    rnd = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(500)]
    passage = [rnd.choice(vocabulary) for _ in range(30)]
    docs = [None, "", "  ", "a b c", "A B  c", "a b", "solo"]

    def edit(w, n):
        w = list(w)
        for _ in range(n):
            w[rnd.randrange(len(w))] = rnd.choice(vocabulary)
        return w

    for g in range(n_groups):
        base = [rnd.choice(vocabulary) for _ in range(rnd.randint(6, 90))]
        for _ in range(rnd.randint(2, dense if g == 0 else 8)):
            docs.append(" ".join(edit(base, rnd.choice([0, 0, 1, 2, 3]))))
        chain = base
        for _ in range(6):  # each like the one before, the ends unlike
            chain = edit(chain, 1)
            docs.append(" ".join(chain))
    for _ in range(60):
        docs.append(" ".join([rnd.choice(vocabulary) for _ in range(rnd.randint(5, 60))] + passage))
    docs += [" ".join(passage)] * 25
    rnd.shuffle(docs)
    return [(k * 3 + 5, t) for k, t in enumerate(docs)]


def test_groups_against_brute_force(spark, monkeypatch):
    for seed in (1, 2):
        docs = corpus(seed)
        df = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id bigint, text string, n string, set_hash int")
        want = brute(docs)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.groups(df).collect()}
        assert got == want
        for block, rows, frequent in ((400, 16384, 1 << 19), (1_000_000, 7, 40)):  # large components go block against block
            monkeypatch.setattr(J, "BLOCK", block)
            monkeypatch.setattr(J, "ROWS", rows)
            monkeypatch.setattr(J, "FREQUENT", frequent)
            assert {r.doc_id: (r.n_shingles, r.component_id) for r in J.groups(df).collect()} == want
        monkeypatch.undo()


def test_odd_rows(spark):
    same = "one two three four five six"
    df = spark.createDataFrame([(4, same, 1), (4, same, 1), (None, same, 1), (2, same.upper(), 1), (None, "alone is this text here now", 1), (None, None, 1), (9, None, 1)], "doc_id bigint, text string, component_id int")
    got = sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in J.groups(df).collect())
    assert got == sorted(map(str, [(4, 2, 2), (4, 2, 2), (None, 2, 2), (2, 2, 2), (None, 2, None), (None, 0, None), (9, 0, 9)]))
    kept = sorted(str(r.doc_id) for r in J.first_of_each(df).collect())
    assert kept == ["2", "9", "None", "None", "None"]
    assert J.groups(df.limit(0)).count() == 0


def test_copies_of_one_text(spark, monkeypatch):
    """Half of the rows are copies of one text: they meet their group by a broadcast, the others by a shuffle."""
    monkeypatch.setattr(S, "COMMON", 5)
    docs = corpus(3, n_groups=2, dense=6)
    text = docs[-1][1]
    docs += [(1000 + k, text) for k in range(len(docs))]
    rows = [*docs, (None, text), (None, "of no group at all")]
    got = [tuple(r) for r in J.groups(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()]
    want = brute(docs)
    assert {g[0]: g[1:] for g in got if g[0] is not None} == want and len(got) == len(rows)
    assert sorted((g[1:] for g in got if g[0] is None), key=str) == sorted([want[1000], (1, None)], key=str)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 9), (4, 4), (None, 1)] + [(k, k + 1) for k in range(100, 180)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, **{k: 100 for k in range(100, 181)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def brute_forest(sets, sides):
    root = list(range(len(sets)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(sets):
        for j, y in enumerate(sets[:i]):
            if 100 * len(x & y) >= 80 * len(x | y) and (sides is None or sides[i] != sides[j]):
                a, b = top(i), top(j)
                root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(sets))]


def test_product_against_brute_force():
    for seed in range(60):
        draw = np.random.default_rng(seed)
        k = int(draw.integers(2, 60))
        base = [draw.choice(200, draw.integers(1, 40), replace=False) for _ in range(4)]
        sets = []
        for _ in range(k):
            b, m = base[draw.integers(4)].copy(), draw.integers(0, 3)
            b[draw.integers(0, len(b), m)] = draw.integers(200, 260, m)
            sets.append(np.unique(np.concatenate([b, draw.integers(300, 400, draw.integers(0, 3))])))
        sides = draw.integers(0, 2, k) if seed % 2 else None
        edges = J.overlaps(np.arange(k), np.zeros(k, int) if sides is None else sides, np.concatenate(sets).astype(np.uint64), np.array([len(s) for s in sets]))
        root = list(range(k))

        def top(x):
            while root[x] != x:
                x = root[x]
            return x

        for a, b in edges:
            a, b = top(a), top(b)
            assert a != b  # a forest
            root[max(a, b)] = min(a, b)
        assert [top(i) for i in range(k)] == brute_forest([set(x.tolist()) for x in sets], sides), seed


def test_many_short_rows_that_share_most_shingles(spark, monkeypatch):
    monkeypatch.setattr(J, "ROWS", 1500)
    words = " ".join(f"w{j}" for j in range(13))
    linked = [(k, f"{words} x{k}") for k in range(6000)]  # 9 of 11 shingles in common
    apart = [(6000 + k, f"{words[:-4]} y{k} z{k}") for k in range(6000)]  # 8 of 12
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.groups(spark.createDataFrame(linked + apart, "doc_id bigint, text string")).collect()}
    assert got == {**{k: (10, 0) for k, _ in linked}, **{k: (10, k) for k, _ in apart}}


def test_frequent_shingles_are_at_most_so_many(spark, monkeypatch):
    docs = spark.createDataFrame([(k, " ".join(f"v{j}" for j in range(k % 50 + 5))) for k in range(2000)], "doc_id bigint, text string")
    every = len(J._frequent(docs, 5))
    monkeypatch.setattr(J, "FREQUENT", every // 2)
    assert 0 < len(J._frequent(docs, 5)) <= every // 2


def test_hubs(spark):
    edges = [(0, k) for k in range(1, 60)] + [(k, 100 + k) for k in range(1, 60)] + [(500, 400 + k) for k in range(50)] + [(700, 701)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{k: 0 for k in [*range(60), *range(101, 160)]}, **{k: 400 for k in [500, *range(400, 450)]}, 700: 700, 701: 700}


def test_long_texts_of_few_shingles_go_as_sets(spark, monkeypatch):
    """Texts that repeat a line have few shingles and many bytes; what is shipped is bounded by their sets."""
    rnd = random.Random(8)
    line = lambda k: " ".join(f"w{rnd.randrange(10**6)}" for _ in range(k))
    texts = []
    for _ in range(12):
        base = line(20)
        texts += [f"{base} " * rnd.randint(300, 500) for _ in range(2)] + [f"{base} {line(1)} " * 400, base.upper(), line(900), None]
    texts += [line(60)] * 3 + [f"{texts[0]}{line(2)}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    want = {(k, n, c) for k, (n, c) in brute(list(enumerate(texts))).items()}
    shipped = J._texts(df, df.select(F.col("doc_id").alias("rep"))).agg(F.sum(F.octet_length("text")).alias("t"), F.sum(F.size("set")).alias("s"), F.count("set").alias("n")).first()
    assert shipped.n >= 36 and shipped.t < 300_000 and shipped.s < 36 * 100
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in J.groups(df).collect()} == want
    monkeypatch.setattr(J, "ROWS", 4)  # blocks by rows
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in J.groups(df).collect()} == want


def test_parities_never_rule_out_what_is_alike():
    rng = np.random.default_rng(4)
    for n in (1, 5, 46, 92, 93, 400, 3000):
        sets = [np.unique(rng.integers(0, 1 << 64, n, np.uint64)) for _ in range(20)]
        for s in sets[:10]:  # the same with a ninth replaced, and with a fifth left out
            sets += [np.union1d(s[n // 9 :], rng.integers(0, 1 << 64, n // 9, np.uint64)), s[n // 5 :]]
        sizes = np.array([len(s) for s in sets])
        alike = [(i, j) for j in range(len(sets)) for i in range(j) if 9 * len(np.intersect1d(sets[i], sets[j])) >= 4 * (sizes[i] + sizes[j])]
        found = J._Union(len(sets))
        edges = J.near(np.arange(len(sets)), sizes, [J.parity(s) for s in sets])
        for i, j in edges:
            found.join(i, j)
        assert alike and all(found.group[i] == found.group[j] for i, j in alike)
        origin = [*range(20), *(i for i in range(10) for _ in "ab")]
        assert n < 46 or all(origin[i] == origin[j] for i, j in edges)


def test_a_shingle_that_unrelated_rows_share_ties_no_component(spark):
    rng = np.random.default_rng(5)
    sets = [np.unique(np.append(rng.integers(0, 1 << 64, 200, np.uint64), np.uint64(7))) for _ in range(60)]
    sets[50] = np.append(sets[3][:-1], np.uint64(1 << 63))  # alike: one replaced
    rows = spark.createDataFrame([(i, len(s), [7, *s[1:40].view(np.int64).tolist()], 0, bytearray(J.parity(s))) for i, s in enumerate(sets)], "rep bigint, n int, prefix array<bigint>, n_late int, parity binary")
    edges, shared = J._candidates(rows, rows)
    assert shared.filter("shingle = 7").first().m == 60
    assert {tuple(sorted(e)) for e in edges.collect()} == {(3, 50)}
