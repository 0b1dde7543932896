import gc
import random
import re
import time
import weakref

from tidewheel.llm import decontam as D

DOCS = "doc_id bigint, text string, n_words string, other string"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window):
    wins = {}
    for key, t in items:
        w = words(t)
        if key is None or not w:
            continue
        n = min(window, len(w))
        for i in range(len(w) - n + 1):
            wins.setdefault(tuple(w[i : i + n]), set()).add(key)
    out = []
    for t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(x) for x in wins}:
            for i in range(len(w) - n + 1):
                if keys := wins.get(tuple(w[i : i + n])):
                    hit |= set(range(i, i + n))
                    found |= keys
        out.append((len(w), len(hit), sorted(found)))
    return out


def case(seed):
    rnd = random.Random(seed)
    vocabulary = ["a", "b", "c", "dé", "e1"]
    line = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(k, line(rnd.randint(1, 9))) for k in range(8)] + [(3, line(6)), (None, line(5)), (9, None), (10, " !! "), (11, line(4).upper())]
    docs = [line(rnd.randint(0, 40)) for _ in range(30)] + [None, "", "!!", items[0][1], f"zz {items[1][1]}, yy {items[1][1].upper()}. xx"]
    return docs, items


def test_against_brute_force(spark):
    for seed in range(4):
        docs, items = case(seed)
        df = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(docs)], DOCS)
        bench = spark.createDataFrame(items, "item_id bigint, text string")
        want = brute(docs, items, 5)
        for block in (10**6, 40):  # one automaton, several
            got = {r.doc_id: r for r in D.decontaminate(df, bench, 5, (1, 2), block).collect()}
            for k, (n, hit, found) in enumerate(want):
                r = got[k]
                assert (r.n_words, r.n_hit, r.item_ids) == (n, hit, found), (seed, block, k)
                assert r.contaminated == (hit > 0 and 2 * hit >= n) and r.other == "y"
                assert sum(s.end - s.start for s in r.spans) == hit


def test_cut(spark):
    df = spark.createDataFrame([(1, "Ça, bad words HERE! end", "", ""), (1, "Ça, bad words HERE! end", "", ""), (2, "clean", "", "")], DOCS)
    bench = spark.createDataFrame([(7, "bad words here")], "item_id bigint, text string")
    got = [(r.doc_id, r.clean_text) for r in D.decontaminate(df, bench).collect()]
    assert sorted(got) == [(1, "Ça, ! end"), (1, "Ça, ! end"), (2, "clean")]
    none = D.decontaminate(df, bench.limit(0)).collect()
    assert not any(r.contaminated for r in none) and len(none) == 3
    assert D.decontaminate(df.limit(0), bench).count() == 0


def test_long_text():
    automaton = D.ItemAutomaton([(1, [b"x"] * 13)], 13)
    spans, found = automaton.match([b"x"] * 50_000 + [b"y"] + [b"x"] * 12)
    assert spans == [(0, 50_000)] and found == {1}


def test_shared_preambles_take_linear_time():
    def seconds(n):
        items = [(k, [b"p%d" % j for j in range(40)] + [b"q%d" % (k * 7 + j) for j in range(20)]) for k in range(n)]
        start = time.process_time()
        automaton = D.ItemAutomaton(items, 13)
        took = time.process_time() - start
        spans, found = automaton.match([b"p%d" % j for j in range(40)] * 3)
        assert len(found) == n and spans == [(0, 120)]
        return took

    assert seconds(16_000) < 12 * max(seconds(4_000), 0.2)


def test_one_automaton_is_held_at_a_time(spark, monkeypatch):
    docs, items = case(1)
    alive, most = weakref.WeakSet(), []

    class Watched(D.ItemAutomaton):
        def __init__(self, items, window):
            super().__init__(items, window)
            if items:
                alive.add(self)
                gc.collect()
                most.append(len(alive))

    monkeypatch.setattr(D, "ItemAutomaton", Watched)
    made = D._blocks(spark.createDataFrame(items * 3, "item_id bigint, text string"), 5, 40)
    for automaton in made:
        del automaton
    assert len(most) > 3 and max(most) <= 2


def test_equal_short_items_are_taken_once():
    n = 100_000
    a = D.ItemAutomaton([(k, [b"a"]) for k in range(n)] + [(n, [b"a", b"b"]), (n + 1, [b"b"])], 13)
    began = time.time()
    spans, found = a.match([b"a"] * n + [b"x", b"a", b"b"])
    assert spans == [(0, n), (n + 1, n + 3)] and found == set(range(n + 2)) and time.time() - began < 5


def test_common_texts_over_several_blocks(spark, monkeypatch):
    from tidewheel.llm import shared

    monkeypatch.setattr(shared, "COMMON", 5)
    items = [(k, f"word{k} other{k} third{k}") for k in range(20)]
    texts = [items[3][1]] * 200 + [None] * 50 + [""] * 20 + [t for _, t in items] + [f"{items[1][1]} {items[7][1]}"]
    df = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], DOCS)
    want = brute(texts, items, 13)
    got = {r.doc_id: r for r in D.decontaminate(df, spark.createDataFrame(items, "item_id bigint, text string"), 13, (1, 20), 60).collect()}
    assert len(got) == len(texts) and all((got[k].n_words, got[k].n_hit, got[k].item_ids) == w for k, w in enumerate(want))
