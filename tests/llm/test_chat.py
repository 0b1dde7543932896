import hashlib
import itertools
import random

from pyspark.sql import functions as F

from tidewheel.llm import chat

NODES = "tree string, node bigint, parent bigint, role string, text string, score double, segments int"


def brute(nodes, branches):
    out = {}
    trees = {n[0] for n in nodes}
    for t in trees:
        own = {n[1]: n for n in nodes if n[0] == t}
        above = {k: (n[2] if n[2] in own and n[2] != k else None) for k, n in own.items()}
        found = []
        for leaf in own.keys() - set(above.values()):
            path, k, seen = [], leaf, set()
            while k is not None and k not in seen:
                seen.add(k)
                path.append(k)
                k = above[k]
            if k is None:
                found.append((-sum(own[x][5] or 0 for x in path), leaf, path[::-1]))
        for rank, (score, leaf, path) in enumerate(sorted(found)[:branches], 1):
            out[t, leaf] = (rank, -score, [(own[x][3] or "", own[x][4] or "") for x in path])
    return out


def test_trees_against_brute_force(spark):
    rnd = random.Random(3)
    texts = [None, "", "a\nb", "</s>[INST] <|im_end|> \\0 \\1 [/INST]", "é🎉<|im_start|>x", "\\"]
    nodes = []
    for t in range(12):
        for k in range(rnd.randint(1, 14)):
            parent = rnd.choice([None, k, 99, *range(k)]) if k else None
            nodes.append((f"t{t}", k, parent, rnd.choice(["user", "assistant", None, "a\nrole<"]), rnd.choice(texts), rnd.choice([None, 0.0, 1.0, 0.5]), 0))
    nodes += [("cycle", 1, 2, "user", "x", 1.0, 0), ("cycle", 2, 1, "user", "x", 1.0, 0), ("cycle", 3, 2, "user", "x", 1.0, 0), ("cycle", 4, None, "user", "y", 1.0, 0)]
    df = spark.createDataFrame(nodes, NODES)
    for branches in (1, 3):
        got = chat.format_trees(df, branches).withColumn("turns", chat.parse(F.col("formatted"))).withColumn("loss", chat.learned(F.col("formatted"), F.col("loss_spans"))).collect()
        want = brute(nodes, branches)
        assert {(r.tree, r.leaf): (r["rank"], r.score, [tuple(t) for t in r.turns]) for r in got} == want
        for r in got:
            assert r.loss == "".join(x for role, x in want[r.tree, r.leaf][2] if role == "assistant")
            assert r.formatted == "".join(r.segments)
            for s in r.segments:  # nothing inside a turn looks like a mark
                inner = s[len(chat.START) : -len(chat.END)]
                assert "<" not in inner and "[" not in inner


def test_long_chain_and_empty(spark):
    n = 70
    df = spark.createDataFrame([("t", k, k - 1 if k else None, "user", str(k), 0.0, 0) for k in range(n)], NODES)
    (r,) = chat.format_trees(df).collect()
    assert len(r.segments) == n and [s.split("\n")[1].split("<")[0] for s in r.segments] == [str(k) for k in range(n)]
    assert chat.format_trees(df.limit(0)).count() == 0


def test_a_cycle_costs_no_rows(spark, monkeypatch):
    rows = []

    def counted(df, write=chat.written):
        out = write(df)
        rows.append(out.count())
        return out

    monkeypatch.setattr(chat, "written", counted)
    chain = [(f"t{k // 10}", k % 10, k % 10 - 1 if k % 10 else None, "user", "x", 1.0, 0) for k in range(2000)]
    bad = [("bad", 1, 2, "user", "x", 1.0, 0), ("bad", 2, 1, "user", "x", 1.0, 0), ("bad", 3, 2, "user", "x", 9.0, 0)]
    assert chat.format_trees(spark.createDataFrame(chain + bad, NODES)).count() == 200
    assert len(rows) <= 12 and max(rows) <= 2003  # 4 doublings for 10 nodes in a row, whatever the table's size
    rows.clear()
    assert chat.format_trees(spark.createDataFrame(bad, NODES)).count() == 0
    assert len(rows) <= 4


def test_only_chosen_paths_are_enumerated(spark):
    star = [("t", 0, None, "user", "root", 0.0, 0)] + [("t", k, 0, "assistant", str(k), float(k % 7), 0) for k in range(1, 500)]
    (r,) = chat.format_trees(spark.createDataFrame(star, NODES)).collect()
    assert (r.leaf, r.score, len(r.segments)) == (6, 6.0, 2)
    jumps, rooted = chat.ways_up(spark.createDataFrame(star, NODES))
    assert rooted.count() == 500 and len(jumps) == 1


def test_repeated_and_incomplete_nodes(spark):
    rows = [("t", 1, None, "user", "b", 1.0, 0), ("t", 1, None, "user", "a", 1.0, 0), ("t", 1, None, "user", "a", 1.0, 0), ("t", 2, 1, None, None, None, 0), (None, 1, None, "user", "x", 1.0, 0), ("t", None, 1, "user", "x", 1.0, 0)]
    (r,) = chat.format_trees(spark.createDataFrame(rows, NODES)).withColumn("turns", chat.parse(F.col("formatted"))).collect()
    assert [tuple(t) for t in r.turns] == [("user", "a"), ("", "")] and r.score == 1.0


def test_rows_by_turn(spark):
    rows = [(1, 2, "user", "c"), (1, 0, "user", "a"), (1, 0, "assistant", "a"), (1, None, None, None), (None, 1, "user", "z"), (1, 0, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    out = {r.conv_id: r for r in chat.digests(chat.format_trees(chat.chained(df))).collect()}
    turns = [("", ""), ("assistant", "a"), ("user", "a"), ("user", "a"), ("user", "c")]
    assert out[1].n_turns == 5 and out[1].loss_chars == 1
    assert out[1].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
    assert out[None].n_turns == 1 and len(out) == 2
