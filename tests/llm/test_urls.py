import random
import re

from pyspark.sql import functions as F

from tidewheel.llm import shared as S
from tidewheel.llm import urls as U
from tidewheel.llm.queries import URL_RULES


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:k], rest[k:]
    k = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), rest[:k]


def rule(host, path):
    hits = [(len(h + p), h + p, v) for v, h, p in URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(hits)[1:] if hits else (None, None)


URLS = [None, "", "no scheme", "http://", "http://EXAMPLE.com/en/x", "http://www.example.com/en/", "https://a.b.net/es/1?x://y", "http://net/fr/", "http://notnet/fr/", "http://x.com", "http://x.com/", "http://x.org/fr/3#a",
        "http://É.com/Ü", "a://b://c.com/q", "http://h.net\n/fr/z", "http://example.com/en", "http://x.com/" + "s/" * 5000, "http://x.com?/en/", "://.com/", "http://xcom/"]


def test_rules_and_parts(spark):
    df = spark.createDataFrame([(k, u, "mine") for k, u in enumerate(URLS)] + [(None, URLS[4], "mine")], "page_id bigint, url string, verdict string")
    out = {r.page_id: r for r in U.judge(df, URL_RULES).collect()}
    assert len(out) == len(URLS) + 1
    for k, u in enumerate(URLS):
        host, path = parts(u)
        name, verdict = rule(host, path)
        r = out[k]
        assert (r.host, r.path, r.rule) == (host, path, name), u
        assert r.verdict == verdict if verdict else r.verdict in ("allow", "block")


def test_template_tree(spark):
    rnd = random.Random(1)
    rows = []
    for k in range(1200):
        host = rnd.choice(["a.net", "b.net", "a.net", "b.net", "c.org", "x.com"])
        lang = rnd.choice(["en", "fr", "es", "de"])
        rows.append((k, f"http://{host}/{lang}/{rnd.randint(1, 9999)}"))
    out = U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), URL_RULES).collect()
    for r in out:
        lang = r.path.split("/")[1]
        if r.host == "c.org":  # no rule speaks of it: the template's purity over all hosts does
            assert (r.verdict == "block") == (lang in ("fr", "es")), r
    none = U.judge(spark.createDataFrame(rows[:50], "page_id bigint, url string"), []).collect()
    assert {r.verdict for r in none} == {"allow"} and {r.rule for r in none} == {None}
    assert U.judge(spark.createDataFrame([], "page_id bigint, url string"), URL_RULES).count() == 0


def test_variable_segments(spark):
    df = spark.createDataFrame([("/a/12/b",), ("",), ("//x//",), ("/" + "y" * 30,), ("/1/2/3/4/5/6/7/8/9/10",)], "p string")
    got = [r.t for r in df.select(U.template(F.col("p")).alias("t")).collect()]
    assert got == [["a", "*", "b"], [], ["x"], ["*"], ["*"] * 10]


def test_many_small_sections(spark):
    counts = spark.createDataFrame([("h", [f"s{k}"], 40, 40 if k == 0 else 0, 40) for k in range(30)], "host string, first array<string>, n bigint, blocked bigint, labelled bigint")
    got = {r.first[0]: (r.template, r.n) for r in U.tree(counts).collect()}
    assert got == {"s0": (["s0"], 40), **{f"s{k}": (["*"], 1160) for k in range(1, 30)}}


def test_deep_sections(spark):
    deep = "/a" * 11
    rules = [("block", "h.net", deep + "/x/"), ("allow", "h.net", "/")]
    rows = [(k, f"http://h.{('net', 'net', 'org')[k % 3]}{deep}/{'xy'[k % 2]}/{k}") for k in range(240)]
    for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), rules).collect():
        assert r.verdict == ("block" if r.path.startswith(deep + "/x/") else "allow"), r


def brute_tree(counts, z=2.0):
    """The tree by recursion over one host: template as given -> generalised; counts: first -> (n, blocked, labelled)."""
    out = {}

    def descend(rows, level, done):
        """rows: template so far -> the ones as given that stand for it; level: the segment to decide."""
        deep = {}
        for first, t in rows.items():
            if len(t) < level:
                out[first] = t
            else:
                deep.setdefault(t[: level - 1], {})[first] = t
        for prefix, group in deep.items():
            blocked = sum(counts[f][1] for f in group)
            labelled = sum(counts[f][2] for f in group)
            if not (len(group) > 1 and 0 < blocked < labelled and labelled > z * z):
                out.update({f: prefix + ("*",) * (len(t) - level + 1) for f, t in group.items()})
                continue
            own = {}
            for f, t in group.items():
                b, n = own.get(t[level - 1], (0, 0))
                own[t[level - 1]] = b + counts[f][1], n + counts[f][2]
            nxt = {}
            for f, t in group.items():
                b, n = own[t[level - 1]]
                rest = labelled - n
                stays = False
                if n and rest:
                    pooled, inverse = blocked / labelled, 1 / n + 1 / rest
                    stays = abs(b / n - (blocked - b) / rest) - inverse / 2 > z * (pooled * (1 - pooled) * inverse) ** 0.5
                nxt[f] = t if stays else prefix + ("*",) + t[level:]
            descend(nxt, level + 1, done)

    descend({f: f for f in counts}, 1, out)
    return out


def test_tree_against_brute_force(spark, monkeypatch):
    rnd = random.Random(8)
    rows, want = [], {}
    for host in ("a", "b", "c", "d"):
        counts = {}
        for _ in range(rnd.randint(5, 60)):
            first = tuple(rnd.choice(["x", "y", "z", "w", "*"]) for _ in range(rnd.randint(0, 4)))
            n = rnd.randint(1, 60)
            labelled = rnd.choice([0, n, n // 2])
            lean = 0.9 if first[:1] == ("x",) else 0.5 if first[1:2] == ("y",) else 0.1
            counts[first] = n, sum(rnd.random() < lean for _ in range(labelled)), labelled
        found = brute_tree(counts)
        whole = {}
        for f, t in found.items():
            whole[t] = [a + b for a, b in zip(whole.get(t, (0, 0, 0)), counts[f])]
        want |= {(host, f): (t, *whole[t]) for f, t in found.items()}
        rows += [(host, list(f), *c) for f, c in counts.items()]
    df = spark.createDataFrame(rows, "host string, first array<string>, n bigint, blocked bigint, labelled bigint")
    for common in (1000, 2):
        monkeypatch.setattr(S, "COMMON", common)  # then most keys are common ones
        got = {(r.host, tuple(r["first"])): (tuple(r.template), r.n, r.blocked, r.labelled) for r in U.tree(df).collect()}
        assert got == want
    assert any("*" in t and any(s != "*" for s in t) for t, *_ in want.values()) and len({t for t, *_ in want.values()}) > 8


def test_verdicts_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "COMMON", 20)
    rnd = random.Random(5)
    rows = []
    for k in range(1500):
        host = rnd.choice(["a.net", "a.net", "a.net", "b.com", "c.org", "d.org", "www.example.com"])
        rows.append((k, f"http://{host}/" + "/".join(rnd.choice(["fr", "es", "en", "news", "page", "7"]) for _ in range(rnd.randint(0, 3)))))
    counts, total = {}, [0, 0]
    for _, u in rows:
        host, path = parts(u)
        first = tuple("*" if re.search(r"\d", s) or len(s) > U.LONG else s for s in path.split("/") if s)
        verdict = rule(host, path)[1]
        for h in (host, U.ALL_HOSTS):
            c = counts.setdefault(h, {}).setdefault(first, [0, 0, 0])
            c[0] += 1
            c[1] += verdict == "block"
            c[2] += verdict is not None
        total[0] += verdict == "block"
        total[1] += verdict is not None
    sums, templates = {}, {h: brute_tree(c) for h, c in counts.items()}
    for h, found in templates.items():
        for f, t in found.items():
            sums[h, t] = [a + b for a, b in zip(sums.get((h, t), (0, 0, 0)), counts[h][f])]
    smooth = lambda h, f, towards: (sums[h, templates[h][f]][1] + 4 * towards) / (sums[h, templates[h][f]][2] + 4)
    out = {r.page_id: r for r in U.judge(spark.createDataFrame(rows, "page_id bigint, url string"), URL_RULES).collect()}
    for k, u in rows:
        host, path = parts(u)
        first = tuple("*" if re.search(r"\d", s) or len(s) > U.LONG else s for s in path.split("/") if s)
        purity = smooth(host, first, smooth(U.ALL_HOSTS, first, total[0] / total[1]))
        assert abs(out[k].purity - purity) < 1e-9 and out[k].template == "/" + "/".join(templates[host][first])
        assert out[k].verdict == (rule(host, path)[1] or ("block" if purity >= 0.5 else "allow"))


def test_a_deep_trap_takes_few_tables(spark, monkeypatch):
    made = []
    real = U.written
    monkeypatch.setattr(U, "written", lambda df: made.append(1) or real(df))
    counts = {}
    for k in range(1, 300):  # a page at every depth, under both verdicts, with two branches far below
        counts[("in",) + ("next",) * k] = 40, 20, 40
    for side, blocked in (("l", 40), ("r", 0)):
        for k in range(3):
            counts[("in",) + ("next",) * 150 + (side,) + ("deep",) * k] = 40, blocked, 40
    df = spark.createDataFrame([("h", list(f), *c) for f, c in counts.items()], "host string, first array<string>, n bigint, blocked bigint, labelled bigint")
    got = {tuple(r["first"]): tuple(r.template) for r in U.tree(df).collect()}
    assert len(made) < 20 and got == brute_tree(counts)
    assert got[("in",) + ("next",) * 150 + ("l", "deep")][151] == "l" and got[("in",) + ("next",) * 299] == ("*",) * 300
