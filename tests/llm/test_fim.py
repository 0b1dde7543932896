import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidewheel.llm import fim

MARKS = re.compile("<[PSM]>")


def brute(key, text):
    text = text or ""
    n = len(text)
    h = hashlib.sha256(f"1:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or MARKS.search(text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h4 % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def test_against_brute_force(spark):
    rnd = random.Random(3)
    alphabet = "ab <\n\tPSM>éß中文😀́\x00"
    texts = ["".join(rnd.choice(alphabet) for _ in range(rnd.choice((0, 1, 2, 5, 40, 300)))) for _ in range(400)]
    texts += [None, "", "😀" * 30_000, "x" * 100_000, "<P", "P>", "<P>", "a<S>b", "<" * 50, "é" * 4096]
    rows = [(k, t, "mine", k * 2) for k, t in enumerate(texts)] + [(None, "no key", "mine", 0), (5, texts[5], "mine", 10)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, form string, other int")
    out = fim.transform(df).withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(out.collect(), key=lambda r: str((r.doc_id, r.other)))
    assert out.columns == ["doc_id", "text", "other", "n", "form", "prefix_units", "middle_units", "output", "back"] and len(got) == len(rows)
    for r in got:
        assert (r.n, r.form, r.prefix_units, r.middle_units, r.output) == brute(r.doc_id, r.text)
        assert r.back == (r.text or "")
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_chunks_own_their_cuts():
    rnd = np.random.default_rng(5)
    units = {"char": lambda t: [m.start() for m in re.finditer(r"(?s).", t)], "word": lambda t: [0] + [m.start() for m in re.finditer(r"(?<=[ \t\n])[^ \t\n]", t)], "line": lambda t: [0] + [m.end() for m in re.finditer("\n", t) if m.end() < len(t)]}
    texts = ["".join(rnd.choice(list("ab \té中😀\n"), rnd.integers(1, 60))) for _ in range(60)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    sizes = np.array([len(t.encode()) for t in texts])
    ends = np.cumsum(sizes)
    draws = rnd.integers(0, 1 << 32, (len(texts), 2))
    for unit, starts_of in units.items():
        for chunk in (1, 3, 7, 4096):
            got = fim.cuts(data, ends - sizes, ends, draws, unit, chunk)
            for t, d, (n, low, high, low_byte, high_byte) in zip(texts, draws, got.tolist()):
                at = [len(t[:x].encode()) for x in sorted(set(starts_of(t)))] + [len(t.encode())]
                assert n == len(at) - 1 and [low, high] == sorted(int(x) % (n + 1) for x in d)
                assert (low_byte, high_byte) == (at[low], at[high])


def test_words_and_empty_tables(spark):
    df = spark.createDataFrame([(k, f"one two{' ' * (k % 3)} three\nfour") for k in range(60)], "id int, body string")
    got = fim.transform(df, "id", "body", unit="word", transformed=100, suffix_first=0).collect()
    for r in got:
        assert r.n == 4 and r.form == "psm"
        pre, suf, mid = MARKS.split(r.output)[1:]
        assert pre + mid + suf == r.body and len(pre.split()) == r.prefix_units and len(mid.split()) == r.middle_units
    none = fim.digests(fim.transform(spark.createDataFrame([], "doc_id bigint, text string")))
    assert none.count() == 0 and none.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
