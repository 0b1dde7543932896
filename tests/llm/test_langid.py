import random
import zlib

from tidewheel.llm import langid as L

WORDS = {"en": "the and thing over with which that from have water".split(), "de": "der und nicht über schön welche mit aus haben wasser".split(), "fr": "les été dans avec quelle être pour eaux nous très".split()}


def rows(n=300, seed=2):
    rnd = random.Random(seed)
    out = []
    for k in range(n):
        lang = rnd.choice(list(WORDS))
        out.append((k, " ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(3, 40))), lang, "s"))
    return out


SCHEMA = "doc_id bigint, text string, lang string, score string"


def test_held_out_accuracy(spark):
    data = rows()
    out = {r.doc_id: r for r in L.identified(spark.createDataFrame(data, SCHEMA)).collect()}
    held = [d for d in data if zlib.crc32(str(d[0]).encode()) % 4 == 2]
    assert len(held) > 50 and all(out[d[0]].held_out for d in held)
    assert sum(out[d[0]].lang_pred == d[2] for d in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_odd_rows(spark):
    more = [(1000, None, "en", None), (1001, "", None, None), (1002, "123 !? ½² Ⅷ", "fr", None), (1003, "DER UND NICHT " * 50_000, None, None), (1003, "der und nicht", None, None), (None, "the and over thing", None, None), (1004, "日本", None, None)]
    df = spark.createDataFrame(rows() + more, SCHEMA)
    out = L.identified(df).collect()
    assert len(out) == 307
    by = {r.doc_id: r for r in out}
    assert all(by[k].lang_pred == L.UNDETERMINED and by[k].score == 0 for k in (1000, 1001, 1002))
    assert {r.lang_pred for r in out if r.doc_id == 1003} == {"de"} and by[None].lang_pred == "en" and by[1004].lang_pred in WORDS
    kept = L.identify(df, L.fit(df))
    assert kept.columns == ["doc_id", "text", "lang", "score", "lang_pred"] and kept.count() == 307


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "some text", None, ""), (2, None, "en", "")], SCHEMA)
    assert {(r.lang_pred, r.score) for r in L.identified(df).collect()} == {("und", 0.0)}
    assert L.identified(df.limit(0)).count() == 0
    one = spark.createDataFrame([(k, "only english here", "en", "") for k in range(20)], SCHEMA)
    assert {r.lang_pred for r in L.identified(one).collect()} == {"en"}


def test_kernel_is_the_mean_cosine_of_presence():
    texts = ["abc abd", "Abc!", "zzz"]

    def sets(t):
        t = " " + " ".join(L._LETTERS.findall(t.lower())) + " "
        return [{t[i : i + n] for i in range(len(t) - n + 1)} for n in (1, 2, 3)]

    k = L.Landmarks(texts).kernel(texts)
    for i, a in enumerate(texts):
        for j, b in enumerate(texts):
            want = sum(len(x & y) / (len(x) * len(y)) ** 0.5 for x, y in zip(sets(a), sets(b))) / 3
            assert abs(k[i, j] - want) < 1e-5


def test_many_languages_are_bounded(spark):
    rnd = random.Random(4)
    data = [(k, " ".join(f"{chr(97 + g % 26)}{chr(97 + g // 26)}{rnd.choice('aeiou')}" for _ in range(8)), f"l{g}", "") for k in range(2400) for g in [k % 300]]
    model = L.fit(spark.createDataFrame(data, SCHEMA), sample=600, marks=100)
    assert 200 <= len(model.languages) <= 300 and 50 <= model.landmarks.n <= 160
    text_ids = spark.createDataFrame([(str(k), t, g, s) for k, t, g, s in rows()], "doc_id string, text string, lang string, score string")
    assert {r.lang_pred for r in L.identified(text_ids).collect()} == set(WORDS)


def test_sparse_and_dense_parts_agree(monkeypatch):
    rnd = random.Random(9)
    texts = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(rnd.randint(1, 60))) for _ in range(30)] + ["", None, "1"]
    got = []
    for dense in (0, 8, 1000):  # all sparse, both, all dense
        monkeypatch.setattr(L, "DENSE", dense)
        marks = L.Landmarks([t for t in texts[:20]])
        got.append(marks.kernel(texts))
    assert abs(got[0] - got[1]).max() < 1e-6 and abs(got[2] - got[1]).max() < 1e-6


def test_one_id_with_many_texts_counts_once(spark):
    many = [(7, f"the and over {'x' * (k % 9)} {k}", "en", "") for k in range(500)]
    assert len(L.fit(spark.createDataFrame(rows() + many, SCHEMA)).languages) == 3


def test_fit_needs_no_plain_python_workers(spark, monkeypatch):
    df = spark.createDataFrame(rows(), SCHEMA).localCheckpoint()

    def refused(*_, **__):
        raise AssertionError("rows from the driver start a second set of Python workers on the executors")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert len(L.fit(df).languages) == 3
