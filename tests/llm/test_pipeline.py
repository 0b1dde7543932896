import random

import corpus_pipeline as C
from pyspark.sql import functions as F
from tidewheel.llm import bpe, decontam, jaccard, langid, quality
from tidewheel.llm.shared import written

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
EN = "the and over that with which from have water some other small river house where never people light night under".split()
DE = "der und nicht über welche mit aus haben wasser einige andere kleine fluss haus wo niemals leute licht nacht unter".split()


def make(spark, path):
    rnd = random.Random(4)
    text = lambda ws, n: " ".join(rnd.choice(ws) + str(rnd.randint(0, 99) if rnd.random() < 0.3 else "") for _ in range(n)).capitalize() + "."
    item = text(EN, 30)
    docs = []
    for k in range(200):
        lang = "en" if k % 2 else "de"
        body = text(EN if k % 2 else DE, rnd.randint(40, 90))
        if k % 5 == 0:
            body = "BUY!! NOW!! " * 20 + "| | | $$$ ***"
        docs.append((k, body, lang, "s", len(body)))
    docs += [(300, docs[1][1], "en", "s", 1), (301, docs[3][1] + " tail", "en", "s", 1), (302, item + " " + text(EN, 30), "en", "s", 1), (303, None, None, None, None), (304, "", "en", "s", 0), (305, "12345 67890", "en", "s", 0), (1, docs[1][1], "en", "s", 1)]
    spark.createDataFrame(docs, SCHEMA).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(0, 200)], "doc_id bigint, quality int").withColumn("toxic", F.lit(0)).write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_each_stage_on_its_own_input(spark, tmp_path):
    docs = make(spark, tmp_path)
    path = str(tmp_path)
    now = spark.read.parquet(f"{path}/documents.parquet")
    columns = now.columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect() if r.doc_id is not None)
    for name, stage in C.STAGES:
        after = written(stage(spark, now, path))
        if name == "quality classifier":
            model = quality.fit(now, spark.read.parquet(f"{path}/labels.parquet"))
            want = sorted(r.doc_id for r in now.collect() if model.score(quality.table([r.text]))[0] >= 0.5)
            assert ids(after) == want and not [k for k in want if k < 200 and k % 5 == 0]
        elif name == "language ID":
            model = langid.fit(now)
            rows = now.collect()
            langs, scores = model.predict([r.text for r in rows])
            assert ids(after) == sorted(r.doc_id for r, x, s in zip(rows, langs, scores) if x != "und" and s >= C.LEAST_LANGUAGE_SCORE)
            assert set(ids(after)) >= {k for k in range(200) if k % 5} and not {303, 304, 305} & set(ids(after))
        elif name == "n-gram Jaccard join":
            found = {r.doc_id: r.component_id for r in jaccard.groups(now).collect()}
            assert set(ids(after)) == {k for k, c in found.items() if k == c} and not {300, 301} & set(ids(after)) and 1 in ids(after)
        elif name == "benchmark decontamination":
            assert set(ids(now)) - set(ids(after)) == {302}
            assert decontam.decontaminate(after, spark.read.parquet(f"{path}/benchmark.parquet")).filter("contaminated").count() == 0
        else:
            assert ids(after) == ids(now) and set(after.columns) >= {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"}
            text = {r.doc_id: r.t for r in now.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("t")).collect()}
            assert all(text[r.doc_id] == r.decoded_sha256 for r in after.collect())
            continue
        assert after.columns == columns
        now = after
    assert ids(C.run(spark, path)) == ids(now)


def test_empty(spark, tmp_path):
    for name, schema in (("documents", SCHEMA), ("labels", "doc_id bigint, quality int, toxic int"), ("benchmark", "item_id bigint, text string")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert C.run(spark, str(tmp_path)).count() == 0
