import zlib

import numpy as np

from tidewheel.llm import quality as Q

GOOD = "The quick brown fox jumps over a lazy dog near the river bank, and then number {} walks home."
BAD = "BUY!! NOW!! BUY!! NOW!! {} | | | $$$ *** BUY!!"


def tables(spark, n=240):
    docs = [(k, (BAD if k % 4 == 0 else GOOD).format(k * 7919), "en") for k in range(n)]
    return spark.createDataFrame([(*d, 0.3) for d in docs], "doc_id bigint, text string, lang string, score double"), spark.createDataFrame([(k, int(k % 4 > 0)) for k in range(n)], "doc_id bigint, quality int")


def test_held_out_accuracy(spark):
    docs, labels = tables(spark)
    out = Q.judged(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    held = [r for r in out if r.held_out]
    assert len(held) > 40 and all(r.predicted == int(r.doc_id % 4 > 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_odd_rows(spark):
    docs, labels = tables(spark)
    more = spark.createDataFrame([(None, None, None, None), (10**6, "", "x", 1.0), (10**6, "", "x", 1.0), (7, "w " * 200_000, None, None)], docs.schema)
    out = Q.judged(docs.unionByName(more), labels.unionByName(spark.createDataFrame([(None, 1), (5, None), (6, 3), (10**7, 0)], labels.schema))).collect()
    assert len(out) == 244 and all(r.score is not None and r.predicted in (0, 1) for r in out)
    twice = [r.score for r in out if r.doc_id == 10**6]
    assert twice[0] == twice[1]
    kept = Q.classify(more, Q.fit(docs, labels))
    assert kept.columns == ["doc_id", "text", "lang", "score", "predicted"]


def test_without_labels(spark):
    docs, labels = tables(spark, 20)
    for none in (labels.limit(0), labels.filter("quality = 1")):
        out = Q.judged(docs, none).collect()
        assert len(out) == 20 and {(r.score, r.predicted) for r in out} == {(0.5, 1)}
    assert Q.judged(docs.limit(0), labels).count() == 0


def test_pairwise_fit_orders():
    draw = np.random.default_rng(0)
    x = draw.normal(size=(400, Q.FEATURES))
    good = x[:, 3] + 0.5 * x[:, 5] > 0.8
    model = Q.BradleyTerry.fit(x, good)
    assert ((model.score(x) >= 0.5) == good).mean() > 0.97
