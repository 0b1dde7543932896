"""Registered queries on the smallest test tables, against DuckDB where there is SQL."""

import math
import os
import zlib

import duckdb
import numpy as np
import pytest

from tidewheel.llm import html_main, langid, quality
from tidewheel.llm import queries as Q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cur = con.execute(Q.ORACLE_SQL[name])
    names = [c[0] for c in cur.description]
    want = sorted(map(str, (dict(sorted(zip(names, r))) for r in cur.fetchall())))
    got = sorted(str(dict(sorted(r.asDict().items()))) for r in Q.QUERIES[name](spark, DATA).collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE_SQL)))
def test_runs(spark, name):
    out = Q.QUERIES[name](spark, DATA)
    assert out.columns and out.count() > 0


def columns(spark, table, *names):
    return [tuple(r) for r in spark.read.parquet(f"{DATA}/{table}.parquet").select(*names).collect()]


def test_quality_equals_plain_python(spark):
    """The whole query against a fit and scores without Spark."""
    docs, labels = columns(spark, "documents", "doc_id", "text"), columns(spark, "labels", "doc_id", "quality")
    learned = {(k, q) for k, q in labels if k is not None and q in (0, 1) and zlib.crc32(str(k).encode()) % 3 != 1}
    texts = {}
    for k, t in docs:
        texts[k] = min(t, texts[k]) if texts.get(k) is not None and t is not None else t if t is not None else texts.get(k)
    rows = sorted((k, q, quality.features(texts[k]).tolist()) for k, q in learned if k in texts)
    model = quality.BradleyTerry.fit(np.array([x for _, _, x in rows]), np.array([q == 1 for _, q, _ in rows]))
    want = {k: (zlib.crc32(str(k).encode()) % 3 == 1, float(model.score(quality.table([t]))[0])) for k, t in docs}
    got = Q.QUERIES["op4_quality"](spark, DATA).collect()
    assert len(got) == len(docs)
    for r in got:
        held, score = want[r.doc_id]
        assert r.held_out == held and abs(r.score - score) < 1e-9 and r.predicted == int(r.score >= 0.5)
    said = dict(labels)
    right = [r.predicted == said[r.doc_id] for r in got if r.held_out and r.doc_id in said]
    assert len(right) > 20 and sum(right) >= 0.9 * len(right)


def test_language_equals_plain_python(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    model = langid.fit(docs)
    texts = columns(spark, "documents", "doc_id", "text", "lang")
    langs, scores = model.predict([t for _, t, _ in texts])
    want = {k: (zlib.crc32(str(k).encode()) % 4 == 2, lang, s) for (k, _, _), lang, s in zip(texts, langs, scores)}
    got = Q.QUERIES["op7_language"](spark, DATA).collect()
    assert len(got) == len(texts) and all((r.held_out, r.lang_pred) == want[r.doc_id][:2] and abs(r.score - want[r.doc_id][2]) < 1e-3 for r in got)
    known = {k: lang for k, _, lang in texts if lang is not None}
    held = [r for r in got if r.held_out and r.doc_id in known and r.lang_pred != langid.UNDETERMINED]
    assert len(held) > 20 and sum(r.lang_pred == known[r.doc_id] for r in held) >= 0.95 * len(held)


def test_main_text_equals_plain_python(spark):
    field = html_main.train()
    want = sorted((k, u or "", html_main.main_text(h, field)) for k, u, h in columns(spark, "pages", "page_id", "url", "html"))
    got = Q.QUERIES["op8_main_text"](spark, DATA).collect()
    assert sorted((r.page_id, r.url or "", r.text) for r in got) == want and all(r.n_chars == len(r.text) for r in got)


def test_whitening_equals_plain_python(spark):
    vectors = columns(spark, "embeddings", "vec_id", "embedding")
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in vectors])
    points = np.unique(x, axis=0)
    n, sums = len(points), points.sum(axis=0)
    centred = (n * points - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:16], axes[:, ::-1][:, :16]
    white = ((n * x - sums) / n) @ axes / np.sqrt(values)
    got = {(r.vec_id, r.component): r for r in Q.QUERIES["op13_whitening"](spark, DATA).collect()}
    assert len(got) == 16 * len(vectors)
    found = np.array([[got[k, c + 1].whitened for c in range(16)] for k, _ in vectors])
    sign = np.sign((found * white).sum(axis=0))
    assert np.allclose(found * sign, white, atol=1e-8) and {r.n for r in got.values()} == {n} and max(r.identity_error for r in got.values()) < 1e-8
    assert all(got[k, 1].deviation == int(((n * p - sums) ** 2).sum()) for (k, _), p in zip(vectors, x))
    assert all(abs(got[k, c + 1].explained / (values[c] / np.trace(centred.T @ centred / n)) - 1) < 1e-9 for k, _ in vectors[:3] for c in range(16))
