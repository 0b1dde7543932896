"""From raw documents to token ids: quality, language, near-duplicates, decontamination, encoding.

Each stage is a function of (spark, docs, sf_dir) that reads all rows of its predecessor and returns
a DataFrame; run() writes each one's result as Parquet in the shared folder and rereads it for the
next. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm import bpe, decontam, jaccard, langid, quality
from tidewheel.llm.shared import read, written

#: A text whose language is this unclear (0.5 is a tie between two languages) is rejected.
LEAST_LANGUAGE_SCORE = 0.52


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose predicted quality is 1."""
    model = quality.fit(docs, read(spark, sf_dir, "labels"))
    return quality.classify(docs, model).filter("predicted = 1").select(docs.columns)


def accept_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows with a letter whose language is clear."""
    found = langid.identify(docs, langid.fit(docs))
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_LANGUAGE_SCORE)).select(docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The row with the smallest doc_id of each group of near-duplicates."""
    return jaccard.first_of_each(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that aren't contaminated by benchmark items; a contaminated row goes as a whole."""
    found = decontam.decontaminate(docs, read(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every row (the round trip of op1)."""
    vocabulary = bpe.Vocabulary.load(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    return bpe.digests(bpe.round_trip(docs, vocabulary))


STAGES = [
    ("quality classifier", accept_quality),
    ("language ID", accept_language),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", without_benchmark),
    ("byte-level BPE encoding and decoding", encoded),
]

#: SQL can't express the two learned classifiers; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table documents."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
